"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. Partition values must stay strings: with inference on,
# ``month=03`` is read as the number 3 and a rewrite makes a second directory.
# Forced skew handling lets the adaptive planner split a hot join key even where
# that costs one more exchange. The smaller floor keeps all cores busy on small inputs;
# large ones are governed by the advisory partition size: its compressed rows are several times
# as many bytes in a task's sorts and windows.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session somebody else created."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "tipoff", **conf: str) -> SparkSession:
    """Create (or reuse) a session; cluster sizing stays with ``spark-submit``."""
    builder = SparkSession.builder.appName(app)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: executors of
    a cluster could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tipoff-")
    return f"{root.rstrip('/')}/tipoff-{uuid.uuid4().hex}"


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(values: dict[str, str], *sessions: SparkSession) -> Iterator[None]:
    """Runtime settings of sessions, put back at the end."""
    before = [(s, k, s.conf.get(k, None)) for s in sessions for k in values]
    try:
        for s, k, _ in before:
            s.conf.set(k, values[k])
        yield
    finally:
        for s, k, value in reversed(before):
            s.conf.unset(k) if value is None else s.conf.set(k, value)


def released_shuffles(*sessions: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of a statement run inside go when it ends, not when the driver collects garbage.

    For jobs that store each step: a frame run twice would shuffle again.
    """
    return settings({RELEASE: "true"}, *sessions)


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = path or shared_dir(spark)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
