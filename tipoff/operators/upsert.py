"""Hash-checked upsert into partitioned Parquet, and insert-if-absent.

A batch is merged at once and gives what applying its records one by one, in
``created_at`` order, would give:

* key not stored                      -> insert
* stored hash equal, one content seen -> unchanged, the stored row keeps its time
* anything else (also an empty hash)  -> update; all stored rows of the key go

Payload text is left out of every step that decides; it is read once, for the keys
that change. Only partitions with a change are rewritten. Their full new content is
staged first and then swapped in, so a run that dies can be replayed by the next one.
One writer per table at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tipoff.operators.ids import greatest_id, with_sequential_id
from tipoff.operators.latest import first_per_key
from tipoff.session import materialize
from tipoff.sources import files
from tipoff.sources.bronze import TableSpec, in_partitions, read_table

RANK = ("created_at", "content_hash", "source_url", "parameters")


def _rank() -> Column:
    return F.struct(*RANK)


def batch_results(meta: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, the record a serial application of the batch ends with.

    That is the first record of the last run of equal hashes: repeats of a content do
    not replace it. ``single`` tells that the batch holds one content only. All groups
    are reduced on the map side first; no key's records are gathered.
    """
    contents = meta.groupBy(*keys, "content_hash").agg(
        F.min(_rank()).alias("first"), F.max(_rank()).alias("last")
    )
    newest = Window.partitionBy(*keys).orderBy(F.desc("last"))
    top_two = contents.withColumn("_pos", F.row_number().over(newest)).where("_pos <= 2")
    ends = top_two.groupBy(*keys).agg(
        F.max(F.when(F.col("_pos") == 1, F.struct("content_hash", "first", "last"))).alias("top"),
        F.max(F.when(F.col("_pos") == 2, F.col("last"))).alias("cut"),
    )
    ends = ends.select(*keys, "top.*", "cut")

    # A content that came, went and came back: its run starts after the other content.
    returned = ends.where(F.col("first") < F.col("cut")).select(*keys, "content_hash", "cut")
    restarts = (
        meta.join(returned, [*keys, "content_hash"])
        .where(_rank() > F.col("cut"))
        .groupBy(*keys)
        .agg(F.min(_rank()).alias("restart"))
    )
    rank = F.when(F.col("content_hash") == "", F.col("last")).otherwise(
        F.coalesce("restart", "first")
    )
    return ends.join(restarts, keys, "left").select(
        *keys, rank.alias("rank"), F.col("cut").isNull().alias("single")
    )


def _group(spec: TableSpec) -> list[str]:
    """Key and partition columns; partition values depend on the key alone."""
    return list(dict.fromkeys([*spec.keys, *spec.partitions]))


def decide(meta: DataFrame, stored: DataFrame, spec: TableSpec) -> DataFrame:
    """The action per incoming key, with the partition it lives in. No payload columns."""
    group = _group(spec)
    found = batch_results(meta, group)
    held = stored.groupBy(*group).agg(
        F.min(F.struct("created_at", "content_hash")).alias("_held")
    )
    new_hash = F.col("rank.content_hash")
    old_hash = F.col("_held.content_hash")
    action = (
        F.when(F.col("_held").isNull(), "insert")
        .when(F.col("single") & (old_hash != "") & (old_hash == new_hash), "unchanged")
        .otherwise("update")
    )
    return found.join(held, group, "left").select(
        *group,
        action.alias("action"),
        old_hash.alias("old_hash"),
        new_hash.alias("content_hash"),
        F.col("rank.created_at").alias("created_at"),
        F.struct(
            F.col("rank.source_url").alias("source_url"), F.col("rank.parameters").alias("parameters")
        ).alias("request"),
    )


def _chosen_records(incoming: DataFrame, changed: DataFrame, spec: TableSpec) -> DataFrame:
    """Full incoming rows of the decided records; identical copies collapse to one.

    Join and deduplication use the same columns: payloads are shuffled once, or not at
    all for the join where few keys changed and their list is broadcast.
    """
    group = _group(spec)
    identity = list(dict.fromkeys([*group, *RANK]))
    request = [f"request.{c}" for c in ("source_url", "parameters") if c not in group]
    wanted = changed.select(*group, "created_at", "content_hash", *request)
    return incoming.join(wanted, identity, "left_semi").dropDuplicates(identity)


def _write(df: DataFrame, path: str, spec: TableSpec) -> None:
    """Write a new directory tree. Rebalancing splits a large partition over tasks."""
    (
        df.select(*spec.schema.names)
        .hint("rebalance", *spec.partitions)
        .write.option("compression", "zstd")
        .partitionBy(*spec.partitions)
        .parquet(path)
    )


def _stage(root: str, spec: TableSpec, run: str = "") -> str:
    return f"{root.rstrip('/')}/_stage/{spec.name}/{run}".rstrip("/")


def _outcomes(root: str, spec: TableSpec) -> str:
    return f"{root.rstrip('/')}/_outcomes/{spec.name}"


def _finish(spark: SparkSession, root: str, spec: TableSpec, run: str) -> None:
    """Swap staged rows into the table, record the outcome, retire the stage. Repeatable."""
    stage = _stage(root, spec, run)
    if files.exists(spark, f"{stage}/rows/_SUCCESS"):
        # Whole partition directories change places: no data is written twice. A partition
        # missing here was moved before an interruption.
        for partition in files.leaf_directories(spark, f"{stage}/rows", len(spec.partitions)):
            files.replace(spark, f"{stage}/rows/{partition}", f"{spec.path(root)}/{partition}")
    decided = spark.read.schema(outcome_schema(spec)).parquet(f"{stage}/decided")
    decided.write.mode("overwrite").parquet(f"{_outcomes(root, spec)}/run={run}")
    files.delete(spark, stage)


def recover(spark: SparkSession, root: str, spec: TableSpec) -> list[str]:
    """Finish runs that died after their rows were complete, drop the rest.

    Returns the finished runs. A dropped run has not touched the table.
    """
    finished = []
    for run in files.subdirectories(spark, _stage(root, spec)):
        stage = _stage(root, spec, run)
        staged = files.exists(spark, f"{stage}/rows/_SUCCESS")
        loaded = files.exists(spark, f"{stage}/_FIRST_LOAD") and files.exists(
            spark, f"{spec.path(root)}/_SUCCESS"
        )
        if staged or loaded:
            _finish(spark, root, spec, run)
            finished.append(run)
        else:
            files.delete(spark, stage)
    return finished


def upsert(
    spark: SparkSession, root: str, spec: TableSpec, incoming: DataFrame, run: str | None = None
) -> DataFrame:
    """Merge prepared bronze rows into ``root/<table>``; returns one outcome row per key.

    The outcome is a stored table below ``root/_outcomes``: the change feed of later
    jobs. Repeating a committed ``run`` changes nothing and returns its outcome. A
    stored file that cannot be read fails the run before anything is replaced.
    """
    run = run or uuid.uuid4().hex
    stage = _stage(root, spec, run)
    recover(spark, root, spec)
    if files.exists(spark, f"{_outcomes(root, spec)}/run={run}/_SUCCESS"):
        return read_outcomes(spark, root, spec, run)

    # Keys, times and hashes of the batch: payloads are read and hashed once.
    meta = materialize(incoming.select(*dict.fromkeys([*_group(spec), *RANK])), f"{stage}/meta")
    # Touched partitions: a few values per batch (calendar months or hash buckets).
    touched = [tuple(r) for r in meta.select(*spec.partitions).distinct().collect()]
    stored = in_partitions(read_table(spark, root, spec), spec, touched)
    decided = materialize(decide(meta, stored, spec), f"{stage}/decided")

    changed = decided.where(F.col("action") != "unchanged")
    rewritten = [tuple(r) for r in changed.select(*spec.partitions).distinct().collect()]
    if rewritten:
        new_rows = _chosen_records(incoming, changed, spec)
        if files.exists(spark, spec.path(root)):
            kept = in_partitions(read_table(spark, root, spec), spec, rewritten).join(
                changed.select(*_group(spec)), _group(spec), "left_anti"
            )
            new_rows = kept.unionByName(new_rows, allowMissingColumns=True)
            _write(new_rows, f"{stage}/rows", spec)
        else:
            # A first load replaces nothing: one write, committed by Spark.
            files.touch(spark, f"{stage}/_FIRST_LOAD")
            _write(new_rows, spec.path(root), spec)
    _finish(spark, root, spec, run)
    return read_outcomes(spark, root, spec, run)


def outcome_schema(spec: TableSpec) -> str:
    group = ", ".join(f"{c} string" for c in _group(spec))
    return (
        f"{group}, action string, old_hash string, content_hash string, created_at timestamp, "
        "request struct<source_url: string, parameters: string>"
    )


def read_outcomes(
    spark: SparkSession, root: str, spec: TableSpec, run: str | None = None
) -> DataFrame:
    """Recorded outcomes of a table, one row per (run, key); of one run when given."""
    schema = f"{outcome_schema(spec)}, run string"
    base = _outcomes(root, spec)
    if not files.exists(spark, base):
        return spark.createDataFrame([], schema)
    path = f"{base}/run={run}" if run else base
    return spark.read.schema(schema).option("basePath", base).parquet(path)


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Counts per run: inserted, updated, unchanged, total."""
    return outcomes.groupBy("run").agg(
        F.count_if(F.col("action") == "insert").alias("inserted"),
        F.count_if(F.col("action") == "update").alias("updated"),
        F.count_if(F.col("action") == "unchanged").alias("unchanged"),
        F.count(F.lit(1)).alias("keys"),
    )


def absent_rows(
    incoming: DataFrame, existing: DataFrame, keys: tuple[str, ...] = ("date", "source_url")
) -> DataFrame:
    """Incoming rows whose key is not stored, the earliest one per key, numbered onwards."""
    firsts = first_per_key(incoming, list(keys), [F.asc("created_at"), F.asc("content_hash")])
    fresh = firsts.join(existing.select(*keys), list(keys), "left_anti")
    return with_sequential_id(fresh, greatest_id(existing), day=keys[0], url=keys[1])


def insert_absent(
    spark: SparkSession, path: str, incoming: DataFrame, keys: tuple[str, ...] = ("date", "source_url")
) -> DataFrame:
    """Append rows with new keys to the table at ``path``; stored keys never change."""
    schema = "id long, date string, source_url string, parameters string, content_hash string, " \
             "raw_data string, created_at timestamp"
    stored = files.exists(spark, path)
    existing = spark.read.schema(schema).parquet(path) if stored else spark.createDataFrame([], schema)
    fresh = absent_rows(incoming, existing, keys)
    wanted = [c.split()[0] for c in schema.split(", ")]
    fresh.select(*wanted).write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)
