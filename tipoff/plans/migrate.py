"""Legacy bronze extract to partitioned bronze, and the comparison of the two."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.operators.upsert import upsert
from tipoff.sources.bronze import SCOREBOARD, TEAMS, TableSpec, prepare_scoreboard, prepare_teams, read_table

LEGACY_COLUMNS = ("id", "date", "source_url", "parameters", "content_hash", "raw_data", "created_at")


def read_legacy(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet extract of the legacy table; older extracts hold ``created_at`` as text."""
    raw = spark.read.parquet(path)
    created = F.col("created_at").try_cast("timestamp") if "created_at" in raw.columns else F.lit(None)
    return raw.withColumn("created_at", created.cast("timestamp"))


def read_legacy_jdbc(spark: SparkSession, url: str, table: str, low: int, high: int, parts: int) -> DataFrame:
    """The legacy table over JDBC, read in ``parts`` id ranges."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn="id", lowerBound=low, upperBound=high, numPartitions=parts)
        .load()
    )


def migrate(spark: SparkSession, legacy: DataFrame, root: str, spec: TableSpec = SCOREBOARD) -> DataFrame:
    """Load legacy rows into bronze in one batch; returns source, migrated and rejected counts."""
    prepare = prepare_scoreboard if spec is SCOREBOARD else prepare_teams
    good, rejected = prepare(legacy)
    outcome = upsert(spark, root, spec, good)
    parts = [("source", legacy), ("rejected", rejected), ("migrated", outcome.where("action != 'unchanged'"))]
    counts = None
    for name, frame in parts:
        one = frame.groupBy(F.lit(name).alias("measure")).agg(F.count(F.lit(1)).alias("n"))
        counts = one if counts is None else counts.unionByName(one)

    def measured(name: str):
        return F.coalesce(F.sum(F.when(F.col("measure") == name, F.col("n"))), F.lit(0))

    return counts.agg(
        measured("source").alias("source_count"),
        measured("migrated").alias("migrated_count"),
        measured("rejected").alias("rejected_count"),
    ).select(F.lit(spec.name).alias("table"), "*")


TABLES = {"scoreboard": SCOREBOARD, "teams": TEAMS}


def migrate_endpoint(
    spark: SparkSession, endpoint: str, legacy: dict[str, DataFrame], root: str, check: bool = True
) -> DataFrame:
    """Migrate ``all``, ``scoreboard`` or ``teams``, or only ``validate``; one row per table.

    ``legacy`` maps table names to legacy frames. With ``check`` the contents are compared
    afterwards and ``success`` tells whether they agree.
    """
    if endpoint not in ("all", "validate", *TABLES):
        raise ValueError(f"Unknown endpoint: {endpoint}. Expected all, scoreboard, teams or validate.")
    names = [endpoint] if endpoint in TABLES else [n for n in TABLES if n in legacy]
    result = None
    for name in names:
        if endpoint == "validate":
            row = validate_table(spark, legacy[name], root, TABLES[name]).withColumn("success", F.col("content_match"))
        else:
            row = migrate(spark, legacy[name], root, TABLES[name])
            if check:
                compared = validate_table(spark, legacy[name], root, TABLES[name])
                row = row.join(compared.select("table", F.col("content_match").alias("success")), "table")
        result = row if result is None else result.unionByName(row)
    return result


def legacy_dates(legacy: DataFrame) -> DataFrame:
    """Distinct dates of the legacy table."""
    return legacy.select("date").distinct()


def compare(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: matched, different, missing (source only) or extra (target only).

    Both sides are reduced to one row per key first: a count and the least and greatest
    hash, which is enough to tell unequal contents and safe for repeated keys.
    """

    def reduced(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.struct(
                F.count(F.lit(1)).alias("n"), F.min("content_hash").alias("lo"), F.max("content_hash").alias("hi")
            ).alias(side)
        )

    both = reduced(source, "s").join(reduced(target, "t"), list(keys), "full_outer")
    state = (
        F.when(F.col("t").isNull(), "missing")
        .when(F.col("s").isNull(), "extra")
        .when(
            F.col("s.lo").eqNullSafe(F.col("t.lo")) & F.col("s.hi").eqNullSafe(F.col("t.hi")), "matched"
        )
        .otherwise("different")
    )
    return both.select(
        *keys,
        state.alias("state"),
        F.coalesce("s.n", F.lit(0)).alias("source_rows"),
        F.coalesce("t.n", F.lit(0)).alias("target_rows"),
    )


def validate(source: DataFrame, target: DataFrame, keys: Sequence[str], table: str = "scoreboard") -> DataFrame:
    """Counts on both sides and whether the contents agree."""
    return (
        compare(source, target, keys)
        .agg(
            F.coalesce(F.sum("source_rows"), F.lit(0)).alias("source_count"),
            F.coalesce(F.sum("target_rows"), F.lit(0)).alias("target_count"),
            F.count_if(F.col("state") == "matched").alias("matched"),
            F.count_if(F.col("state") == "different").alias("different"),
            F.count_if(F.col("state") == "missing").alias("missing"),
            F.count_if(F.col("state") == "extra").alias("extra"),
        )
        .select(
            F.lit(table).alias("table"),
            "*",
            ((F.col("different") + F.col("missing") + F.col("extra")) == 0).alias("content_match"),
        )
    )


def validate_table(spark: SparkSession, legacy: DataFrame, root: str, spec: TableSpec = SCOREBOARD) -> DataFrame:
    prepare = prepare_scoreboard if spec is SCOREBOARD else prepare_teams
    good, _ = prepare(legacy)
    return validate(good, read_table(spark, root, spec), spec.keys, spec.name)
