"""Bronze tables: layout, preparation of incoming records, readers."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tipoff import schemas
from tipoff.functions import dates, values
from tipoff.operators.latest import latest, latest_per_key
from tipoff.sources import files


@dataclass(frozen=True)
class TableSpec:
    """A bronze table: ``keys`` identify a record, ``partitions`` are its directories."""

    name: str
    keys: tuple[str, ...]
    partitions: tuple[str, ...]
    schema: T.StructType

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.name}"


SCOREBOARD = TableSpec("scoreboard", ("date",), ("year", "month"), schemas.BRONZE_SCOREBOARD)
# Team pages have no date; hash buckets keep an upsert from rewriting the whole table.
TEAMS = TableSpec("teams", ("parameters",), ("bucket",), schemas.BRONZE_TEAMS)
TEAM_BUCKETS = 16


def _metadata(incoming: DataFrame, now: datetime) -> dict[str, Column]:
    """Metadata of incoming rows: text passes through, anything else becomes JSON text."""

    def text(name: str) -> Column:
        if name not in incoming.columns:
            return F.lit(None).cast("string")
        kind = incoming.schema[name].dataType
        nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
        return F.to_json(name) if nested else F.col(name).cast("string")

    given_hash = F.col("content_hash") if "content_hash" in incoming.columns else F.lit(None)
    given_time = F.col("created_at") if "created_at" in incoming.columns else F.lit(None)
    raw = text("raw_data")
    return {
        "source_url": F.coalesce(text("source_url"), F.lit("")),
        "parameters": F.coalesce(text("parameters"), F.lit("")),
        "raw_data": raw,
        "content_hash": F.coalesce(given_hash.cast("string"), values.content_hash(raw)),
        "created_at": F.coalesce(given_time.try_cast("timestamp"), F.lit(now)),
    }


def prepare_scoreboard(
    incoming: DataFrame, now: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split incoming rows into bronze rows and rejects (``reason`` says why).

    ``now`` is fixed once so that re-evaluated tasks stamp the same time.
    """
    now = now or datetime.now(tz=UTC)
    day = dates.iso_date(F.col("date").cast("string"))
    reason = (
        F.when(F.coalesce(F.col("date").cast("string"), F.lit("")) == "", "date is required")
        .when(day.isNull(), "invalid date format")
        .when(F.col("raw_data").isNull(), "payload is missing")
    )
    checked = incoming.withColumns({"_day": day, "reason": reason})
    good = checked.where(F.col("reason").isNull()).withColumns(_metadata(incoming, now))
    good = good.withColumns(
        {
            "date": F.date_format("_day", "yyyy-MM-dd"),
            "year": dates.partition_year("_day"),
            "month": dates.partition_month("_day"),
        }
    ).select(*SCOREBOARD.schema.names)
    return good, checked.where(F.col("reason").isNotNull()).drop("_day")


def prepare_teams(incoming: DataFrame, now: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """As :func:`prepare_scoreboard`, for records identified by their request parameters."""
    now = now or datetime.now(tz=UTC)
    reason = (
        F.when(F.col("parameters").isNull(), "parameters are required")
        .when(F.col("raw_data").isNull(), "payload is missing")
    )
    checked = incoming.withColumn("reason", reason)
    good = checked.where(F.col("reason").isNull()).withColumns(_metadata(incoming, now))
    bucket = F.lpad(F.pmod(F.xxhash64("parameters"), F.lit(TEAM_BUCKETS)).cast("string"), 2, "0")
    good = good.withColumn("bucket", bucket).select(*TEAMS.schema.names)
    return good, checked.where(F.col("reason").isNotNull())


def read_table(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The stored table, or an empty frame with its schema."""
    path = spec.path(root)
    if not files.exists(spark, path):
        return spark.createDataFrame([], spec.schema)
    return (
        spark.read.schema(spec.schema)
        .option("ignoreCorruptFiles", "false")
        .option("recursiveFileLookup", "false")
        .parquet(path)
    )


def in_partitions(df: DataFrame, spec: TableSpec, parts: Iterable[tuple]) -> DataFrame:
    """Rows of the given partitions, as a predicate the scan prunes directories with."""
    wanted = F.lit(False)
    by_head: dict = {}
    for part in parts:
        by_head.setdefault(part[:-1], []).append(part[-1])
    for head, tails in sorted(by_head.items()):
        clause = F.col(spec.partitions[-1]).isin(*sorted(tails))
        for name, value in zip(spec.partitions, head):
            clause = clause & (F.col(name) == value)
        wanted = wanted | clause
    return df.where(wanted)


def read_scoreboard(
    spark: SparkSession, root: str, day: str | date, latest_only: bool = True
) -> DataFrame:
    """Records of one date; scans only that month's directory. Bad or unknown dates give no rows."""
    table = read_table(spark, root, SCOREBOARD)
    try:
        when = dates.parse_date(day)
    except ValueError:
        return table.limit(0)
    rows = table.where(
        (F.col("year") == f"{when:%Y}") & (F.col("month") == f"{when:%m}") & (F.col("date") == f"{when:%Y-%m-%d}")
    )
    return latest(rows) if latest_only else rows


def read_scoreboard_range(
    spark: SparkSession, root: str, start: str | date, end: str | date, latest_only: bool = True
) -> DataFrame:
    """Records of a date range, with year and month predicates derived from it."""
    first, last = dates.check_range(start, end)
    months = {(f"{y:04d}", f"{m:02d}") for y in range(first.year, last.year + 1) for m in range(1, 13)
              if (first.year, first.month) <= (y, m) <= (last.year, last.month)}
    rows = in_partitions(read_table(spark, root, SCOREBOARD), SCOREBOARD, months).where(
        F.col("date").between(f"{first:%Y-%m-%d}", f"{last:%Y-%m-%d}")
    )
    return latest_per_key(rows, ["date"]) if latest_only else rows


def read_teams(spark: SparkSession, root: str, latest_only: bool = True) -> DataFrame:
    """The newest team record overall, or all of them."""
    table = read_table(spark, root, TEAMS).drop("bucket")
    return latest(table) if latest_only else table


def read_teams_per_request(spark: SparkSession, root: str) -> DataFrame:
    """The newest team record of every request."""
    return latest_per_key(read_table(spark, root, TEAMS).drop("bucket"), ["parameters"])


def processed_dates(spark: SparkSession, root: str, endpoint: str = "scoreboard") -> DataFrame:
    """Distinct stored dates, sorted. Reads one small column; unreadable files are skipped."""
    path = SCOREBOARD.path(root)
    if endpoint != SCOREBOARD.name or not files.exists(spark, path):
        return spark.createDataFrame([], "date string")
    stored = (
        spark.read.schema(SCOREBOARD.schema).option("ignoreCorruptFiles", "true").parquet(path)
    )
    return stored.select("date").distinct().orderBy("date")


def list_endpoints(spark: SparkSession, root: str) -> list[str]:
    """Names of the bronze tables below ``root``: a directory listing, no data is read."""
    return files.subdirectories(spark, root)
