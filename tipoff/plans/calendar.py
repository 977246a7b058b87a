"""Which dates to request: selection, skipping, seasons, request manifests."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.functions import dates, values
from tipoff.sources.landing import DEFAULT_GROUPS, DEFAULT_LIMIT


def date_range(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """One row per day, both ends included."""
    first, last = dates.check_range(start, end)
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))


def select_dates(
    spark: SparkSession,
    day: str | None = None,
    start: str | None = None,
    end: str | None = None,
    seasons: Sequence[str] | None = None,
    yesterday: bool = False,
    today: bool = False,
    year: int | None = None,
    history_start: str | None = None,
    as_of: str | date | None = None,
) -> DataFrame:
    """The dates to ingest, distinct and sorted. The first selector that is set decides:

    one day, a range, seasons, yesterday, today, a calendar year, or everything from
    ``history_start`` to yesterday.
    """
    if day:
        spans = [(dates.parse_date(day),) * 2]
    elif start and end:
        spans = [dates.check_range(start, end)]
    elif seasons:
        spans = [dates.season_window(s) for s in seasons]
    elif yesterday:
        spans = [(dates.yesterday(as_of),) * 2]
    elif today:
        spans = [(dates.today(as_of),) * 2]
    elif year:
        spans = [(date(year, 1, 1), date(year, 12, 31))]
    elif history_start:
        spans = [dates.check_range(history_start, dates.yesterday(as_of))]
    else:
        raise ValueError("the call selects no dates")
    wanted = spark.createDataFrame(spans, "first date, last date")
    days = wanted.select(F.explode(F.sequence("first", "last")).alias("date"))
    return days.distinct().orderBy("date")


def calendar_of(days: DataFrame, day: str = "date") -> DataFrame:
    """The gap-free calendar from the first to the last of the given days."""
    ends = days.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return ends.where("first is not null").select(
        F.explode(F.sequence(F.to_date("first"), F.to_date("last"))).alias("date")
    )


def pending_dates(requested: DataFrame, processed: DataFrame, force: bool = False) -> DataFrame:
    """Requested dates not stored yet; all of them when forced."""
    return requested if force else requested.join(processed, "date", "left_anti")


def with_season(rows: DataFrame, seasons: DataFrame, day: str = "date") -> DataFrame:
    """Attach the season whose window holds the day (null between seasons).

    The window test rides on an equality of the season year, so this is a hash join.
    """
    on = (dates.season_year(day) == F.col("_s.year")) & F.to_date(day).between(
        F.col("_s.start_date"), F.col("_s.end_date")
    )
    renamed = seasons.select("season_id", "year", "start_date", "end_date").alias("_s")
    return rows.join(renamed, on, "left").select(*[rows[c] for c in rows.columns], F.col("_s.season_id"))


def request_manifest(
    requests: DataFrame,
    endpoints: DataFrame,
    base_url: str,
    groups: str = DEFAULT_GROUPS,
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """URL and parameters per request row.

    ``requests`` has ``endpoint`` plus ``date`` and / or ``team_id``; ``endpoints`` is
    ``(endpoint, path)`` with ``{team_id}`` placeholders. Rows of an unknown endpoint
    are left out here and listed by :func:`unknown_endpoints`.
    """
    joined = requests.join(endpoints, "endpoint")
    team = F.col("team_id") if "team_id" in requests.columns else F.lit(None).cast("string")
    path = values.fill_template(F.col("path"), team_id=team)
    path = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path))
    if "date" in requests.columns:
        parameters = F.to_json(
            F.struct(
                dates.api_date("date").alias("dates"),
                F.lit(groups).alias("groups"),
                F.lit(limit).alias("limit"),
            )
        )
    else:
        parameters = F.lit("{}")
    return joined.select(
        *requests.columns,
        F.concat(F.lit(base_url), path).alias("source_url"),
        parameters.alias("parameters"),
    )


def unknown_endpoints(requests: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Distinct endpoint names of requests that have no template."""
    return requests.select("endpoint").distinct().join(endpoints, "endpoint", "left_anti")
