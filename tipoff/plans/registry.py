"""Jobs by name: silver entities, gold feature sets, and their incremental forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.plans import gold, lineage, silver
from tipoff.sources.bronze import SCOREBOARD, TEAMS, read_table

FEATURE_SETS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "team_performance": gold.team_performance,
    "game_context": gold.game_context,
    "historical_performance": gold.historical_performance,
    "prediction_features": gold.prediction_features,
}

ENTITIES = ("games", "teams", "venues", "team_stats", "seasons", "conferences")


def bronze_to_silver(
    spark: SparkSession, root: str, entity: str, processed: DataFrame | None = None
) -> DataFrame:
    """One silver entity from bronze.

    With ``processed(date, content_hash)`` only the dates whose content is new or changed
    are parsed: payload text of the other dates is not read past the hash join.
    """
    if entity not in ENTITIES:
        raise ValueError(f"Unknown entity: {entity}. Expected one of {', '.join(ENTITIES)}.")
    if entity == "conferences":
        return silver.conferences(spark)
    bronze = read_table(spark, root, SCOREBOARD)
    if processed is not None:
        changed = lineage.changed_keys(bronze, processed)
        bronze = bronze.join(changed.select("date"), "date", "left_semi")
    event_rows = silver.events(bronze)
    if entity == "games":
        return silver.games(silver.game_records(event_rows))
    if entity == "teams":
        pages = silver.teams_in_pages(read_table(spark, root, TEAMS))
        return silver.teams([silver.teams_in_games(event_rows), pages])
    if entity == "venues":
        return silver.venues(event_rows)
    if entity == "seasons":
        return silver.seasons_of(silver.game_records(event_rows))
    return silver.team_stats(silver.statistics_records(event_rows))


def silver_to_gold(games: DataFrame, feature_set: str) -> DataFrame:
    if feature_set not in FEATURE_SETS:
        raise ValueError(f"Unknown feature set: {feature_set}. Expected one of {', '.join(FEATURE_SETS)}.")
    return FEATURE_SETS[feature_set](games)


def list_features(games: DataFrame) -> DataFrame:
    """Every feature set with its columns and types, from the plans (building them counts group sizes)."""
    rows = [(name, c, t) for name, build in FEATURE_SETS.items() for c, t in build(games).dtypes]
    return games.sparkSession.createDataFrame(rows, "feature_set string, feature string, type string")


def analyze_feature(features: DataFrame, feature: str) -> DataFrame:
    """Exact counts and range plus approximate quartiles of one feature."""
    exact = gold.feature_summary(features, (feature,))
    return exact.join(gold.feature_quantiles(features, (feature,)), "feature")


def write_silver(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_gold(df: DataFrame, path: str, season: str = "season_id") -> None:
    """Gold tables are partitioned by season: an incremental run replaces touched seasons."""
    (
        df.withColumn("season", F.col(season))
        .hint("rebalance", "season")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("season")
        .parquet(path)
    )
