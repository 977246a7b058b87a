"""Metadata tables: sources, dependencies between layers, job history, changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_metadata(outcomes: DataFrame, source_type: str = "scoreboard") -> DataFrame:
    """One row per record an upsert inserted or replaced, not yet processed downstream."""
    folder = F.concat_ws("/", F.lit(source_type), F.concat(F.lit("year="), "year"), F.concat(F.lit("month="), "month"))
    return outcomes.where(F.col("action") != "unchanged").select(
        F.lit(source_type).alias("source_type"),
        F.col("date").alias("source_date"),
        folder.alias("file_path"),
        "content_hash",
        F.lit(False).alias("processed"),
        F.col("created_at").alias("ingestion_timestamp"),
    )


def dependencies(rows: DataFrame, source: Sequence[str], target: Sequence[str]) -> DataFrame:
    """Distinct edges from source columns to target columns of rows that carry both."""
    return rows.select(*dict.fromkeys([*source, *target])).distinct()


def silver_dependencies(records: DataFrame) -> DataFrame:
    return dependencies(records, ["source_date", "content_hash"], ["game_id"])


def gold_dependencies(games: DataFrame) -> DataFrame:
    """Edges from games to the (team, season) groups they feed."""
    side = F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")
    return games.select("game_id", side, "season_id").where("team_id is not null").distinct()


def model_dependencies(features: DataFrame, model_id: str) -> DataFrame:
    """Seasons a model was trained on."""
    return features.select("season_id").distinct().withColumn("model_id", F.lit(model_id))


def affected_groups(changed: DataFrame, silver_edges: DataFrame, gold_edges: DataFrame) -> DataFrame:
    """(team, season) groups that changed source records reach. Edges are narrowed first."""
    games = silver_edges.join(changed.select("source_date").distinct(), "source_date", "left_semi").select("game_id")
    return gold_edges.join(games.distinct(), "game_id", "left_semi").select("team_id", "season_id").distinct()


EDGES = ("source_game", "game_group", "group_model")


def store_edges(root: str, source_game: DataFrame, game_group: DataFrame, group_model: DataFrame) -> None:
    """Write the three edge tables: source date to game, game to (team, season), season to model."""
    for name, edges in zip(EDGES, (source_game, game_group, group_model)):
        edges.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{name}")


def stale_models(spark, root: str, changed: DataFrame, registry: DataFrame) -> DataFrame:
    """Every model of ``registry`` (model_id, trained_at) with what changed sources reach in it.

    ``changed`` holds (source_date, changed_at). Changes travel source -> game -> (team, season)
    -> model over the stored edges. Games and groups are counted per season before the season
    meets the models, so a large season is reduced by map-side aggregation and only one row per
    season joins. A game and its groups belong to one season: per-season counts add up per model.
    A model is stale when a change that reaches it is newer than its training.
    """
    source_game, game_group, group_model = (spark.read.parquet(f"{root}/{n}") for n in EDGES)
    games = source_game.join(changed, "source_date").groupBy("game_id").agg(F.max("changed_at").alias("changed_at"))
    groups = game_group.join(games, "game_id")
    seasons = groups.groupBy("season_id").agg(
        F.count_distinct("game_id").alias("changed_games"),
        F.count_distinct("team_id").alias("changed_groups"),
        F.max("changed_at").alias("changed_at"),
    )
    reached = group_model.join(seasons, "season_id").groupBy("model_id").agg(
        F.sum("changed_games").alias("changed_games"),
        F.sum("changed_groups").alias("changed_groups"),
        F.max("changed_at").alias("last_change"),
    )
    trained_on = group_model.groupBy("model_id").agg(F.count_distinct("season_id").alias("seasons"))
    return (
        registry.join(trained_on, "model_id", "left")
        .join(reached, "model_id", "left")
        .select(
            "model_id",
            F.coalesce("seasons", F.lit(0)).cast("long").alias("seasons"),
            F.coalesce("changed_games", F.lit(0)).cast("long").alias("changed_games"),
            F.coalesce("changed_groups", F.lit(0)).cast("long").alias("changed_groups"),
            F.coalesce(F.col("last_change") > F.col("trained_at"), F.lit(False)).alias("stale"),
        )
    )


def changed_keys(current: DataFrame, processed: DataFrame, key: str = "date") -> DataFrame:
    """Keys whose (key, hash) was not processed yet, marked ``new`` or ``changed``."""
    fresh = current.select(key, "content_hash").join(
        processed.select(key, "content_hash"), [key, "content_hash"], "left_anti"
    )
    known = processed.select(key).distinct().withColumn("_known", F.lit(True))
    return fresh.join(known, key, "left").select(
        key, "content_hash", F.when(F.col("_known"), "changed").otherwise("new").alias("change")
    )


def job_record(outcomes: DataFrame, rejected: DataFrame, job: str) -> DataFrame:
    """One job-history row: records by result."""
    counts = outcomes.agg(
        F.count_if(F.col("action") == "insert").alias("inserted"),
        F.count_if(F.col("action") == "update").alias("updated"),
        F.count_if(F.col("action") == "unchanged").alias("unchanged"),
        F.count(F.lit(1)).alias("successful"),
    )
    failed = rejected.agg(F.count(F.lit(1)).alias("failed"))
    # Two one-row aggregates side by side, joined on a constant.
    return (
        counts.withColumn("job", F.lit(job))
        .join(failed.withColumn("job", F.lit(job)), "job")
        .select("job", "successful", "failed", "inserted", "updated", "unchanged")
    )


def append_history(record: DataFrame, path: str) -> None:
    record.withColumn("recorded_at", F.current_timestamp()).write.mode("append").option(
        "compression", "zstd"
    ).parquet(path)
