"""Data-quality rules. Each returns counts of violations, never the rows themselves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_rules(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """One pass over ``df``: (table, rule, violations). A rule is a condition that must hold;
    null counts as holding, so required columns are written as ``isNotNull``."""
    counts = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])
    return counts.select(F.explode(pairs).alias("r")).select(F.lit(table).alias("table"), "r.rule", "r.violations")


def required(*columns: str) -> dict[str, Column]:
    return {f"{c} required": F.col(c).isNotNull() for c in columns}


def in_range(column: str, low: float | None = None, high: float | None = None) -> dict[str, Column]:
    rules = {}
    if low is not None:
        rules[f"{column} at least {low}"] = F.col(column) >= low
    if high is not None:
        rules[f"{column} at most {high}"] = F.col(column) <= high
    return rules


def unique_rule(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table"), F.lit(f"{', '.join(keys)} unique").alias("rule"), "violations"
    )


def foreign_key_rule(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Number of child rows whose value has no parent; null values are allowed.

    Child values are counted before the join, so a hot value crosses the network as one
    number per task.
    """
    values = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    keys = parent.select(F.col(parent_column).alias(column))
    orphans = values.join(keys, column, "left_anti")
    return orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations")).select(
        F.lit(table).alias("table"), F.lit(f"{column} references {parent_column}").alias("rule"), "violations"
    )


def report(parts: Sequence[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def validate_silver(
    games: DataFrame, teams: DataFrame, venues: DataFrame | None = None, seasons: DataFrame | None = None
) -> DataFrame:
    """The rules the silver tables promise."""
    side_columns = ("home_team_id", "away_team_id")
    parts = [
        unique_rule(games, "games", ["game_id"]),
        unique_rule(teams, "teams", ["team_id"]),
        row_rules(teams, "teams", required("team_id", "name")),
        row_rules(
            games,
            "games",
            {
                **required("game_id", "date"),
                **in_range("home_score", low=0),
                **in_range("away_score", low=0),
                "teams differ": F.col("home_team_id") != F.col("away_team_id"),
                "final games have scores": (F.col("status") != "final")
                | (F.col("home_score").isNotNull() & F.col("away_score").isNotNull()),
            },
        ),
        *[foreign_key_rule(games, "games", c, teams, "team_id") for c in side_columns],
    ]
    if venues is not None:
        parts.append(foreign_key_rule(games, "games", "venue_id", venues, "venue_id"))
    if seasons is not None:
        parts.append(foreign_key_rule(games, "games", "season_id", seasons, "season_id"))
    return report(parts)
