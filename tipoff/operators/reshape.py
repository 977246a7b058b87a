"""Reshaping: games to team rows, competitor arrays to sides, statistics to columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def final_result(points: str, other_points: str) -> Column:
    """Whether a game is final and has both scores: points of other games are no result."""
    final = F.col("status").eqNullSafe("final")
    return final & F.col(points).isNotNull() & F.col(other_points).isNotNull()


def team_rows(games: DataFrame) -> DataFrame:
    """Each game as two rows, one per team, in a single pass over the games.

    Games without both team ids carry no team view and are left out.
    """

    def side(is_home: bool) -> Column:
        me, other = ("home", "away") if is_home else ("away", "home")
        return F.struct(
            F.col(f"{me}_team_id").alias("team_id"),
            F.col(f"{other}_team_id").alias("opponent_id"),
            F.lit(is_home).alias("is_home"),
            F.col(f"{me}_score").alias("points_for"),
            F.col(f"{other}_score").alias("points_against"),
        )

    kept = [c for c in games.columns if c not in
            ("home_team_id", "away_team_id", "home_score", "away_score")]
    counts = final_result("points_for", "points_against")
    return (
        games.where("home_team_id is not null and away_team_id is not null")
        .select(*kept, F.explode(F.array(side(True), side(False))).alias("_side"))
        .select(*kept, "_side.*")
        .withColumns(
            {
                "played": counts,
                "win": counts & (F.col("points_for") > F.col("points_against")),
                "loss": counts & (F.col("points_for") < F.col("points_against")),
            }
        )
    )


def home_side(competitors: Column | str) -> Column:
    """The last competitor marked as home, null if there is none."""
    return F.try_element_at(F.filter(competitors, lambda c: c["homeAway"] == "home"), F.lit(-1))


def away_side(competitors: Column | str) -> Column:
    """The last competitor not marked as home, null if there is none."""
    not_home = F.filter(competitors, lambda c: F.coalesce(c["homeAway"], F.lit("")) != "home")
    return F.try_element_at(not_home, F.lit(-1))


def statistic_columns(statistics: str, columns: Mapping[str, tuple[str, str]]) -> dict[str, Column]:
    """``[{name, displayValue}]`` as typed columns: statistic name -> (column, type).

    Repeated names keep the last value. Array lookups only: no lambda per element, so
    the expressions stay in generated code.
    """
    backwards = F.reverse(statistics)
    names, texts = backwards["name"], backwards["displayValue"]

    def pick(name: str, kind: str) -> Column:
        return F.get(texts, (F.array_position(names, name) - 1).cast("int")).try_cast(kind)

    return {column: pick(name, kind) for name, (column, kind) in columns.items()}


def pair_columns(first: str = "home_team_id", second: str = "away_team_id") -> dict[str, Column]:
    """An order-free key for two teams."""
    return {"team_low": F.least(first, second), "team_high": F.greatest(first, second)}


def statistics_long(df: DataFrame, statistics: str = "statistics") -> DataFrame:
    """One row per statistic, names and values kept as text."""
    kept = [c for c in df.columns if c != statistics]
    return df.select(*kept, F.explode(statistics).alias("_s")).select(
        *kept, F.col("_s.name").alias("statistic"), F.col("_s.displayValue").alias("value")
    )
