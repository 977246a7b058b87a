"""The given relational tables, seen as a schedule.

No basketball data is given, so suppliers stand for teams, nations for conferences,
customers for venues, orders for the schedule and line items for box scores. Each two
consecutive lines of an order are the home and the away side of a game; their quantities are
the scores. Lines left over are listed by :func:`unpaired_lines`.
Ids stay whole numbers; every job only compares and orders ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tipoff.functions import dates

LINE_ORDER = ("l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _status(code: Column) -> Column:
    return F.when(code == "F", "final").when(code == "O", "scheduled").otherwise("in_progress")


def paired_lines(lineitem: DataFrame) -> DataFrame:
    """Lines numbered within their order (``rn``), each with its game and its mate's team.

    Lines 1 and 2 of an order are one game, 3 and 4 the next. A last line without a mate has
    no ``mate``. The numbers of a game's order and pair share one id: up to 2**20 pairs an order.
    """
    window = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    team = F.struct("l_suppkey")
    first = F.col("rn") % 2 == 1
    return lineitem.withColumn("rn", F.row_number().over(window)).withColumns(
        {
            "game_id": F.expr("cast(l_orderkey as bigint) * 1048576 + (rn + 1) div 2"),
            "mate": F.when(first, F.lead(team).over(window)).otherwise(F.lag(team).over(window)),
        }
    )


def _is_game() -> Column:
    """Whether a line has a mate of another team."""
    return F.coalesce(F.col("mate.l_suppkey") != F.col("l_suppkey"), F.lit(False))


def _all_games(spark: SparkSession, sf_dir: str, with_venue: bool = False) -> DataFrame:
    """Games in silver columns, with the scores of unfinished ones beside them, and the venue's name and city."""
    lines = paired_lines(load(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER, "l_returnflag"))
    # The second line sits beside the first under the same sort: no aggregate needed.
    window = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    score = F.col("l_quantity").cast("int")
    sides = (
        lines.withColumn("away_points", F.lead(score).over(window))
        .where((F.col("rn") % 2 == 1) & _is_game())
        .withColumn("home_points", score)
    )
    orders = load(spark, sf_dir, "orders")
    if with_venue:
        # Orders are fewer and narrower than games, so the venue is looked up for them.
        venue = venues(spark, sf_dir).select("venue_id", F.col("name").alias("venue"), "city")
        orders = orders.join(venue, F.col("o_custkey") == F.col("venue_id"), "left").drop("venue_id")
    status = _status(F.col("o_orderstatus"))
    return sides.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "game_id",
        dates.season_label(dates.rolling_season_year("o_orderdate")).alias("season_id"),
        F.col("o_orderdate").alias("date"),
        F.col("l_suppkey").alias("home_team_id"),
        F.col("mate.l_suppkey").alias("away_team_id"),
        F.col("o_custkey").alias("venue_id"),
        F.when(status == "final", F.col("home_points")).alias("home_score"),
        F.when(status == "final", F.col("away_points")).alias("away_score"),
        status.alias("status"),
        (F.col("l_returnflag") == "R").alias("neutral_site"),
        (F.col("o_orderpriority") == "1-URGENT").alias("conference_game"),
        "home_points",
        "away_points",
        *(["venue", "city"] if with_venue else []),
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games in silver columns; only final ones have scores."""
    return _all_games(spark, sf_dir).drop("home_points", "away_points")


def unpaired_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that belong to no game, with the reason: every line is here or in one game."""
    lines = paired_lines(load(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER))
    known = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(True).alias("_known"))
    reason = (
        F.when(F.col("_known").isNull(), "no order")
        .when(F.col("mate").isNull(), "last line")
        .when(~_is_game(), "same team")
    )
    return (
        lines.join(known.distinct(), "l_orderkey", "left")
        .select("l_orderkey", "l_linenumber", "l_suppkey", reason.alias("reason"))
        .where("reason is not null")
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("team_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("conference_id"),
    )


def conferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("conference_id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("division_id"),
    )


def divisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("division_id"), F.col("r_name").alias("division")
    )


def venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("venue_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_nationkey").alias("nation_id"),
    )


def date_payloads(spark: SparkSession, sf_dir: str, statuses: tuple[str, ...] | None = None) -> DataFrame:
    """One JSON document per order date with that day's counts: a capture of the schedule.

    Restricting ``statuses`` gives the capture as seen before other games were entered.
    """
    orders = load(spark, sf_dir, "orders")
    if statuses:
        orders = orders.where(F.col("o_orderstatus").isin(*statuses))
    per_day = orders.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")).agg(
        F.count(F.lit(1)).alias("games"),
        F.count_if(F.col("o_orderstatus") == "F").alias("final"),
        F.min("o_orderkey").alias("first"),
        F.max("o_orderkey").alias("last"),
    )
    return per_day.select(
        "date",
        F.lit("orders").alias("source_url"),
        F.to_json(F.struct(F.replace("date", F.lit("-"), F.lit("")).alias("dates"))).alias("parameters"),
        F.to_json(F.struct("date", "games", "final", "first", "last")).alias("raw_data"),
    )


def payload_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The games that :func:`game_payloads` writes as documents, with their venues."""
    return _all_games(spark, sf_dir, with_venue=True)


def game_payloads(
    spark: SparkSession,
    sf_dir: str,
    statuses: tuple[str, ...] | None = None,
    shift_days: int = 0,
    games: DataFrame | None = None,
) -> DataFrame:
    """Games as nested scoreboard documents, one event each, keyed by date and game.

    ``statuses`` keeps games of those silver statuses only; ``shift_days`` reschedules them:
    key and event date move, the season stays the one of the original date. ``games`` are the
    rows of :func:`payload_games` where a caller has stored them.
    """
    g = payload_games(spark, sf_dir) if games is None else games
    if statuses:
        g = g.where(F.col("status").isin(*statuses))
    g = g.withColumn("season_of", F.col("date")).withColumn("date", F.date_add("date", shift_days).cast(g.schema["date"].dataType))
    named = teams(spark, sf_dir).withColumn(
        "color", F.lower(F.lpad(F.hex("team_id"), 6, "0"))
    )
    home = named.select(*[F.col(c).alias(f"home_{c}") for c in ("team_id", "name", "color")])
    away = named.select(*[F.col(c).alias(f"away_{c}") for c in ("team_id", "name", "color")])
    rows = g.join(home, "home_team_id", "left").join(away, "away_team_id", "left")

    def text(name: str) -> Column:
        return F.col(name).cast("string")

    def competitor(which: str) -> Column:
        return F.struct(
            text(f"{which}_team_id").alias("id"),
            F.lit(which).alias("homeAway"),
            # Before a game the score reads 0, during it the points so far.
            F.when(F.col("status") == "scheduled", "0").otherwise(text(f"{which}_points")).alias("score"),
            F.struct(
                text(f"{which}_team_id").alias("id"),
                F.col(f"{which}_name").alias("displayName"),
                F.col(f"{which}_color").alias("color"),
            ).alias("team"),
            F.array(
                F.struct(F.lit("rebounds").alias("name"), text(f"{which}_score").alias("displayValue"))
            ).alias("statistics"),
        )

    state = (
        F.when(F.col("status") == "final", "post").when(F.col("status") == "scheduled", "pre").otherwise("in")
    )
    competition = F.struct(
        text("game_id").alias("id"),
        F.col("neutral_site").alias("neutralSite"),
        F.col("conference_game").alias("conferenceCompetition"),
        F.struct(
            text("venue_id").alias("id"),
            F.col("venue").alias("fullName"),
            F.struct(F.col("city").alias("city")).alias("address"),
        ).alias("venue"),
        F.array(competitor("home"), competitor("away")).alias("competitors"),
        F.struct(F.struct(state.alias("state")).alias("type")).alias("status"),
    )
    event = F.struct(
        text("game_id").alias("id"),
        F.date_format("date", "yyyy-MM-dd'T'HH:mm'Z'").alias("date"),
        F.struct(dates.rolling_season_year("season_of").alias("year"), F.lit(2).alias("type")).alias("season"),
        F.array(competition).alias("competitions"),
    )
    raw = F.to_json(F.struct(F.array(event).alias("events")))
    return rows.select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("game/"), text("game_id")).alias("source_url"),
        raw.alias("raw_data"),
        F.sha2(raw, 256).alias("content_hash"),
        F.col("date").cast("timestamp").alias("created_at"),
    )


# Statistic names of the box scores built from line items, and their silver columns.
BOX_SCORE_COLUMNS = {
    "fieldGoalsMade": "field_goals_made",
    "fieldGoalsAttempted": "field_goals_attempted",
    "rebounds": "rebounds",
    "assists": "assists",
    "turnovers": "turnovers",
}


def box_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One named-statistics array per line item, under its pair's game and the order's season.

    Pairs of one team are no games, but their lines count in its statistics.
    """
    values = {
        "fieldGoalsMade": F.col("l_linenumber"),
        "fieldGoalsAttempted": F.col("l_linenumber") + F.col("l_quantity").cast("int"),
        "rebounds": F.col("l_quantity").cast("int"),
        "assists": F.round(F.col("l_discount") * 100).cast("int"),
        "turnovers": F.round(F.col("l_tax") * 100).cast("int"),
    }
    entries = [
        F.struct(F.lit(n).alias("name"), v.cast("string").alias("displayValue")) for n, v in values.items()
    ]
    days = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER, "l_discount", "l_tax")
    return paired_lines(lines).join(days, "l_orderkey", "left").select(
        "game_id",
        F.col("l_suppkey").alias("team_id"),
        dates.season_label(dates.rolling_season_year("o_orderdate")).alias("season_id"),
        F.col("l_quantity").cast("int").alias("points"),
        F.array(*entries).alias("statistics"),
    )
