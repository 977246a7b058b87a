"""The registered queries: every operator over the given tables, whole.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame; ``tipoff.oracle`` holds
the SQL each one is checked against.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.functions import dates, values
from tipoff.operators import latest, upsert
from tipoff.plans import calendar, gold, incremental, lineage, migrate, models, quality, silver
from tipoff.session import configure, materialize, released_shuffles, shared_dir
from tipoff.sources import bronze, landing, tables
from tipoff.streaming import layers
from tipoff.streaming.ingest import drain, stream_to_bronze

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Capture times of the two schedule captures the bronze queries merge.
FIRST_CAPTURE = datetime(2024, 1, 1, tzinfo=UTC)
SECOND_CAPTURE = datetime(2024, 2, 1, tzinfo=UTC)
BASE_URL = "https://scores.example.org/v2"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


# --- bronze -------------------------------------------------------------------------


@query
def bronze_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content hash of every whole document."""
    digest = values.content_hash("text")
    return tables.load(spark, sf_dir, "documents").select(
        "doc_id", digest.alias("content_hash"), values.hash_prefix(digest).alias("hash_prefix")
    )


@query
def bronze_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition values of every order date, with row counts."""
    return (
        tables.load(spark, sf_dir, "orders")
        .groupBy(dates.partition_year("o_orderdate").alias("year"), dates.partition_month("o_orderdate").alias("month"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


def _captures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The schedule as first captured (final games only) and as captured later (all games)."""
    first = tables.date_payloads(spark, sf_dir, ("F",))
    second = tables.date_payloads(spark, sf_dir)
    return (
        bronze.prepare_scoreboard(first, FIRST_CAPTURE)[0],
        bronze.prepare_scoreboard(second, SECOND_CAPTURE)[0],
    )


def _merged_bronze(spark: SparkSession, sf_dir: str) -> str:
    root = shared_dir(spark)
    first, second = _captures(spark, sf_dir)
    upsert.upsert(spark, root, bronze.SCOREBOARD, first, run="first")
    upsert.upsert(spark, root, bronze.SCOREBOARD, second, run="second")
    return root


def _bronze_state(table: DataFrame) -> DataFrame:
    return table.select(
        "date",
        "parameters",
        "content_hash",
        "raw_data",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        "year",
        "month",
    )


@query
def bronze_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two captures merged by date: new, changed and unchanged dates; the stored table."""
    root = _merged_bronze(spark, sf_dir)
    return _bronze_state(bronze.read_table(spark, root, bronze.SCOREBOARD))


@query
def bronze_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of the two merges did, counted from the change feed."""
    root = _merged_bronze(spark, sf_dir)
    return upsert.run_summary(upsert.read_outcomes(spark, root, bronze.SCOREBOARD))


@query
def source_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source records of the second merge, from the change feed."""
    root = _merged_bronze(spark, sf_dir)
    meta = lineage.source_metadata(upsert.read_outcomes(spark, root, bronze.SCOREBOARD, "second"))
    return meta.drop("ingestion_timestamp")


@query
def team_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team records keyed by request parameters: by market, then by every customer, merged."""
    root = shared_dir(spark)
    customers = tables.load(spark, sf_dir, "customer")

    def capture(rows: DataFrame, at: datetime) -> DataFrame:
        pages = rows.groupBy("c_nationkey", "c_mktsegment").agg(
            F.count(F.lit(1)).alias("count"), F.max("c_custkey").alias("last")
        )
        records = pages.select(
            F.lit("teams").alias("source_url"),
            F.to_json(F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))).alias(
                "parameters"
            ),
            F.to_json(F.struct("count", "last")).alias("raw_data"),
        )
        return bronze.prepare_teams(records, at)[0]

    upsert.upsert(spark, root, bronze.TEAMS, capture(customers.where("c_acctbal > 0"), FIRST_CAPTURE))
    upsert.upsert(spark, root, bronze.TEAMS, capture(customers, SECOND_CAPTURE))
    return bronze.read_teams_per_request(spark, root).select(
        "parameters",
        "content_hash",
        "raw_data",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )


@query
def bronze_insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final orders are stored first; then all orders arrive and only absent ones get new ids."""
    path = shared_dir(spark) + "/legacy"
    orders = tables.load(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("order/"), F.col("o_orderkey").cast("string")).alias("source_url"),
        F.lit("{}").alias("parameters"),
        F.sha2("o_orderstatus", 256).alias("content_hash"),
        F.col("o_orderstatus").alias("raw_data"),
        F.lit(FIRST_CAPTURE).alias("created_at"),
    )
    upsert.insert_absent(spark, path, orders.where("raw_data = 'F'"))
    return upsert.insert_absent(spark, path, orders).select("id", "date", "source_url", "raw_data")


@query
def read_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest event per user and type."""
    events = tables.load(spark, sf_dir, "events")
    newest = latest.latest_per_key(events, ["user_id", "event_type"], "ts", ("event_id",))
    return newest.select("user_id", "event_type", "event_id", "value", "props")


@query
def processed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct stored dates of the merged bronze table."""
    return bronze.processed_dates(spark, _merged_bronze(spark, sf_dir))


@query
def skip_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates that no final order has: requested but not yet processed."""
    orders = tables.load(spark, sf_dir, "orders").select("o_orderstatus", F.to_date("o_orderdate").alias("date"))
    processed = orders.where("o_orderstatus = 'F'").select("date").distinct()
    return calendar.pending_dates(orders.select("date").distinct(), processed)


@query
def migration_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first capture as legacy extract, migrated, then compared after bronze moved on."""
    root = shared_dir(spark)
    first, second = _captures(spark, sf_dir)
    legacy = materialize(first.drop("year", "month"), f"{root}/extract")
    migrate.migrate(spark, legacy, root)
    before = migrate.validate_table(spark, legacy, root)
    before = materialize(before.withColumn("stage", F.lit("migrated")), f"{root}/report")
    upsert.upsert(spark, root, bronze.SCOREBOARD, second)
    after = migrate.validate_table(spark, legacy, root).withColumn("stage", F.lit("later capture"))
    return before.unionByName(after)


@query
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two captures as landed files, merged by a stream that is stopped and restarted."""
    root = shared_dir(spark)
    for capture in _captures(spark, sf_dir):
        landed = capture.select("date", "source_url", "parameters", "content_hash", "raw_data", "created_at")
        landed.write.mode("append").parquet(f"{root}/landing")
        records = landing.stream_records(spark, f"{root}/landing")
        drain(stream_to_bronze(spark, records, root, f"{root}/_checkpoint", stream="orders"))
    return _bronze_state(bronze.read_table(spark, root, bronze.SCOREBOARD))


@query
def changed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates whose content differs from what was processed."""
    first, second = _captures(spark, sf_dir)
    return lineage.changed_keys(second, first)


@query
def page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as paged requests: turns present against the last turn number."""
    turns = tables.load(spark, sf_dir, "conversations").select("conv_id", "turn")
    announced = turns.groupBy("conv_id").agg((F.max("turn") + 1).cast("long").alias("announced"))
    return landing.page_completeness(turns.join(announced, "conv_id"), "conv_id", "turn", "announced")


# --- calendar -----------------------------------------------------------------------


@query
def schedule_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first to the last order date, with request form, season and games."""
    orders = tables.load(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    per_day = orders.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return (
        calendar.calendar_of(orders)
        .join(per_day, "date", "left")
        .select(
            "date",
            dates.api_date("date").alias("api_date"),
            dates.season_id("date").alias("season_id"),
            F.coalesce("n", F.lit(0)).alias("orders"),
        )
    )


@query
def season_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per season window; orders between seasons under no season."""
    orders = tables.load(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    seasons = silver.seasons_of(orders)
    placed = calendar.with_season(orders, seasons)
    counts = placed.groupBy("season_id").agg(F.count(F.lit(1)).alias("orders"))
    return counts.join(seasons, "season_id", "left").select(
        "season_id", "name", "start_date", "end_date", "year", "orders"
    )


@query
def request_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scoreboard request per order date."""
    days = tables.load(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    endpoints = spark.createDataFrame([("scoreboard", "/scoreboard")], "endpoint string, path string")
    return calendar.request_manifest(days.withColumn("endpoint", F.lit("scoreboard")), endpoints, BASE_URL)


@query
def team_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A team-detail request per team, the id filled into the path."""
    teams = tables.teams(spark, sf_dir).select("team_id").withColumn("endpoint", F.lit("team_detail"))
    endpoints = spark.createDataFrame([("team_detail", "/teams/{team_id}")], "endpoint string, path string")
    return calendar.request_manifest(teams, endpoints, BASE_URL)


# --- silver -------------------------------------------------------------------------


@query
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed fields of every event's JSON, with defaults for absent ones."""
    parsed = F.from_json("props", "k int, neutral boolean, score string")
    return tables.load(spark, sf_dir, "events").select(
        "event_id",
        parsed["k"].alias("k"),
        F.coalesce(parsed["neutral"], F.lit(False)).alias("neutral"),
        values.score(parsed["score"]).alias("score"),
    )


def _payload_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the game payloads, which are landed as a written table first."""
    return silver.events(materialize(tables.game_payloads(spark, sf_dir)), ("date", "source_url"))


@query
def payload_to_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested payloads parsed back into silver games."""
    records = silver.game_records(_payload_events(spark, sf_dir))
    return silver.usable_games(records).withColumn("date", F.to_date("date"))


# Capture times of the change sets of the incremental silver: the re-capture is older than the second.
RECAPTURE = datetime(2024, 1, 15, tzinfo=UTC)
NO_EVENTS = '{"events":[]}'
LANDED = "date string, source_url string, raw_data string, content_hash string, created_at timestamp"


def _change_sets(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """A first capture of every game; a later one that moves scheduled games a day on and withdraws
    games in progress (an empty payload under their key); an older re-capture of both, last."""

    def at(df: DataFrame, when: datetime) -> DataFrame:
        return df.withColumn("created_at", F.lit(when).cast("timestamp"))

    with released_shuffles(spark):
        games = materialize(tables.payload_games(spark, sf_dir))  # every change set is written from them
    first = at(tables.game_payloads(spark, sf_dir, games=games), FIRST_CAPTURE)
    moved = tables.game_payloads(spark, sf_dir, ("scheduled",), shift_days=1, games=games)
    withdrawn = tables.game_payloads(spark, sf_dir, ("in_progress",), games=games).withColumns(
        {"raw_data": F.lit(NO_EVENTS), "content_hash": F.sha2(F.lit(NO_EVENTS), 256)}
    )
    second = at(moved.unionByName(withdrawn), SECOND_CAPTURE)
    again = at(tables.game_payloads(spark, sf_dir, ("scheduled", "in_progress"), games=games), RECAPTURE)
    return [first, second, again]


@query
def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable games of the stored silver table after three change sets were merged into it."""
    root = shared_dir(spark)
    for batch in _change_sets(spark, sf_dir):
        incremental.merge(spark, root, batch)
    return silver.usable_games(incremental.live_games(spark, root)).withColumn("date", F.to_date("date"))


@query
def stream_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season records kept by a stream that takes each landed change set through silver into gold."""
    root = shared_dir(spark)
    for batch in _change_sets(spark, sf_dir):
        batch.select(*[c.split()[0] for c in LANDED.split(", ")]).write.mode("append").option("compression", "zstd").parquet(f"{root}/landing")
        records = spark.readStream.schema(LANDED).parquet(f"{root}/landing")
        drain(layers.stream_to_gold(spark, records, root, f"{root}/_checkpoint"))
    return layers.read_gold(spark, root).withColumn("team_id", F.col("team_id").cast("long"))


@query
def payload_to_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams named in the payloads, newest naming per team."""
    return silver.teams([silver.teams_in_games(_payload_events(spark, sf_dir))]).select("team_id", "name", "color")


@query
def team_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored silver teams looked up by id: every team a scheduled game names."""
    stored = materialize(payload_to_teams(spark, sf_dir))
    scheduled = tables.games(spark, sf_dir).where(F.col("status") == "scheduled")
    ids = scheduled.select(F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    return silver.teams_by_id(stored, ids)


@query
def payload_to_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.venues(_payload_events(spark, sf_dir)).select("venue_id", "name", "city")


@query
def payload_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points and rebounds of each competitor, from the payload's statistics array."""
    records = silver.statistics_records(_payload_events(spark, sf_dir))
    return silver.team_stats(records).select("game_id", "team_id", "season_id", "points", "rebounds")


@query
def request_truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates with as many orders as one request may return."""
    per_day = tables.load(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date"))
    counts = per_day.agg(F.count(F.lit(1)).alias("events"))
    return counts.withColumn("maybe_truncated", F.col("events") >= 10)


@query
def stats_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named statistics of every box score as typed columns."""
    stats = silver.team_stats(tables.box_scores(spark, sf_dir), tables.BOX_SCORE_COLUMNS)
    return stats.select(
        "game_id", "team_id", "points", "field_goals_made", "field_goals_attempted",
        "field_goal_pct", "rebounds", "assists", "turnovers",
    )


@query
def stats_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics in long form, summed per name and season."""
    long = silver.team_stats_long(tables.box_scores(spark, sf_dir))
    return long.groupBy("statistic", "season_id").agg(
        F.count(F.lit(1)).alias("entries"), F.sum(F.col("value").try_cast("int")).alias("total")
    )


@query
def season_team_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season totals per team; percentages from the sums."""
    stats = silver.team_stats(tables.box_scores(spark, sf_dir), tables.BOX_SCORE_COLUMNS)
    return silver.season_team_stats(stats).select(
        "team_id", "season_id", "games", "points", "field_goals_made", "field_goals_attempted",
        "field_goal_pct", "rebounds", "assists", "turnovers",
    )


@query
def unpaired_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items that are part of no game, with the reason."""
    return tables.unpaired_lines(spark, sf_dir)


@query
def line_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in all, in games and in none: the last two sum to the first."""

    def counted(rows: DataFrame, part: str, each: int = 1) -> DataFrame:
        return rows.agg((F.count(F.lit(1)) * each).alias("lines")).withColumn("part", F.lit(part))

    parts = [
        counted(tables.load(spark, sf_dir, "lineitem"), "all"),
        counted(tables.games(spark, sf_dir), "in games", 2),
        counted(tables.unpaired_lines(spark, sf_dir), "unpaired"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized status of every order, counted."""
    code = F.col("o_orderstatus")
    state = F.when(code == "F", "post").when(code == "O", "pre").when(code == "P", "in")
    status = values.game_status(state, F.lit(None).cast("string"))
    return tables.load(spark, sf_dir, "orders").groupBy(status.alias("status")).agg(
        F.count(F.lit(1)).alias("games")
    )


@query
def game_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games joined with both teams, their conferences and the venue."""
    return gold.with_dimensions(
        tables.games(spark, sf_dir),
        tables.teams(spark, sf_dir),
        tables.venues(spark, sf_dir),
        tables.conferences(spark, sf_dir),
    ).select("game_id", "home_team", "home_conference", "away_team", "away_conference", "venue", "venue_city")


@query
def conference_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams per conference and division."""
    named = tables.conferences(spark, sf_dir).join(tables.divisions(spark, sf_dir), "division_id", "left")
    counts = tables.teams(spark, sf_dir).groupBy("conference_id").agg(F.count(F.lit(1)).alias("teams"))
    return named.join(counts, "conference_id", "left").select(
        F.col("name").alias("conference"), "division", F.coalesce("teams", F.lit(0)).alias("teams")
    )


@query
def conference_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games per home conference and season."""
    per_team = tables.games(spark, sf_dir).groupBy("home_team_id", "season_id").agg(F.count(F.lit(1)).alias("n"))
    member = tables.teams(spark, sf_dir).select(F.col("team_id").alias("home_team_id"), "conference_id")
    return per_team.join(member, "home_team_id", "left").groupBy("conference_id", "season_id").agg(
        F.sum("n").alias("games")
    )


# --- gold ---------------------------------------------------------------------------


def _silver_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule as a written silver table: window features read it more than once."""
    return materialize(tables.games(spark, sf_dir))


def _on_games(build: Callable[[DataFrame], DataFrame], name: str, doc: str, once: bool = False) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(tables.games(spark, sf_dir) if once else _silver_games(spark, sf_dir))

    run.__name__, run.__doc__ = name, doc
    query(run)


_on_games(gold.season_record, "season_record", "Record and scoring averages per team and season.", once=True)
_on_games(gold.record_splits, "record_splits", "Home, away, neutral-site and conference records.", once=True)
_on_games(gold.season_to_date, "season_to_date", "Record and scoring entering each game.")
_on_games(lambda g: gold.form(g, 5), "form_last5", "Results and scoring over the last five played games.")
_on_games(lambda g: gold.form(g, 10), "form_last10", "Results and scoring over the last ten played games.")
_on_games(gold.rest_days, "rest_days", "Days since each team's previous game.")
_on_games(gold.streaks, "streaks", "Current winning or losing run entering each game.")
_on_games(gold.trends, "trends", "Slope of the margin over the last ten played games.")
_on_games(gold.head_to_head, "head_to_head", "Earlier meetings of the two teams of each game.")
_on_games(gold.historical_performance, "matchups", "Meetings, wins and margin per pair of teams.", once=True)
_on_games(gold.opponent_strength, "opponent_strength", "The opponent's record entering each game.")
_on_games(gold.game_context, "game_context", "Site, rest, conference matchup and earlier meetings.")
_on_games(gold.prediction_features, "prediction_features", "All features of both sides, and the labels.")


@query
def team_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every game seen from both teams."""
    return gold.team_games(tables.games(spark, sf_dir)).select(
        "team_id", "season_id", F.col("day").alias("game_day"), "game_id", "opponent_id", "is_home",
        "points_for", "points_against", "win", "loss",
    )


@query
def matchup_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every game under its order-free team pair."""
    return gold.matchup_games(tables.games(spark, sf_dir)).select("team_low", "team_high", "game_id", "home_score", "away_score")


@query
def games_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games of one calendar year, as a date range."""
    return gold.games_between(tables.games(spark, sf_dir), "1997-01-01", "1997-12-31").select(
        "game_id", "season_id", "home_team_id", "away_team_id"
    )


@query
def upcoming_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled games from a reference day on."""
    return gold.upcoming_games(tables.games(spark, sf_dir), "2000-01-01").select(
        "game_id", "home_team_id", "away_team_id", "status"
    )


@query
def conference_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conference matchups derived from team membership."""
    unmarked = tables.games(spark, sf_dir).withColumn("conference_game", F.lit(None).cast("boolean"))
    return gold.conference_flag(unmarked, tables.teams(spark, sf_dir)).select("game_id", "conference_game")


@query
def division_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games with a team from one division's conferences."""
    asia = tables.conferences(spark, sf_dir).join(
        tables.divisions(spark, sf_dir).where("division = 'ASIA'"), "division_id", "left_semi"
    )
    return gold.games_of_conferences(_silver_games(spark, sf_dir), tables.teams(spark, sf_dir), asia).select(
        "game_id", "home_team_id", "away_team_id"
    )


@query
def game_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box scores of the two teams of each game, with site, result and team name."""
    stats = silver.team_stats(tables.box_scores(spark, sf_dir), tables.BOX_SCORE_COLUMNS)
    joined = gold.game_statistics(stats, tables.games(spark, sf_dir), tables.teams(spark, sf_dir))
    return joined.select("game_id", "team_id", "team", "opponent_id", "is_home", "win", "rebounds", "assists")


@query
def refreshed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features built before scheduled games were played, then refreshed for touched teams.

    The result must equal a full rebuild.
    """
    games = _silver_games(spark, sf_dir)
    urgent = F.col("conference_game")
    before = games.withColumns(
        {s: F.when(~urgent, F.col(s)) for s in ("home_score", "away_score")}
    )
    corrected = games.where(urgent & F.col("home_score").isNotNull())
    columns = ["game_id", "team_id", "season_id", "prior_games", "prior_wins", "last5_wins", "streak", "rest_days"]
    stored = materialize(gold.team_performance(before).select(*columns))
    touched = gold.touched_groups(corrected, corrected)
    return gold.refresh_team_performance(games, stored, touched)


@query
def feature_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact statistics per feature, in long form."""
    features = gold.season_record(tables.games(spark, sf_dir))
    summary = gold.feature_summary(features, ("games_played", "wins", "losses", "win_pct"))
    return summary.withColumn("mean", F.round("mean", 6))


@query
def baseline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contingency counts of picking the side with the better record so far, home on ties."""
    features = gold.prediction_features(_silver_games(spark, sf_dir))
    pick = F.when(F.col("diff_prior_win_pct") >= 0, 1).otherwise(0)
    return models.classification_metrics(features.withColumn("prediction", pick))


@query
def model_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact AUC of a fixed score of final games: home team's season wins less the away team's."""
    games = _silver_games(spark, sf_dir)
    wins = gold.season_record(games).select("team_id", "season_id", "wins")
    home = wins.select(F.col("team_id").alias("home_team_id"), "season_id", F.col("wins").alias("home_wins"))
    away = wins.select(F.col("team_id").alias("away_team_id"), "season_id", F.col("wins").alias("away_wins"))
    final = games.where(F.col("status") == "final").join(home, ["home_team_id", "season_id"]).join(away, ["away_team_id", "season_id"])
    scored = final.select(
        (F.col("home_wins") - F.col("away_wins")).cast("double").alias("score"),
        F.when(F.col("home_score") > F.col("away_score"), 1).otherwise(0).alias("label"),
    )
    return models.exact_auc(scored)


@query
def refreshed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction features stored before a late correction, then refreshed where it reaches.

    The correction enters the scores of the final games of the latest day that has any.
    """
    games = _silver_games(spark, sf_dir)
    last_day = games.where("status = 'final'").agg(F.max("date").alias("date"))
    corrected = games.where("status = 'final'").join(last_day, "date", "left_semi")
    late = corrected.select("game_id", F.lit(True).alias("_late"))
    before = materialize(games.join(late, "game_id", "left").withColumns(
        {s: F.when(F.col("_late").isNull(), F.col(s)) for s in ("home_score", "away_score")}
    ).drop("_late"))
    columns = ["game_id", "home_team_id", "away_team_id", "home_prior_games", "away_prior_games",
               "home_streak", "away_streak", "h2h_meetings", "home_win"]
    stored = materialize(gold.prediction_features(before).select(*columns))
    return gold.refresh_prediction_features(games, stored, corrected)


# --- quality and lineage ------------------------------------------------------------


@query
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver rules over games, teams and venues, with an upper score bound."""
    games = tables.games(spark, sf_dir)
    silver_report = quality.validate_silver(games, tables.teams(spark, sf_dir), tables.venues(spark, sf_dir))
    bounds = quality.row_rules(games, "games", quality.in_range("home_score", high=45))
    return quality.report([silver_report, bounds])


@query
def key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness and references between the given tables."""
    load = lambda name: tables.load(spark, sf_dir, name)
    lines = load("lineitem")
    return quality.report(
        [
            quality.unique_rule(lines, "lineitem", ["l_orderkey", "l_linenumber"]),
            quality.unique_rule(load("orders"), "orders", ["o_orderkey"]),
            quality.foreign_key_rule(lines, "lineitem", "l_orderkey", load("orders"), "o_orderkey"),
            quality.foreign_key_rule(lines, "lineitem", "l_suppkey", load("supplier"), "s_suppkey"),
            quality.foreign_key_rule(load("orders"), "orders", "o_custkey", load("customer"), "c_custkey"),
            quality.foreign_key_rule(load("labels"), "labels", "doc_id", load("documents"), "doc_id"),
        ]
    )


@query
def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges from games to the team-season groups they feed."""
    return lineage.gold_dependencies(tables.games(spark, sf_dir))


@query
def lineage_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team-season groups reached by the dates whose content is new or changed."""
    first, second = _captures(spark, sf_dir)
    changed = lineage.changed_keys(second, first).withColumnRenamed("date", "source_date")
    games = tables.games(spark, sf_dir)
    edges = games.select(F.date_format("date", "yyyy-MM-dd").alias("source_date"), "game_id")
    return lineage.affected_groups(changed, edges, lineage.gold_dependencies(games))


# Models of the lineage graph are trained between the two captures.
TRAINED_AT = datetime(2024, 1, 2, tzinfo=UTC)


@query
def lineage_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models that changed dates reach over stored edges, and whether each is now stale.

    One model per season and one over all seasons, each trained on the season records of its
    seasons after the first capture; the second capture's new or changed dates change them.
    """
    root = shared_dir(spark)
    first, second = _captures(spark, sf_dir)
    games = tables.games(spark, sf_dir)
    features = gold.season_record(games)
    seasons = lineage.model_dependencies(features, "all")
    group_model = seasons.unionByName(seasons.withColumn("model_id", F.concat(F.lit("season-"), "season_id")))
    source_game = games.select(F.date_format("date", "yyyy-MM-dd").alias("source_date"), "game_id")
    lineage.store_edges(root, source_game, lineage.gold_dependencies(games), group_model)
    registry = group_model.select("model_id").distinct().withColumn("trained_at", F.lit(TRAINED_AT).cast("timestamp"))
    changed = lineage.changed_keys(second, first).select(
        F.col("date").alias("source_date"), F.lit(SECOND_CAPTURE).cast("timestamp").alias("changed_at")
    )
    return lineage.stale_models(spark, root, changed, registry)


@query
def job_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One history row for a merge in which documents arrive as dated records and some are rejected."""
    root = shared_dir(spark)
    orders = tables.load(spark, sf_dir, "orders")
    # A record per priority and day; the final ones lost their date on the way.
    per_day = orders.groupBy("o_orderdate", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    records = per_day.select(
        F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-M-d")).otherwise("unknown").alias("date"),
        F.to_json(F.struct("n", "o_orderstatus")).alias("raw_data"),
    )
    good, rejected = bronze.prepare_scoreboard(records, FIRST_CAPTURE)
    outcomes = upsert.upsert(spark, root, bronze.SCOREBOARD, good)
    return lineage.job_record(outcomes, rejected, "scoreboard")


# --- models (no SQL counterpart) ----------------------------------------------------


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction features as a written table: training reads it many times."""
    return materialize(gold.prediction_features(_silver_games(spark, sf_dir)))


@query
def model_train_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A logistic model on all played games; predictions for the scheduled ones."""
    features = _features(spark, sf_dir)
    upcoming = features.where("status = 'scheduled'")
    scored = models.predict(models.train(features, regParam=0.01), upcoming)
    return scored.select("game_id", "home_team_id", "away_team_id", "prediction", "probability_home", "confidence")


@query
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two model types compared on the last season."""
    return models.compare_models(_features(spark, sf_dir), ("logistic", "forest"))


@query
def spread_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted margin and total of every scheduled game."""
    features = _features(spark, sf_dir)
    upcoming = features.where("status = 'scheduled'")
    parts = [
        models.predict(models.train(features, "linear", label, regParam=0.1), upcoming).select(
            "game_id", F.col("prediction").alias(f"predicted_{label}")
        )
        for label in ("spread", "total")
    ]
    return parts[0].join(parts[1], "game_id")


@query
def model_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a parameter grid on time-ordered folds."""
    return models.tune(_features(spark, sf_dir), grid={"regParam": [0.0, 0.1]}, folds=2)[1]


@query
def model_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean probability of two models on the last season."""
    past, held_out = models.season_split(_features(spark, sf_dir))
    trained = [models.train(past, "logistic", regParam=r) for r in (0.0, 0.1)]
    return models.ensemble([models.predict(m, held_out) for m in trained])


@query
def model_explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contribution of each feature to each scheduled game's prediction."""
    features = _features(spark, sf_dir)
    model = models.train(features, regParam=0.01)
    return models.explain_predictions(model, features.where("status = 'scheduled'"))


@query
def prediction_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions written by date and read back."""
    root = shared_dir(spark)
    features = _features(spark, sf_dir)
    scored = models.predict(models.train(features, regParam=0.01), features.where("status = 'scheduled'"))
    models.write_predictions(scored.select("game_id", "game_date", "probability_home"), root, "2001-08-02")
    return models.read_predictions(spark, root, "game_id long, game_date date, probability_home double")
