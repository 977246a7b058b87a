"""Gold features from silver games. Every feature of a game uses earlier games only.

``games`` needs ``game_id, season_id, date, home_team_id, away_team_id, home_score,
away_score, status, neutral_site, conference_game``. Timelines run per team and season (per
pair for head-to-head), ordered by day and game id. A game that is not final or lacks a score
has features but counts for nobody. Ties count for neither side, but their points do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tipoff.functions.values import ratio
from tipoff.operators.reshape import final_result, pair_columns, team_rows
from tipoff.operators.timeline import (
    by_size,
    entering,
    entering_whole,
    join_same,
    look_back,
    look_back_whole,
    prior_totals,
)
from tipoff.session import materialize

TEAM_SEASON = ["team_id", "season_id"]
PAIR = ["team_low", "team_high"]
RECENT = (5, 10)


def team_games(games: DataFrame) -> DataFrame:
    """One row per game and team, with result flags and the calendar day."""
    return team_rows(games).withColumn("day", F.to_date("date"))


# --- records ------------------------------------------------------------------------


def _split_flags() -> dict[str, Column]:
    home = F.col("is_home") & ~F.col("neutral_site")
    away = ~F.col("is_home") & ~F.col("neutral_site")
    return {"home": home, "away": away, "neutral": F.col("neutral_site"), "conference": F.col("conference_game")}


def season_record(games: DataFrame) -> DataFrame:
    """Wins, losses, win share and scoring averages per team and season."""
    totals = team_games(games).groupBy(*TEAM_SEASON).agg(
        F.count_if("win").alias("wins"),
        F.count_if("loss").alias("losses"),
        F.coalesce(F.sum(F.when(F.col("played"), F.col("points_for"))), F.lit(0)).alias("points_for"),
        F.coalesce(F.sum(F.when(F.col("played"), F.col("points_against"))), F.lit(0)).alias("points_against"),
    )
    return totals.withColumn("games_played", F.col("wins") + F.col("losses")).select(
        *TEAM_SEASON,
        "games_played",
        "wins",
        "losses",
        ratio("wins", "games_played").alias("win_pct"),
        ratio("points_for", "games_played").alias("avg_points_for"),
        ratio("points_against", "games_played").alias("avg_points_against"),
    )


def record_splits(games: DataFrame) -> DataFrame:
    """Home, away, neutral-site and conference records in one pass."""
    flags = _split_flags()
    return team_games(games).groupBy(*TEAM_SEASON).agg(
        *[
            F.count_if(flag & F.col(result)).alias(f"{name}_{plural}")
            for name, flag in flags.items()
            for result, plural in (("win", "wins"), ("loss", "losses"))
        ]
    )


# --- features entering a game -------------------------------------------------------


def _one(flag: Column) -> Column:
    return F.when(flag, 1).otherwise(0)


def _timeline(rows: DataFrame, whole: bool = False) -> DataFrame:
    """Season to date, rest and streak entering each game, in one running-total pass.

    ``whole``: no (team, season) group is too large for one task."""
    played, win, loss = F.col("played"), F.col("win"), F.col("loss")
    measures = {
        "wins": _one(win),
        "losses": _one(loss),
        "points_for": F.when(played, F.col("points_for")),
        "points_against": F.when(played, F.col("points_against")),
    }
    for name, flag in _split_flags().items():
        if name != "neutral":
            measures[f"{name}_wins"] = _one(flag & win)
            measures[f"{name}_losses"] = _one(flag & loss)
    labels = {"win": win, "loss": loss, "tie": played & ~win & ~loss}
    state = entering_whole if whole else entering
    rows = state(rows, TEAM_SEASON, "day", ["game_id"], played, measures, labels)
    before = F.col("position") - 1
    since_other = [
        F.when(F.col(f"last_{name}") == before, before - F.greatest(*[f"last_{o}" for o in others])).otherwise(0)
        for name, others in (("win", ("loss", "tie")), ("loss", ("win", "tie")))
    ]
    prior_games = F.col("prior_wins") + F.col("prior_losses")
    return rows.withColumns(
        {
            "prior_games": prior_games,
            "prior_win_pct": ratio(F.col("prior_wins"), prior_games),
            "prior_avg_points_for": ratio(F.col("prior_points_for"), prior_games),
            "prior_avg_points_against": ratio(F.col("prior_points_against"), prior_games),
            "rest_days": F.datediff("day", "previous_day"),
            # Positive: wins in a row; negative: losses in a row; 0 after a tie or at the start.
            "streak": since_other[0] - since_other[1],
        }
    ).drop("last_win", "last_loss", "last_tie", "previous_day")


def team_timeline(games: DataFrame) -> DataFrame:
    """Each team's state entering each game of its season."""
    return by_size(team_games(games), TEAM_SEASON, lambda rows: _timeline(rows, True), _timeline)


def season_to_date(games: DataFrame) -> DataFrame:
    return team_timeline(games).select(
        "game_id",
        *TEAM_SEASON,
        "prior_games",
        "prior_wins",
        "prior_losses",
        "prior_win_pct",
        "prior_avg_points_for",
        "prior_avg_points_against",
    )


def rest_days(games: DataFrame) -> DataFrame:
    """Days since the team's previous game of the season, null before the first."""
    return team_timeline(games).select("game_id", *TEAM_SEASON, "rest_days")


def streaks(games: DataFrame) -> DataFrame:
    return team_timeline(games).select("game_id", *TEAM_SEASON, "streak")


def _recent_features(n: int) -> dict[str, tuple[int, Column]]:
    played = F.col("played")
    return {
        f"last{n}_games": (n, F.count_if(played)),
        f"last{n}_wins": (n, F.count_if("win")),
        f"last{n}_losses": (n, F.count_if("loss")),
        f"last{n}_points_for": (n, F.sum(F.when(played, F.col("points_for")))),
        f"last{n}_points_against": (n, F.sum(F.when(played, F.col("points_against")))),
    }


def _trend_sums(n: int) -> dict[str, tuple[int, Column]]:
    x = F.when(F.col("played"), F.col("position"))
    y = F.when(F.col("played"), (F.col("points_for") - F.col("points_against")).cast("long"))
    return {
        "_n": (n, F.count(x)),
        "_sx": (n, F.sum(x)),
        "_sy": (n, F.sum(y)),
        "_sxy": (n, F.sum(x * y)),
        "_sxx": (n, F.sum(x * x)),
    }


def _recent_form(timeline: DataFrame, spans: tuple[int, ...], whole: bool = False) -> DataFrame:
    """Results, scoring and margin trend over the last ``n`` played games."""
    features = {k: v for n in spans for k, v in _recent_features(n).items()}
    longest = max(spans)
    features |= _trend_sums(longest)
    if whole:
        rows = look_back_whole(timeline, TEAM_SEASON, "position", features)
    else:
        rows = look_back(timeline, TEAM_SEASON, "position", F.col("played"), features)
    rows = rows.fillna(0, [f"last{n}_{what}" for n in spans for what in ("games", "wins", "losses")])
    for n in spans:
        count = F.col(f"last{n}_games")
        decided = F.col(f"last{n}_wins") + F.col(f"last{n}_losses")
        rows = rows.withColumns(
            {
                f"last{n}_win_pct": ratio(F.col(f"last{n}_wins"), decided),
                f"last{n}_avg_points_for": ratio(F.col(f"last{n}_points_for"), count),
                f"last{n}_avg_points_against": ratio(F.col(f"last{n}_points_against"), count),
            }
        )
    # Least-squares slope of the margin over the game number, from whole-number sums.
    slope = F.try_divide(
        (F.col("_n") * F.col("_sxy") - F.col("_sx") * F.col("_sy")).cast("double"),
        (F.col("_n") * F.col("_sxx") - F.col("_sx") * F.col("_sx")).cast("double"),
    )
    return rows.withColumn("margin_trend", slope).drop("_n", "_sx", "_sy", "_sxy", "_sxx")


def team_performance(games: DataFrame, spans: tuple[int, ...] = RECENT) -> DataFrame:
    """The team feature set: one row per game and team."""
    return by_size(
        team_games(games),
        TEAM_SEASON,
        lambda rows: _recent_form(_timeline(rows, True), spans, True),
        lambda rows: _recent_form(_timeline(rows), spans),
    ).drop("position")


def form(games: DataFrame, n: int) -> DataFrame:
    return team_performance(games, (n,)).select(
        "game_id",
        *TEAM_SEASON,
        f"last{n}_games",
        f"last{n}_wins",
        f"last{n}_losses",
        f"last{n}_win_pct",
        f"last{n}_avg_points_for",
        f"last{n}_avg_points_against",
    )


def trends(games: DataFrame, n: int = 10) -> DataFrame:
    return team_performance(games, (n,)).select("game_id", *TEAM_SEASON, "margin_trend")


# --- pairs --------------------------------------------------------------------------


def _paired(games: DataFrame) -> DataFrame:
    played = final_result("home_score", "away_score")
    home_win = played & (F.col("home_score") > F.col("away_score"))
    away_win = played & (F.col("home_score") < F.col("away_score"))
    low_home = F.col("home_team_id") == F.col("team_low")
    margin = F.when(played, F.col("home_score") - F.col("away_score"))
    return (
        games.where("home_team_id is not null and away_team_id is not null")
        .withColumns(pair_columns())
        .withColumns(
            {
                "played": played,
                "low_win": (low_home & home_win) | (~low_home & away_win),
                "high_win": (low_home & away_win) | (~low_home & home_win),
                "low_margin": F.when(low_home, margin).otherwise(-margin),
                "day": F.to_date("date"),
            }
        )
    )


def _with_meetings(games: DataFrame) -> DataFrame:
    """Games with both teams known, and the earlier meetings of the two."""
    rows = prior_totals(
        _paired(games),
        PAIR,
        "day",
        ["game_id"],
        {"meetings": _one(F.col("played")), "low_wins": _one(F.col("low_win")), "high_wins": _one(F.col("high_win"))},
    )
    low_home = F.col("home_team_id") == F.col("team_low")
    low, high = F.col("prior_low_wins"), F.col("prior_high_wins")
    return rows.select(
        *games.columns,
        F.col("prior_meetings").alias("h2h_meetings"),
        F.when(low_home, low).otherwise(high).alias("h2h_home_wins"),
        F.when(low_home, high).otherwise(low).alias("h2h_away_wins"),
    )


def head_to_head(games: DataFrame) -> DataFrame:
    """Earlier meetings of the two teams, at either venue and in any season."""
    return _with_meetings(games).select(
        "game_id", "home_team_id", "away_team_id", "h2h_meetings", "h2h_home_wins", "h2h_away_wins"
    )


def historical_performance(games: DataFrame) -> DataFrame:
    """Meetings, wins each way and average margin per pair of teams."""
    return _paired(games).groupBy(*PAIR).agg(
        F.count_if("played").alias("meetings"),
        F.count_if("low_win").alias("low_wins"),
        F.count_if("high_win").alias("high_wins"),
        F.coalesce(
            F.try_divide(F.sum("low_margin").cast("double"), F.count("low_margin").cast("double")), F.lit(0.0)
        ).alias("avg_low_margin"),
    )


def matchup_games(games: DataFrame, team: object = None, other: object = None) -> DataFrame:
    """Games between two teams at either venue; of every pair when none is named."""
    rows = games.where("home_team_id is not null and away_team_id is not null").withColumns(pair_columns())
    if team is not None:
        rows = rows.where(
            (F.col("team_low") == F.least(F.lit(team), F.lit(other)))
            & (F.col("team_high") == F.greatest(F.lit(team), F.lit(other)))
        )
    return rows


# --- game context -------------------------------------------------------------------


def conference_flag(games: DataFrame, teams: DataFrame) -> DataFrame:
    """Fill ``conference_game`` from team membership where the payload does not tell."""
    member = teams.select("team_id", "conference_id")
    home = member.select(F.col("team_id").alias("home_team_id"), F.col("conference_id").alias("_home_conf"))
    away = member.select(F.col("team_id").alias("away_team_id"), F.col("conference_id").alias("_away_conf"))
    same = F.coalesce(F.col("_home_conf") == F.col("_away_conf"), F.lit(False))
    return (
        games.join(home, "home_team_id", "left")
        .join(away, "away_team_id", "left")
        .withColumn("conference_game", F.coalesce(F.col("conference_game"), same))
        .drop("_home_conf", "_away_conf")
    )


def game_context(games: DataFrame) -> DataFrame:
    """Site, rest, conference matchup and earlier meetings, one row per game and team."""
    rows = team_timeline(games).select(
        "game_id", *TEAM_SEASON, "opponent_id", "is_home", "neutral_site", "conference_game", "rest_days"
    )
    history = head_to_head(games).select("game_id", "h2h_meetings", "h2h_home_wins", "h2h_away_wins")
    won, lost = F.col("h2h_home_wins"), F.col("h2h_away_wins")
    site = F.when(F.col("neutral_site"), "neutral").when(F.col("is_home"), "home").otherwise("away")
    return rows.join(history, "game_id").select(
        "game_id",
        *TEAM_SEASON,
        site.alias("site"),
        "rest_days",
        "conference_game",
        "h2h_meetings",
        F.when(F.col("is_home"), won).otherwise(lost).alias("h2h_wins"),
        F.when(F.col("is_home"), lost).otherwise(won).alias("h2h_losses"),
    )


# --- one row per game ---------------------------------------------------------------

FEATURES = (
    "prior_games",
    "prior_win_pct",
    "prior_avg_points_for",
    "prior_avg_points_against",
    "last5_win_pct",
    "last5_avg_points_for",
    "last5_avg_points_against",
    "last10_win_pct",
    "rest_days",
    "streak",
    "margin_trend",
)


def prediction_features(games: DataFrame) -> DataFrame:
    """Both teams' features, their differences, earlier meetings and the labels.

    The two team rows of a game meet in one aggregate on ``game_id``; no as-of join.
    """
    perf = team_performance(games)
    both = F.struct(*[F.col(f) for f in FEATURES])
    sides = perf.groupBy("game_id").agg(
        F.max(F.when(F.col("is_home"), both)).alias("home"),
        F.max(F.when(~F.col("is_home"), both)).alias("away"),
    )
    joined = _with_meetings(games).join(sides, "game_id")
    played = final_result("home_score", "away_score")
    margin = F.when(played, F.col("home_score") - F.col("away_score"))
    return joined.select(
        "game_id",
        "season_id",
        F.to_date("date").alias("game_date"),
        "status",
        "home_team_id",
        "away_team_id",
        "neutral_site",
        "conference_game",
        *[F.col(f"home.{f}").alias(f"home_{f}") for f in FEATURES],
        *[F.col(f"away.{f}").alias(f"away_{f}") for f in FEATURES],
        *[(F.col(f"home.{f}") - F.col(f"away.{f}")).alias(f"diff_{f}") for f in FEATURES],
        "h2h_meetings",
        "h2h_home_wins",
        "h2h_away_wins",
        F.when(margin != 0, F.when(margin > 0, 1).otherwise(0)).alias("home_win"),
        margin.alias("spread"),
        F.when(played, F.col("home_score") + F.col("away_score")).alias("total"),
    )


def opponent_strength(games: DataFrame) -> DataFrame:
    """The opponent's record entering each game."""
    timeline = team_timeline(games)
    entering_game = F.struct("season_id", "prior_games", "prior_win_pct", "prior_avg_points_for")
    sides = timeline.groupBy("game_id").agg(
        F.max(F.when(F.col("is_home"), F.col("team_id"))).alias("home_id"),
        F.max(F.when(~F.col("is_home"), F.col("team_id"))).alias("away_id"),
        F.max(F.when(F.col("is_home"), entering_game)).alias("home"),
        F.max(F.when(~F.col("is_home"), entering_game)).alias("away"),
    )
    view = F.explode(
        F.array(
            F.struct(F.col("home_id").alias("team_id"), F.col("away_id").alias("opponent_id"), F.col("away").alias("o")),
            F.struct(F.col("away_id").alias("team_id"), F.col("home_id").alias("opponent_id"), F.col("home").alias("o")),
        )
    ).alias("v")
    return sides.select("game_id", view).select(
        "game_id",
        "v.team_id",
        "v.opponent_id",
        F.col("v.o.season_id").alias("season_id"),
        F.col("v.o.prior_games").alias("opp_prior_games"),
        F.col("v.o.prior_win_pct").alias("opp_prior_win_pct"),
        F.col("v.o.prior_avg_points_for").alias("opp_prior_avg_points_for"),
    )


# --- lookups ------------------------------------------------------------------------


def games_of_team(games: DataFrame, team_id: object, season_id: object = None) -> DataFrame:
    rows = games.where((F.col("home_team_id") == F.lit(team_id)) | (F.col("away_team_id") == F.lit(team_id)))
    if season_id is not None:
        rows = rows.where(F.col("season_id") == F.lit(season_id))
    return rows.orderBy("date", "game_id")


def games_between(games: DataFrame, start: str, end: str) -> DataFrame:
    """Games of a date range, both days included."""
    return games.where((F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.date_add(F.lit(end).cast("date"), 1)))


def upcoming_games(games: DataFrame, as_of: str) -> DataFrame:
    return games.where((F.col("status") == "scheduled") & (F.col("date") >= F.lit(as_of).cast("date")))


def with_dimensions(games: DataFrame, teams: DataFrame, venues: DataFrame, conferences: DataFrame) -> DataFrame:
    """Games with both teams' names and conferences and the venue.

    Left joins without hints: Spark broadcasts a dimension only if its measured size
    allows, and otherwise splits hot teams while sort-merging.
    """
    named = teams.join(conferences.select("conference_id", F.col("name").alias("conference")), "conference_id", "left")

    def side(which: str) -> DataFrame:
        return named.select(
            F.col("team_id").alias(f"{which}_team_id"),
            F.col("name").alias(f"{which}_team"),
            F.col("conference").alias(f"{which}_conference"),
        )

    venue = venues.select("venue_id", F.col("name").alias("venue"), F.col("city").alias("venue_city"))
    return (
        games.join(side("home"), "home_team_id", "left")
        .join(side("away"), "away_team_id", "left")
        .join(venue, "venue_id", "left")
    )


def games_of_conferences(games: DataFrame, teams: DataFrame, conferences: DataFrame) -> DataFrame:
    """Games in which at least one team belongs to one of the given conferences."""
    members = teams.join(conferences.select("conference_id"), "conference_id", "left_semi").select("team_id")
    sides = games.select("game_id", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    wanted = sides.join(members, "team_id", "left_semi").select("game_id").distinct()
    return games.join(wanted, "game_id", "left_semi")


def game_statistics(stats: DataFrame, games: DataFrame, teams: DataFrame) -> DataFrame:
    """Team statistics with their game and team: site, result and team name."""
    sides = team_games(games).select(
        "game_id", "team_id", "opponent_id", "is_home", F.col("day").alias("game_day"), "win"
    )
    named = teams.select("team_id", F.col("name").alias("team"))
    return stats.join(sides, ["game_id", "team_id"]).join(named, "team_id")


def feature_summary(features: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Count, nulls, minimum, maximum and mean per numeric column, in long form, one pass."""
    numeric = ("int", "bigint", "double", "float", "smallint")
    names = list(columns or [n for n, t in features.dtypes if t in numeric])
    stats = features.agg(
        *[
            F.struct(
                F.count(n).alias("values"),
                F.count_if(F.col(n).isNull()).alias("nulls"),
                F.min(n).cast("double").alias("minimum"),
                F.max(n).cast("double").alias("maximum"),
                F.avg(n).alias("mean"),
            ).alias(n)
            for n in names
        ]
    )
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("s")) for n in names]))
    return stats.select(pairs.alias("p")).select("p.feature", "p.s.*")


def feature_quantiles(features: DataFrame, columns: tuple[str, ...], accuracy: int = 10_000) -> DataFrame:
    """Approximate quartiles per column, in long form."""
    stats = features.agg(
        *[F.approx_percentile(n, [0.25, 0.5, 0.75], accuracy).alias(n) for n in columns]
    )
    pairs = F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col(n).cast("array<double>").alias("q")) for n in columns
    ]))
    return stats.select(pairs.alias("p")).select(
        "p.feature",
        F.col("p.q")[0].alias("q25"),
        F.col("p.q")[1].alias("median"),
        F.col("p.q")[2].alias("q75"),
    )


# --- incremental rebuild ------------------------------------------------------------


def touched_groups(before: DataFrame, after: DataFrame) -> DataFrame:
    """(team, season) groups of changed games, by their old and their new version."""
    cols = ["home_team_id", "away_team_id", "season_id"]
    changed = before.select(*cols).unionByName(after.select(*cols))
    side = F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")
    return changed.select(side, "season_id").where("team_id is not null").distinct()


def refresh_team_performance(games: DataFrame, stored: DataFrame, touched: DataFrame) -> DataFrame:
    """Stored team features with the touched (team, season) groups computed anew.

    Only games with a touched team enter the windows; the opponents' rows computed on
    the way are dropped, since their own groups are incomplete there.
    """
    keys = touched.select(*TEAM_SEASON).distinct()
    by_side = [
        join_same(games, keys.withColumnRenamed("team_id", f"{s}_team_id"), [f"{s}_team_id", "season_id"], "left_semi")
        for s in ("home", "away")
    ]
    ids = by_side[0].select("game_id").unionByName(by_side[1].select("game_id")).distinct()
    needed = materialize(games.join(ids, "game_id", "left_semi"))
    fresh = join_same(team_performance(needed), keys, TEAM_SEASON, "left_semi")
    kept = join_same(stored, keys, TEAM_SEASON, "left_anti")
    return kept.unionByName(fresh.select(*stored.columns))


def refresh_prediction_features(games: DataFrame, stored: DataFrame, changed: DataFrame) -> DataFrame:
    """Stored prediction features with every row a changed game reaches computed anew.

    ``changed`` holds old and new versions of the changed games. They reach the games of
    both teams in that season and later meetings of the pair in any season. Computing those
    needs the whole seasons of all their teams and the whole history of their pairs.
    """
    groups = touched_groups(changed, changed.limit(0))
    pairs = changed.withColumns(pair_columns()).select(*PAIR).distinct()
    paired = games.withColumns(pair_columns())

    def with_team(keys: DataFrame) -> DataFrame:
        """Ids of games with a side in the given (team, season) groups."""
        sides = paired.select("game_id", "season_id", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
        return join_same(sides, keys, TEAM_SEASON, "left_semi").select("game_id")

    reached_ids = with_team(groups).unionByName(paired.join(pairs, PAIR, "left_semi").select("game_id")).distinct()
    reached = paired.join(reached_ids, "game_id", "left_semi")
    seasons = with_team(touched_groups(reached, reached.limit(0)))
    history = paired.join(reached.select(*PAIR).distinct(), PAIR, "left_semi").select("game_id")
    needed = materialize(games.join(seasons.unionByName(history).distinct(), "game_id", "left_semi"))
    fresh = prediction_features(needed).join(reached_ids, "game_id", "left_semi")
    kept = stored.join(reached_ids, "game_id", "left_anti")
    return kept.unionByName(fresh.select(*stored.columns))
