from collections import Counter
from datetime import datetime, timedelta

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tipoff.operators import timeline
from tipoff.plans import gold
from tipoff.sources import tables
from tipoff.session import materialize

SCHEMA = (
    "game_id string, season_id string, date timestamp, home_team_id string, away_team_id string, home_score int, "
    "away_score int, neutral_site boolean, conference_game boolean, status string"
)
START = datetime(2022, 11, 1)


def schedule(spark, rows):
    """(game, day, home, away, home score, away score[, season]) tuples as games."""
    data = [
        (g, r[0] if r else "2022-23", START + timedelta(days=d), h, a, hs, as_, False, False,
         "final" if hs is not None else "scheduled")
        for g, d, h, a, hs, as_, *r in rows
    ]
    return spark.createDataFrame(data, SCHEMA)


def by_game(df, team, *columns):
    rows = df.where(F.col("team_id") == team).orderBy("game_id").collect()
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in rows]


def test_record_of_two_wins_and_one_loss(spark):
    rows = [("a", 0, "Otters", "Newts", 41, 38), ("b", 2, "Toads", "Otters", 50, 29), ("c", 5, "Otters", "Toads", 35, 11)]
    row = gold.season_record(schedule(spark, rows)).where("team_id = 'Otters'").first()
    assert (row.games_played, row.wins, row.losses, round(row.win_pct, 6)) == (3, 2, 1, 0.666667)
    assert (row.avg_points_for, row.avg_points_against) == (35.0, 33.0)


def test_tie_points_count_but_the_game_does_not(spark):
    games = schedule(spark, [("1", 0, "A", "B", 60, 60), ("2", 1, "A", "B", 70, 50)])
    row = gold.season_record(games).where("team_id = 'A'").first()
    assert (row.games_played, row.avg_points_for, row.avg_points_against) == (1, 130.0, 110.0)


def test_team_without_a_played_game_has_zeros_not_nulls(spark):
    row = gold.season_record(schedule(spark, [("1", 0, "A", "B", None, None)])).where("team_id = 'A'").first()
    assert (row.games_played, row.win_pct, row.avg_points_for) == (0, 0.0, 0.0)


def test_zero_is_a_score(spark):
    row = gold.season_record(schedule(spark, [("1", 0, "A", "B", 0, 2)])).where("team_id = 'A'").first()
    assert (row.losses, row.avg_points_against) == (1, 2.0)


def test_rest_days_and_same_day_games(spark):
    games = schedule(spark, [("1", 0, "A", "B", 1, 0), ("2", 4, "A", "C", 1, 0), ("3", 4, "D", "A", 1, 0), ("4", 9, "A", "B", 1, 0)])
    assert by_game(gold.rest_days(games), "A", "rest_days") == [None, 4, 0, 5]


def test_seasons_do_not_mix(spark):
    games = schedule(spark, [("1", 0, "A", "B", 1, 0), ("2", 400, "A", "B", 1, 0, "2023-24")])
    assert by_game(gold.season_to_date(games), "A", "prior_games") == [0, 0]
    assert by_game(gold.rest_days(games), "A", "rest_days") == [None, None]


STREAK_GAMES = [
    ("1", 0, "A", "B", 2, 1), ("2", 1, "A", "B", 2, 1), ("3", 2, "A", "B", None, None), ("4", 3, "A", "B", 2, 1),
    ("5", 4, "A", "B", 1, 2), ("6", 4, "B", "A", 2, 1), ("7", 5, "A", "B", 1, 1), ("8", 6, "A", "B", 2, 1), ("9", 7, "A", "B", 2, 1),
]


def test_streaks_entering_each_game(spark):
    games = schedule(spark, STREAK_GAMES)
    assert by_game(gold.streaks(games), "A", "streak") == [0, 1, 2, 2, 3, -1, -2, 0, 1]


def test_last_five_counts_played_games_only(spark):
    rows = [(str(i), i, "A", "B", 10 + i, 0) if i % 2 == 0 else (str(i), i, "A", "B", None, None) for i in range(10)]
    form = gold.form(schedule(spark, rows), 3)
    assert by_game(form, "A", "last3_games") == [0, 1, 1, 2, 2, 3, 3, 3, 3, 3]
    assert by_game(form, "A", "last3_avg_points_for")[-1] == pytest.approx((14 + 16 + 18) / 3)


def test_margin_trend_is_the_least_squares_slope(spark):
    rows = [(str(i), i, "A", "B", 10 + 2 * i, 10) for i in range(4)]
    assert by_game(gold.trends(schedule(spark, rows)), "A", "margin_trend") == [None, None, 2.0, 2.0]


def test_head_to_head_counts_either_venue_and_earlier_seasons(spark):
    games = schedule(
        spark,
        [("1", 0, "A", "B", 2, 1), ("2", 5, "B", "A", 2, 1), ("3", 5, "A", "C", 2, 1), ("4", 400, "A", "B", 2, 1, "2023-24")],
    )
    rows = {r.game_id: (r.h2h_meetings, r.h2h_home_wins, r.h2h_away_wins) for r in gold.head_to_head(games).collect()}
    assert rows == {"1": (0, 0, 0), "2": (1, 0, 1), "3": (0, 0, 0), "4": (2, 1, 1)}


def test_features_do_not_see_the_game_or_later_ones(spark):
    labels = ("home_win", "spread", "total", "status")
    full = gold.prediction_features(schedule(spark, STREAK_GAMES)).drop(*labels)
    partial = gold.prediction_features(schedule(spark, STREAK_GAMES[:6])).drop(*labels)
    expected = {r for r in full.collect() if int(r.game_id) <= 6}
    assert set(partial.collect()) == expected and len(expected) == 6


def odd_schedule(spark):
    """Games with null seasons and null days, and a team in most rows."""
    games = tables.games(spark, DATA).where("game_id % 3 = 0")
    hot = schedule(spark, [(f"h{i:03d}", i // 3, "HOT", f"T{i % 7}", (i * 7) % 50, (i * 11) % 50) for i in range(90)])
    names = hot.columns
    both = games.select(*[F.col(c).cast(hot.schema[c].dataType).alias(c) for c in names]).unionByName(hot)
    number = F.crc32("game_id")
    return both.withColumns(
        {"season_id": F.when(number % 5 > 0, F.col("season_id")), "date": F.when(number % 7 > 0, F.col("date"))}
    )


@pytest.mark.parametrize("name", ["team_performance", "head_to_head", "prediction_features"])
def test_block_size_does_not_change_the_result(spark, monkeypatch, name):
    games = odd_schedule(spark)
    build = getattr(gold, name)
    expected = Counter(build(games).collect())
    for size in (1, 12):
        monkeypatch.setattr(timeline, "BLOCK_ROWS", size)
        assert Counter(build(games).collect()) == expected


def test_null_seasons_and_days_lose_no_row(spark):
    """The plan for all groups against a loop over each team's games."""
    games = odd_schedule(spark)
    rows = gold.team_games(games).collect()
    want = {}
    for key in {(r.team_id, r.season_id) for r in rows}:
        own = sorted((r for r in rows if (r.team_id, r.season_id) == key), key=lambda r: (r.day is not None, r.day or START.date(), r.game_id))
        wins = losses = 0
        for r in own:
            want[(r.game_id, r.team_id)] = (wins, losses)
            wins, losses = wins + bool(r.win), losses + bool(r.loss)
    got = gold.season_to_date(games).collect()
    assert len(got) == len(rows)
    assert {(r.game_id, r.team_id): (r.prior_wins, r.prior_losses) for r in got} == want


def test_refresh_with_null_seasons_equals_a_full_rebuild(spark):
    before = odd_schedule(spark)
    number = before.where("season_id is null and home_score is not null").orderBy("game_id").first().game_id
    after = before.withColumn("home_score", F.when(F.col("game_id") == number, 99).otherwise(F.col("home_score")))
    changed = [df.where(F.col("game_id") == number) for df in (after, before)]
    stored = gold.team_performance(before)
    refreshed = gold.refresh_team_performance(after, stored, gold.touched_groups(*changed))
    assert Counter(refreshed.collect()) == Counter(gold.team_performance(after).select(*stored.columns).collect())
    stored = gold.prediction_features(before)
    refreshed = gold.refresh_prediction_features(after, stored, changed[0].unionByName(changed[1]))
    assert Counter(refreshed.collect()) == Counter(gold.prediction_features(after).select(*stored.columns).collect())


def test_refresh_equals_a_full_rebuild_after_a_correction(spark):
    rows = [(f"{i:03d}", i, f"T{i % 5}", f"T{(i * 3 + 1) % 5}", 50 + i % 9, 50 + i % 7) for i in range(60) if i % 5 != (i * 3 + 1) % 5]
    before = schedule(spark, rows)
    corrected = [(g, d, h, a, 99 if g == rows[3][0] else hs, as_) for g, d, h, a, hs, as_ in rows]
    after = schedule(spark, corrected)
    changed = [after.where(F.col("game_id") == rows[3][0]), before.where(F.col("game_id") == rows[3][0])]
    stored = gold.team_performance(before)
    refreshed = gold.refresh_team_performance(after, stored, gold.touched_groups(*changed))
    assert set(refreshed.collect()) == set(gold.team_performance(after).select(*stored.columns).collect())


def test_lookups(spark):
    games = schedule(spark, [("1", 0, "A", "B", 2, 1), ("2", 5, "B", "A", 2, 1), ("3", 6, "C", "B", None, None)])
    assert [r.game_id for r in gold.games_of_team(games, "A", "2022-23").collect()] == ["1", "2"]
    assert gold.games_of_team(games, "A", "2021-22").count() == 0
    assert {r.game_id for r in gold.matchup_games(games, "B", "A").collect()} == {"1", "2"}
    assert [r.game_id for r in gold.games_between(games, "2022-11-06", "2022-11-06").collect()] == ["2"]
    assert [r.game_id for r in gold.upcoming_games(games, "2022-11-01").collect()] == ["3"]


def test_refreshed_predictions_equal_a_full_rebuild(spark):
    """The correction reaches the season of both teams and later meetings of the pair."""
    rows = [(f"{i:03d}", i * 7, f"T{i % 6}", f"T{(i * 5 + 1) % 6}", 50 + i % 9, 50 + i % 7, "2022-23" if i < 50 else "2023-24")
            for i in range(100) if i % 6 != (i * 5 + 1) % 6]
    late = rows[5][0]
    before = schedule(spark, rows)
    after = schedule(spark, [(g, d, h, a, 99 if g == late else hs, *r) for g, d, h, a, hs, *r in rows])
    changed = after.where(F.col("game_id") == late).unionByName(before.where(F.col("game_id") == late))
    stored = gold.prediction_features(before)
    refreshed = gold.refresh_prediction_features(after, stored, changed)
    assert set(refreshed.collect()) == set(gold.prediction_features(after).select(*stored.columns).collect())


def test_games_of_conferences_and_statistics(spark):
    games = schedule(spark, [("1", 0, "A", "B", 2, 1), ("2", 5, "C", "D", 2, 1)])
    teams = spark.createDataFrame([("A", "a", "1"), ("B", "b", "2"), ("C", "c", "2"), ("D", "d", "3")], "team_id string, name string, conference_id string")
    one = spark.createDataFrame([("1",)], "conference_id string")
    assert [r.game_id for r in gold.games_of_conferences(games, teams, one).collect()] == ["1"]
    stats = spark.createDataFrame([("1", "A", 30), ("1", "Z", 5)], "game_id string, team_id string, rebounds int")
    rows = gold.game_statistics(stats, games, teams).collect()
    assert [(r.team, r.is_home, r.win, r.rebounds) for r in rows] == [("a", True, True, 30)]


def test_games_that_are_not_final_count_for_nobody(spark):
    games = schedule(spark, [("1", 0, "A", "B", 5, 2), ("2", 1, "A", "B", 9, 9), ("3", 2, "A", "B", 0, 0), ("4", 3, "A", "B", 1, 7), ("5", 4, "A", "B", None, None)])
    unfinished = F.when(F.col("game_id") == "3", "scheduled").when(F.col("game_id") == "4", "in_progress")
    games = games.withColumn("status", F.coalesce(unfinished, F.col("status")))
    # One win and one tie: the tie belongs to neither part of the share.
    assert by_game(gold.form(games, 5), "A", "last5_games", "last5_wins", "last5_losses", "last5_win_pct")[-1] == (2, 1, 0, 1.0)
    labels = {r.game_id: (r.home_win, r.spread) for r in gold.prediction_features(games).collect()}
    assert labels == {"1": (1, 3), "2": (None, 0), "3": (None, None), "4": (None, None), "5": (None, None)}
    assert gold.historical_performance(games).first().meetings == 2


def test_every_line_is_in_a_game_or_listed(spark):
    lines = tables.load(spark, DATA, "lineitem").count()
    unpaired = tables.unpaired_lines(spark, DATA)
    assert 2 * tables.games(spark, DATA).count() + unpaired.count() == lines
    assert {r.reason for r in unpaired.select("reason").distinct().collect()} <= {"last line", "same team", "no order"}


def test_lines_without_team_order_or_mate(spark, tmp_path):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    line = "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_quantity double, l_extendedprice double, l_returnflag string"
    teams = [(1, 1, 7), (1, 2, 8), (1, 3, 9), (1, 4, 9), (1, 5, 7), (2, 1, 7), (2, 2, None), (3, 1, 7), (3, 2, 8)]
    write("lineitem", [(o, n, t, 1, 2.0, 3.0, "N") for o, n, t in teams], line)
    write("orders", [(o, "F", START, 1, "x") for o in (1, 2)], "o_orderkey long, o_orderstatus string, o_orderdate timestamp, o_custkey long, o_orderpriority string")
    assert [(r.home_team_id, r.away_team_id) for r in tables.games(spark, str(tmp_path)).collect()] == [(7, 8)]
    left = {(r.l_orderkey, r.l_linenumber): r.reason for r in tables.unpaired_lines(spark, str(tmp_path)).collect()}
    same = dict.fromkeys([(1, 3), (1, 4), (2, 1), (2, 2)], "same team")
    assert left == same | {(1, 5): "last line", (3, 1): "no order", (3, 2): "no order"}


@pytest.mark.parametrize("name", ["team_performance", "streaks", "head_to_head", "prediction_features"])
def test_large_groups_are_cut_and_give_the_same_rows(spark, monkeypatch, name):
    """All groups whole, the hot ones cut, all cut: the same rows."""
    games = odd_schedule(spark)
    build = getattr(gold, name)
    expected = Counter(build(games).collect())
    monkeypatch.setattr(timeline, "BLOCK_ROWS", 12)
    for most in (20, 0):
        monkeypatch.setattr(timeline, "GROUP_ROWS", most)
        assert Counter(build(games).collect()) == expected


def test_usual_groups_take_one_exchange(spark):
    games = materialize(odd_schedule(spark))
    plan = gold.streaks(games)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
