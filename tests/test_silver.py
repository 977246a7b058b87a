import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tipoff import schemas
from tipoff.operators.reshape import statistic_columns
from tipoff.plans import lineage, quality, registry, silver
from tipoff.sources import bronze
from tipoff.operators import upsert as up

T0 = datetime(2024, 1, 1)


def captures(spark, *payloads, dates=None):
    rows = [
        (dates[i] if dates else f"2023-03-{15 + i:02d}", f"h{i}", p if isinstance(p, str) else json.dumps(p), T0.replace(day=1 + i))
        for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, "date string, content_hash string, raw_data string, created_at timestamp")


def games_of(spark, *payloads, **kw):
    return silver.game_records(silver.events(captures(spark, *payloads, **kw)))


def event(game_id="1", date="2023-03-15T20:00Z", competitors=(), **competition):
    return {"id": game_id, "date": date, "competitions": [{"id": game_id, "competitors": list(competitors), **competition}]}


def side(team, home_away, score):
    return {"id": team, "homeAway": home_away, "score": score, "team": {"id": team}}


def document(seed):
    """A made-up scoreboard document with one finished game of which one side is known."""
    team, venue, game = str(7_000 + seed), str(90_000 + seed), f"g-{seed}"
    home = side(team, "home", str(80 + seed)) | {"statistics": [{"name": n, "displayValue": str(seed + i)} for i, n in enumerate(("rebounds", "assists", "fieldGoalPct"))]}
    home["team"] |= {"displayName": f"Team {seed}", "color": f"{seed:06x}", "alternateColor": f"{seed + 170:06x}"}
    match = event(game, f"2031-0{1 + seed % 3}-09T18:30Z", [home])
    match["season"] = {"year": 2031, "type": 3, "slug": "made-up"}
    match["competitions"][0] |= {
        "venue": {"id": venue, "fullName": f"Hall {seed}", "address": {"city": f"City {seed}", "state": f"S{seed}"}},
        "status": {"type": {"name": "STATUS_FINAL", "state": "post"}},
    }
    return {"events": [match], "unknown": {"key": [seed]}}


FULL = document(4)


def test_full_payload_with_one_side(spark):
    row = games_of(spark, FULL).first()
    assert (row.game_id, row.season_id, row.season_type, row.season_slug) == ("g-4", "2030-31", 3, "made-up")
    assert row.date == datetime(2031, 2, 9, 18, 30)
    assert (row.home_team_id, row.home_score, row.away_team_id, row.away_score) == ("7004", 84, None, None)
    assert (row.status_name, row.status, row.venue_id) == ("STATUS_FINAL", "final", "90004")
    assert (row.neutral_site, row.conference_game, row.missing_team_id) == (False, False, True)


def test_unmarked_competitors_are_away_last_wins_and_flagged(spark):
    teams = [{"team": {"id": "1", "score": "70"}}, {"team": {"id": "2", "score": "65"}}]
    records = games_of(spark, {"events": [event(competitors=teams)]})
    row = records.first()
    assert (row.home_team_id, row.away_team_id, row.home_score, row.away_score) == (None, "2", None, None)
    assert row.missing_home_away
    assert silver.usable_games(records).count() == 0
    assert {r.flag for r in silver.rejected_games(records).collect()} >= {"missing_home_away", "missing_team_id"}


def test_competitors_without_team_keep_scores(spark):
    sides = [{"id": "1", "score": "75", "homeAway": "home"}, {"id": "2", "score": "70", "homeAway": "away"}]
    row = games_of(spark, {"leagues": [], "events": [event(competitors=sides)]}).first()
    assert (row.home_score, row.away_score, row.home_team_id) == (75, 70, None)
    assert row.missing_team_id and not row.missing_home_away


@pytest.mark.parametrize("payload", [{"events": [{"id": "12345"}]}, {"events": [{"id": "1", "date": "2023-03-15", "name": "x"}]},
                                     {"events": []}, {}, {"events": [{"id": "1", "competitions": []}]}])
def test_events_without_competitions_give_no_game(spark, payload):
    assert games_of(spark, payload).count() == 0


def test_two_events_of_one_date(spark):
    payload = {"events": [event(f"event_{i}", f"2023-03-15T2{i}:00Z", [side("1", "home", "1"), side("2", "away", "2")]) for i in (0, 1)]}
    rows = games_of(spark, payload).orderBy("game_id").collect()
    assert [r.date.hour for r in rows] == [20, 21]


@pytest.mark.parametrize("text, value, bad", [("0", 0, False), ("", None, False), (None, None, False), ("72", 72, False), ("7x", None, True), (61, 61, False)])
def test_score_text(spark, text, value, bad):
    row = games_of(spark, {"events": [event(competitors=[side("1", "home", text), side("2", "away", "1")])]}).first()
    assert (row.home_score, row.bad_score) == (value, bad)


@pytest.mark.parametrize("text, expected", [("2023-03-11T16:00Z", datetime(2023, 3, 11, 16)), ("2023-03-11T19:00:00Z", datetime(2023, 3, 11, 19)), ("soon", None)])
def test_event_times(spark, text, expected):
    row = games_of(spark, {"events": [event(date=text, competitors=[side("1", "home", "1")])]}).first()
    assert (row.date, row.bad_date) == (expected, expected is None)


@pytest.mark.parametrize("kind, expected", [({"state": "post"}, "final"), ({"name": "STATUS_FINAL"}, "final"), ({"state": "pre"}, "scheduled"),
                                            ({"state": "in"}, "in_progress"), ({"state": "??"}, None), ({}, None)])
def test_status(spark, kind, expected):
    row = games_of(spark, {"events": [event(competitors=[side("1", "home", "1")], status={"type": kind})]}).first()
    assert (row.status, row.unknown_status) == (expected, expected is None)


def test_newest_record_of_a_date_and_of_a_game_win(spark):
    old, new = ({"events": [event(competitors=[side("1", "home", s), side("2", "away", "1")])]} for s in ("10", "20"))
    assert games_of(spark, old, new, dates=["2023-03-15", "2023-03-15"]).first().home_score == 20
    rows = games_of(spark, old, new, dates=["2023-03-15", "2023-03-16"]).collect()
    assert [r.home_score for r in rows] == [20]


def test_broken_json_is_kept_apart(spark):
    landed = captures(spark, '{"events": [', FULL)
    corrupt = silver.corrupt_payloads(silver.parse_payloads(landed))
    assert [r.source_date for r in corrupt.collect()] == ["2023-03-15"]
    assert silver.events(landed).count() == 1


def test_full_request_may_be_truncated(spark):
    payload = {"events": [{"id": "1"}, {"id": "2"}]}
    rows = silver.truncated_requests(captures(spark, payload, {"events": []}), 2).collect()
    assert sorted((r.events, r.maybe_truncated) for r in rows) == [(0, False), (2, True)]


def test_teams_venues_and_statistics(spark):
    rows = silver.events(captures(spark, FULL))
    team = silver.teams([silver.teams_in_games(rows)]).first()
    assert (team.team_id, team.name, team.color, team.alternate_color) == ("7004", "Team 4", "#000004", "#0000AE")
    venue = silver.venues(rows).first()
    assert (venue.venue_id, venue.city, venue.state, venue.capacity, venue.country) == ("90004", "City 4", "S4", None, None)
    stats = silver.team_stats(silver.statistics_records(rows)).first()
    assert (stats.points, stats.rebounds, stats.assists, stats.field_goal_pct, stats.steals) == (84, 4, 5, 6.0, None)
    assert silver.team_stats_long(silver.statistics_records(rows)).count() == 3


def test_team_pages(spark):
    page = {"count": 12, "pageIndex": 2, "pageSize": 6, "pageCount": 2,
            "items": [{"id": "t1", "displayName": "Team One", "color": "0a1b2c"}, {"id": "t2", "displayName": "Team Two", "color": "abc0de"}]}
    table = spark.createDataFrame([("p1", "h", json.dumps(page), T0)], "parameters string, content_hash string, raw_data string, created_at timestamp")
    rows = silver.teams([silver.teams_in_pages(table)]).orderBy("team_id").collect()
    assert [(r.team_id, r.name, r.color) for r in rows] == [("t1", "Team One", "#0A1B2C"), ("t2", "Team Two", "#ABC0DE")]


def test_repeated_statistic_keeps_the_last_value(spark):
    df = spark.createDataFrame([([("a", "1"), ("b", "x"), ("a", "2")],), ([],), (None,)], "s array<struct<name: string, displayValue: string>>")
    picked = df.select(*[c.alias(n) for n, c in statistic_columns("s", {"a": ("a", "int"), "b": ("b", "int"), "c": ("c", "int")}).items()])
    assert [tuple(r) for r in picked.collect()] == [(2, None, None), (None, None, None), (None, None, None)]


def test_season_percentages_come_from_sums(spark):
    stats = silver.team_stats(
        spark.createDataFrame(
            [("g1", "t", "s", 1, [("m", "1"), ("a", "2")]), ("g2", "t", "s", 1, [("m", "8"), ("a", "8")])],
            "game_id string, team_id string, season_id string, points int, statistics array<struct<name: string, displayValue: string>>",
        ),
        {"m": "field_goals_made", "a": "field_goals_attempted"},
    )
    assert silver.season_team_stats(stats).first().field_goal_pct == 90.0


def test_silver_rules_find_seeded_violations(spark):
    games = spark.createDataFrame(
        [("1", T0, "a", "b", "v", 1, 2, "final"), ("1", None, "a", "zz", "v", -1, None, "final"), ("2", T0, "a", "a", "nope", None, None, "scheduled")],
        "game_id string, date timestamp, home_team_id string, away_team_id string, venue_id string, home_score int, away_score int, status string",
    )
    teams = spark.createDataFrame([("a", "A"), ("b", None)], "team_id string, name string")
    venues = spark.createDataFrame([("v",)], "venue_id string")
    found = {(r.table, r.rule): r.violations for r in quality.validate_silver(games, teams, venues).collect()}
    assert {k: v for k, v in found.items() if v} == {
        ("games", "game_id unique"): 1,
        ("games", "date required"): 1,
        ("games", "home_score at least 0"): 1,
        ("games", "final games have scores"): 1,
        ("games", "teams differ"): 1,
        ("games", "away_team_id references team_id"): 1,
        ("games", "venue_id references venue_id"): 1,
        ("teams", "name required"): 1,
    }


def test_registry_runs_entities_incrementally(spark, root):
    def put(payload, day, hour):
        row = spark.createDataFrame([(day, json.dumps(payload), T0.replace(hour=hour))], "date string, raw_data string, created_at timestamp")
        return up.upsert(spark, root, bronze.SCOREBOARD, bronze.prepare_scoreboard(row)[0])

    other = {"events": [event("7", competitors=[side("1", "home", "1"), side("2", "away", "2")])]}
    put(FULL, "2031-02-09", 1)
    put(other, "2023-03-15", 2)
    assert registry.bronze_to_silver(spark, root, "games").count() == 2
    processed = bronze.read_table(spark, root, bronze.SCOREBOARD).where("date = '2031-02-09'").select("date", "content_hash")
    assert [r.game_id for r in registry.bronze_to_silver(spark, root, "games", processed).collect()] == ["7"]
    for entity in registry.ENTITIES:
        assert registry.bronze_to_silver(spark, root, entity).count() >= 1
    with pytest.raises(ValueError, match="Unknown entity"):
        registry.bronze_to_silver(spark, root, "players")


def test_feature_sets_by_name(spark, tmp_path):
    columns = "game_id string, season_id string, date timestamp, home_team_id string, away_team_id string, home_score int, away_score int, neutral_site boolean, conference_game boolean, status string"
    games = spark.createDataFrame([("1", "2022-23", T0, "a", "b", 70, 60, False, True, "final")], columns)
    listed = registry.list_features(games)
    assert {r.feature_set for r in listed.select("feature_set").distinct().collect()} == set(registry.FEATURE_SETS)
    features = registry.silver_to_gold(games, "team_performance")
    registry.write_gold(features, str(tmp_path / "gold"))
    assert spark.read.parquet(str(tmp_path / "gold")).count() == 2
    summary = registry.analyze_feature(features, "points_for").first()
    assert (summary["values"], summary.minimum, summary.maximum, summary.mean) == (2, 60.0, 70.0, 65.0)
    with pytest.raises(ValueError, match="Unknown feature set"):
        registry.silver_to_gold(games, "player_performance")


def test_changed_keys_and_their_reach(spark):
    old = spark.createDataFrame([("d1", "a"), ("d2", "b")], "date string, content_hash string")
    new = spark.createDataFrame([("d1", "a"), ("d2", "c"), ("d3", "d")], "date string, content_hash string")
    changed = lineage.changed_keys(new, old)
    assert {(r.date, r.change) for r in changed.collect()} == {("d2", "changed"), ("d3", "new")}
    edges = spark.createDataFrame([("d1", "g1"), ("d2", "g2")], "source_date string, game_id string")
    gold_edges = spark.createDataFrame([("g1", "t1", "s"), ("g2", "t2", "s"), ("g2", "t3", "s")], "game_id string, team_id string, season_id string")
    reached = lineage.affected_groups(changed.withColumnRenamed("date", "source_date"), edges, gold_edges)
    assert {r.team_id for r in reached.collect()} == {"t2", "t3"}


def test_job_history_rows(spark, tmp_path):
    outcomes = spark.createDataFrame([("insert",), ("insert",), ("update",), ("unchanged",)], "action string")
    record = lineage.job_record(outcomes, spark.range(2), "scoreboard")
    lineage.append_history(record, str(tmp_path / "jobs"))
    lineage.append_history(record, str(tmp_path / "jobs"))
    rows = spark.read.parquet(str(tmp_path / "jobs")).collect()
    assert [(r.successful, r.failed, r.inserted, r.updated, r.unchanged) for r in rows] == [(4, 2, 2, 1, 1)] * 2


def test_conferences_have_unique_ids(spark):
    table = silver.conferences(spark)
    assert table.select("conference_id").distinct().count() == table.count()
    assert table.where(F.col("short_name") == "SEC").first().conference_id == "23"


@pytest.mark.parametrize(("state", "score", "live"), [("pre", None, None), ("in", None, 3), ("post", 3, None)])
def test_scores_before_and_during_a_game_are_no_result(spark, state, score, live):
    sides = [side("1", "home", "3"), side("2", "away", "3")]
    row = games_of(spark, {"events": [event(competitors=sides, status={"type": {"state": state}})]}).first()
    assert (row.home_score, row.away_score, row.home_live_score, row.away_live_score) == (score, score, live, live)


def test_several_rows_of_a_game_are_one_game(spark):
    rows = [("1", "g", "s", 4), ("1", "g", "s", 6), ("1", "h", "s", 5)]
    stats = spark.createDataFrame(rows, "team_id string, game_id string, season_id string, rebounds int")
    missing = [c for c in schemas.COUNT_STATISTICS if c != "rebounds"]
    stats = stats.withColumns({c: F.lit(None).cast("int") for c in missing})
    row = silver.season_team_stats(stats).first()
    assert (row.games, row.rebounds) == (2, 15)


def test_team_by_id_reaches_the_scan(spark, tmp_path):
    from tipoff.plans import silver as plans

    teams = spark.createDataFrame([("1", "A", "#1"), ("2", "B", "#2"), (None, "C", None)], "team_id string, name string, color string")
    teams.write.parquet(str(tmp_path / "teams"))
    stored = spark.read.parquet(str(tmp_path / "teams"))
    one = plans.team_by_id(stored, 2)
    assert [r.name for r in one.collect()] == ["B"]
    assert "PushedFilters: [IsNotNull(team_id), EqualTo(team_id,2)]" in one._jdf.queryExecution().executedPlan().toString()
    ids = spark.createDataFrame([(1,), (1,), (9,), (None,)], "team_id long")
    assert sorted(r.name for r in plans.teams_by_id(stored, ids).collect()) == ["A"]


def test_only_repeated_keys_are_ranked(spark, monkeypatch):
    """Records alone under their key are not shuffled; the rows are those of ranking all of them."""
    payloads = [{"events": [event(str(i), competitors=[side("1", "home", str(i)), side("2", "away", "1")]), event(f"{i}b")]} for i in range(6)]
    alone = silver.events(captures(spark, *payloads))
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and alone.count() == 12
    days = ["2023-03-15", "2023-03-16", "2023-03-15", None, None, "2023-03-17"]
    some = captures(spark, *payloads, dates=days)
    some = some.unionByName(some)
    want = silver.newest_events(some, ("date",)).where("date is not null")
    for limit in (100, 0):
        monkeypatch.setattr(silver, "REPEATED_KEYS", limit)
        for landed in (some, captures(spark, *payloads, dates=days)):
            got = silver.events(landed).select("source_date", "event.id", "content_hash")
            copies = 2 if landed is some else 1
            assert sorted(map(tuple, got.collect())) == sorted(
                (d, i, f"h{n}") for n, d in ((1, days[1]), (2, days[0]), (5, days[5])) for i in (str(n), f"{n}b") for _ in range(copies)
            )
    assert want.count() == 12
