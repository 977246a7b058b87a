"""Stale models over stored lineage edges."""

import datetime

from conftest import DATA
from pyspark.sql import functions as F

from tipoff.plans import lineage
from tipoff.workload import QUERIES


def test_models_reached_by_changes(spark):
    got = {r.model_id: r for r in QUERIES["lineage_models"](spark, DATA).collect()}
    seasons = [r for k, r in got.items() if k.startswith("season-")]
    assert got["all"].seasons == len(seasons) and all(r.seasons == 1 for r in seasons)
    assert got["all"].changed_games == sum(r.changed_games for r in seasons)
    assert got["all"].stale == any(r.stale for r in seasons)
    assert all(r.stale == (r.changed_games > 0) for r in got.values())


def test_a_model_trained_after_the_change_is_fresh(spark, tmp_path):
    root = str(tmp_path)
    source_game = spark.createDataFrame([("2024-01-01", "g1"), ("2024-01-02", "g2")], "source_date string, game_id string")
    game_group = spark.createDataFrame([("g1", "t1", "s1"), ("g1", "t2", "s1"), ("g2", "t1", "s2")], "game_id string, team_id string, season_id string")
    group_model = spark.createDataFrame([("s1", "old"), ("s1", "new"), ("s2", "other")], "season_id string, model_id string")
    lineage.store_edges(root, source_game, game_group, group_model)
    when = datetime.datetime(2024, 3, 1)
    registry = spark.createDataFrame(
        [("old", when - datetime.timedelta(days=1)), ("new", when + datetime.timedelta(days=1)), ("other", when), ("lone", when)],
        "model_id string, trained_at timestamp",
    )
    changed = spark.createDataFrame([("2024-01-01", when)], "source_date string, changed_at timestamp")
    got = {r.model_id: tuple(r)[1:] for r in lineage.stale_models(spark, root, changed, registry).collect()}
    assert got == {"old": (1, 1, 2, True), "new": (1, 1, 2, False), "other": (1, 0, 0, False), "lone": (0, 0, 0, False)}
    assert lineage.stale_models(spark, root, changed.where(F.lit(False)), registry).where("stale").count() == 0
