import pytest
from pyspark.sql import functions as F

from tipoff.plans import models
from tipoff.plans.gold import FEATURES


@pytest.fixture(scope="module")
def features(spark):
    """Games whose better side so far wins four times in five: there is signal to find."""
    rows = spark.range(600).select(
        F.col("id").cast("string").alias("game_id"),
        F.concat(F.lit("20"), (F.col("id") / 200).cast("int") + 10, F.lit("-"), (F.col("id") / 200).cast("int") + 11).alias("season_id"),
        ((F.col("id") * 37 % 101) / 50.0 - 1).alias("edge"),
    )
    flip = F.col("game_id").cast("int") % 5 == 0
    rows = rows.withColumn("home_win", F.when((F.col("edge") > 0) != flip, 1).otherwise(0))
    rows = rows.withColumns({f"diff_{f}": F.col("edge") if f == "prior_win_pct" else F.lit(0.0) for f in FEATURES})
    rows = rows.withColumns({c: F.lit(0) for c in ("h2h_meetings", "h2h_home_wins", "h2h_away_wins")})
    return rows.withColumns({"spread": F.col("edge") * 10, "total": F.lit(120) + F.col("edge")}).cache()


def test_split_is_by_season(features):
    past, held_out = models.season_split(features)
    assert {r.season_id for r in past.select("season_id").distinct().collect()} == {"2010-11", "2011-12"}
    assert {r.season_id for r in held_out.select("season_id").distinct().collect()} == {"2012-13"}
    with pytest.raises(ValueError, match="more seasons"):
        models.season_split(held_out)


def test_model_beats_the_home_base_rate(features):
    past, held_out = models.season_split(features)
    row = models.evaluate(models.train(past), held_out).first()
    base = held_out.agg(F.avg("home_win")).first()[0]
    assert row.accuracy > max(base, 1 - base) + 0.1
    assert row.games == 200 == row.true_positive + row.false_positive + row.true_negative + row.false_negative


def test_saved_model_predicts_the_same(features, tmp_path):
    model = models.train(features)
    models.save_model(model, str(tmp_path), "logistic", "v1")
    loaded = models.load_model(str(tmp_path), "logistic", "v1")
    pick = lambda m: {r.game_id: r.probability_home for r in models.predict(m, features).collect()}
    assert pick(model) == pick(loaded)


def test_contributions_point_to_the_feature_with_signal(features):
    rows = models.explain_predictions(models.train(features), features).groupBy("feature").agg(F.max(F.abs("contribution")).alias("m"))
    strongest = rows.orderBy(F.desc("m")).first()
    assert strongest.feature == "diff_prior_win_pct"


def test_ensemble_is_the_mean_probability(features):
    scored = [models.predict(models.train(features, regParam=r), features) for r in (0.0, 1.0)]
    each = [{r.game_id: r.probability_home for r in s.collect()} for s in scored]
    for r in models.ensemble(scored).collect():
        assert r.probability_home == pytest.approx((each[0][r.game_id] + each[1][r.game_id]) / 2)
        assert r.confidence == pytest.approx(abs(r.probability_home - 0.5) * 2)


def test_tuning_tests_on_later_seasons_only(features):
    best, trials = models.tune(features, grid={"regParam": [0.0, 5.0]}, folds=2)
    assert set(best) == {"regParam"}
    assert {r.season_id for r in trials.collect()} == {"2011-12", "2012-13"}


def test_regression_of_the_margin(features):
    row = models.evaluate(models.train(features, "linear", "spread"), features, "spread").first()
    assert row.rmse < 0.5


def test_predictions_of_a_repeated_day_are_replaced(spark, features, tmp_path):
    rows = features.select("game_id")
    for n, day in ((600, "2023-03-15"), (600, "2023-03-16"), (100, "2023-03-16")):
        models.write_predictions(rows.limit(n), str(tmp_path), day)
    stored = models.read_predictions(spark, str(tmp_path), "game_id string")
    counts = {r.prediction_date: r["count"] for r in stored.groupBy("prediction_date").count().collect()}
    assert counts == {"2023-03-15": 600, "2023-03-16": 100}


def test_unknown_model_type(features):
    with pytest.raises(ValueError, match="Unknown model type"):
        models.train(features, "neural")
