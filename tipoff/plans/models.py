"""Win, spread and total models on the prediction features, with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tipoff.functions.dates import parse_date
from tipoff.functions.values import ratio
from tipoff.plans.gold import FEATURES
from tipoff.session import materialize as _materialize

INPUTS = tuple(f"diff_{f}" for f in FEATURES) + ("h2h_meetings", "h2h_home_wins", "h2h_away_wins")
CLASSIFIERS = {"logistic": LogisticRegression, "forest": RandomForestClassifier, "boosted": GBTClassifier}
REGRESSORS = {"linear": LinearRegression, "boosted": GBTRegressor}


def pipeline(kind: str, label: str = "home_win", inputs: Sequence[str] = INPUTS, **params) -> Pipeline:
    """Fill gaps, assemble, scale, fit. Labels other than ``home_win`` get a regressor."""
    family = CLASSIFIERS if label == "home_win" else REGRESSORS
    if kind not in family:
        raise ValueError(f"Unknown model type: {kind}. Expected one of {', '.join(sorted(family))}.")
    doubles = [f"{c}__in" for c in inputs]
    estimator = family[kind](featuresCol="features", labelCol=label, **params)
    return Pipeline(
        stages=[
            Imputer(inputCols=list(doubles), outputCols=[f"{c}_filled" for c in doubles], strategy="mean"),
            VectorAssembler(inputCols=[f"{c}_filled" for c in doubles], outputCol="assembled"),
            StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True),
            estimator,
        ]
    )


def model_input(features: DataFrame, inputs: Sequence[str] = INPUTS) -> DataFrame:
    """Input columns as doubles; a column with no value at all would fail the imputer."""
    return features.withColumns({f"{c}__in": F.col(c).cast("double") for c in inputs})


def labelled(features: DataFrame, label: str = "home_win") -> DataFrame:
    return features.where(F.col(label).isNotNull())


def season_split(features: DataFrame, test_seasons: int = 1) -> tuple[DataFrame, DataFrame]:
    """Earlier seasons to train on, the last ones to test on. The season list is one row a year."""
    seasons = sorted(r[0] for r in features.select("season_id").distinct().collect())
    if len(seasons) <= test_seasons:
        raise ValueError("A split by season needs more seasons than it holds out.")
    held_out = seasons[-test_seasons:]
    last = F.col("season_id").isin(held_out)
    return features.where(~last), features.where(last)


def train(features: DataFrame, kind: str = "logistic", label: str = "home_win", **params) -> PipelineModel:
    return pipeline(kind, label, **params).fit(model_input(labelled(features, label)))


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Features with ``prediction``, and for classifiers ``probability_home`` and ``confidence``."""
    scored = model.transform(model_input(features))
    if "probability" in scored.columns:
        p = vector_to_array("probability")[1]
        scored = scored.withColumn("probability_home", p).withColumn(
            "confidence", F.abs(F.col("probability_home") - 0.5) * 2
        )
    technical = [c for c in scored.columns if c.endswith(("__in", "__in_filled"))]
    return scored.drop(*technical, "assembled", "features", "rawPrediction", "probability")


def classification_metrics(predictions: DataFrame, label: str = "home_win", prediction: str = "prediction") -> DataFrame:
    """Contingency counts and the rates that follow from them, one row."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = predictions.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).agg(
        F.count(F.lit(1)).alias("games"),
        F.count_if(y & p).alias("true_positive"),
        F.count_if(~y & p).alias("false_positive"),
        F.count_if(~y & ~p).alias("true_negative"),
        F.count_if(y & ~p).alias("false_negative"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("true_positive", "false_positive", "false_negative", "true_negative"))
    return counts.select(
        "*",
        ratio(tp + tn, F.col("games")).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
    )


def exact_auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Area under the ROC curve by rank sums, ties at their mid-rank; one row, no sampling.

    Rows are counted per distinct score (positives: label 1, negatives: label 0; rows with a null
    score or label are left out and counted in ``skipped``). Distinct scores are range-partitioned;
    negatives below each score are a running sum inside each partition plus the negatives of all
    earlier partitions, whose per-partition totals are the only rows the driver reads. Each
    positive then counts the negatives below it and half of those at its score. With no positive
    or no negative the area is null.
    """
    known = F.col(score).isNotNull() & F.col(label).isNotNull()
    counts = scored.groupBy(F.when(known, F.col(score).cast("double")).alias("score")).agg(
        F.count_if(known & (F.col(label) == 1)).alias("pos"),
        F.count_if(known & (F.col(label) == 0)).alias("neg"),
        F.count_if(~known).alias("skipped"),
    )
    skipped = counts.agg(F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped"))
    per_score = counts.where(F.col("score").isNotNull()).drop("skipped")
    spark = scored.sparkSession
    ranked = _materialize(
        per_score.repartitionByRange("score").sortWithinPartitions("score").withColumn("_part", F.spark_partition_id())
    )
    carry, offsets = 0, []
    for r in ranked.groupBy("_part").agg(F.sum("neg").alias("neg")).orderBy("_part").collect():
        offsets.append((r["_part"], carry))
        carry += r["neg"]
    starts = spark.createDataFrame(offsets or [(0, 0)], "_part int, _carry long")
    earlier = Window.partitionBy("_part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(earlier), F.lit(0)) + F.col("_carry")
    placed = ranked.join(F.broadcast(starts), "_part").withColumn("below", below)
    totals = placed.agg(
        F.sum(F.col("pos") * (F.col("below") + F.col("neg") * 0.5)).alias("wins"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
    )
    area = F.when((F.col("positives") > 0) & (F.col("negatives") > 0), F.col("wins") / (F.col("positives") * F.col("negatives")))
    # Two one-row aggregates side by side, joined on a constant.
    one = F.lit(1).alias("_one")
    return totals.select("*", one).join(skipped.select("*", one), "_one").select(area.alias("auc"), "positives", "negatives", "skipped")


def evaluate(model: PipelineModel, test: DataFrame, label: str = "home_win", model_id: str = "model") -> DataFrame:
    """One metrics row for a model on a test set."""
    scored = model.transform(model_input(labelled(test, label)))
    if label != "home_win":
        rmse = RegressionEvaluator(labelCol=label, metricName="rmse").evaluate(scored)
        mae = RegressionEvaluator(labelCol=label, metricName="mae").evaluate(scored)
        rows = [(model_id, label, float(rmse), float(mae))]
        return test.sparkSession.createDataFrame(rows, "model_id string, label string, rmse double, mae double")
    auc = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC").evaluate(scored)
    return classification_metrics(scored, label).select(
        F.lit(model_id).alias("model_id"), F.lit(float(auc)).alias("area_under_roc"), "*"
    )


def compare_models(
    features: DataFrame, kinds: Sequence[str] = tuple(CLASSIFIERS), test_seasons: int = 1
) -> DataFrame:
    """Metrics of several model types on the same held-out seasons."""
    past, held_out = season_split(labelled(features), test_seasons)
    result = None
    for kind in kinds:
        row = evaluate(train(past, kind), held_out, model_id=kind)
        result = row if result is None else result.unionByName(row)
    return result


def tune(
    features: DataFrame, kind: str = "logistic", grid: dict[str, Sequence] | None = None, folds: int = 2
) -> tuple[dict, DataFrame]:
    """Search parameters on time-ordered folds: each fold tests on a season after its training.

    Returns the best parameters and every trial's score.
    """
    grid = grid or {"regParam": [0.0, 0.1], "elasticNetParam": [0.0]}
    data = labelled(features)
    seasons = sorted(r[0] for r in data.select("season_id").distinct().collect())
    if len(seasons) <= folds:
        raise ValueError("Time-ordered folds need more seasons than folds.")
    estimator = CLASSIFIERS[kind]()
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(getattr(estimator, name), list(values))
    evaluator = BinaryClassificationEvaluator(labelCol="home_win")
    trials = []
    for combination in builder.build():
        params = {p.name: v for p, v in combination.items()}
        for season in seasons[-folds:]:
            model = train(data.where(F.col("season_id") < season), kind, **params)
            scored = model.transform(model_input(data.where(F.col("season_id") == season)))
            trials.append((str(params), season, float(evaluator.evaluate(scored)), params))
    means: dict[str, list] = {}
    for text, _, score, params in trials:
        means.setdefault(text, [params]).append(score)
    best = max(means.values(), key=lambda v: sum(v[1:]) / (len(v) - 1))[0]
    frame = features.sparkSession.createDataFrame(
        [t[:3] for t in trials], "params string, season_id string, area_under_roc double"
    )
    return best, frame


def ensemble(scored: Sequence[DataFrame]) -> DataFrame:
    """Mean home probability per game over several models' predictions."""
    merged = scored[0].select("game_id", "home_win", "probability_home")
    for other in scored[1:]:
        merged = merged.unionByName(other.select("game_id", "home_win", "probability_home"))
    mean = merged.groupBy("game_id").agg(
        F.max("home_win").alias("home_win"), F.avg("probability_home").alias("probability_home")
    )
    return mean.withColumns(
        {
            "prediction": F.when(F.col("probability_home") >= 0.5, 1.0).otherwise(0.0),
            "confidence": F.abs(F.col("probability_home") - 0.5) * 2,
        }
    )


def explain_predictions(model: PipelineModel, features: DataFrame, inputs: Sequence[str] = INPUTS) -> DataFrame:
    """Per game and feature: coefficient times standardized value, for linear models."""
    scored = model.transform(model_input(features)).withColumn("_x", vector_to_array("features"))
    weights = [float(w) for w in model.stages[-1].coefficients]
    parts = F.array(
        *[
            F.struct(F.lit(n).alias("feature"), (F.col("_x")[i] * F.lit(w)).alias("contribution"))
            for i, (n, w) in enumerate(zip(inputs, weights))
        ]
    )
    return scored.select("game_id", F.explode(parts).alias("e")).select("game_id", "e.feature", "e.contribution")


def save_model(model: PipelineModel, root: str, name: str, version: str) -> str:
    path = f"{root.rstrip('/')}/models/{name}/{version}"
    model.write().save(path)
    return path


def load_model(root: str, name: str, version: str) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/models/{name}/{version}")


def write_predictions(predictions: DataFrame, root: str, prediction_date: str | date) -> str:
    """One directory per day predictions are made; a repeated day replaces its directory."""
    path = f"{root.rstrip('/')}/predictions"
    day = f"{parse_date(prediction_date):%Y-%m-%d}"
    (
        predictions.withColumn("prediction_date", F.lit(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("prediction_date")
        .parquet(path)
    )
    return path


def read_predictions(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, prediction_date string").parquet(f"{root.rstrip('/')}/predictions")
