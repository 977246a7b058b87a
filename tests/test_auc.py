"""Rank-sum AUC against every positive and negative pair."""

import random

from tipoff.plans import models


def pairwise(rows):
    pos = [s for s, y in rows if s is not None and y == 1]
    neg = [s for s, y in rows if s is not None and y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_equals_all_pairs(spark):
    rng = random.Random(5)
    rows = [(float(rng.randint(0, 40)), rng.randint(0, 1)) for _ in range(1500)] + [(None, 1), (3.0, None)]
    df = spark.createDataFrame(rows, "score double, label int").repartition(7)
    (got,) = models.exact_auc(df).collect()
    assert abs(got.auc - pairwise(rows)) < 1e-12
    assert (got.positives, got.negatives, got.skipped) == (
        sum(1 for s, y in rows if s is not None and y == 1),
        sum(1 for s, y in rows if s is not None and y == 0),
        2,
    )


def test_one_class_and_nothing(spark):
    (got,) = models.exact_auc(spark.createDataFrame([(1.0, 1), (2.0, 1)], "score double, label int")).collect()
    assert got.auc is None and got.positives == 2 and got.negatives == 0
    (got,) = models.exact_auc(spark.createDataFrame([], "score double, label int")).collect()
    assert got.auc is None and got.positives == 0
