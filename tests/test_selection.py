import math

import numpy as np
import pytest

from riskloom.operators import evidence as E


def _anova(x, y):
    classes = [x[y == c] for c in np.unique(y)]
    between = sum(len(g) * (g.mean() - x.mean()) ** 2 for g in classes) / (len(classes) - 1)
    within = sum(((g - g.mean()) ** 2).sum() for g in classes) / (len(x) - len(classes))
    return between / within


@pytest.mark.parametrize("shift", [0.0, 1e8])
def test_f_score_survives_large_means(spark, shift):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 400)
    x = rng.normal(size=400) + y * 0.3 + shift
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, TARGET int")
    found = E.anova_f(df, "TARGET", ["x"]).first()["f_score"]
    assert found == pytest.approx(_anova(x, y), rel=1e-6)


def test_f_score_counts_missing_as_zero_and_handles_no_spread(spark):
    rows = [(None, 1.0, 5.0, 0), (2.0, 1.0, 5.0, 0), (3.0, 2.0, 5.0, 1), (4.0, 2.0, 5.0, 1)]
    df = spark.createDataFrame(rows, "x double, split double, flat double, TARGET int")
    found = {r["feature"]: r["f_score"] for r in E.anova_f(df, "TARGET", ["x", "split", "flat"]).collect()}
    assert found["x"] == pytest.approx(_anova(np.array([0.0, 2, 3, 4]), np.array([0, 0, 1, 1])))
    assert found["split"] == math.inf
    assert found["flat"] is None


def _best(spark, scores, k):
    df = spark.createDataFrame(list(scores.items()), "feature string, f_score double")
    return [r["feature"] for r in E.select_k_best(df, list(scores), k).collect()]


def test_k_best_keeps_feature_order_and_later_ties(spark):
    scores = {"a": 1.0, "b": 3.0, "c": 1.0, "d": None, "e": 2.0}
    assert _best(spark, scores, 3) == ["b", "c", "e"]
    assert _best(spark, scores, "auto") == ["a", "b", "c", "d", "e"]
    assert _best(spark, scores, 99) == ["a", "b", "c", "d", "e"]
    assert _best(spark, scores, 4) == ["a", "b", "c", "e"]


def test_linear_contributions_sum_to_the_score(spark):
    rows = [(1.0, 2.0), (3.0, -2.0), (5.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    found = {
        r["feature"]: r["mean_abs_contribution"]
        for r in E.contribution_summary(df, {"a": 2.0, "b": -1.0}).collect()
    }
    assert found["a"] == pytest.approx(2.0 * (2 + 0 + 2) / 3)
    assert found["b"] == pytest.approx((2 + 2 + 0) / 3)
