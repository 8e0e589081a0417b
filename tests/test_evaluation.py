import random

import pytest

from riskloom.operators import evaluation as V


def _pairs(rows):
    """How often a positive outscores a negative, by looking at every pair."""
    wins = total = 0.0
    for yp, sp in rows:
        for yn, sn in rows:
            if yp == 1 and yn == 0:
                total += 1
                wins += 1.0 if sp > sn else 0.5 if sp == sn else 0.0
    return wins / total


@pytest.fixture(scope="module")
def scored():
    rng = random.Random(5)
    rows = []
    for _ in range(400):
        y = int(rng.random() < 0.3)
        # A third of the rows share one score.
        s = 0.25 if rng.random() < 0.33 else round(rng.random() * 0.6 + 0.3 * y, 2)
        rows.append((y, s))
    return rows


@pytest.mark.parametrize("parts,rows", [(1, 1_000_000), (17, 30)])
def test_areas_match_brute_force(spark, scored, parts, rows, monkeypatch):
    monkeypatch.setattr(V, "CURVE_ROWS", rows)
    df = spark.createDataFrame(scored, "y int, s double").repartition(parts)
    expected = _pairs(scored)
    assert V.roc_auc(df, "y", "s").first()[0] == pytest.approx(expected, abs=1e-12)
    assert V.roc_auc_trapezoid(df, "y", "s").first()[0] == pytest.approx(expected, abs=1e-12)


def test_curve(spark, scored, monkeypatch):
    monkeypatch.setattr(V, "CURVE_ROWS", 25)
    df = spark.createDataFrame(scored, "y int, s double")
    p = sum(y for y, _ in scored)
    n = len(scored) - p
    for r in V.roc_curve(df, "y", "s").collect():
        above = [y for y, s in scored if s >= r["threshold"]]
        assert r["tpr"] == pytest.approx(sum(above) / p)
        assert r["fpr"] == pytest.approx((len(above) - sum(above)) / n)


def test_rounded_scores_bound_the_thresholds(spark):
    df = spark.createDataFrame([(i % 2, i / 1000.0) for i in range(1000)], "y int, s double")
    assert V.roc_curve(df, "y", "s", decimals=1).count() == 11


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.3)], "y int, s double")
    assert V.roc_auc(df, "y", "s").first()[0] is None
    assert V.roc_auc_trapezoid(df, "y", "s").first()[0] is None
    curve = V.roc_curve(df, "y", "s").orderBy("threshold").collect()
    assert [(r["fpr"], r["tpr"]) for r in curve] == [(None, 1.0), (None, 0.5)]


def test_report(spark):
    rows = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 0)] * 1 + [(1, 1)] * 3
    df = spark.createDataFrame(rows, "y int, p int")
    report = {r["row"]: r for r in V.classification_report(df, "y", "p").collect()}
    assert report["0"]["precision"] == pytest.approx(5 / 6)
    assert report["0"]["recall"] == pytest.approx(5 / 7)
    assert report["1"]["f1"] == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    assert report["accuracy"]["f1"] == pytest.approx(8 / 11)
    assert report["0"]["support"] + report["1"]["support"] == report["accuracy"]["support"] == 11
    assert V.accuracy(df, "y", "p").first()[0] == pytest.approx(8 / 11)
    cells = {(r["label"], r["prediction"]): r["n"] for r in V.confusion_matrix(df, "y", "p").collect()}
    assert cells == {(0, 0): 5, (0, 1): 2, (1, 0): 1, (1, 1): 3}


def test_report_without_predictions_of_a_class(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "y int, p int")
    report = {r["row"]: r for r in V.classification_report(df, "y", "p").collect()}
    assert report["1"]["precision"] == 0.0 and report["1"]["f1"] == 0.0
