import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions import scores as S

GOLDEN = (0.9988268613815308, 0.0011731224367395043)


def _row(spark, p0, p1, *columns):
    return spark.createDataFrame([(p0, p1)], "p0 double, p1 double").select(*columns).first()


def test_golden_entropy_and_confidence(spark):
    p0, p1 = F.col("p0"), F.col("p1")
    row = _row(spark, *GOLDEN, S.entropy(p0, p1), S.confidence(p0, p1), S.decision_label(p0, p1))
    assert row[0] == pytest.approx(0.013112341053783894, abs=1e-6)
    assert row[1] == GOLDEN[0]
    assert row[2] == "Accept"
    rounded = _row(spark, *GOLDEN, S.round_score(S.entropy(p0, p1)), S.round_score(p0))
    assert tuple(rounded) == (0.0131, 0.9988)


@pytest.mark.parametrize(
    "p0,p1,label,cls", [(1.0, 0.0, "Accept", 0), (0.0, 1.0, "Decline", 1), (0.5, 0.5, "Accept", 0)]
)
def test_certain_and_tied_rows(spark, p0, p1, label, cls):
    a, b = F.col("p0"), F.col("p1")
    row = _row(spark, p0, p1, S.decision_label(a, b), S.argmax_class(a, b), S.entropy(a, b))
    assert (row[0], row[1]) == (label, cls)
    expected = -sum(p * math.log2(p + 1e-10) for p in (p0, p1))
    assert row[2] == pytest.approx(expected, abs=1e-15)


def test_array_entropy_agrees(spark):
    df = spark.createDataFrame([([0.2, 0.3, 0.5],)], "p array<double>")
    three = S.entropy(*[F.col("p")[i] for i in range(3)])
    row = df.select(S.entropy_of(F.col("p")), three).first()
    assert row[0] == pytest.approx(row[1], abs=1e-15)


@pytest.mark.parametrize(
    "metric,value,band",
    [
        ("api_avg_confidence", 0.69, "red"),
        ("api_avg_confidence", 0.7, "yellow"),
        ("api_avg_confidence", 0.9, "green"),
        ("api_prediction_entropy", 0.49, "green"),
        ("api_prediction_entropy", 0.5, "yellow"),
        ("api_prediction_entropy", 0.8, "red"),
        ("api_distribution_shift", 2.0, "yellow"),
        ("api_distribution_shift", 4.0, "red"),
        ("something_else", 1.0, None),
        ("api_avg_confidence", None, None),
    ],
)
def test_bands(spark, metric, value, band):
    df = spark.createDataFrame([(metric, value)], "m string, v double")
    assert df.select(S.band_label(F.col("m"), F.col("v"))).first()[0] == band


def test_rounding_goes_up_at_half(spark):
    df = spark.createDataFrame([(0.12345,)], "v double")
    assert df.select(S.round_score(F.col("v"))).first()[0] == 0.1235
