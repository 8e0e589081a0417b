import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import quantiles as Q
from riskloom.operators.binning import bin_contingency, fit_prebins
from riskloom.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.05, 0.1, 0.25, 0.5, 0.731, 0.9, 0.95, 1.0]


def _values(kind, n=5000):
    rng = random.Random(kind)
    if kind == "spread":
        return [rng.gauss(0, 1) for _ in range(n)]
    if kind == "hot":
        return [0.0 if rng.random() < 0.4 else rng.expovariate(1) for _ in range(n)]
    if kind == "integers":
        return [float(rng.randint(1, 7)) for _ in range(n)]
    if kind == "one":
        return [3.5] * n
    return [math.exp(rng.gauss(0, 6)) * rng.choice((-1, 1)) for _ in range(n)]


@pytest.mark.parametrize("limit", [1_000_000, 500, 7])
def test_matches_brute_force_at_every_depth(spark, limit):
    kinds = ["spread", "hot", "integers", "one", "wild"]
    columns = {k: _values(k) for k in kinds}
    rows = [tuple(float(columns[k][i]) for k in kinds) for i in range(5000)]
    df = spark.createDataFrame(rows, kinds).repartition(5)
    found = Q.exact_quantiles(df, kinds, PROBS, limit=limit, k=64)
    for k in kinds:
        np.testing.assert_allclose(found[k], np.quantile(columns[k], PROBS), rtol=1e-12)


def test_missing_values_are_left_out(spark):
    rows = [(float(i) if i % 3 else None, float("nan"), None) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    found = Q.exact_quantiles(df, ["a", "b", "c"], [0.5])
    assert found["a"] == [np.median([i for i in range(100) if i % 3])]
    assert found["b"] == [] and found["c"] == []


def test_partitioning_does_not_matter(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    columns = ["l_quantity", "l_extendedprice"]
    results = [Q.exact_quantiles(df.repartition(n), columns, PROBS, limit=50) for n in (1, 17)]
    assert results[0] == results[1]


def test_sketch_is_close(spark):
    df = spark.range(100_000).select(F.rand(1).alias("x"))
    found = Q.sketch_quantiles(df, ["x"], [0.1, 0.5, 0.9])["x"]
    np.testing.assert_allclose(found, [0.1, 0.5, 0.9], atol=0.01)


def test_infinite_values(spark):
    inf = float("inf")
    values = [-inf] * 3 + [float(i) for i in range(20)] + [inf] * 30 + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for limit in (5, 1_000_000):
        found = exact_quantiles(df, ["x"], [0.0, 0.2, 0.5, 1.0], limit=limit)["x"]
        assert found[0] == -inf and 0 < found[1] < 19 and found[2:] == [inf, inf]
    bins = fit_prebins(df, [], ["x"], 10)
    assert bin_contingency(df.withColumn("y", F.lit(1)), "y", bins).agg(F.sum("bad")).first()[0] > 0


def test_code_of_a_count_does_not_grow_with_its_edges(spark):
    from riskloom.operators.quantiles import _segments

    df = spark.createDataFrame([(-0.0,), (0.0,), (0.5,), (7.0,), (None,), (float("nan"),), (float("inf"),)], "x double")
    few, many = [0.0, 1.0], [i / 10 for i in range(300)]
    sizes = [len(_segments(df, {"x": e})._jdf.queryExecution().optimizedPlan().toString()) for e in (few, many)]
    assert sizes[1] < 1.5 * sizes[0]
    got = sorted((r["value"], r["segment"]) for r in _segments(df, {"x": few}).collect())
    assert [s for _, s in got] == [1, 1, 1, 2, 2] and got[0][0] == 0.0
    numbered = _segments(df, {"x": few}, {"x": [None, 4, None]}).collect()
    assert sorted((r["value"], r["segment"]) for r in numbered) == [(0.0, 4), (0.0, 4), (0.5, 4)]
