import math
import random

import pytest

from riskloom.operators.binning import BINS_SCHEMA, BinMap, fit_bins
from riskloom.operators.evidence import woe_by_range, woe_long

SCHEMA = "id long, y int, x double, n int, c string"


def _rows(n):
    r = random.Random(3)
    values = [None, math.nan, math.inf, -math.inf, 0.0, -0.0]
    out = []
    for i in range(n):
        x = r.choice(values) if i % 9 == 0 else r.gauss(0, 3)
        out.append((i, r.randrange(2), x, None if i % 13 == 0 else r.randrange(50), r.choice(["a", "b", "rare%d" % (i % 40), None])))
    return out


@pytest.mark.parametrize("missing,per_bucket", [("zero", 64), ("empirical", 3)])
def test_equals_the_other_forms(spark, missing, per_bucket):
    df = spark.createDataFrame(_rows(2000), SCHEMA)
    bins = fit_bins(df, "y", ["c"], ["x", "n"], 20, merge=False, missing=missing)
    unseen = spark.createDataFrame([(5000, 0, 1e9, 10**6, "never seen"), (5001, 1, -1e9, -5, "")], SCHEMA)
    every = df.unionByName(unseen)
    got = woe_by_range(every, bins.to_table(spark), ["id"], missing, per_bucket)
    want = woe_long(every, bins, ["id"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_ten_thousand_bins(spark):
    edges = [-math.inf, *[i / 7 for i in range(9_999)], math.inf]
    rows = [("x", 0, "num", i, lo, hi, None, 1, 1, float(i), 0.0) for i, (lo, hi) in enumerate(zip(edges, edges[1:]))]
    table = spark.createDataFrame(rows, BINS_SCHEMA)
    df = spark.range(20_000).selectExpr("id", "id / 13 - 3 AS x")
    got = woe_by_range(df, table, ["id"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    found = {r["id"]: r["woe"] for r in got.collect()}
    assert len(found) == 20_000
    for i in random.Random(1).sample(range(20_000), 300):
        x = i / 13 - 3
        assert found[i] == next(k for k in range(10_000) if edges[k] <= x < edges[k + 1])


def test_bins_without_some_kinds(spark):
    table = BinMap([]).to_table(spark)
    df = spark.createDataFrame([(1, 0, 1.0, 1, "a")], SCHEMA)
    one = spark.createDataFrame([("c", 0, "cat", 0, None, None, ["a"], 1, 2, 0.5, 0.1)], BINS_SCHEMA)
    assert woe_by_range(df, one, ["id"]).collect() == [(1, "c", 0.5)]
    assert table.count() == 0
