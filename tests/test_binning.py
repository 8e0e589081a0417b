import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import binning as N
from riskloom.operators import evidence as E

# One numeric feature with a missing value, one category with an empty side,
# and two bins of equal evidence (x in [10, 20) and [20, 30)).
ROWS = [
    # key, x, c, TARGET
    (1, 1.0, "a", 0),
    (2, 2.0, "a", 0),
    (3, 3.0, "a", 1),
    (4, 11.0, "a", 0),
    (5, 12.0, "b", 1),
    (6, 21.0, "b", 0),
    (7, 22.0, "b", 1),
    (8, 31.0, "b", 1),
    (9, 32.0, "b", 1),
    (10, 33.0, "b", 0),
    (11, None, "only_good", 0),
    (12, float("nan"), "only_good", 0),
]
PREBINS = N.Prebins({"c": ["a", "b", "only_good"]}, {"x": [10.0, 20.0, 30.0]})


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "k int, x double, c string, TARGET int")


@pytest.fixture(scope="module")
def counts(rows):
    return N.bin_contingency(rows, "TARGET", PREBINS)


def _table(df, *columns):
    return {tuple(r[c] for c in columns[:2]): tuple(r[c] for c in columns[2:]) for r in df.collect()}


def test_contingency(counts):
    assert _table(counts, "feature", "bin_id", "good", "bad") == {
        ("x", 0): (2, 1),
        ("x", 1): (1, 1),
        ("x", 2): (1, 1),
        ("x", 3): (1, 2),
        ("x", -1): (2, 0),
        ("c", 0): (3, 1),
        ("c", 1): (2, 4),
        ("c", 2): (2, 0),
    }


def test_woe_with_an_empty_side(counts):
    woe = _table(E.woe_table(counts), "feature", "bin_id", "woe", "iv")
    assert woe["c", 2][0] == pytest.approx(math.log((2 / 7) / (0.5 / 5)))
    assert woe["c", 0][0] == pytest.approx(math.log((3 / 7) / (1 / 5)))
    assert woe["x", 1][0] == woe["x", 2][0]
    expected = sum((g / 7 - b / 5) * math.log((g / 7) / (b / 5)) for g, b in [(3, 1), (2, 4), (2, 0.5)])
    iv = {r["feature"]: r["iv"] for r in E.iv_by_feature(counts).collect()}
    assert iv["c"] == pytest.approx(expected)


def test_iv_grouped_by_value(counts):
    """Bins of equal evidence count as one; the missing ones stand at zero."""
    iv = {r["feature"]: r["iv"] for r in E.iv_by_feature(counts, group_by="woe").collect()}
    sides = [(2, 1), (2, 2), (1, 2), (2, 0.5)]
    expected = sum((g / 7 - b / 5) * math.log((g / 7) / (b / 5)) for g, b in sides)
    assert iv["x"] == pytest.approx(expected)


def test_one_class_has_no_evidence(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, 0)], "x double, TARGET int")
    counts = N.bin_contingency(df, "TARGET", N.Prebins({}, {"x": [2.0]}))
    assert E.iv_by_feature(counts).first()["iv"] is None


def test_gate_is_inclusive_on_both_ends(spark):
    iv = spark.createDataFrame(
        [("low", 0.02), ("high", 0.5), ("over", 0.5000001), ("under", 0.0199), ("gaps", 0.1), ("nothing", None)],
        "feature string, iv double",
    )
    order = ["nothing", "high", "under", "over", "gaps", "low"]
    missing = spark.createDataFrame(
        [("low", 0.1), ("high", 0.0), ("over", 0.0), ("under", 0.0), ("gaps", 0.1000001), ("nothing", 0.0)],
        "feature string, missing_rate double",
    )
    assert [r["feature"] for r in E.feature_gate(iv, missing, order).collect()] == ["high", "low"]
    verdicts = {r["feature"]: r["kept"] for r in E.screening(iv, missing, order).collect()}
    assert verdicts == {"low": True, "high": True, "over": False, "under": False, "gaps": False, "nothing": False}


def test_empty_gate_is_well_typed(spark):
    iv = spark.createDataFrame([("a", 0.0)], "feature string, iv double")
    missing = spark.createDataFrame([("a", 0.0)], "feature string, missing_rate double")
    gate = E.feature_gate(iv, missing, ["a"])
    assert gate.collect() == []
    assert gate.columns == ["ordinal", "feature", "iv", "missing_rate"]


def test_rare_categories_are_pooled(spark):
    rows = [("a",)] * 60 + [("b",)] * 36 + [("c",)] * 2 + [("d",)] + [(None,)]
    df = spark.createDataFrame(rows, "c string")
    found = {
        (r["category"], r["pooled"]): r["n"] for r in N.prebin_categorical(df, ["c"], 0.05).collect()
    }
    assert found == {("a", False): 60, ("b", False): 36, (None, True): 3, (None, False): 1}
    assert N.kept_categories(df, ["c"], 0.05) == {"c": ["a", "b"]}


def _fit(spark, rows, schema, **kw):
    df = spark.createDataFrame(rows, schema)
    cat = [c for c, t in df.dtypes if t == "string"]
    num = [c for c, t in df.dtypes if t == "double"]
    return df, N.fit_bins(df, "TARGET", cat, num, **kw)


def test_merged_bins_are_monotone_and_large_enough(spark):
    rows = [(float(i % 97), "pqrst"[i % 5], int((i * 7919) % 101 < (i % 97) // 2)) for i in range(3000)]
    df, bins = _fit(spark, rows, "x double, c string, TARGET int", bins=20)
    for f in ("x", "c"):
        mine = [r for r in bins.of(f) if r["kind"] != "missing"]
        assert all(r["good"] + r["bad"] >= 150 for r in mine) or len(mine) == 1
        assert sum(r["good"] + r["bad"] for r in mine) == 3000
    rates = [r["bad"] / (r["good"] + r["bad"]) for r in bins.of("x")]
    assert rates == sorted(rates) or rates == sorted(rates, reverse=True)
    ends = [(r["lo"], r["hi"]) for r in bins.of("x")]
    assert ends[0][0] == -math.inf and ends[-1][1] == math.inf
    assert all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_pooling_yields_monotone_stretches():
    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(50):
        counts = rng.integers(0, 30, size=(7, 2)).astype(float)
        for sign in (1, -1):
            groups = N._monotone(counts, sign)
            assert [i for g in groups for i in g] == list(range(7))
            rates = [sign * N._rate(counts, g) for g in groups]
            assert all(a < b for a, b in zip(rates, rates[1:]))


def test_transform_reproduces_the_counts(spark):
    rows = [(float(i % 13) if i % 10 else None, "ab"[i % 2], int(i % 3 == 0)) for i in range(600)]
    df, bins = _fit(spark, rows, "x double, c string, TARGET int", bins=5)
    by_bin = (
        df.select(bins.bin_column("x").alias("b"), "TARGET")
        .groupBy("b")
        .agg(F.sum("TARGET").alias("bad"), F.count("*").alias("n"))
        .collect()
    )
    expected = {r["bin_id"]: (r["bad"], r["good"] + r["bad"]) for r in bins.of("x")}
    assert {r["b"]: (r["bad"], r["n"]) for r in by_bin} == expected


def test_missing_and_unseen_values(spark):
    rows = [(float(i), "ab"[i % 2], int(i % 3 == 0)) for i in range(100)] + [(None, None, 1)] * 10
    df, bins = _fit(spark, rows, "x double, c string, TARGET int", bins=4)
    new = spark.createDataFrame(
        [(None, "never seen"), (float("nan"), None)], "x double, c string"
    )
    zero = E.woe_transform(new, bins, []).collect()
    assert [tuple(r) for r in sorted(zero)] == [(0.0, 0.0), (0.0, 0.0)]
    empirical = N.BinMap(bins.rows, missing="empirical")
    own = next(r["woe"] for r in bins.of("x") if r["kind"] == "missing")
    found = E.woe_transform(new, empirical, []).collect()
    assert all(r["x"] == own for r in found)
    assert own < 0


def test_wide_and_long_transform_agree(spark, sf_dir):
    from riskloom import bindings as B

    items = B.lineitems_with_gaps(spark, sf_dir)
    features = ["l_quantity", "discount_few_gaps", "discount_many_gaps"]
    bins = N.fit_bins(items, "TARGET", B.ITEM_CAT, features, bins=10)
    for missing in ("zero", "empirical"):
        bins = N.BinMap(bins.rows, missing)
        wide = E.woe_transform(items, bins, B.ITEM_KEY).unpivot(
            B.ITEM_KEY, bins.features, "feature", "woe"
        )
        long = E.woe_long(items, bins, B.ITEM_KEY).select(wide.columns)
        assert wide.exceptAll(long).count() == 0 and long.exceptAll(wide).count() == 0


def test_long_transform_joins_nothing(spark, sf_dir):
    from riskloom import bindings as B

    items = B.lineitems_with_gaps(spark, sf_dir)
    features = ["l_quantity", "discount_few_gaps", "discount_many_gaps"]
    rows = N.fit_bins(items, "TARGET", B.ITEM_CAT, features, bins=10).rows
    for missing in ("zero", "empirical"):
        bins = N.BinMap(rows, missing)
        long, joined = E.woe_long(items, bins, B.ITEM_KEY), E.woe_joined(items, bins, B.ITEM_KEY)
        assert "Join" not in long._jdf.queryExecution().executedPlan().toString()
        assert long.exceptAll(joined).count() == 0 and joined.exceptAll(long).count() == 0


def test_fit_does_not_depend_on_partitioning(spark, sf_dir):
    from riskloom import bindings as B

    docs = B.labelled_documents(spark, sf_dir, "quality")
    maps = [
        N.fit_bins(docs.repartition(n), "TARGET", B.DOC_CAT, B.DOC_NUM, bins=10).rows for n in (1, 17)
    ]
    assert maps[0] == maps[1]


def test_names_and_categories_with_quotes(spark):
    rows = [(float(i), ("it's", 'a "b"', "c\\d")[i % 3], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "`x y` double, `c d` string, TARGET int")
    bins = N.fit_bins(df, "TARGET", ["c d"], ["x y"], bins=3)
    kept = {c for r in bins.of("c d") for c in r["categories"]}
    assert kept == {"it's", 'a "b"', "c\\d"}
    out = E.woe_transform(df, bins, ["TARGET"])
    assert out.columns == ["TARGET", "c d", "x y"] and out.count() == 60
