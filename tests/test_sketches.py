import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import quantiles as Q
from riskloom.operators import sketches as S
from riskloom.session import fresh_dir

PROBABILITIES = [i / 20 for i in range(1, 20)]


def _table(spark, start, end):
    x = F.col("id")
    return spark.range(start, end, numPartitions=5).select(
        F.when(x % 10 != 0, (x * 7919 % 100_003).cast("double")).alias("spread"),
        F.when(x % 3 == 0, F.lit(1.0)).otherwise(F.when(x % 5 == 0, F.lit(float("nan"))).otherwise(x / 1000)).alias("heavy"),
        F.lit(None).cast("double").alias("nothing"),
    )


def test_two_loads_refit_like_one(spark):
    columns = ["spread", "heavy", "nothing"]
    path = fresh_dir(spark, "sketches")
    loads = {"a": _table(spark, 0, 30_000), "b": _table(spark, 30_000, 100_000)}
    for name, rows in loads.items():
        S.keep_load(S.quantile_sketches(rows, columns), path, name)
    S.keep_load(S.quantile_sketches(loads["a"], columns), path, "a")  # once more is still one load
    merged = S.merged_sketches(S.kept_loads(spark, path))
    whole = loads["a"].unionByName(loads["b"])
    sizes = {r["feature"]: r["n"] for r in merged.collect()}
    assert sizes == {"spread": 90_000, "heavy": whole.where("heavy IS NOT NULL AND NOT isnan(heavy)").count(), "nothing": 0}

    exact = Q.exact_quantiles(whole, columns, PROBABILITIES)
    assert Q.exact_quantiles(whole, columns, PROBABILITIES, limit=2000, sketches=merged) == exact
    near = S.sketched_quantiles(merged, PROBABILITIES)
    assert near["nothing"] == []
    for c in ("spread", "heavy"):
        for p, value in zip(PROBABILITIES, near[c]):
            # the value's ranks reach to within the slack of the wanted one
            below, through = whole.select(
                F.count(F.when(F.col(c) < value, 1)), F.count(F.when(F.col(c) <= value, 1))
            ).first()
            rank = p * sizes[c]
            assert below - Q.SKETCH_SLACK * sizes[c] <= rank <= through + Q.SKETCH_SLACK * sizes[c]


def test_sketches_of_other_rows_are_refused(spark):
    merged = S.quantile_sketches(_table(spark, 0, 1000), ["spread"])
    with pytest.raises(ValueError):
        Q.exact_quantiles(_table(spark, 0, 900), ["spread"], [0.5], sketches=merged)


def test_infinities_and_empty_tables(spark):
    rows = [(v,) for v in (math.inf, -math.inf, 1.0, 2.0, None)]
    made = S.quantile_sketches(spark.createDataFrame(rows, "x double"), ["x"])
    found = S.sketched_quantiles(made, [0.0, 1.0])
    assert found == {"x": [-math.inf, math.inf]}
    assert S.quantile_sketches(spark.createDataFrame([], "x double"), ["x"]).count() == 0


def test_distinct_counts_over_loads(spark):
    schema = "n long, t string, d double, at timestamp, flag boolean"
    first = spark.range(20_000).selectExpr("id AS n", "CAST(id % 700 AS STRING) AS t", "id / 7 AS d", "timestamp_seconds(id) AS at", "id % 2 = 0 AS flag")
    second = spark.range(10_000, 50_000).selectExpr("id AS n", "IF(id % 9 = 0, NULL, CAST(id % 900 AS STRING)) AS t", "id / 7 AS d", "timestamp_seconds(id % 100) AS at", "NULL AS flag")
    path = fresh_dir(spark, "distinct")
    for name, rows in (("1", first), ("2", second)):
        S.keep_load(S.distinct_sketches(rows.select([F.col(f.split()[0]).cast(f.split()[1]) for f in schema.split(", ")])), path, name)
    found = {r["column_name"]: r for r in S.distinct_counts(S.kept_loads(spark, path)).collect()}
    want = {"n": 50_000, "t": 878, "d": 50_000, "at": 20_000, "flag": 2}
    assert set(found) == set(want)
    for c, n in want.items():
        assert abs(found[c]["approx_distinct"] - n) <= S.DISTINCT_ERROR * n
        assert found[c]["n_rows"] == 60_000
    assert found["t"]["n_missing"] == second.where("t IS NULL").count()
