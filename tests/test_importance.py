import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskloom.operators.importance import permutation_importance
from riskloom.plans import training
from riskloom.plans.flow import contributions

SCHEMA = "id long, sub string, y int, a double, b double, noise double"


def _rows(n):
    out = []
    for i in range(n):
        a, b = (i * 7 % 11) / 11, (i * 5 % 13) / 13
        out.append((i, None if i % 4 == 0 else "s", int(a + 0.3 * b > 0.6), a, b, (i * 3 % 17) / 17))
    return out


def _judge(a, b, noise):
    return int(a + 0.3 * b + 0.0 * noise > 0.6)


def _brute(rows, seed, repeats, buckets):
    def place(row, r):
        return hashlib.md5(f"{seed}:{r}|{row[0]}|{row[1] or ''}".encode()).hexdigest()

    dealt = defaultdict(list)
    for row in rows:
        dealt[int(place(row, 0)[:8], 16) % buckets].append(row)
    right = defaultdict(int)
    for bucket in dealt.values():
        for r in range(repeats):
            order = sorted(bucket, key=lambda row: place(row, r))
            for i, row in enumerate(order):
                donor = order[(i + 1) % len(order)]
                for f in range(3):
                    values = list(row[3:])
                    values[f] = donor[3 + f]
                    right[f] += _judge(*values) == row[2]
    base = sum(_judge(*row[3:]) == row[2] for row in rows) / len(rows)
    return {name: (base, right[f] / len(rows) / repeats) for f, name in enumerate(("a", "b", "noise"))}


@pytest.mark.parametrize("repeats,bucket_rows", [(1, 10_000), (3, 40)])
def test_against_brute_force(spark, repeats, bucket_rows):
    rows = _rows(300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    score = lambda t: t.withColumn("prediction", (F.col("a") + 0.3 * F.col("b") > 0.6).cast("int"))
    got = permutation_importance(df, ["id", "sub"], "y", ["a", "b", "noise"], score, repeats, 7, bucket_rows)
    want = _brute(rows, 7, repeats, max(1, 300 // bucket_rows))
    for r in got.collect():
        assert (r["baseline"], r["permuted"]) == pytest.approx(want[r["feature"]])
        assert r["importance"] == pytest.approx(r["baseline"] - r["permuted"])
    assert want["a"][1] < want["noise"][1] == want["noise"][0] == 1.0


def test_trees_are_ranked_by_what_they_lose(spark):
    df = spark.createDataFrame(_rows(400), SCHEMA)
    model = training.train_boosted_trees(df, "y", ["a", "b", "noise"], training.TreeParams(3, 0.3, 5))
    found = {r["feature"]: r["mean_abs_contribution"] for r in contributions(model, df, ["id"], "y").collect()}
    assert set(found) == {"a", "b", "noise"}
    assert found["a"] > found["b"] >= found["noise"]


def test_no_rows_and_no_labels(spark):
    score = lambda t: t.withColumn("prediction", F.lit(1))
    empty = spark.createDataFrame([], SCHEMA)
    assert permutation_importance(empty, ["id"], "y", ["a"], score).count() == 0
    unlabelled = spark.createDataFrame([(1, "x", None, 0.1, 0.2, 0.3)], SCHEMA)
    assert permutation_importance(unlabelled, ["id"], "y", ["a"], score).first()["permuted"] == 0.0
