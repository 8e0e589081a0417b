import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.operators.ordered import breach_runs, running_totals, sessions

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("parts", [1, 2, 5])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, parts, descending):
    values = [(float(v), v * 10) for v in range(12)]
    df = spark.createDataFrame(values, "s double, n long").repartition(3)
    out = running_totals(df, "s", {"through": "n"}, parts, descending)
    total = 0
    for s, n in sorted(values, reverse=descending):
        total += n
        found = out.where(out.s == s).first()
        assert found["through"] == total


def _series(seed, n=300, key="a"):
    rng = random.Random(seed)
    t, rows, state = 0, [], False
    for _ in range(n):
        t += rng.choice([5, 15, 15, 15, 90, 400])
        if rng.random() < 0.15:
            state = not state
        rows.append((key, T0 + timedelta(seconds=t), rng.choice([state, state, None]) if not state else state))
    return rows


def _runs_by_hand(rows, max_gap):
    out, start, last = {}, None, None
    for key, ts, hit in sorted(rows):
        if not hit:
            start = None
        elif start is None or (max_gap is not None and (ts - last).total_seconds() > max_gap):
            start = ts
        out[key, ts] = start if hit else None
        last = ts
    return out


@pytest.mark.parametrize("max_gap", [None, 60])
@pytest.mark.parametrize("bucket", [30, 600, 86_400])
def test_runs_match_a_plain_loop(spark, max_gap, bucket):
    rows = _series(3, key="a") + _series(4, key="b")
    expected = {}
    for k in ("a", "b"):
        expected.update(_runs_by_hand([r for r in rows if r[0] == k], max_gap))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, hit boolean").repartition(7)
    found = breach_runs(df, ["k"], "ts", "hit", max_gap, bucket).collect()
    assert {(r["k"], r["ts"]): r["run_start"] for r in found} == expected


@pytest.mark.parametrize("bucket", [61, 600, 86_400])
def test_sessions_match_a_plain_loop(spark, bucket):
    rows = [(k, ts) for key in (5, 6) for k, ts, _ in _series(key, key=str(key))]
    expected = []
    for k in ("5", "6"):
        last = None
        for ts in sorted(ts for kk, ts in rows if kk == k):
            if last is None or (ts - last).total_seconds() > 60:
                expected.append([k, ts, ts, 0])
            expected[-1][2] = last = ts
            expected[-1][3] += 1
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz").repartition(7)
    found = sessions(df, ["k"], "ts", 60, bucket).collect()
    assert sorted(map(list, found)) == sorted(expected)


def test_readings_exactly_a_gap_apart_belong_together(spark):
    rows = [("a", T0), ("a", T0 + timedelta(seconds=60)), ("a", T0 + timedelta(seconds=121))]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    assert sorted(r["readings"] for r in sessions(df, ["k"], "ts", 60).collect()) == [1, 2]


def test_buckets_must_be_wider_than_the_gap(spark):
    df = spark.createDataFrame([("a", T0)], "k string, ts timestamp_ntz")
    with pytest.raises(ValueError):
        sessions(df, ["k"], "ts", 60, 60)


def test_readings_at_one_time_are_one(spark):
    rows = [("a", 0, True), ("a", 10, False), ("a", 10, True), ("a", 20, True), ("a", 30, False), ("a", 40, True)]
    want = {(0, True): 0, (10, True): 0, (10, False): None, (20, True): 0, (30, False): None, (40, True): 40}
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, t long, hit boolean").withColumn("ts", F.timestamp_seconds("t"))
        out = breach_runs(df, ["k"], "ts", "hit", bucket_s=15).withColumn("s", F.unix_timestamp("run_start")).collect()
        assert {(r.t, r.hit): r.s for r in out} == want
