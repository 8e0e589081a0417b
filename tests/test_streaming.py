import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom import bindings as B
from riskloom.operators import alerts as A
from riskloom.operators.binning import fit_bins
from riskloom.operators.evidence import woe_transform
from riskloom.plans import scoring, training
from riskloom.session import fresh_dir, settle
from riskloom.streaming import jobs
from riskloom.operators import drift as D
from riskloom.operators.binning import Prebins
from riskloom.streaming.alerts import alert_stream, stream_alerts, stream_groups, stream_incidents

T0 = datetime(2024, 1, 1)
LOG = "ts timestamp, job string, entropy double, confidence double"


def _files(spark, batches, schema=LOG):
    """One file per batch, read one at a time in order."""
    folder = fresh_dir(spark, "input")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(folder, f"b={i:03d}"))
        stamp = 1_700_000_000 + i
        for name in os.listdir(os.path.join(folder, f"b={i:03d}")):
            if name.endswith(".parquet"):
                os.utime(os.path.join(folder, f"b={i:03d}", name), (stamp, stamp))
    reader = spark.readStream.schema(spark.createDataFrame([], schema).schema)
    return reader.option("maxFilesPerTrigger", 1).parquet(os.path.join(folder, "b=*"))


def _at(seconds, entropy=0.8, confidence=0.95, job="api"):
    return (T0 + timedelta(seconds=seconds), job, entropy, confidence)


def test_scoring_a_stream_equals_scoring_the_table(spark, sf_dir):
    docs = B.labelled_documents(spark, sf_dir, "quality")
    bins = fit_bins(docs, "TARGET", B.DOC_CAT, B.DOC_NUM, 5)
    woe = settle(woe_transform(docs, bins, ["doc_id", "TARGET"]), "woe")
    model = training.train_scorecard(woe, "TARGET", bins.features)
    path = os.path.join(sf_dir, "documents.parquet")
    table = spark.read.parquet(path)
    arriving = jobs.read_stream(spark, path + "*", table.schema)
    streamed = jobs.write_available(
        jobs.stream_score(B.text_features(arriving), bins, model, ["doc_id"]), "score"
    )
    batch = scoring.batch_score(B.text_features(table), bins, model, ["doc_id"])
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_gauges_close_windows_and_drop_late_rows(spark):
    batches = [
        [_at(0, 0.2), _at(10, 0.4)],
        [_at(300, 0.6)],
        [_at(400, 0.7)],
        [_at(5, 99.0)],  # later than the watermark by now
        [_at(3600, 0.5)],
    ]
    windows = jobs.write_available(
        jobs.stream_gauges(_files(spark, batches), "ts", "1 minute", ["job"]), "gauges"
    )
    found = {int((r["window_start"] - T0).total_seconds()): (r["avg_entropy"], r["n"]) for r in windows.collect()}
    assert found[0] == (pytest.approx(0.3), 2)
    assert found[300] == (0.6, 1)
    assert 3600 not in found


def _seconds(ts):
    return int((ts - T0).total_seconds())


def _sent(rows):
    return sorted((r["alert"], r["status"], r["repeat_no"], _seconds(r["run_start"]), _seconds(r["sent_at"])) for r in rows.collect())


def test_alerts_keep_state_across_batches(spark):
    # 15 s windows: breach from 0 s to 90 s, a break, then a long breach.
    first = [_at(s) for s in (0, 15, 30)]
    second = [_at(s) for s in (45, 60, 75, 90)] + [_at(105, 0.1)]
    third = [_at(s) for s in range(120, 120 + 15 * 30, 15)]
    last = [_at(120 + 15 * 30, 0.1)]
    end = [_at(100_000, 0.1)]
    stream = _files(spark, [first, second, third, last, end])
    windows = jobs.stream_gauges(stream, "ts", "15 seconds", ["job"], delay="0 seconds")
    sent = jobs.write_available(
        stream_alerts(windows, A.alert_rules(spark), ["job"], repeat_s=120), "alerts", rocksdb=True
    )
    found = _sent(sent)

    rows = [r for batch in (first, second, third, last, end) for r in batch]
    table = spark.createDataFrame(rows, LOG).select(
        "ts", "job", F.lit("api_prediction_entropy").alias("metric"), F.col("entropy").alias("value")
    )
    firing = A.threshold_alerts(table, A.alert_rules(spark), ["job"]).where("firing")
    batch = A.alert_repeat_suppression(firing, ["job"], repeat_s=120)
    expected = sorted(
        (r["alert"], "firing", r["repeat_no"], _seconds(r["run_start"]), _seconds(r["sent_at"])) for r in batch.collect()
    )
    assert [f for f in found if f[1] == "firing"] == expected
    assert found[0] == ("PredictionEntropyTooHigh", "firing", 0, 0, 60)
    assert [f[3:] for f in found if f[1] == "resolved"] == [(0, 105), (120, 570)]


def test_silent_series_fires_repeats_and_clears(spark):
    """One breaching window, then nothing of this series; others move the time on."""
    others = [[_at(s, 0.1, job="other")] for s in (40, 200, 4000, 11_000, 11_500, 30_000, 30_100, 60_000)]
    stream = _files(spark, [[_at(0)], *others])
    windows = jobs.stream_gauges(stream, "ts", "15 seconds", ["job"], delay="0 seconds")
    alerts = stream_alerts(windows, A.alert_rules(spark), ["job"])
    base = fresh_dir(spark, "silent")
    query = jobs.start(alerts, f"{base}/rows", f"{base}/progress", available_now=True, rocksdb=True)
    query.awaitTermination()
    found = _sent(spark.read.schema(alerts.schema).parquet(f"{base}/rows"))
    three_hours = 3 * 3600
    assert found == [
        ("PredictionEntropyTooHigh", "firing", 0, 0, 60),
        ("PredictionEntropyTooHigh", "firing", 1, 0, three_hours),
        ("PredictionEntropyTooHigh", "resolved", 1, 0, three_hours + 300),
    ]
    stateful = [op for op in query.lastProgress["stateOperators"] if "transformWithState" in op["operatorName"]]
    assert [op["numRowsTotal"] for op in stateful] == [0]


def test_alert_before_its_time_is_not_sent(spark):
    """A breach that ends before the rule's time, and one that falls silent before it."""
    rules = A.alert_rules(spark, 600)
    stream = _files(spark, [[_at(0), _at(300, 0.1)], [_at(1000)], [_at(9000, 0.1, job="other")], [_at(9100, 0.1, job="other")]])
    windows = jobs.stream_gauges(stream, "ts", "15 seconds", ["job"], delay="0 seconds")
    sent = jobs.write_available(stream_alerts(windows, rules, ["job"], silence_s=300), "alerts", rocksdb=True)
    assert sent.count() == 0


def test_incidents_close_after_silence(spark):
    batches = [[_at(0), _at(200)], [_at(450)], [_at(2000), _at(2100)], [_at(9000)]]
    firing = _files(spark, batches)
    closed = jobs.write_available(stream_incidents(firing, ["job"]), "incidents", rocksdb=True)
    found = sorted((_seconds(r["first_ts"]), _seconds(r["last_ts"]), r["readings"]) for r in closed.collect())
    assert found == [(0, 450, 3), (2000, 2100, 2)]
    with pytest.raises(ValueError):
        stream_incidents(firing, ["job"], timeout_s=30)


def test_incidents_equal_those_of_the_table(spark):
    seconds = [0, 290, 300, 599, 600, 901, 902, 1202, 1500, 1501, 1502, 2200, 2501, 2801, 4000]
    batches = [[_at(s), _at(s + 1, job="b")] for s in seconds] + [[_at(50_000), _at(50_000, job="b")], [_at(60_000)]]
    closed = jobs.write_available(stream_incidents(_files(spark, batches), ["job"]), "incidents", rocksdb=True)
    table = spark.createDataFrame([r for b in batches for r in b], LOG).withColumn("alert", F.lit("x"))
    early = F.col("last_ts") < F.lit(T0 + timedelta(seconds=40_000))
    closed, whole = closed.where(early), A.alert_incidents(table, ["job"]).where(early)
    columns = ["job", "first_ts", "last_ts", "readings"]
    assert sorted(map(tuple, closed.select(columns).collect())) == sorted(map(tuple, whole.select(columns).collect()))


def test_groups_equal_those_of_the_table(spark):
    seconds = [0, 10, 310, 650, 1300, 1301, 1600, 3000, 3301]
    batches = [[_at(s), _at(s + 700, job="b")] for s in seconds] + [[_at(50_000)], [_at(60_000)]]
    stream = _files(spark, batches)
    sent = jobs.write_available(stream_groups(stream, ["job"], delay="20 minutes"), "groups", rocksdb=True)
    table = spark.createDataFrame([r for b in batches for r in b], LOG).withColumn("alert", F.lit("x"))
    early = F.col("window_start") < F.lit(T0 + timedelta(seconds=40_000))
    sent, whole = sent.where(early), A.alert_group(table, ["job"]).where(early)
    columns = ["job", "window_start", "first_ts", "n", "notify_at"]
    assert sorted(map(tuple, sent.select(columns).collect())) == sorted(map(tuple, whole.select(columns).collect()))


EVENTS = "ts timestamp, job string, colour string, amount double"
BINS = Prebins({"colour": ["blue", "red"]}, {"amount": [10.0, 20.0]})


def _event(seconds, colour, amount, job="api"):
    return (T0 + timedelta(seconds=seconds), job, colour, amount)


def _reference(spark):
    rows = [_event(0, c, a) for c in ("red", "blue", "blue", "green") for a in (1.0, 12.0, 15.0, 30.0, None)]
    return D.reference_counts(spark.createDataFrame(rows, EVENTS), BINS)


def test_drift_of_a_stream_equals_that_of_the_table(spark):
    batches = [
        [_event(s, "red" if s % 40 else None, float(s % 35)) for s in range(0, 300, 7)],
        [_event(s, "blue", float("nan") if s % 3 else 2.0, "b") for s in range(250, 700, 11)],
        [_event(9000, "red", 1.0)],
    ]
    found = jobs.write_available(
        jobs.stream_drift(_files(spark, batches, EVENTS), "ts", "1 minute", BINS, _reference(spark), ["job"]), "drift"
    )
    table = spark.createDataFrame([r for b in batches for r in b], EVENTS)
    whole = D.windowed_drift(table, "ts", "1 minute", BINS, _reference(spark), ["job"])
    whole = whole.where(F.col("window_start") < F.lit(T0 + timedelta(seconds=8000)))
    columns = ["window_start", "job", "feature", "n", F.round("psi", 9)]
    got = sorted(map(tuple, found.select(columns).collect()))
    assert got == sorted(map(tuple, whole.select(columns).collect())) and len(got) > 20


def test_windowed_drift_is_the_drift_score(spark):
    reference = [_event(0, c, a) for c in ("red", "blue", "blue", "green") for a in (1.0, 12.0, 15.0, 30.0, None)]
    current = [_event(5, c, a) for c in ("red", "red", "blue") for a in (1.0, 2.0, 30.0)]
    both = spark.createDataFrame([(*r, 0) for r in reference] + [(*r, 1) for r in current], EVENTS + ", is_current int")
    want = {r["feature"]: r["psi"] for r in D.drift_score(both, "is_current", BINS).collect()}
    got = D.windowed_drift(spark.createDataFrame(current, EVENTS), "ts", "1 hour", BINS, _reference(spark))
    assert {r["feature"]: pytest.approx(r["psi"], abs=1e-12) for r in got.collect()} == want


def test_drift_rules_fire_on_a_stream(spark):
    """Colours as in the reference first, then half of them red, then all red, then silence."""
    calm = [_event(s, c, 12.0) for s in range(0, 300, 15) for c in ("red", "blue", "blue", "green")]
    warm = [_event(s, c, 12.0) for s in range(300, 600, 15) for c in ("red", "red", "red", "blue", "blue", "green")]
    hot = [_event(s, "red", 12.0) for s in range(600, 900, 15)]
    far = [[_event(s, "red", 12.0, "other")] for s in (20_000, 20_100)]
    windows = jobs.stream_drift(
        _files(spark, [calm, warm, hot, *far], EVENTS), "ts", "15 seconds", BINS, _reference(spark), ["job"], "0 seconds"
    )
    colours = D.drift_readings(windows, ["job"]).where("feature = 'colour' AND job = 'api'")
    sent = jobs.write_available(
        alert_stream(colours, A.alert_rules(spark), ["job", "feature"], silence_s=600), "drift-alerts", rocksdb=True
    )
    first = {}
    for alert, status, number, start, at in _sent(sent):
        if status == "firing" and number == 0:
            first[alert] = (start, at)
    assert first == {"DataDriftWarning": (300, 360), "DataDriftCritical": (600, 660)}


def test_late_rows_are_counted(spark):
    late = [_at(s) for s in (1, 2, 3)]
    batches = [[_at(0)], [_at(5000)], [_at(5100)], late, [_at(9000)]]
    path = fresh_dir(spark, "late")
    windows = jobs.stream_gauges(_files(spark, batches), "ts", "1 second", ["job"])
    jobs.write_available(windows, "gauges", late=path)
    found = spark.read.parquet(path).collect()
    assert sum(r["dropped"] for r in found) == len(late)
    assert {r["name"] for r in found} == {"stateStoreSave"}


def test_queries_that_start_together_keep_their_stores(spark):
    from concurrent.futures import ThreadPoolExecutor

    before = spark.conf.get(jobs.STATE_STORE, None)

    def run(timed):
        windows = jobs.stream_gauges(_files(spark, [[_at(0)], [_at(900)]]), "ts", "15 seconds", ["job"], "0 seconds")
        rows = stream_alerts(windows, A.alert_rules(spark), ["job"]) if timed else windows
        return jobs.write_available(rows, "together", rocksdb=timed).count()

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(run, [True, False, True, False])) == [1, 1, 1, 1]
    assert spark.conf.get(jobs.STATE_STORE, None) == before


def test_session_settings_are_left_alone(spark):
    before = spark.conf.get(jobs.STATE_STORE, None)
    windows = jobs.stream_gauges(_files(spark, [[_at(0)]]), "ts", "1 minute")
    jobs.write_available(windows, "gauges", rocksdb=True)
    assert spark.conf.get(jobs.STATE_STORE, None) == before
