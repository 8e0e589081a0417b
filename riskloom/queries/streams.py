"""Streaming jobs, run over the files there are and read back.

Windows still open when the input ends are not handed on, so the checks look
at closed ones only.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import bindings as B
from riskloom.functions.scores import rounded
from riskloom.operators import alerts, drift
from riskloom.operators.binning import fit_prebins
from riskloom.plans import scoring, training
from riskloom.queries import query
from riskloom.queries.binning import (
    DOCS_SQL,
    EDGES_SQL,
    KEPT_SQL,
    SCORE_WEIGHTS,
    WOE_SQL,
    contingency_sql,
    doc_bins,
    long_cat,
    long_num,
)
from riskloom.queries.models import SCORED_RIGHT_SQL, beside_plain, fitted
from riskloom.queries.monitoring import RULES_SQL, HOLD_S
from riskloom.queries.quality import SCORED_SQL
from riskloom.streaming import jobs
from riskloom.streaming import alerts as timed


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream; the glob takes a single file as well as a folder of them."""
    schema = B.table(spark, sf_dir, name).schema
    return jobs.read_stream(spark, os.path.join(sf_dir, f"{name}.parquet*"), schema)


@query("stream_score", SCORED_RIGHT_SQL)
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents as they arrive, beside plain arithmetic over the table."""
    _, bins, woe = fitted(spark, sf_dir)
    model = training.train_scorecard(woe, "TARGET", bins.features)
    arriving = B.text_features(_stream(spark, sf_dir, "documents"))
    scored = jobs.write_available(jobs.stream_score(arriving, bins, model, ["doc_id"]), "stream-score")
    return beside_plain(scored, B.text_features(B.table(spark, sf_dir, "documents")), bins, model)


@query("stream_answers")
def stream_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bins, woe = fitted(spark, sf_dir)
    model = training.train_scorecard(woe, "TARGET", bins.features)
    arriving = B.text_features(_stream(spark, sf_dir, "documents"))
    scored = jobs.write_available(
        jobs.stream_score(arriving, bins, model, ["doc_id"]), "stream-score"
    )
    return scoring.response_rows(scored, ["doc_id"])


SCORE_WEIGHTS_SQL = ", ".join(f"('{f}', {w})" for f, w in SCORE_WEIGHTS.items())
_ALL_NUM_SQL = " UNION ALL ".join(
    f"SELECT doc_id, '{c}' AS feature, {c}::DOUBLE AS v FROM features" for c in B.DOC_NUM
)
_ALL_CAT_SQL = " UNION ALL ".join(
    f"SELECT doc_id, '{c}' AS feature, {c} AS v FROM features" for c in B.DOC_CAT
)


@query(
    "stream_scorecard",
    f"""WITH {contingency_sql(DOCS_SQL, B.DOC_NUM, B.DOC_CAT)}, {WOE_SQL},
        weights(feature, w) AS (VALUES {SCORE_WEIGHTS_SQL}),
        placed AS (
          SELECT a.doc_id, a.feature, len(list_filter(m.cuts, lambda e: e <= a.v)) AS bin_id
          FROM ({_ALL_NUM_SQL}) a JOIN marks m USING (feature)
          UNION ALL
          SELECT a.doc_id, a.feature, coalesce(k.bin_id, -2) FROM ({_ALL_CAT_SQL}) a
          LEFT JOIN kept k ON k.feature = a.feature AND k.v = a.v),
        logits AS (SELECT doc_id, -2.0 + sum(weights.w * coalesce(woe.woe, 0)) AS z
                   FROM placed JOIN weights USING (feature)
                   LEFT JOIN woe ON woe.feature = placed.feature AND woe.bin_id = placed.bin_id
                   GROUP BY doc_id),
        p AS (SELECT doc_id, 1 / (1 + exp(-z)) AS p1 FROM logits)
        SELECT doc_id, CASE WHEN p1 > 1 - p1 THEN 'Decline' ELSE 'Accept' END AS result,
               round(1 - p1, 6) AS prob_accept, round(p1, 6) AS prob_decline FROM p""",
)
def stream_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins fitted on the labelled documents, scores for all documents as they arrive."""
    _, bins = doc_bins(spark, sf_dir)
    arriving = B.text_features(_stream(spark, sf_dir, "documents"))
    scored = jobs.write_available(
        jobs.stream_scorecard(arriving, bins, SCORE_WEIGHTS, -2.0, ["doc_id"]), "stream-scorecard"
    )
    return scored.select(
        "doc_id",
        "result",
        rounded(F.col("prob_accept")).alias("prob_accept"),
        rounded(F.col("prob_decline")).alias("prob_decline"),
    )


_CLOSED_SQL = "(SELECT max(ts) - INTERVAL 1 MINUTE FROM events)"


@query(
    "stream_gauges",
    f"""WITH {SCORED_SQL},
        windows AS (SELECT date_trunc('hour', ts) AS window_start, job, avg(entropy) AS e, avg(confidence) AS c,
                           count(*) AS n FROM scored GROUP BY ALL)
        SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, job,
               round(e, 6) + 0.0 AS avg_entropy, round(c, 6) + 0.0 AS avg_confidence, n
        FROM windows WHERE window_start + INTERVAL 1 HOUR <= {_CLOSED_SQL}""",
)
def stream_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = B.score_log(_stream(spark, sf_dir, "events"))
    windows = jobs.write_available(
        jobs.stream_gauges(log, "ts", "1 hour", ["job"]), "stream-gauges"
    )
    return windows.withColumns(
        {
            "window_start": F.col("window_start").cast("timestamp_ntz"),
            "window_end": F.col("window_end").cast("timestamp_ntz"),
            "avg_entropy": rounded(F.col("avg_entropy")),
            "avg_confidence": rounded(F.col("avg_confidence")),
        }
    )


_SILENCE_US = timed.SILENCE_S * 1_000_000
_REPEAT_US = alerts.REPEAT_INTERVAL_S * 1_000_000


# What is sent for matched(alert, job, severity, held, t, breach), in microseconds, up to the watermark.
_SENT_SQL = f"""
        beside AS (SELECT *, lag(t) OVER w AS before, lag(breach) OVER w AS was, lead(t) OVER w AS after FROM matched
                   WINDOW w AS (PARTITION BY alert, job ORDER BY t)),
        numbered AS (SELECT *, sum((NOT coalesce(was AND t - before <= {_SILENCE_US}, false))::INT)
                               OVER (PARTITION BY alert, job ORDER BY t) AS run FROM beside WHERE breach),
        runs AS (SELECT alert, job, severity, held, min(t) AS start,
                        least(max(t) + {_SILENCE_US}, max_by(coalesce(after, 9000000000000000), t)) AS ended
                 FROM numbered GROUP BY alert, job, severity, held, run),
        due AS (SELECT *, unnest(range(held // {_REPEAT_US}, (ended - start) // {_REPEAT_US} + 1)) AS no FROM runs),
        sent AS (SELECT *, start + greatest(held, no * {_REPEAT_US}) AS due_at FROM due
                 WHERE start + greatest(held, no * {_REPEAT_US}) < ended),
        said AS (SELECT alert, job, severity, 'firing' AS status, start, no, due_at FROM sent
                 UNION ALL SELECT alert, job, severity, 'resolved', start, max(no), ended FROM sent
                 GROUP BY alert, job, severity, start, ended)
        SELECT alert, job, severity, status, make_timestamp(start) AS run_start, no AS repeat_no,
               make_timestamp(due_at) AS sent_at
        FROM said WHERE make_timestamp(due_at) + INTERVAL 15 MINUTES <= {_CLOSED_SQL}"""


@query(
    "stream_alerts",
    f"""WITH {SCORED_SQL}, {RULES_SQL},
        windows AS (SELECT time_bucket(INTERVAL 15 MINUTES, ts, TIMESTAMP '1970-01-01') AS ts, job,
                           avg(entropy) AS e, avg(confidence) AS c FROM scored GROUP BY ALL),
        closed AS (SELECT * FROM windows WHERE ts + INTERVAL 15 MINUTES <= {_CLOSED_SQL}),
        readings AS (SELECT ts, job, 'api_prediction_entropy' AS metric, e AS value FROM closed
                     UNION ALL SELECT ts, job, 'api_avg_confidence', c FROM closed),
        matched AS (SELECT alert, job, severity, for_s * 1000000 AS held, epoch_us(ts) AS t,
                           CASE op WHEN '>' THEN value > threshold ELSE value < threshold END AS breach
                    FROM readings JOIN rules USING (metric)),{_SENT_SQL}""",
)
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is due up to the watermark, each series holding its last reading."""
    log = B.score_log(_stream(spark, sf_dir, "events"))
    windows = jobs.stream_gauges(log, "ts", "15 minutes", ["job"])
    rules = alerts.alert_rules(spark, HOLD_S)
    sent = jobs.write_available(
        timed.stream_alerts(windows, rules, ["job"], width_s=900), "stream-alerts", rocksdb=True
    )
    return sent.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("run_start", "sent_at")})


RATIO_RULE = ("EntropyShareTooHigh", "entropy_share", ">", 60.0, HOLD_S, "warning")


@query(
    "stream_ratio_rule",
    f"""WITH {SCORED_SQL},
        windows AS (SELECT time_bucket(INTERVAL 15 MINUTES, ts, TIMESTAMP '1970-01-01') AS w, job,
                           max_by(entropy, ts) / max_by(confidence, ts) * 100 AS value FROM scored GROUP BY ALL),
        matched AS (SELECT '{RATIO_RULE[0]}' AS alert, job, '{RATIO_RULE[5]}' AS severity, {HOLD_S * 1_000_000} AS held,
                           epoch_us(w) AS t, value > {RATIO_RULE[3]} AS breach
                    FROM windows WHERE w + INTERVAL 15 MINUTES <= {_CLOSED_SQL}),{_SENT_SQL}""",
)
def stream_ratio_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule on the ratio of two streams of gauges."""
    log = B.score_log(_stream(spark, sf_dir, "events"))
    part = log.select("ts", "job", F.col("entropy").alias("value"))
    other = B.score_log(_stream(spark, sf_dir, "events"))
    whole = other.select("ts", "job", F.col("confidence").alias("value"))
    readings = timed.stream_ratio(part, whole, ["job"], RATIO_RULE[1], width_s=900)
    rules = spark.createDataFrame([RATIO_RULE], alerts.RULES_SCHEMA)
    sent = jobs.write_available(
        timed.alert_stream(readings, rules, ["job"], width_s=900), "stream-ratio", rocksdb=True
    )
    return sent.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("run_start", "sent_at")})


@query(
    "stream_incidents",
    f"""WITH {SCORED_SQL},
        gaps AS (SELECT job, ts, coalesce(ts - lag(ts) OVER w > INTERVAL 30 MINUTES, true) AS is_new
                 FROM scored WHERE entropy > 0.7 WINDOW w AS (PARTITION BY job ORDER BY ts)),
        numbered AS (SELECT *, sum(is_new::INT) OVER (PARTITION BY job ORDER BY ts) AS no FROM gaps),
        incidents AS (SELECT job, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS readings
                      FROM numbered GROUP BY job, no)
        SELECT * FROM incidents WHERE last_ts + INTERVAL 31 MINUTES
          <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM scored WHERE entropy > 0.7)""",
)
def stream_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a minute first, then the incidents they make."""
    log = B.score_log(_stream(spark, sf_dir, "events"))
    firing = log.where(F.col("entropy") > 0.7)
    closed = jobs.write_available(
        timed.stream_incidents(firing, ["job"], "ts", HOLD_S), "stream-incidents", rocksdb=True
    )
    return closed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_ts", "last_ts")})


@query(
    "stream_alert_group",
    f"""WITH {SCORED_SQL},
        firing AS (SELECT *, time_bucket(INTERVAL 5 MINUTES, ts, TIMESTAMP '1970-01-01') AS window_start
                   FROM scored WHERE entropy > 0.7),
        grouped AS (SELECT job, window_start, min(ts) AS first_ts, count(*) AS n FROM firing GROUP BY ALL)
        SELECT job, window_start, first_ts, n,
               CASE WHEN lag(window_start) OVER (PARTITION BY job ORDER BY window_start) = window_start - INTERVAL 5 MINUTES
                    THEN window_start + INTERVAL 5 MINUTES ELSE first_ts + INTERVAL 30 SECONDS END AS notify_at
        FROM grouped
        WHERE window_start + INTERVAL 5 MINUTES <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM firing)""",
)
def stream_alert_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notifications of closed intervals."""
    log = B.score_log(_stream(spark, sf_dir, "events"))
    groups = timed.stream_groups(log.where(F.col("entropy") > 0.7), ["job"])
    sent = jobs.write_available(groups, "stream-groups", rocksdb=True)
    return sent.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "first_ts", "notify_at")}
    )


#: Events before this moment are what later ones are compared with.
REFERENCE_END = "2024-01-11"
_EVENT_KEEP = "day, is_reference"


@query(
    "stream_drift",
    f"""WITH rows AS (SELECT date_trunc('day', ts) AS day, ts < TIMESTAMP '{REFERENCE_END}' AS is_reference, event_type, value
                      FROM events),
        {long_num(["value"], _EVENT_KEEP)}, {long_cat(["event_type"], _EVENT_KEEP)},
        {EDGES_SQL.format(fitted_on="is_reference")}, {KEPT_SQL.format(fitted_on="is_reference")},
        marks AS (SELECT feature, list(edge) AS cuts FROM edges GROUP BY feature),
        binned AS (SELECT {_EVENT_KEEP}, feature, CASE WHEN v IS NULL THEN -1 ELSE len(list_filter(cuts, lambda e: e <= v)) END AS bin_id
                   FROM nums JOIN marks USING (feature)
                   UNION ALL SELECT {_EVENT_KEEP}, c.feature, CASE WHEN c.v IS NULL THEN -1 ELSE coalesce(k.bin_id, -2) END
                   FROM cats c LEFT JOIN kept k ON c.feature = k.feature AND c.v = k.v),
        bins AS (SELECT feature, bin_id, count(*) FILTER (is_reference) AS r FROM binned GROUP BY ALL),
        now AS (SELECT day, feature, bin_id, count(*) AS c FROM binned GROUP BY ALL),
        cells AS (SELECT d.day, b.feature, r, coalesce(c, 0) AS c
                  FROM (SELECT DISTINCT day FROM rows) d CROSS JOIN bins b LEFT JOIN now USING (day, feature, bin_id)),
        shares AS (SELECT day, feature, c, r + c > 0 AS is_there,
                          (CASE WHEN r = 0 THEN 0.5 ELSE r END) / sum(r) OVER w AS q,
                          (CASE WHEN c = 0 THEN 0.5 ELSE c END) / sum(c) OVER w AS p
                   FROM cells WINDOW w AS (PARTITION BY day, feature))
        SELECT day AS window_start, feature, sum(c)::BIGINT AS n,
               round(sum(CASE WHEN is_there THEN (p - q) * ln(p / q) ELSE 0 END), 6) + 0.0 AS psi
        FROM shares WHERE day + INTERVAL 1 DAY <= {_CLOSED_SQL} GROUP BY day, feature""",
)
def stream_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of every closed day of events against the first days."""
    columns = ["ts", "event_type", "value"]
    reference = B.table(spark, sf_dir, "events").select(columns)
    reference = reference.where(F.col("ts") < F.lit(REFERENCE_END).cast("timestamp_ntz"))
    prebins = fit_prebins(reference, ["event_type"], ["value"], 10)
    counts = drift.reference_counts(reference, prebins)
    arriving = _stream(spark, sf_dir, "events").select(columns)
    windows = jobs.stream_drift(arriving, "ts", "1 day", prebins, counts)
    found = jobs.write_available(windows, "stream-drift")
    return found.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "feature",
        "n",
        (rounded(F.col("psi")) + 0.0).alias("psi"),
    )
