"""Drift, gauges and alerts.

The event log has about one row in four minutes, so gauges are read every
quarter of an hour and conditions must hold for half an hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import bindings as B
from riskloom.functions.scores import rounded
from riskloom.operators import alerts, drift, gauges
from riskloom.operators.binning import fit_prebins
from riskloom.queries import query
from riskloom.queries.binning import contingency_sql
from riskloom.queries.quality import SCORED_SQL

HOLD_S = 1800
WIDTH = "15 minutes"

_ORDERS_SQL = """
rows AS (SELECT o.o_orderpriority, c.c_mktsegment, o.o_totalprice, c.c_acctbal,
                (o.o_orderdate >= DATE '1998-01-01')::INT AS is_current
         FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

# Bins come from the reference period only; the counts from both.
_DRIFT_SQL = (
    contingency_sql(_ORDERS_SQL, B.ORDER_NUM, B.ORDER_CAT, "is_current", fitted_on="is_current = 0")
    + """,
shares AS (SELECT feature, (CASE WHEN good = 0 THEN 0.5 ELSE good END) / sum(good) OVER (PARTITION BY feature) AS q,
                  (CASE WHEN bad = 0 THEN 0.5 ELSE bad END) / sum(bad) OVER (PARTITION BY feature) AS p
           FROM contingency),
drift AS (SELECT feature, sum((p - q) * ln(p / q)) AS psi FROM shares GROUP BY feature)"""
)


def _drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = B.customer_orders(spark, sf_dir)
    reference = rows.where(F.col("is_current") == 0)
    prebins = fit_prebins(reference, B.ORDER_CAT, B.ORDER_NUM, 10)
    return drift.drift_score(rows, "is_current", prebins)


@query(
    "drift_score",
    f"""WITH {_DRIFT_SQL}
        SELECT feature, round(psi, 6) + 0.0 AS psi,
               CASE WHEN psi > 0.3 THEN 'critical' WHEN psi > 0.1 THEN 'warning' ELSE 'ok' END AS level
        FROM drift""",
)
def drift_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drift(spark, sf_dir).withColumn("psi", rounded(F.col("psi")))


@query(
    "distribution_shift",
    f"WITH {_DRIFT_SQL} SELECT round(sum(psi), 6) + 0.0 AS distribution_shift, round(least(sum(psi), 5.0), 6) + 0.0 AS shown FROM drift",
)
def distribution_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift = drift.distribution_shift(_drift(spark, sf_dir))
    return shift.select(*[rounded(F.col(c)).alias(c) for c in ("distribution_shift", "shown")])


_SAMPLES_SQL = f"""{SCORED_SQL},
samples AS (SELECT event_id, ts, job, 'api_prediction_entropy' AS metric, entropy AS value FROM scored
            UNION ALL SELECT event_id, ts, job, 'api_avg_confidence', confidence FROM scored)"""


@query(
    "gauge_resample",
    f"""WITH {_SAMPLES_SQL}
        SELECT to_timestamp(floor(epoch_us(ts) / 15000000) * 15)::TIMESTAMP AS ts, metric,
               round(arg_max(value, (ts, event_id)), 6) + 0.0 AS value
        FROM samples GROUP BY 1, 2""",
)
def gauge_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = gauges.gauge_resample(B.samples(spark, sf_dir), "ts", ["metric"], tie=["event_id"])
    return readings.withColumn("value", rounded(F.col("value")))


@query(
    "gauge_last_value",
    f"""WITH {_SAMPLES_SQL}
        SELECT metric, job, round(arg_max(value, (ts, event_id)), 6) + 0.0 AS value, max(ts) AS last_ts
        FROM samples WHERE value IS NOT NULL GROUP BY metric, job""",
)
def gauge_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = gauges.gauge_last_value(
        B.samples(spark, sf_dir), "ts", ["metric", "job"], tie=["event_id"]
    )
    return last.withColumn("value", rounded(F.col("value")))


RULES_SQL = f"""
rules(alert, metric, op, threshold, for_s, severity) AS (VALUES
  ('DataDriftWarning', 'app_data_drift_score', '>', 0.1, {HOLD_S}, 'warning'),
  ('DataDriftCritical', 'app_data_drift_score', '>', 0.3, {HOLD_S}, 'critical'),
  ('PredictionEntropyTooHigh', 'api_prediction_entropy', '>', 0.7, {HOLD_S}, 'warning'),
  ('PredictionEntropyCritical', 'api_prediction_entropy', '>', 0.9, {HOLD_S}, 'critical'),
  ('ConfidenceTooLow', 'api_avg_confidence', '<', 0.9, {HOLD_S}, 'warning'),
  ('ConfidenceCritical', 'api_avg_confidence', '<', 0.7, {HOLD_S}, 'critical'))"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per quarter hour, metric and job."""
    return gauges.gauge_resample(
        B.samples(spark, sf_dir), "ts", ["metric", "job"], tie=["event_id"], width=WIDTH
    )


_READINGS_SQL = f"""{_SAMPLES_SQL},
readings AS (SELECT time_bucket(INTERVAL 15 MINUTES, ts, TIMESTAMP '1970-01-01') AS ts, metric, job,
                    arg_max(value, (ts, event_id)) AS value
             FROM samples GROUP BY ALL), {RULES_SQL},
matched AS (SELECT r.ts, r.metric, r.job, r.value, a.alert, a.severity, a.for_s,
                   CASE a.op WHEN '>' THEN r.value > a.threshold ELSE r.value < a.threshold END AS breach
            FROM readings r JOIN rules a USING (metric))"""


@query(
    "gauge_rule_match",
    f"""WITH {_READINGS_SQL} SELECT ts, metric, job, alert, round(value, 6) + 0.0 AS value, breach FROM matched""",
)
def gauge_rule_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = alerts.gauge_rule_match(readings(spark, sf_dir), alerts.alert_rules(spark, HOLD_S))
    return matched.select("ts", "metric", "job", "alert", rounded(F.col("value")).alias("value"), "breach")


_ALERTS_SQL = f"""{_READINGS_SQL},
islands AS (SELECT *, sum((NOT breach)::INT) OVER (PARTITION BY alert, job ORDER BY ts) AS island FROM matched),
alerts AS (SELECT *, min(ts) OVER (PARTITION BY alert, job, island) AS run_start FROM islands WHERE breach),
states AS (SELECT *, epoch_us(ts) - epoch_us(run_start) >= for_s * 1000000 AS firing FROM alerts),
firing AS (SELECT * FROM states WHERE firing)"""


def fired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.threshold_alerts(
        readings(spark, sf_dir), alerts.alert_rules(spark, HOLD_S), ["job"]
    )


@query(
    "threshold_alerts",
    f"""WITH {_ALERTS_SQL}
        SELECT alert, severity, metric, job, ts, round(value, 6) + 0.0 AS value, run_start, firing FROM states""",
)
def threshold_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fired(spark, sf_dir).withColumn("value", rounded(F.col("value")))


@query(
    "alert_route",
    f"""WITH {_ALERTS_SQL}
        SELECT alert, severity, job, ts,
               CASE WHEN severity = 'critical' OR alert = 'NodeOutOfMemory' THEN 'discord' ELSE 'null' END AS receiver
        FROM firing""",
)
def alert_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = alerts.alert_route(fired(spark, sf_dir).where("firing"))
    return routed.select("alert", "severity", "job", "ts", "receiver")


# Alerts of a whole quarter hour arrive together here, so groups span an hour.
_GROUP_S = 3600


@query(
    "alert_group",
    f"""WITH {_ALERTS_SQL},
        batches AS (SELECT alert, job, date_trunc('hour', ts) AS window_start, min(ts) AS first_ts, count(*) AS n
                    FROM firing GROUP BY ALL)
        SELECT *, CASE WHEN lag(window_start) OVER (PARTITION BY alert, job ORDER BY window_start)
                            = window_start - INTERVAL 1 HOUR
                       THEN window_start + INTERVAL 1 HOUR ELSE first_ts + INTERVAL 30 SECONDS END AS notify_at
        FROM batches""",
)
def alert_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_group(fired(spark, sf_dir).where("firing"), ["job"], interval_s=_GROUP_S)


@query(
    "alert_repeat_suppression",
    f"""WITH {_ALERTS_SQL}
        SELECT alert, job, run_start, (epoch_us(ts) - epoch_us(run_start)) // 10800000000 AS repeat_no,
               min(ts) AS sent_at
        FROM firing GROUP BY ALL""",
)
def alert_repeat_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_repeat_suppression(fired(spark, sf_dir).where("firing"), ["job"])


@query(
    "alert_incidents",
    f"""WITH {_ALERTS_SQL},
        gaps AS (SELECT alert, job, ts, coalesce(ts - lag(ts) OVER w > INTERVAL 30 MINUTES, true) AS is_new
                 FROM firing WINDOW w AS (PARTITION BY alert, job ORDER BY ts)),
        numbered AS (SELECT *, sum(is_new::INT) OVER (PARTITION BY alert, job ORDER BY ts) AS no FROM gaps)
        SELECT alert, job, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS readings
        FROM numbered GROUP BY alert, job, no""",
)
def alert_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_incidents(fired(spark, sf_dir).where("firing"), ["job"], timeout_s=HOLD_S)


_RATIO = dict(part="errors", whole="requests", op=">", threshold=25.0, for_s=7200)


@query(
    "ratio_threshold_rule",
    f"""WITH hourly AS (SELECT date_trunc('hour', ts) AS ts, user_id % 4 AS node,
                               count(*) FILTER (event_type = 'error') / count(*) * 100 AS ratio
                        FROM events GROUP BY ALL),
        islands AS (SELECT *, sum((ratio <= {_RATIO["threshold"]})::INT)
                    OVER (PARTITION BY node ORDER BY ts) AS island FROM hourly),
        runs AS (SELECT *, min(ts) OVER (PARTITION BY node, island) AS run_start
                 FROM islands WHERE ratio > {_RATIO["threshold"]})
        SELECT node, ts, round(ratio, 6) AS ratio, run_start,
               epoch(ts) - epoch(run_start) >= {_RATIO["for_s"]} AS firing FROM runs""",
)
def ratio_threshold_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (
        B.table(spark, sf_dir, "events")
        .groupBy((F.col("user_id") % 4).alias("node"), F.window("ts", "1 hour").alias("w"))
        .agg(
            F.count(F.when(F.col("event_type") == "error", 1)).cast("double").alias("errors"),
            F.count("*").cast("double").alias("requests"),
        )
        .select("node", F.col("w.start").alias("ts"), "errors", "requests")
        .unpivot(["node", "ts"], ["errors", "requests"], "metric", "value")
    )
    return alerts.ratio_threshold_rule(counts, ["node"], **_RATIO).withColumn(
        "ratio", rounded(F.col("ratio"))
    )
