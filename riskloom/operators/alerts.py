"""Threshold alerts over gauge series: matching, holding, routing, grouping, repeating."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scores import epoch_us
from riskloom.operators.gauges import CONFIDENCE_GAUGE, DRIFT_GAUGE, ENTROPY_GAUGE
from riskloom.operators.ordered import BUCKET_S, breach_runs, sessions

# Fixed values: (alert, metric, comparison, threshold, seconds held, severity).
ALERT_RULES = [
    ("DataDriftWarning", DRIFT_GAUGE, ">", 0.1, 60, "warning"),
    ("DataDriftCritical", DRIFT_GAUGE, ">", 0.3, 60, "critical"),
    ("PredictionEntropyTooHigh", ENTROPY_GAUGE, ">", 0.7, 60, "warning"),
    ("PredictionEntropyCritical", ENTROPY_GAUGE, ">", 0.9, 60, "critical"),
    ("ConfidenceTooLow", CONFIDENCE_GAUGE, "<", 0.9, 60, "warning"),
    ("ConfidenceCritical", CONFIDENCE_GAUGE, "<", 0.7, 60, "critical"),
]

# The ratio rule (alert, part, whole, scale, comparison, threshold, seconds, severity).
MEMORY_RULE = (
    "NodeOutOfMemory",
    "node_memory_MemAvailable_bytes",
    "node_memory_MemTotal_bytes",
    100,
    "<",
    5,
    60,
    "warning",
)

# Routing and timing of notifications.
CHANNEL = "discord"
NO_RECEIVER = "null"
ROUTED_SEVERITY = "critical"
ROUTED_ALERTS = "^(?:NodeOutOfMemory)$"
GROUP_WAIT_S = 30
GROUP_INTERVAL_S = 5 * 60
REPEAT_INTERVAL_S = 3 * 3600
RESOLVE_TIMEOUT_S = 5 * 60

RULE_COPIES = 64

RULES_SCHEMA = (
    "alert string, metric string, op string, threshold double, for_s int, severity string"
)


def alert_rules(spark: SparkSession, for_s: int | None = None) -> DataFrame:
    """The rule table; ``for_s`` overrides how long a condition must hold."""
    rows = [(*r[:4], r[4] if for_s is None else for_s, r[5]) for r in ALERT_RULES]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def breached(value: Column, op: Column, threshold: Column) -> Column:
    """Whether the comparison holds; an operator that is none of the six is an error."""
    return (
        F.when(op == ">", value > threshold)
        .when(op == "<", value < threshold)
        .when(op == ">=", value >= threshold)
        .when(op == "<=", value <= threshold)
        .when(op == "==", value == threshold)
        .when(op == "!=", value != threshold)
        .otherwise(F.raise_error(F.concat(F.lit("unknown comparison "), op)).cast("boolean"))
    )


def gauge_rule_match(samples: DataFrame, rules: DataFrame) -> DataFrame:
    """Every reading with every rule on its metric, and whether it breaches.

    There are few metrics with very many readings each, so every rule stands RULE_COPIES times
    and the readings of a metric are dealt to the copies. Small rule tables are sent to the
    readings by the optimizer instead.
    """
    copy = F.explode(F.sequence(F.lit(0), F.lit(RULE_COPIES - 1))).alias("_copy")
    dealt = F.pmod(F.xxhash64(*samples.columns), F.lit(RULE_COPIES)).cast("int")
    return (
        samples.withColumn("_copy", dealt)
        .join(rules.select("*", copy), ["metric", "_copy"])
        .drop("_copy")
        .withColumn("breach", breached(F.col("value"), F.col("op"), F.col("threshold")))
    )


def threshold_alerts(
    samples: DataFrame,
    rules: DataFrame,
    keys: list[str],
    ts: str = "ts",
    max_gap_s: int | None = None,
    bucket_s: int = BUCKET_S,
) -> DataFrame:
    """Breaching readings with the start of their run and whether the alert fires yet.

    An alert fires once its condition has held without a break for the rule's
    time. ``keys`` tell series of one metric apart.
    """
    matched = gauge_rule_match(samples, rules)
    runs = breach_runs(matched, ["alert", *keys], ts, "breach", max_gap_s, bucket_s)
    held = epoch_us(F.col(ts)) - epoch_us(F.col("run_start"))
    return (
        runs.where("breach")
        .withColumn("firing", held >= F.col("for_s") * 1_000_000)
        .select("alert", "severity", "metric", *keys, ts, "value", "run_start", "firing")
    )


def ratio_threshold_rule(
    samples: DataFrame,
    keys: list[str],
    part: str,
    whole: str,
    op: str,
    threshold: float,
    for_s: int,
    ts: str = "ts",
    scale: float = 100.0,
    bucket_s: int = BUCKET_S,
) -> DataFrame:
    """The same for a rule on ``part / whole * scale``; no ratio, no breach."""
    pick = lambda name: F.max(F.when(F.col("metric") == name, F.col("value")))
    ratio = (
        samples.where(F.col("metric").isin(part, whole))
        .groupBy(*keys, ts)
        .agg(pick(part).alias("_part"), pick(whole).alias("_whole"))
        .select(*keys, ts, (F.try_divide("_part", "_whole") * F.lit(float(scale))).alias("ratio"))
        .withColumn("breach", breached(F.col("ratio"), F.lit(op), F.lit(float(threshold))))
    )
    held = epoch_us(F.col(ts)) - epoch_us(F.col("run_start"))
    return (
        breach_runs(ratio, keys, ts, "breach", None, bucket_s)
        .where("breach")
        .withColumn("firing", held >= F.lit(for_s * 1_000_000))
        .select(*keys, ts, "ratio", "run_start", "firing")
    )


def alert_route(alerts: DataFrame) -> DataFrame:
    """Adds ``receiver``: critical alerts and the named ones go to the channel."""
    routed = (F.col("severity") == ROUTED_SEVERITY) | F.col("alert").rlike(ROUTED_ALERTS)
    return alerts.withColumn("receiver", F.when(routed, CHANNEL).otherwise(NO_RECEIVER))


def alert_group(
    alerts: DataFrame,
    keys: list[str],
    ts: str = "ts",
    interval_s: int = GROUP_INTERVAL_S,
    wait_s: int = GROUP_WAIT_S,
) -> DataFrame:
    """(alert, keys, window_start, first_ts, n, notify_at): one notification per group.

    Alerts of one group within an interval go out together. The first batch
    after a quiet interval waits ``wait_s`` from its first alert, later ones go
    at the end of their interval.
    """
    grouped = (
        alerts.groupBy("alert", *keys, F.window(ts, f"{interval_s} seconds").alias("_w"))
        .agg(F.min(ts).alias("first_ts"), F.count("*").alias("n"))
        .select("alert", *keys, F.col("_w.start").alias("window_start"), "first_ts", "n")
    )
    # The interval before is looked up by an equi-join, so a busy group is not
    # sorted in one task.
    width = F.expr(f"INTERVAL {interval_s} SECONDS")
    quiet_end = grouped.select(
        "alert",
        *keys,
        (F.col("window_start") + width).alias("window_start"),
        F.lit(True).alias("_busy"),
    )
    notify_at = F.when(F.col("_busy"), F.col("window_start") + width).otherwise(
        F.col("first_ts") + F.expr(f"INTERVAL {wait_s} SECONDS")
    )
    return (
        grouped.join(quiet_end, ["alert", *keys, "window_start"], "left")
        .withColumn("notify_at", notify_at)
        .drop("_busy")
    )


def alert_repeat_suppression(
    firing: DataFrame, keys: list[str], ts: str = "ts", repeat_s: int = REPEAT_INTERVAL_S
) -> DataFrame:
    """(alert, keys, run_start, repeat_no, sent_at): an unchanged alert is sent once per
    repeat interval of its run."""
    age = epoch_us(F.col(ts)) - epoch_us(F.col("run_start"))
    return (
        firing.withColumn("repeat_no", F.floor(age / F.lit(repeat_s * 1_000_000)).cast("bigint"))
        .groupBy("alert", *keys, "run_start", "repeat_no")
        .agg(F.min(ts).alias("sent_at"))
    )


def alert_incidents(
    firing: DataFrame,
    keys: list[str],
    ts: str = "ts",
    timeout_s: int = RESOLVE_TIMEOUT_S,
    bucket_s: int | None = None,
) -> DataFrame:
    """(alert, keys, first_ts, last_ts, readings): silence for the timeout closes an incident."""
    return sessions(firing, ["alert", *keys], ts, timeout_s, bucket_s)
