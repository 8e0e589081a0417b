"""Gauge series (ts, metric, value) from scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Metric names and the scrape interval.
ENTROPY_GAUGE = "api_prediction_entropy"
CONFIDENCE_GAUGE = "api_avg_confidence"
SHIFT_GAUGE = "api_distribution_shift"
DRIFT_GAUGE = "app_data_drift_score"
SCRAPE_INTERVAL = "15 seconds"


def batch_quality_means(scored: DataFrame) -> DataFrame:
    """Mean entropy and confidence of a batch, not rounded."""
    return scored.agg(
        F.avg("entropy").alias("avg_entropy"), F.avg("confidence").alias("avg_confidence")
    )


def as_gauges(scored: DataFrame, keep: list[str]) -> DataFrame:
    """Scored rows as two gauge readings each: (keep..., metric, value)."""
    return scored.select(
        *keep, F.col("entropy").alias(ENTROPY_GAUGE), F.col("confidence").alias(CONFIDENCE_GAUGE)
    ).unpivot(keep, [ENTROPY_GAUGE, CONFIDENCE_GAUGE], "metric", "value")


def windowed_means(scored: DataFrame, ts: str, width: str, keys: list[str] | None = None) -> DataFrame:
    """(window_start, keys, avg_entropy, avg_confidence, n) in tumbling windows.

    Works on a table and, with a watermark, on a stream.
    """
    return (
        scored.groupBy(F.window(ts, width).alias("_w"), *(keys or []))
        .agg(
            F.avg("entropy").alias("avg_entropy"),
            F.avg("confidence").alias("avg_confidence"),
            F.count("*").alias("n"),
        )
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *(keys or []),
            "avg_entropy",
            "avg_confidence",
            "n",
        )
    )


def gauge_resample(
    samples: DataFrame,
    ts: str,
    keys: list[str],
    value: str = "value",
    tie: list[str] | None = None,
    width: str = SCRAPE_INTERVAL,
) -> DataFrame:
    """One value per scrape: the last write in the interval, ``tie`` settling equal times.

    Leave ``tie`` out where times are distinct: a single time is compared in a
    hash aggregate, several columns in one that sorts.
    """
    order = F.struct(ts, *tie) if tie else F.col(ts)
    return (
        samples.groupBy(F.window(ts, width).alias("_w"), *keys)
        .agg(F.max_by(value, order).alias("value"))
        .select(F.col("_w.start").alias("ts"), *keys, "value")
    )


def gauge_last_value(
    samples: DataFrame, ts: str, keys: list[str], value: str = "value", tie: list[str] | None = None
) -> DataFrame:
    """Last reading per key that is not NULL."""
    order = F.struct(ts, *tie) if tie else F.col(ts)
    return (
        samples.where(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(F.max_by(value, order).alias("value"), F.max(ts).alias("last_ts"))
    )
