"""Scoring and monitoring as Structured Streaming jobs.

Each job shares its column logic with the batch operator of the same name and
differs only in what time does to it: a watermark, and rows handed on once
their window has closed. Rows later than the watermark are dropped, and
counted: ``late_rows`` reads the numbers, ``write_available`` keeps them beside
the result. State of several stages is in ``streaming.alerts``.
"""

from __future__ import annotations

import os
import threading

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.binning import BinMap, Prebins
from riskloom.operators.drift import windowed_drift
from riskloom.operators.gauges import CONFIDENCE_GAUGE, ENTROPY_GAUGE, windowed_means
from riskloom.plans.scoring import batch_score, scorecard_score
from riskloom.session import fresh_dir

WATERMARK = "1 minute"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
LATE_SCHEMA = "batch bigint, operator int, name string, dropped bigint"
#: The state store is a setting of the session, so queries of one session start one at a time.
_STARTING = threading.Lock()
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """A growing folder of Parquet files, or a glob of folders and files."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a timestamp with time zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def start(
    df: DataFrame,
    path: str,
    progress: str,
    available_now: bool = False,
    every: str = "15 seconds",
    rocksdb: bool = False,
) -> StreamingQuery:
    """Append to Parquet files; ``progress`` must be a folder all machines reach.

    The state store is the session's, as window and session state is small;
    ``rocksdb`` is for jobs that keep state of their own, which need it. A query
    keeps the settings it was started with, so the session's are put back at once.
    """
    writer = df.writeStream.format("parquet").option("checkpointLocation", progress)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    conf = df.sparkSession.conf
    with _STARTING:
        before = conf.get(STATE_STORE, None)
        if rocksdb:
            conf.set(STATE_STORE, ROCKSDB)
        try:
            return writer.trigger(**trigger).outputMode("append").start(path)
        finally:
            if before is None:
                conf.unset(STATE_STORE)
            else:
                conf.set(STATE_STORE, before)


def late_rows(query: StreamingQuery) -> list[tuple[int, int, str, int]]:
    """(batch, operator, name, dropped) for every stateful operator that dropped late rows.

    Read from the progress reports that the session keeps, which are the last hundred unless
    ``spark.sql.streaming.numRecentProgressUpdates`` says otherwise. Rows of windows that are added up
    before the state are counted as such sums.
    """
    return [
        (p["batchId"], k, op["operatorName"], op["numRowsDroppedByWatermark"])
        for p in query.recentProgress
        for k, op in enumerate(p["stateOperators"])
        if op["numRowsDroppedByWatermark"]
    ]


def write_available(
    df: DataFrame, tag: str, rocksdb: bool = False, late: str | None = None
) -> DataFrame:
    """Run over all input there is, into files of the shared folder; the files as a table.

    ``late`` is a folder for a table of the dropped late rows of this run, as ``late_rows`` has them.
    """
    spark = df.sparkSession
    base = fresh_dir(spark, tag)
    rows = os.path.join(base, "rows")
    query = start(df, rows, os.path.join(base, "progress"), available_now=True, rocksdb=rocksdb)
    query.awaitTermination()
    if late is not None:
        spark.createDataFrame(late_rows(query), LATE_SCHEMA).coalesce(1).write.mode("append").parquet(late)
    return spark.read.schema(df.schema).parquet(rows)


def stream_score(
    applications: DataFrame, bins: BinMap, model: PipelineModel, keep: list[str]
) -> DataFrame:
    """Scores of arriving applications: the batch function, which keeps no state."""
    return batch_score(applications, bins, model, keep)


def stream_scorecard(
    applications: DataFrame,
    bins: BinMap,
    weights: dict[str, float],
    intercept: float,
    keep: list[str],
) -> DataFrame:
    """The same for a linear scorecard as plain column arithmetic."""
    return scorecard_score(applications, bins, weights, intercept, keep)


def stream_gauges(
    scored: DataFrame, ts: str, width: str, keys: list[str] | None = None, delay: str = WATERMARK
) -> DataFrame:
    """Tumbling means of entropy and confidence, each window once it has closed."""
    return windowed_means(event_time(scored, ts).withWatermark(ts, delay), ts, width, keys)


def stream_drift(
    rows: DataFrame,
    ts: str,
    width: str,
    prebins: Prebins,
    reference: DataFrame,
    keys: list[str] | None = None,
    delay: str = WATERMARK,
) -> DataFrame:
    """``windowed_drift`` of arriving rows against a reference table, each window once it has closed."""
    return windowed_drift(event_time(rows, ts).withWatermark(ts, delay), ts, width, prebins, reference, keys)


def gauge_readings(windows: DataFrame, keys: list[str]) -> DataFrame:
    """Gauge windows as readings (ts, keys, metric, value)."""

    def reading(metric: str, column: str):
        return F.struct(F.lit(metric).alias("metric"), F.col(column).alias("value"))

    both = F.array(reading(ENTROPY_GAUGE, "avg_entropy"), reading(CONFIDENCE_GAUGE, "avg_confidence"))
    return windows.select(F.col("window_start").alias("ts"), *keys, F.inline(both))
