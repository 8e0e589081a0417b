"""Sinks: versioned datasets and the run log."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_name", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


def versioned_name(dest: str, version: str) -> str:
    """``x.csv`` -> ``x_{version}.csv``; the same for ``.parquet``."""
    for suffix in (".csv", ".parquet"):
        if suffix in dest:
            return dest.replace(suffix, f"_{version}{suffix}")
    return f"{dest}_{version}"


def write_versioned(df: DataFrame, dest: str, version: str) -> str:
    """Write under the versioned name, CSV or Parquet by suffix; returns the name."""
    target = versioned_name(dest, version)
    writer = df.write.mode("overwrite")
    if target.endswith(".csv"):
        writer.option("header", True).csv(target)
    else:
        writer.parquet(target)
    return target


def run_name(version: str, model_name: str) -> str:
    return f"{version}_{model_name.upper()}"


def append_run(
    spark: SparkSession,
    path: str,
    version: str,
    model_name: str,
    params: dict[str, object],
    metrics: dict[str, float | None],
) -> str:
    """Append one run; metrics without a value (an undefined AUC) are left out."""
    name = run_name(version, model_name)
    row = (
        name,
        datetime.now(timezone.utc),
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items() if v is not None},
    )
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return name


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)
