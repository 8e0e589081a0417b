"""Sketches kept beside each load of a table, merged later without reading old rows again.

Quantile sketches (KLL) propose bins, distinct-count sketches (HyperLogLog) tell how many values a
column has. A load's sketches are one row per column; the sketches of several loads are merged by
an aggregate that has a map-side part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.trees import quoted
from riskloom.operators.quantiles import merged_sketches, quantile_sketches, sketched_quantiles

#: Size of distinct-count sketches as a power of two; the standard error is about 1.04 / 2 ** (LG_K / 2).
LG_K = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)

__all__ = [
    "distinct_counts",
    "distinct_sketches",
    "keep_load",
    "kept_loads",
    "merged_sketches",
    "quantile_sketches",
    "sketched_quantiles",
]


def distinct_sketches(df: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(column_name, sketch, n_rows, n_missing): one distinct-count sketch per column, from one scan.

    Values count as equal if they are equal as text. NULL is no value.
    """
    stats = []
    for f in df.schema.fields:
        value = F.col(quoted(f.name))
        whole = isinstance(f.dataType, (T.IntegralType, T.StringType)) and not isinstance(f.dataType, T.ByteType)
        stats.append(
            F.struct(
                F.hll_sketch_agg(value if whole else value.cast("string"), lg_k).alias("sketch"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count(F.when(value.isNull(), 1)).alias("n_missing"),
            ).alias(f.name)
        )
    return df.agg(*stats).unpivot([], df.columns, "column_name", "s").select("column_name", "s.*")


def distinct_counts(sketches: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_missing, approx_distinct) over all loads that ``sketches`` has."""
    return sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_missing").alias("n_missing"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"),
    )


def keep_load(sketches: DataFrame, path: str, load: str) -> None:
    """Write a load's sketches beside those of others; the same load again takes the place of the first."""
    sketches.coalesce(1).write.mode("overwrite").parquet(f"{path}/load={load}")


def kept_loads(spark: SparkSession, path: str) -> DataFrame:
    """The sketches of all loads written to ``path``, with the column ``load``."""
    return spark.read.parquet(path)
