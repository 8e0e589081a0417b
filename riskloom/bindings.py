"""Application-like tables derived from the given test tables.

No applicant data is available, so operators are exercised on these. All text
features look at whole texts, and every binding keeps every row.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scores import argmax_class, confidence, entropy
from riskloom.operators.gauges import as_gauges
from riskloom.session import settle

DOC_CAT = ["lang", "source"]
DOC_NUM = ["n_chars", "space_ratio", "digit_ratio", "uniq_ratio", "upper_ratio", "dot_ratio"]
ITEM_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
ITEM_CAT = ["l_linestatus"]
ITEM_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORDER_CAT = ["o_orderpriority", "c_mktsegment"]
ORDER_NUM = ["o_totalprice", "c_acctbal"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def text_features(documents: DataFrame) -> DataFrame:
    """Ratios describing each whole text; the text itself goes no further."""
    words = F.split("text", " ", -1)

    def share_of(pattern: str) -> Column:
        return F.try_divide(F.regexp_count("text", F.lit(pattern)), "n_chars")

    return documents.select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        share_of(" ").alias("space_ratio"),
        share_of("[0-9]").alias("digit_ratio"),
        F.try_divide(F.size(F.array_distinct(words)), F.size(words)).alias("uniq_ratio"),
        share_of("[A-Z]").alias("upper_ratio"),
        share_of("[.]").alias("dot_ratio"),
    )


def labelled_documents(spark: SparkSession, sf_dir: str, target: str) -> DataFrame:
    """Documents with a label; TARGET is ``toxic``, or not ``quality``.

    Features are taken before the join, so numbers are shuffled, not texts.
    Fitting reads its input several times, so they are written out once rather
    than taken from the texts again and again.
    """
    labels = table(spark, sf_dir, "labels")
    bad = F.col("toxic") if target == "toxic" else F.lit(1) - F.col("quality")
    features = text_features(table(spark, sf_dir, "documents"))
    return settle(features.join(labels.select("doc_id", bad.alias("TARGET")), "doc_id"), "documents")


def lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per item, TARGET 1 for a returned one."""
    returned = (F.col("l_returnflag") == "R").cast("int")
    return table(spark, sf_dir, "lineitem").select(
        *ITEM_KEY, *ITEM_CAT, *ITEM_NUM, returned.alias("TARGET")
    )


def lineitems_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with missing values on both sides of the missing-rate limit."""
    d = F.col("l_discount")
    return lineitems(spark, sf_dir).select(
        *ITEM_KEY,
        *ITEM_CAT,
        "l_quantity",
        "l_tax",
        F.when(d != 0.0, d).alias("discount_few_gaps"),
        F.when(d > 0.01, d).alias("discount_many_gaps"),
        "TARGET",
    )


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer; ``is_current`` tells the later period.

    Joined once and written out, as fitting reads its input several times.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    later = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", *ORDER_CAT, *ORDER_NUM, later.cast("int").alias("is_current")
    )
    return settle(rows, "orders")


def score_log(events: DataFrame) -> DataFrame:
    """The event log read as a log of scored applications."""
    p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("value") - 50.0) / 25.0))
    p0, p1_col = F.col("p0"), F.col("p1")
    return (
        events.select("event_id", "ts", "user_id", "event_type", p1.alias("p1"))
        .withColumn("p0", F.lit(1.0) - F.col("p1"))
        .select(
            "event_id",
            "ts",
            F.col("event_type").alias("job"),
            (F.col("event_type") == "error").cast("int").alias("y"),
            "p0",
            "p1",
            argmax_class(p0, p1_col).alias("pred"),
            entropy(p0, p1_col).alias("entropy"),
            confidence(p0, p1_col).alias("confidence"),
        )
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_log(table(spark, sf_dir, "events"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauge readings, two per scored row: (event_id, ts, job, metric, value)."""
    return as_gauges(scores(spark, sf_dir), ["event_id", "ts", "job"])
