"""Scans, projections, checks and lookups."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import bindings as B
from riskloom.functions.scores import rounded
from riskloom.operators import profile, shaping, sketches
from riskloom.queries import query
from riskloom.session import fresh_dir
from riskloom.sources import (
    parse_records,
    read_applications,
    read_object,
    rejected_records,
    rejected_rows,
    write_versioned,
)

_ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
_ORDER_SQL = f"SELECT {', '.join(_ORDERS.names)} FROM orders"
_DAMAGED_ORDER = "o_orderkey % 9 = 4"


def _orders_csv(spark: SparkSession, sf_dir: str, damaged: bool) -> str:
    """Orders as CSV, columns in another order and one more; every ninth price no number if damaged."""
    orders = B.table(spark, sf_dir, "orders").select(*reversed(_ORDERS.names), F.lit("x").alias("extra"))
    if damaged:
        price = F.when(F.expr(_DAMAGED_ORDER), "none").otherwise(F.col("o_totalprice").cast("string"))
        orders = orders.withColumn("o_totalprice", price)
    path = fresh_dir(spark, "orders") + ".csv"
    orders.write.option("header", True).csv(path)
    return path


@query("csv_scan", _ORDER_SQL)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_applications(spark, _orders_csv(spark, sf_dir, damaged=False), _ORDERS)


@query(
    "csv_rejects",
    f"""SELECT o_orderkey, {_DAMAGED_ORDER} AS rejected,
               CASE WHEN NOT ({_DAMAGED_ORDER}) THEN o_totalprice END AS o_totalprice FROM orders""",
)
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a damaged file, the rows that can be read and the keys of the others."""
    path = _orders_csv(spark, sf_dir, damaged=True)
    good = read_applications(spark, path, _ORDERS, bad="drop")
    key = F.get_json_object("rejected", "$.o_orderkey").cast("bigint")
    lost = rejected_rows(spark, path, _ORDERS).select(
        key.alias("o_orderkey"), F.lit(True).alias("rejected"), F.lit(None).cast("double").alias("o_totalprice")
    )
    return good.select("o_orderkey", F.lit(False).alias("rejected"), "o_totalprice").unionByName(lost)


@query("object_store_source", "SELECT * FROM customer")
def object_store_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    if "://" in sf_dir:
        scheme, rest = sf_dir.split("://", 1)
        bucket, _, prefix = rest.partition("/")
        key = os.path.join(prefix, "customer.parquet")
        return read_object(spark, bucket, key, scheme)
    return read_object(spark, os.path.abspath(sf_dir), "customer.parquet", "file")


_RECORD = T.StructType([T.StructField("k", T.LongType()), T.StructField("absent", T.StringType())])
# A text that breaks off, one with a value of another type, and a NULL one.
_DAMAGED_TEXT = """CASE WHEN event_id % 13 = 0 THEN substring(props, 1, length(props) - 1)
    WHEN event_id % 13 = 1 THEN '{"k":"many"}' WHEN event_id % 13 = 2 THEN NULL ELSE props END"""


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = B.table(spark, sf_dir, "events")
    return events.select("event_id", "event_type", F.expr(_DAMAGED_TEXT).alias("body"))


@query(
    "json_records_scan",
    """SELECT event_id, event_type, json_extract(props, '$.k')::BIGINT AS k,
              CAST(NULL AS VARCHAR) AS absent
       FROM events WHERE event_id % 13 > 2""",
)
def json_records_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_records(_bodies(spark, sf_dir), "body", _RECORD, bad="drop")


@query(
    "json_rejects",
    f"""SELECT event_id, event_type, rejected
        FROM (SELECT event_id, event_type, {_DAMAGED_TEXT} AS rejected FROM events) WHERE event_id % 13 <= 2""",
)
def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and records that cannot be read, as they came."""
    return rejected_records(_bodies(spark, sf_dir), "body", _RECORD)


@query("versioned_dataset_write", _ORDER_SQL)
def versioned_dataset_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    dest = os.path.join(fresh_dir(spark, "datasets"), "train.csv")
    orders = B.table(spark, sf_dir, "orders").select(_ORDERS.names)
    return read_applications(spark, write_versioned(orders, dest, "v1"), _ORDERS)


def _profile_sql(table: str, numbers: dict[str, str], texts: dict[str, str]) -> str:
    parts = [
        f"""SELECT '{c}' AS column_name, '{t}' AS dtype, count(*)::BIGINT AS n_rows,
            (count(*) - count({c}))::BIGINT AS n_missing,
            min({c})::DOUBLE AS min_number, max({c})::DOUBLE AS max_number,
            round(avg({c}), 6) AS mean, NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text
            FROM {table}"""
        for c, t in numbers.items()
    ] + [
        f"""SELECT '{c}', '{t}', count(*)::BIGINT, (count(*) - count({c}))::BIGINT,
            NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, min({c}::VARCHAR), max({c}::VARCHAR) FROM {table}"""
        for c, t in texts.items()
    ]
    return " UNION ALL ".join(parts)


@query(
    "table_profile",
    _profile_sql(
        "lineitem",
        {
            "l_orderkey": "bigint",
            "l_partkey": "bigint",
            "l_suppkey": "bigint",
            "l_linenumber": "int",
            "l_quantity": "double",
            "l_extendedprice": "double",
            "l_discount": "double",
            "l_tax": "double",
        },
        {"l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"},
    ),
)
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.table_profile(B.table(spark, sf_dir, "lineitem"))
    return found.withColumn("mean", rounded(F.col("mean")))


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query(
    "profile_sketches",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*)::BIGINT AS n_rows, (count(*) - count({c}))::BIGINT AS n_missing,
            count(DISTINCT {c})::BIGINT AS n_distinct, true AS within FROM events"""
        for c in EVENT_COLUMNS
    ),
)
def profile_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts over two loads whose sketches were kept apart, and whether they are within
    the bound of the exact ones."""
    events = B.table(spark, sf_dir, "events").select(EVENT_COLUMNS)
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    path = fresh_dir(spark, "profile")
    for load, rows in (("1", events.where(early)), ("2", events.where(~early))):
        sketches.keep_load(sketches.distinct_sketches(rows), path, load)
    found = sketches.distinct_counts(sketches.kept_loads(spark, path))
    whole = events.agg(*[F.count_distinct(c).alias(c) for c in EVENT_COLUMNS])
    exact = whole.unpivot([], EVENT_COLUMNS, "column_name", "n_distinct")
    off = F.abs(F.col("approx_distinct") - F.col("n_distinct"))
    within = off <= sketches.DISTINCT_ERROR * F.col("n_distinct")
    return found.join(exact, "column_name").select("column_name", "n_rows", "n_missing", "n_distinct", within.alias("within"))


@query(
    "model_input_projection",
    "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
)
def model_input_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = ["o_orderpriority", "o_totalprice", "not_a_column"]
    return shaping.model_input(B.table(spark, sf_dir, "orders"), known, ["o_orderkey"])


@query(
    "entity_lookup",
    """SELECT i.id AS requested_id, c.c_custkey, c.c_name, c.c_acctbal,
              CASE WHEN c.c_custkey IS NULL THEN 'ID ' || i.id || ' not found' END AS error
       FROM (SELECT DISTINCT l_partkey AS id FROM lineitem) i
       LEFT JOIN customer c ON c.c_custkey = i.id""",
)
def entity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = B.table(spark, sf_dir, "lineitem").select("l_partkey")
    customers = B.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return shaping.entity_lookup(ids, customers, "l_partkey", "c_custkey")


_ITEM_KEY = ", ".join(B.ITEM_KEY)


@query(
    "null_normalise",
    f"SELECT {_ITEM_KEY}, l_tax, nullif(l_discount, 0.0) AS discount FROM lineitem",
)
def null_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("l_discount")
    dirty = B.table(spark, sf_dir, "lineitem").select(
        *B.ITEM_KEY, "l_tax", F.when(d == 0.0, F.lit(float("nan"))).otherwise(d).alias("discount")
    )
    return shaping.null_normalise(dirty)


@query(
    "fill_missing",
    f"""SELECT {_ITEM_KEY}, l_discount AS discount_few_gaps,
        CASE WHEN l_discount > 0.01 THEN l_discount ELSE 0.0 END AS discount_many_gaps FROM lineitem""",
)
def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = ["discount_few_gaps", "discount_many_gaps"]
    return shaping.fill_missing(
        B.lineitems_with_gaps(spark, sf_dir).select(*B.ITEM_KEY, *gaps), gaps
    )


@query(
    "required_column_check",
    f"""SELECT {_ITEM_KEY},
        CASE WHEN l_discount = 0.0 THEN 'discount_few_gaps,' ELSE '' END || 'discount_many_gaps' AS missing
        FROM lineitem WHERE l_discount <= 0.01""",
)
def required_column_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.required_column_check(
        B.lineitems_with_gaps(spark, sf_dir),
        B.ITEM_KEY,
        ["l_quantity", "discount_few_gaps", "discount_many_gaps"],
    )
    return found.withColumn("missing", F.array_join("missing", ","))


@query(
    "type_conformance",
    """SELECT column_name, count(v)::BIGINT AS n_values,
              count(*) FILTER (v IS NOT NULL AND NOT regexp_full_match(v, pattern))::BIGINT AS n_bad
       FROM (
         SELECT 'o_orderkey' AS column_name, o_orderkey::VARCHAR AS v, '-?[0-9]+' AS pattern FROM orders
         UNION ALL SELECT 'o_totalprice', o_totalprice::VARCHAR, '-?[0-9]+(\\.[0-9]+)?' FROM orders
         UNION ALL SELECT 'o_orderpriority', o_orderpriority, '-?[0-9]+' FROM orders
         UNION ALL SELECT 'priority_code',
           CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE o_orderpriority[1:1] END, '-?[0-9]+'
           FROM orders
       ) GROUP BY column_name""",
)
def type_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    raw = B.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        "o_orderpriority",
        F.when(F.col("o_orderstatus") == "P", priority)
        .otherwise(F.substring(priority, 1, 1))
        .alias("priority_code"),
    )
    declared = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderpriority", T.LongType()),
            T.StructField("priority_code", T.LongType()),
        ]
    )
    return profile.type_conformance(raw, declared)


@query(
    "train_valid_split",
    """SELECT o_orderkey, CASE WHEN ('0x' || md5('42_' || o_orderkey)[1:8])::BIGINT % 100 < 80
              THEN 'train' ELSE 'valid' END AS part
       FROM orders""",
)
def train_valid_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey")
    return shaping.with_split(orders, "o_orderkey")


@query(
    "latest_with_fallback",
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY
           CASE o_orderstatus WHEN 'F' THEN 0 ELSE 1 END, o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders WHERE o_orderstatus IN ('F', 'O'))
       WHERE rn = 1""",
)
def latest_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = B.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    return shaping.latest_with_fallback(
        orders, "o_custkey", "o_orderstatus", ["o_orderdate", "o_orderkey"], ("F", "O")
    ).drop("o_orderdate")
