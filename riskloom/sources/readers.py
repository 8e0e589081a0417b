"""Scans. Every reader takes a declared schema; inference costs one more pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.trees import quoted
from riskloom.sources.applicant import APPLICANT_SCHEMA

_CORRUPT = "_corrupt_record"


#: Where a row or record that could not be read stands as text.
REJECT = "rejected"


def read_applications(
    spark: SparkSession, path: str, schema: T.StructType | None = None, bad: str = "fail"
) -> DataFrame:
    """A header CSV, or Parquet when the name says so, as a table.

    CSV columns are found by the names in the header, in any order; others are left out and a
    missing one is an error. A row that is cut short, or has a cell that is not of the declared
    type, fails the job, or with ``bad="drop"`` is left out (see ``rejected_rows``).
    """
    if path.rstrip("/").endswith(".parquet"):
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    if schema is None:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    typed, wrong = _typed_csv(spark, path, schema)
    return _settled(typed, wrong, bad).select(schema.names)


def rejected_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(rejected): the rows of a header CSV that ``read_applications`` cannot read, as JSON of their cells."""
    typed, wrong = _typed_csv(spark, path, schema)
    return typed.where(wrong).select(REJECT)


def _typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, Column]:
    """Rows with typed cells and their text, and whether a row is to be rejected."""
    header = spark.read.option("header", True).csv(path).columns
    if missing := [n for n in schema.names if n not in header]:
        raise ValueError(f"columns that the header does not name: {missing}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _CORRUPT]])
    # every file's header is held against the first one's, and every row's length against both
    rows = (
        spark.read.schema(text)
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path)
    )
    cells = {f.name: F.col(quoted(f.name)).try_cast(f.dataType) for f in schema}
    lost = [F.col(quoted(n)).isNotNull() & c.isNull() for n, c in cells.items()]
    wrong = F.col(_CORRUPT).isNotNull()
    for x in lost:
        wrong = wrong | x
    whole = F.to_json(F.struct(*[quoted(c) for c in header]))
    typed = rows.select(
        *[c.alias(n) for n, c in cells.items()],
        wrong.alias("_wrong"),
        F.coalesce(_CORRUPT, whole).alias(REJECT),
    )
    return typed, F.col("_wrong")


def _settled(rows: DataFrame, wrong: Column, bad: str) -> DataFrame:
    """The rows that can be read; others fail the job or are left out."""
    if bad == "drop":
        return rows.where(~wrong)
    if bad != "fail":
        raise ValueError(f"bad must be fail or drop, not {bad}")
    stop = F.raise_error(F.concat(F.lit("cannot be read: "), F.coalesce(REJECT, F.lit("null"))))
    return rows.where(F.when(wrong, stop.cast("boolean")).otherwise(True))


def object_uri(bucket: str, key: str, scheme: str = "s3a") -> str:
    """Address of one object; ``file`` takes a local folder as the bucket."""
    if scheme == "file":
        return f"file://{bucket.rstrip('/')}/{key}"
    return f"{scheme}://{bucket}/{key}"


def read_object(
    spark: SparkSession,
    bucket: str,
    key: str,
    scheme: str = "s3a",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read an object in place. A missing object fails here, at analysis."""
    return read_applications(spark, object_uri(bucket, key, scheme), schema)


def read_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType = APPLICANT_SCHEMA,
    lines: bool = False,
    bad: str = "fail",
) -> DataFrame:
    """JSON requests as a table: unlisted keys are dropped, absent ones are NULL.

    A request is one JSON list (or single record) per file. Large inputs should come as JSON lines
    (``lines=True``), which Spark splits within a file. A broken request, and a record with a value
    of another type, fails the job, or with ``bad="drop"`` is left out (see ``rejected_requests``).
    """
    return parse_records(_requests(spark, path, lines), "value", schema, bad)


def rejected_requests(
    spark: SparkSession, path: str, schema: T.StructType = APPLICANT_SCHEMA, lines: bool = False
) -> DataFrame:
    """(file, rejected): what ``read_records`` cannot read, and where it stands."""
    requests = _requests(spark, path, lines).withColumn("file", F.input_file_name())
    return rejected_records(requests, "value", schema)


def _requests(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    texts = spark.read.text(path, wholetext=not lines)
    return texts.where(F.length(F.trim("value")) > 0)


def parse_records(
    df: DataFrame, column: str, schema: T.StructType = APPLICANT_SCHEMA, bad: str = "fail"
) -> DataFrame:
    """Expand a text column of JSON lists (or single records) to one row per record.

    Unlisted keys are dropped, absent ones are NULL. A text that is no list or record, and a record
    with a value of another type, fails the job, or with ``bad="drop"`` is left out (see
    ``rejected_records``).
    """
    rest = [c for c in df.columns if c != column]
    rows = _parsed(df, column, schema)
    return _settled(rows, F.col("_wrong"), bad).select(*rest, "_record.*").drop(_CORRUPT)


def rejected_records(
    df: DataFrame, column: str, schema: T.StructType = APPLICANT_SCHEMA
) -> DataFrame:
    """The other columns and ``rejected``: texts and records that ``parse_records`` cannot read."""
    rest = [c for c in df.columns if c != column]
    return _parsed(df, column, schema).where("_wrong").select(*rest, REJECT)


def _parsed(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """A row per record, or per text that has none: ``_record``, ``_wrong`` and ``rejected``."""
    rest = [c for c in df.columns if c != column]
    body = F.trim(F.col(column))
    as_list = F.when(body.startswith("{"), F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    texts = df.select(*rest, F.col(column).alias("_body"), F.from_json(as_list, "array<string>").alias("_list"))
    texts = texts.where(F.col("_list").isNull() | (F.size("_list") > 0))
    one = texts.select(*rest, "_body", F.explode_outer("_list").alias("_text"))
    found = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    record = F.from_json("_text", found, {"columnNameOfCorruptRecord": _CORRUPT})
    return one.withColumn("_record", record).select(
        *rest,
        "_record",
        (F.col("_record").isNull() | F.col(f"_record.{_CORRUPT}").isNotNull()).alias("_wrong"),
        F.coalesce("_text", "_body").alias(REJECT),
    )
