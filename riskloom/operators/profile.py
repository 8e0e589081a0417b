"""One-pass checks and profiles. Every aggregate here combines on the map side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.scores import not_nan

_FLOATS = (T.DoubleType, T.FloatType)


def _is_missing(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, _FLOATS):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def table_profile(df: DataFrame, distinct: bool = False, rsd: float = 0.05) -> DataFrame:
    """Per column: type, rows, nulls, range and mean, plus an approximate distinct count on demand."""
    names = df.columns
    per_column = []
    for f in df.schema.fields:
        numeric = isinstance(f.dataType, T.NumericType)
        number = not_nan(F.col(f.name).cast("double")) if numeric else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if numeric else F.col(f.name).cast("string")
        stats = [
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count(F.when(_is_missing(f), 1)).alias("n_missing"),
            F.min(number).alias("min_number"),
            F.max(number).alias("max_number"),
            F.avg(number).alias("mean"),
            F.min(text).alias("min_text"),
            F.max(text).alias("max_text"),
        ]
        if distinct:
            stats.append(F.approx_count_distinct(f.name, rsd).alias("approx_distinct"))
        per_column.append(F.struct(*stats).alias(f.name))
    wide = df.agg(*per_column)
    return wide.unpivot([], names, "column_name", "s").select("column_name", "s.*")


def missing_rate(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, missing_rate): share of NULL or NaN."""
    fields = {f.name: f for f in df.schema.fields}
    wide = df.agg(*[F.avg(_is_missing(fields[c]).cast("int")).alias(c) for c in columns])
    return wide.unpivot([], columns, "feature", "missing_rate")


def class_totals(df: DataFrame, label: str) -> DataFrame:
    t = F.col(label)
    return df.agg(
        F.count(F.when(t == 0, 1)).alias("goods"), F.count(F.when(t == 1, 1)).alias("bads")
    )


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns the table does not have at all."""
    return [c for c in required if c not in df.columns]


def required_column_check(df: DataFrame, key: list[str], required: list[str]) -> DataFrame:
    """Rows lacking a required value, with the names of what they lack."""
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    fields = {f.name: f for f in df.schema.fields}
    lacking = F.array_compact(F.array(*[F.when(_is_missing(fields[c]), F.lit(c)) for c in required]))
    return df.select(*key, lacking.alias("missing")).where(F.size("missing") > 0)


def conforms(column: Column, dtype: T.DataType) -> Column:
    """False where a present text value cannot be read as the type."""
    return column.isNull() | column.try_cast(dtype).isNotNull()


def type_conformance(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column_name, n_values, n_bad) of a text table against the declared types."""
    names = [f.name for f in schema.fields]
    wide = df.agg(
        *[
            F.struct(
                F.count(f.name).alias("n_values"),
                F.count(F.when(~conforms(F.col(f.name), f.dataType), 1)).alias("n_bad"),
            ).alias(f.name)
            for f in schema.fields
        ]
    )
    return wide.unpivot([], names, "column_name", "s").select("column_name", "s.*")


def conforming_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed rows in which every present value can be read as declared."""
    ok = F.lit(True)
    for f in schema.fields:
        ok = ok & conforms(F.col(f.name), f.dataType)
    return df.where(ok).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )
