"""Row-wise steps: feature lists, projection, missing values, splits, lookups, latest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.scores import not_nan

KEY = "SK_ID_CURR"
LABEL = "TARGET"

_FLOATS = (T.DoubleType, T.FloatType)


def feature_lists(
    df: DataFrame, key: str | list[str] = KEY, label: str = LABEL
) -> tuple[list[str], list[str]]:
    """(categorical, numeric) feature names in column order, without key and label."""
    keys = {key} if isinstance(key, str) else set(key)
    cat, num = [], []
    for f in df.schema.fields:
        if f.name in keys or f.name == label:
            continue
        if isinstance(f.dataType, T.StringType):
            cat.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            num.append(f.name)
    return cat, num


def label_split(df: DataFrame, label: str = LABEL) -> tuple[DataFrame, DataFrame]:
    """Features and label as two projections of one table; rows are never zipped again."""
    return df.drop(label), df.select(label)


def model_input(df: DataFrame, known: list[str], keep: list[str] | None = None) -> DataFrame:
    """Only the columns a fitted map knows, in the table's own order."""
    names = set(known)
    return df.select(*(keep or []), *[c for c in df.columns if c in names])


def null_normalise(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column."""
    return df.select(
        *[
            not_nan(F.col(f.name)).alias(f.name) if isinstance(f.dataType, _FLOATS) else f.name
            for f in df.schema.fields
        ]
    )


def fill_missing(df: DataFrame, columns: list[str], value: float = 0.0) -> DataFrame:
    return df.na.fill(value, columns)


def split_bucket(key: Column, seed: int = 42) -> Column:
    """0-99 from the key alone: the same row always lands in the same part,
    whatever the partitioning, and a lost task recomputes the same split."""
    digest = F.md5(F.concat_ws("_", F.lit(str(seed)), key.cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def with_split(
    df: DataFrame, key: str | list[str], train_share: float = 0.8, seed: int = 42
) -> DataFrame:
    """Adds ``part``: 'train' or 'valid'."""
    keys = [key] if isinstance(key, str) else key
    bucket = split_bucket(F.concat_ws("_", *[F.col(k).cast("string") for k in keys]), seed)
    share = F.lit(round(train_share * 100))
    return df.withColumn("part", F.when(bucket < share, "train").otherwise("valid"))


def train_valid_split(
    df: DataFrame, key: str | list[str], train_share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    parts = with_split(df, key, train_share, seed)
    return (
        parts.where(F.col("part") == "train").drop("part"),
        parts.where(F.col("part") == "valid").drop("part"),
    )


def entity_lookup(ids: DataFrame, table: DataFrame, id_column: str, key: str) -> DataFrame:
    """Rows for the given ids; an unknown id gives one row saying so.

    Ids are made distinct first, so an id asked for many times is looked up
    once. The join strategy is left to the optimizer, which knows the sizes.
    """
    wanted = ids.select(F.col(id_column).alias("requested_id")).distinct()
    found = table.withColumn("_hit", F.lit(True))
    joined = wanted.join(found, wanted["requested_id"] == found[key], "left")
    # Fixed value: the text of the answer.
    error = F.when(
        F.col("_hit").isNull(),
        F.concat(F.lit("ID "), F.col("requested_id").cast("string"), F.lit(" not found")),
    )
    return joined.withColumn("error", error).drop("_hit")


def lookup_one(table: DataFrame, key: str, value: int) -> DataFrame:
    """One id: a plain filter, which reaches the scan."""
    return table.where(F.col(key) == F.lit(value))


def latest_with_fallback(
    df: DataFrame,
    key: str | list[str],
    status: str,
    order: list[str],
    preference: tuple[str, ...] = ("Production", "None"),
) -> DataFrame:
    """Per key the latest row in the most preferred status that occurs.

    One aggregate with a map-side part rather than a window: a key holding a
    large share of the rows never has to be gathered and sorted.
    """
    keys = [key] if isinstance(key, str) else key
    rank = F.lit(None).cast("int")
    for i, name in enumerate(preference):
        rank = F.when(F.col(status) == F.lit(name), F.lit(-i)).otherwise(rank)
    rest = [c for c in df.columns if c not in keys]
    picked = (
        df.where(F.col(status).isin(*preference))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(rank, *[F.col(c) for c in order])).alias("row"))
    )
    return picked.select(*keys, "row.*").select(*df.columns)
