"""Helpers shared by the operators of this package."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of rows that are handed to Python at a time.
BATCH_BYTES = 4 << 20


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names; whatever else the table has stays out."""
    return df.select([df[old].alias(new) for new, old in columns.items()])


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32 of the id as text, modulo ``folds``, is ``fold``; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of at most about BATCH_BYTES, whatever their length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the table does not have yet, whatever the case of its letters."""
    known = {c.lower() for c in df.columns}
    while name.lower() in known:
        name += "_"
    return name


def stretches(text: bytes, cut: re.Pattern[bytes], step: int = 1 << 20) -> Iterator[bytes]:
    """A text in turns of about ``step`` bytes, each ending just before a match of ``cut``."""
    start = 0
    while len(text) - start > step and (end := cut.search(text, start + step)):
        yield text[start : end.start()]
        start = end.start()
    yield text[start:] if start else text


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


__all__ = [
    "BATCH_BYTES",
    "ascii_lower",
    "fresh_name",
    "in_fold",
    "pick",
    "settle",
    "sha256_hex",
    "small_batches",
    "stretches",
]
