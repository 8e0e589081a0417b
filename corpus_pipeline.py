"""The corpus pipeline: documents in, encoded clean documents out.

Every stage works on all that the one before kept. ``STAGES`` names them in order; each function
takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
documents. Null ids and repeated rows go through every stage like others; an empty table gives an
empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.bindings import table
from riskloom.llm import bpe, decontaminate, line_dedup, near_dedup, pretokens, queries, toxicity
from riskloom.queries import query
from riskloom.session import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject; null and empty texts score as calm ones."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels")).select(COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand elsewhere before; n_chars counts what is left.

    Of lines in rows of equal id the one with the lower text hash stays; rows that repeat both are
    one document. Null texts stay null, with 0 characters.
    """
    kept = line_dedup.line_dedup(docs, carry=("lang", "source"))
    n_chars = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    return kept.select("doc_id", "text", "lang", "source", n_chars.alias("n_chars"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the lowest id; texts without words are one group."""
    return near_dedup.drop_copies(docs).select(COLUMNS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark stands; null and empty texts have none."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, checked by what they decode to; a null text has none."""
    ranks = pretokens.load_ranks(queries.RANKS)
    return bpe.digests(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_copies),
    ("decontamination", drop_benchmark),
    ("byte_bpe", encode),
]

#: Label model, edit similarity, XXH64 and BPE have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
