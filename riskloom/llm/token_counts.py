"""Token counts, with overlap resynchronisation for huge texts.

A huge text is cut into chunks that overlap, which any task may encode. Encoding at a place
depends on the text before it only through where the last match of the splitting pattern ended.
So where a boundary of the chunk before and one of the chunk after coincide in their overlap, the
two agree from there on, and the counts are spliced. A boundary is only relied upon if the text
that decides it, up to the longest special token and two characters on, lies within the chunk.
Where no boundaries coincide, the text is taken again with a wider overlap.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from riskloom.llm.common import pick, settle, small_batches
from riskloom.llm.pretokens import Splitter

#: Characters of a chunk; shorter texts are one.
CHUNK = 1 << 15
#: Characters that a chunk shares with the next one, at first.
OVERLAP = 1 << 8
#: How much wider the next overlap is.
WIDER = 4
#: Distinct pre-tokens whose counts a task remembers.
REMEMBERED = 100_000


class Counter:
    """Tokens of the pre-tokens of a text, as the tokenizer of a .json file counts them.

    Special tokens standing in a text are tokens, and the text between them is split by itself.
    """

    def __init__(self, model: str, pattern: str):
        # one thread: the tasks are what runs side by side
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        splitter = self.tokenizer.pre_tokenizer
        if self.tokenizer.normalizer or not isinstance(splitter, ByteLevel) or splitter.add_prefix_space:
            raise ValueError("only byte-level tokenizers that take texts as they are can be cut")
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added):
            raise ValueError("only special tokens that stand for themselves can be cut")
        self.special = {t.content for t in added}
        self.longest = max(map(len, self.special), default=0)
        ordered = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, ordered)) + ")") if ordered else None
        self.split = Splitter(pattern)
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.special):
            return self.split(text)
        out: list[str] = []
        for part in self.cut.split(text):
            out += [part] if part in self.special else self.split(part)
        return out

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        new = [p for p in set(pieces) if p not in known]
        if new:
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = list(set(pieces))
            for p, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
                known[p] = len(e)
        return list(map(known.__getitem__, pieces))


@lru_cache(maxsize=1)
def _counter(model: str, pattern: str) -> Counter:
    """A Python worker builds its counter once and keeps it for its next tasks."""
    return Counter(model, pattern)


def token_counts(
    docs: DataFrame,
    model: str,
    pattern: str,
    limit: int = 1024,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit): one row per row of ``docs``.

    ``model`` is the text of a tokenizer's .json file, ``pattern`` what its byte-level splitter
    matches. No begin, end or added tokens, no truncation; special tokens inside a text count as
    one. Null texts count as empty: no bytes, no tokens. Repeated rows and null ids each get their
    row; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    Counter(model, pattern)  # refuses what it cannot count, before any job
    own = pick(docs, doc_id=doc_id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    kind = own.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the vocabulary

    def whole(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value, pattern)
        for b in it:
            n = [sum(counter.counts(counter.pieces(t.as_py()))) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    sized = own.withColumn("n_bytes", F.octet_length("text").cast("long"))
    short = sized.where(F.length("text") <= chunk).mapInArrow(whole, f"doc_id {kind}, n_bytes long, n_tokens long")
    # written out, so that a number can tell rows apart
    long = settle(sized.where(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id()), "long")
    spliced = _spliced(long.select("row", "text"), shared, pattern, chunk, overlap)
    counted = short if spliced is None else short.unionByName(
        long.select("row", "doc_id", "n_bytes").join(spliced, "row").select("doc_id", "n_bytes", "n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


_CHUNKS = "row long, k int, last boolean, start long, text string"
_CUTS = "row long, k int, last boolean, n long, head_at array<long>, head_n array<long>, tail_at array<long>, tail_n array<long>"


def _spliced(long: DataFrame, shared, pattern: str, chunk: int, overlap: int) -> DataFrame | None:
    """(row, n_tokens) of all long texts."""
    pending, done = long, None
    while n := pending.count():
        cuts = settle(_cuts(_chunks(pending, chunk, overlap), shared, pattern, chunk, overlap), "cuts")
        ahead = Window.partitionBy("row").orderBy("k")
        pairs = cuts.select(
            "row", "last", "n", "tail_at", "tail_n",
            F.lead("head_at").over(ahead).alias("next_at"),
            F.lead("head_n").over(ahead).alias("next_n"),
        )
        at = F.get(F.array_intersect("tail_at", "next_at"), 0)

        def count(where: str, counts: str):
            return F.get(F.col(counts), (F.array_position(where, at) - 1).cast("int"))

        # what a chunk has before the boundary, less what the next one has before it
        share = F.when(F.col("last"), F.col("n")).otherwise(count("tail_at", "tail_n") - count("next_at", "next_n"))
        totals = pairs.select("row", share.alias("share")).groupBy("row").agg(
            F.sum("share").alias("n_tokens"), F.bool_or(F.col("share").isNull()).alias("open")
        )
        totals = settle(totals, "totals")
        now = totals.where(~F.col("open")).select("row", "n_tokens")
        done = now if done is None else done.unionByName(now)
        left = totals.where("open").select("row")
        pending = pending.join(left, "row", "left_semi")
        if left.isEmpty():
            break
        chunk, overlap = chunk * 2, overlap * WIDER
        del n
    return done


def _chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Chunk k begins at k * chunk and goes on for ``overlap`` characters beyond the next one's start."""

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for row, text in zip(b.column(0), b.column(1)):
                text = text.as_py()
                starts = range(0, max(1, len(text) - overlap), chunk)
                for i in range(0, len(starts), 64):
                    some = starts[i : i + 64]
                    n = len(some)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row.as_py()] * n, pa.int64()),
                            pa.array(range(i, i + n), pa.int32()),
                            pa.array([i + x + 1 == len(starts) for x in range(n)]),
                            pa.array(some, pa.int64()),
                            pa.array([text[s:] if i + x + 1 == len(starts) else text[s : s + chunk + overlap] for x, s in enumerate(some)], pa.string()),
                        ],
                        names=["row", "k", "last", "start", "text"],
                    )

    chunks = settle(long.mapInArrow(cut, _CHUNKS), "chunks")
    return chunks.repartition(max(1, -(-chunks.count() // 64)))


def _cuts(chunks: DataFrame, shared, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Tokens of each chunk, and its boundaries in both overlaps with the tokens before them."""

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value, pattern)
        for b in it:
            rows = []
            for row, k, last, start, text in zip(*(b.column(i).to_pylist() for i in range(5))):
                pieces = counter.pieces(text)
                ends = np.cumsum([0, *map(len, pieces)])
                before = np.cumsum([0, *counter.counts(pieces)])
                head = ends < (overlap if k else 0)
                sure = len(text) - counter.longest - 2
                tail = (ends >= chunk) & (ends <= sure) if not last else np.zeros(len(ends), bool)
                rows.append(
                    (row, k, last, int(before[-1]), (start + ends[head]).tolist(), before[head].tolist(), (start + ends[tail]).tolist(), before[tail].tolist())
                )
            longs = pa.list_(pa.int64())
            kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), longs, longs, longs, longs]
            names = [c.split()[0] for c in _CUTS.split(", ")]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return chunks.mapInArrow(batch, _CUTS)
