"""How filters interact: sorted posting lists of failing documents, merged range by range.

Every part of the documents is cut into ranges of ids. Within a range each filter has the sorted
list of the places that fail it; the list of a set of filters is the union of the lists, and what a
filter removes after others is a difference of lists. Both look up the shorter list's places in the
longer one, leaping over what lies between, instead of reading both to the end. Sizes are summed
over ranges, so no list of a part is ever in one place, and all orders of the filters come from the
sums for each filter and each set of earlier ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskloom.llm.common import pick, settle, small_batches, stretches

#: Rows of a range, at most.
RANGE_ROWS = 1 << 16
#: Filters that can be audited together, as all their orders are listed.
MOST_FILTERS = 6

FILTERS = "ABCDE"

_SPACE = re.compile(rb"[\x09-\x0D\x20]")
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUED = bytes(range(0x80, 0xC0))
_MARKS = re.compile(rb"[#$%&*|]")


def _failing(text: bytes) -> tuple[bool, bool, bool, bool]:
    """Whether a text fails A (short), B (repetitive), C (shouting) and D (marks)."""
    n, seen = 0, set()
    for some in stretches(text, _SPACE):
        words = some.split()
        n += len(words)
        seen.update(words)
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _CONTINUED))
    return n < 50, 100 * len(seen) < 65 * n, 100 * upper > 5 * points, _MARKS.search(text) is not None


def document_fails(docs: DataFrame, part: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, part, A, B, C, D, E, copies): what each document fails; equal rows are one row.

    A to D are of the text alone: under 50 words; under 65 % of the words distinct; over 5 % of the
    characters A-Z; one of ``#$%&*|``. E fails if a row with a smaller id has the same text, by its
    SHA-256; a null id is no smaller one and fails never. Null texts are empty, a null part is the
    empty string. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    own = pick(docs, doc_id=doc_id, part=part, text=text).select(
        "doc_id",
        F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )
    kind = own.schema["doc_id"].dataType.simpleString()

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts = [x.as_py() for x in b.column(2)]
            found = [pa.array(x, pa.bool_()) for x in zip(*map(_failing, texts))] if texts else [pa.array([], pa.bool_())] * 4
            marks = pa.array([sha256(x).digest() for x in texts], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), marks, *found], names=["doc_id", "part", "mark", *FILTERS[:4]]
            )

    schema = f"doc_id {kind}, part string, mark binary, A boolean, B boolean, C boolean, D boolean"
    rows = settle(own.mapInArrow(batch, schema), "fails")
    rows = rows.groupBy(rows.columns).agg(F.count("*").alias("copies"))
    # joined on the id too, so that a text of very many documents is no hot key
    first = rows.where(F.col("doc_id").isNotNull()).groupBy("mark").agg(F.min("doc_id").alias("doc_id"))
    kept = rows.join(first.withColumn("_first", F.lit(True)), ["mark", "doc_id"], "left")
    repeats = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    return kept.select("doc_id", "part", *FILTERS[:4], repeats.alias("E"), "copies")


def audit(rows: DataFrame, filters: list[str], losses: list[str], part: str = "part", doc_id: str = "doc_id", copies: str | None = None) -> DataFrame:
    """One row per part, order of all ``filters`` and step of it, with what the step's filter does.

    ``filters`` name boolean columns that are true where a row fails; ``losses`` name boolean
    columns whose rows are counted where they are removed. A null counts as false. ``copies`` names
    the number of times that a row counts, else once.

    (part, filter_order, step, kept, removed, redundant, unique_fails, <loss>_lost..., shapley).
    ``kept`` are left after the step, ``removed`` go in it, ``redundant`` fail its filter but went
    before; ``unique_fails`` fail no other filter; ``shapley`` sums ``removed`` over all orders.
    Rows with equal or null ids count one by one. A null part is a part of its own.
    An empty table gives no rows.
    """
    if not 1 <= len(filters) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters")
    spark, n = rows.sparkSession, len(filters)
    flags = [*filters, *losses]
    own = rows.select(
        rows[part].alias("part"),
        rows[doc_id].alias("doc_id"),
        (rows[copies] if copies else F.lit(1)).cast("long").alias("copies"),
        *[F.coalesce(rows[c], F.lit(False)).alias(f"f{i}") for i, c in enumerate(flags)],
    )
    names = [f"f{i}" for i in range(len(flags))]
    # equal rows become one, so that no id or null fills a range; dealing by range reads its input twice
    own = own.groupBy("part", "doc_id", *names).agg(F.sum("copies").alias("copies"))
    own = settle(own, "audit")
    dealt = own.repartitionByRange("part", "doc_id", *names)
    dealt = dealt.sortWithinPartitions("part", "doc_id").select("part", "copies", *names)
    numbers = ["all", "together", "removed", "redundant", *[f"lost{i}" for i in range(len(losses))]]
    schema = T.StructType(
        [
            dealt.schema["part"],
            T.StructField("filter", T.IntegerType()),
            T.StructField("earlier", T.IntegerType()),
            *[T.StructField(c, T.LongType()) for c in numbers],
        ]
    )

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, block in _ranges(it):
            weight = block[0].astype(np.int64)
            sums = list(_sums(weight, block[1 : n + 1], [weight * x for x in block[n + 1 :]]))
            columns = [pa.array([key] * len(sums), kind), *(pa.array(c) for c in np.array(sums, np.int64).T)]
            columns[1:3] = [c.cast(pa.int32()) for c in columns[1:3]]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    kind = pa.string() if isinstance(schema["part"].dataType, T.StringType) else None
    parts = dealt.mapInArrow(batch, schema).groupBy("part", "filter", "earlier").agg(*[F.sum(c).alias(c) for c in numbers])

    orders = []
    for order in permutations(range(n)):
        for step, f in enumerate(order):
            earlier = sum(1 << i for i in order[:step])
            orders.append(("".join(filters[i] for i in order), step + 1, f, earlier, step == n - 1))
    orders = spark.createDataFrame(orders, "filter_order string, step int, filter int, earlier int, last boolean")
    same = Window.partitionBy("part", "filter")
    return parts.join(F.broadcast(orders), ["filter", "earlier"]).select(  # n! * n rows
        "part",
        "filter_order",
        "step",
        (F.col("all") - F.col("together")).alias("kept"),
        "removed",
        "redundant",
        F.max(F.when(F.col("last"), F.col("removed"))).over(same).alias("unique_fails"),
        *[F.col(f"lost{i}").alias(f"{c}_lost") for i, c in enumerate(losses)],
        F.sum("removed").over(same).alias("shapley"),
    )


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[np.ndarray]]]:
    """Stretches of rows of one part, at most RANGE_ROWS long; the rows come sorted by part."""
    key, held, size = None, [], 0

    def block() -> list[np.ndarray]:
        return [np.concatenate(c) for c in zip(*held)]

    for b in batches:
        names = b.column(0).to_pylist()
        columns = [c.to_numpy(zero_copy_only=False) for c in b.columns[1:]]
        cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
        for start, end in zip(cuts, cuts[1:]):
            while start < end:
                if size and (names[start] != key or size == RANGE_ROWS):
                    yield key, block()
                    held, size = [], 0
                key, until = names[start], min(end, start + RANGE_ROWS - size)
                held.append([c[start:until] for c in columns])
                size += until - start
                start = until
    if size:
        yield key, block()


def _places(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each place of ``short`` stands or would stand in ``long``, and whether it is there."""
    at = np.searchsorted(long, short)
    there = np.zeros(len(short), bool)
    inside = at < len(long)
    there[inside] = long[at[inside]] == short[inside]
    return at, there


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two sorted lists as one, by leaps through the longer."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    at, there = _places(short, long)
    return np.insert(long, at[~there], short[~there])


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The places of ``a`` that are not in ``b``; both sorted."""
    if len(a) <= len(b):
        return a[~_places(a, b)[1]]
    at, there = _places(b, a)
    return np.delete(a, at[there])


def _sums(weight: np.ndarray, failing: list[np.ndarray], lost: list[np.ndarray]) -> Iterator[tuple[int, ...]]:
    """(filter, earlier set, all, failing any of both, removed, redundant, lost...) of one range."""
    lists = [np.flatnonzero(x) for x in failing]
    whole = int(weight.sum())
    joined = [np.empty(0, np.int64)]
    for chosen in range(1, 1 << len(lists)):
        last = chosen.bit_length() - 1
        joined.append(union(joined[chosen ^ (1 << last)], lists[last]))
    sizes = [int(weight[x].sum()) for x in joined]
    for f, own in enumerate(lists):
        for earlier in range(1 << len(lists)):
            if earlier >> f & 1:
                continue
            gone = difference(own, joined[earlier])
            removed = int(weight[gone].sum())
            yield (
                f,
                earlier,
                whole,
                sizes[earlier | 1 << f],
                removed,
                sizes[1 << f] - removed,
                *(int(x[gone].sum()) for x in lost),
            )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five document filters per source, with lost good and lost toxic documents.

    A document is good, or toxic, if any of its labels says 1; without labels it is neither.
    Nulls, empty texts, repeated rows and empty tables are as in ``document_fails`` and ``audit``.
    """
    marked = (
        pick(labels, doc_id="doc_id", quality="quality", toxic="toxic")
        .groupBy("doc_id")
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    rows = document_fails(docs).join(marked, "doc_id", "left")
    return audit(rows, list(FILTERS), ["good", "toxic"], copies="copies")
