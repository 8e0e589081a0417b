"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of the benchmark's items. A table tells for every block of
neighbouring words how far the search may move on; a block that ends no window moves it by
several words at once, without looking at the words between. A block that ends a window names the
windows to compare word by word. Windows of unlike length are searched apart, as the shortest one
bounds the shift.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import pick, settle, sha256_hex, small_batches

#: Words of a window.
WINDOW = 10
#: Windows in one search table; more of them are searched in several passes.
TABLE_WINDOWS = 500_000
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20

#: ASCII other than 0-9, A-Z and a-z as spaces, and A-Z as a-z.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, ASCII digits and any characters beyond ASCII; A-Z lower-cased."""
    return text.translate(_WORD_BYTES).split()


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, from pieces that end between two words."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and _WORD_BYTES[text[end]] != 32:
            end += 1
        yield words(text[at:end])
        at = end


class Search:
    """Shift and bucket tables for windows of one length."""

    def __init__(self, windows: dict[tuple[bytes, ...], tuple[int, ...]]):
        self.windows = windows
        self.length = len(next(iter(windows)))
        self.block = min(2, self.length)
        self.far = self.length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[bytes, ...]]] = {}
        for window in windows:
            for end in range(self.block, self.length + 1):
                block = window[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.far), self.length - end)
            self.buckets.setdefault(window[-self.block :], []).append(window)

    def occurrences(self, text: list[bytes]) -> Iterator[tuple[int, tuple[int, ...]]]:
        """(place of the first word, items) of every occurrence of a window."""
        length, far, shift, buckets = self.length, self.far, self.shift, self.buckets
        at, n = length, len(text)
        while at <= n:
            block = (text[at - 2], text[at - 1]) if self.block == 2 else (text[at - 1],)
            step = shift.get(block, far)
            if step:
                at += step
                continue
            here = text[at - length : at]
            for window in buckets[block]:
                if window[0] == here[0] and list(window) == here:
                    yield at - length, self.windows[window]
            at += 1


def item_windows(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(words array<binary>, items array<int>): each distinct window with the numbers of its items."""
    rows = pick(items, item=item_id, text=text).select("item", F.col("text").cast("binary").alias("text"))
    kind = rows.schema["item"].dataType.simpleString()

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            ids, found = [], []
            for i, t in enumerate(b.column(1)):
                w = words(t.as_py() or b"")
                for k in range(max(1, len(w) - WINDOW + 1) if w else 0):
                    ids.append(i)
                    found.append(w[k : k + WINDOW])
            if found:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(ids)), pa.array(found, pa.list_(pa.binary()))], names=["item", "words"]
                )

    pairs = rows.mapInArrow(batch, f"item {kind}, words array<binary>")
    return pairs.groupBy("words").agg(F.collect_set(F.col("item").cast("string")).alias("items"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items): one row per document.

    A window is WINDOW consecutive words of an item, or all words of an item that has fewer. A
    document word inside any occurrence of a window is hit. ``items`` lists, sorted as strings,
    the items with a window that occurs. Null and empty texts have no words, and null items no
    windows; an item without id still hits, but is listed nowhere. Repeated items and documents
    each count as they stand. No items leave all documents clean.

    The distinct windows go to all tasks in tables of at most TABLE_WINDOWS, and all documents
    pass each table in turn; with several tables the parts of a document are put together by a
    key made of its id and text.
    """
    tables = _tables(items, item_id, item_text)
    own = pick(docs, doc_id=doc_id, text=text).select("doc_id", F.col("text").cast("binary").alias("text"))
    if len(tables) == 1:
        return _hits(own, tables[0].collect(), merge=False)
    keyed = own.withColumn("key", F.xxhash64("text"))
    found = None
    for windows in tables:
        part = settle(_hits(keyed, windows.collect(), merge=True), "hits")
        found = part if found is None else found.unionByName(part)
    return _together(found, len(tables))


def decontaminate(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows of ``docs``, with all their columns, in whose text no window of ``items`` occurs.

    Texts, items and windows are those of ``contamination``; null and empty texts stay.
    """
    at = docs.columns.index(text)
    for windows in _tables(items, item_id, item_text):
        shared = _shared(docs, windows.collect())

        def keep(it: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            searches = [Search(x) for x in shared.value]
            for b in it:
                clean = [not _search((t.as_py() or "").encode(), searches)[1] for t in b.column(at)]
                yield b.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def _tables(items: DataFrame, item_id: str, text: str) -> list[DataFrame]:
    """The distinct windows, in tables of about TABLE_WINDOWS at most."""
    small_batches(items.sparkSession)
    windows = settle(item_windows(items, item_id, text), "windows")
    n = max(1, -(-windows.count() // TABLE_WINDOWS))
    if n == 1:
        return [windows]
    table = F.pmod(F.xxhash64("words"), F.lit(n))
    return [windows.where(table == k) for k in range(n)]


def _shared(docs: DataFrame, windows: list):
    """One table's windows by length, for all tasks."""
    by_length: dict[int, dict[tuple[bytes, ...], tuple[str, ...]]] = {}
    for w, ids in windows:
        w = tuple(bytes(x) for x in w)
        by_length.setdefault(len(w), {})[w] = tuple(ids)
    return docs.sparkSession.sparkContext.broadcast(list(by_length.values()))


_OUT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>"


def _hits(docs: DataFrame, windows: list, merge: bool) -> DataFrame:
    """What one table of windows finds; the words hit as spans if they are to be merged."""
    shared = _shared(docs, windows)
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, " + ("key long, n_words long, spans array<long>, items array<string>" if merge else _OUT)

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Search(x) for x in shared.value]
        for b in it:
            rows = [_search(t.as_py() or b"", searches) for t in b.column(1)]
            if merge:
                names = ["doc_id", "key", "n_words", "spans", "items"]
                columns = [
                    b.column(0),
                    b.column(2),
                    pa.array([n for n, _, _ in rows], pa.int64()),
                    pa.array([[x for s in spans for x in s] for _, spans, _ in rows], pa.list_(pa.int64())),
                    pa.array([sorted(i) for _, _, i in rows], pa.list_(pa.string())),
                ]
            else:
                names = ["doc_id", *(x.split()[0] for x in _OUT.split(", "))]
                hit = [sum(e - s for s, e in spans) for _, spans, _ in rows]
                listed = [sorted(i) for _, _, i in rows]
                columns = [
                    b.column(0),
                    pa.array([n for n, _, _ in rows], pa.int64()),
                    pa.array(hit, pa.int64()),
                    pa.array([len(i) for i in listed], pa.int64()),
                    pa.array([sha256_hex(",".join(i).encode()) for i in listed], pa.string()),
                    pa.array([h > 0 for h in hit], pa.bool_()),
                    pa.array(listed, pa.list_(pa.string())),
                ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(batch, out)


def _search(text: bytes, searches: list[Search]) -> tuple[int, list[list[int]], set[str]]:
    """Number of words, spans of words hit (disjoint, in order) and items found."""
    done, tail, items = 0, [], set()
    hits: list[tuple[int, int]] = []
    most = max((s.length for s in searches), default=1) - 1
    for part in word_pieces(text):
        here = tail + part  # the last words of the piece before, for what lies across
        begin = done - len(tail)
        for s in searches:
            # an occurrence within the tail was found with the piece before
            new = here[max(0, len(tail) - s.length + 1) :]
            offset = begin + max(0, len(tail) - s.length + 1)
            for at, ids in s.occurrences(new):
                hits.append((offset + at, offset + at + s.length))
                items.update(ids)
        done += len(part)
        tail = here[len(here) - most :] if most else []
    spans: list[list[int]] = []
    for a, e in sorted(hits):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([a, e])
    return done, spans, items


def _together(parts: DataFrame, tables: int) -> DataFrame:
    """The finds of all tables for each document, as one row for each time that it stands there."""
    pairs = F.transform(
        F.sequence(F.lit(0), F.floor(F.size("spans") / 2) - 1),
        lambda k: F.struct(F.get("spans", 2 * k).alias("a"), F.get("spans", 2 * k + 1).alias("e")),
    )
    rows = parts.select(
        "doc_id", "key", "n_words", F.when(F.size("spans") > 0, pairs).otherwise(F.array().cast("array<struct<a:long,e:long>>")).alias("spans"), "items"
    )
    grouped = rows.groupBy("doc_id", "key").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        (F.count(F.lit(1)) / tables).cast("int").alias("times"),
    )
    # running through the spans in order: the end so far and the words counted so far
    hit = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x["e"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(s["end"], x["a"]))).alias("n"),
        ),
    )["n"]
    return (
        grouped.withColumn("n_hit", hit)
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
            "items",
            F.explode(F.sequence(F.lit(1), "times")).alias("copy"),
        )
        .drop("copy")
    )

