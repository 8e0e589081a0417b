"""SimHash near-duplicates, found by an anchor-point covering of the fingerprints.

A fingerprint has two blocks of 31 bits and two bits more. Two fingerprints that differ in at
most 3 bits differ in at most 1 bit of one of the blocks. On a block, the words of the perfect
Hamming code of length 31 are the anchors: each of the 2^31 values has exactly one anchor within
distance 1 (the covering radius). So a fingerprint is at home at that anchor, visits every anchor
within 1 + 1 (one or sixteen of them), and meets all its partners: whoever differs from it in at
most 1 bit of the block visits its home. Fingerprints are compared at the anchors only.

Equal fingerprints are one row before that. An anchor hands on the links of a spanning forest of
those that met there, not all pairs. An anchor with many rows is dealt out as a grid of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh_name, pick, settle, small_batches
from riskloom.llm.components import components
from riskloom.llm.meeting import spanning_links
from riskloom.llm.simhash import FOLD, fingerprint, shingle_hashes

WIDTH = 3
BLOCK = 31
#: Differing bits that link; the covering is made for this number.
LINK_BITS = 3


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp long): one row per row of ``docs``; fp holds the 64 bits as a signed number.

    Words are runs without white space (space, \\t to \\r), A-Z lower-cased; shingles are three
    words, repeats included. Fewer words make one shingle; none, or a null text, gives zero.
    """
    small_batches(docs.sparkSession)
    rows = pick(docs, doc_id=doc_id, text=text).select("doc_id", F.col("text").cast("binary").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fps = np.fromiter(
                (
                    fingerprint(shingle_hashes(t.as_py().translate(FOLD).split(), WIDTH)) if t.is_valid else 0
                    for t in b.column(1)
                ),
                np.uint64,
                b.num_rows,
            )
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"]
            )

    return rows.mapInArrow(batch, f"doc_id {id_type}, fp long")


def _syndrome(block: np.ndarray) -> np.ndarray:
    """XOR of the places (1 to 31) of the bits set; zero for a word of the Hamming code."""
    out = np.zeros(block.shape, np.uint64)
    for place in range(1, BLOCK + 1):
        out ^= ((block >> np.uint64(place - 1)) & np.uint64(1)) * np.uint64(place)
    return out


def _flip(block: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The bit at a place turned; place zero is none."""
    turned = np.left_shift(np.uint64(1), np.maximum(place, np.uint64(1)) - np.uint64(1))
    return np.where(place == 0, block, block ^ turned)


def anchors(block: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The home of each value, and (rows, anchors) of all others within distance 2.

    A word of the code is its own home and has no other within 2. From any other value, with
    syndrome s, one flip at s leads home, and two flips lead to a code word where their places
    i and j have i xor j = s: fifteen pairs, given by the lower place.
    """
    s = _syndrome(block)
    more = []
    for i in range(1, BLOCK + 1):
        place = np.uint64(i)
        j = place ^ s
        rows = np.flatnonzero((s != 0) & (j > place))
        if rows.size:
            more.append((rows, _flip(_flip(block[rows], np.full(rows.size, place)), j[rows])))
    return _flip(block, s), more


def _visits(fps: DataFrame) -> DataFrame:
    """(half, anchor, home, fp): where each fingerprint is at home and whom it visits."""
    schema = pa.schema(
        [("half", pa.int32()), ("anchor", pa.int32()), ("home", pa.bool_()), ("fp", pa.int64())]
    )

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for half in (0, 1):
                block = (fp.view(np.uint64) >> np.uint64(half * BLOCK)) & np.uint64((1 << BLOCK) - 1)
                home, more = anchors(block)
                for rows, at, here in [(np.arange(fp.size), home, True), *((r, a, False) for r, a in more)]:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(rows.size, half, np.int32)),
                            pa.array(at.astype(np.int32)),
                            pa.array(np.full(rows.size, here)),
                            pa.array(fp[rows]),
                        ],
                        schema=schema,
                    )

    return fps.mapInArrow(batch, "half int, anchor int, home boolean, fp long")


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """(a, b): links that connect what all links of LINK_BITS or fewer differing bits connect.

    ``fps`` has one column fp with distinct values.
    """
    return spanning_links(settle(_visits(fps), "visits"), ["half", "anchor"], LINK_BITS)


def fingerprint_groups(prints: DataFrame) -> DataFrame:
    """(fp, component): each distinct fingerprint of ``prints`` and a label of its group."""
    distinct = settle(prints.select("fp").distinct(), "distinct")
    groups = components(fingerprint_links(distinct))
    return distinct.join(groups, distinct["fp"] == groups["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("component")
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs``.

    Fingerprints link at LINK_BITS or fewer differing bits; the component is the smallest doc_id
    that is reachable, the row's own included. Rows are linked, not ids: a repeated doc_id gives
    a row each. A null doc_id is kept and is never the smallest, unless it has no other company
    (then the component is null). Empty and null texts have fingerprint zero and link like any
    other. An empty table gives no rows.
    """
    prints = settle(fingerprints(docs, doc_id, text), "prints")
    groups = settle(fingerprint_groups(prints), "groups")
    # the lowest id of a fingerprint, then of a group: a large group is one row per fingerprint
    low = prints.groupBy("fp").agg(F.min("doc_id").alias("low")).join(groups, "fp")
    lowest = low.groupBy("component").agg(F.min("low").alias("component_id"))
    classes = groups.join(lowest, "component").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with all their columns, but of each group only the row with the lowest id.

    Of several rows with that id one stays; a null id only where the group has no other. Null and
    empty texts are one group. An empty table gives no rows. Columns of any name come along.
    """
    # written out, so that a number can tell rows apart
    row = fresh_name(docs, "_row")
    rows = settle(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    prints = settle(fingerprints(rows, row, text).withColumnRenamed("doc_id", "_row"), "prints")
    groups = fingerprint_groups(prints)
    first = F.struct(F.col("id").isNull().alias("none"), "id", F.col("_row").alias("row"))
    ids = pick(rows, _row=row, id=doc_id)
    per_print = prints.join(ids, "_row").groupBy("fp").agg(F.min(first).alias("first"))
    kept = per_print.join(groups, "fp").groupBy("component").agg(F.min("first").alias("first"))
    return rows.join(kept.select(F.col("first.row").alias(row)), row, "left_semi").select(docs.columns)
