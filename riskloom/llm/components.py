"""Connected components of a graph given by its links, as rounds of Spark joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import settle

#: Links that one task ties together by itself.
LINKS = 500_000


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of the nodes 0 to n - 1 the lowest that the links reach."""
    root, before = np.arange(n), None
    while before is None or (root != before).any():
        before = root.copy()
        low = np.minimum(root[a], root[b])
        for x in (before[a], before[b], a, b):
            np.minimum.at(root, x, low)
        while (root != (root := root[root])).any():
            pass
    return root


def _stars(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links as links of each node to the lowest that they reach."""
    if not (batches := list(it)):
        return
    links = pa.Table.from_batches(batches)
    ends = pa.chunked_array(links["a"].chunks + links["b"].chunks).combine_chunks().dictionary_encode()
    order = pc.array_sort_indices(ends.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    a, b = np.split(rank[ends.indices.to_numpy()], 2)
    root, nodes = roots(a, b, rank.size), ends.dictionary.take(order)
    tied = np.flatnonzero(root != np.arange(rank.size))
    pair = [nodes.take(pa.array(tied)), nodes.take(pa.array(root[tied]))]
    yield pa.RecordBatch.from_arrays(pair, names=["a", "b"])


def _lowest(links: DataFrame) -> DataFrame:
    """Of each node, the lowest among itself and its neighbours.

    A minimum has a map-side part, so a node with very many links costs one row per task.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))


def _named(stars: DataFrame) -> DataFrame:
    """(node, component) from links of each node to the lowest of its group."""
    low = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(low)


def components(links: DataFrame) -> DataFrame:
    """(node, component): the lowest node reachable, for every node that has a link.

    ``links`` has two columns a, b of one orderable type (no struct); links to itself and nulls are
    ignored, repeated links count once. No links give no rows. Tasks first tie together LINKS links
    each; if that takes one task, all is done. Else two steps alternate until nothing changes:
    all higher neighbours of a node are tied to its lowest neighbour, then all lower ones. The
    number of rounds grows with the logarithm of the longest path. Links are joined to their
    nodes' minima, never gathered per node, and every round is written to the shared folder.
    """
    a, b = F.col("a"), F.col("b")
    now = settle(links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")), "links")
    tasks = -(-now.count() // LINKS)
    now = now.coalesce(1) if tasks < 2 else now.repartition(tasks)
    now = settle(now.mapInArrow(_stars, now.schema), "links")
    if tasks < 2:
        return _named(now)
    before = None
    while True:
        mark = now.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
        ).first()
        if mark == before or mark.n == 0:
            return _named(now)
        before = mark
        low = _lowest(now)
        # higher neighbours of a node follow its lowest neighbour (the links hold a > b)
        tied = now.select(F.col("b").alias("node"), F.col("a").alias("v")).join(
            low.select(F.col("a").alias("node"), "low"), "node"
        )
        large = tied.select(F.col("v").alias("a"), F.col("low").alias("b")).where(a != b).distinct()
        large = settle(large, "links")
        # then a node and all its lower neighbours follow the lowest of them
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least.withColumnRenamed("a", "x"), a == F.col("x"))
        now = settle(
            small.select(b.alias("a"), F.col("low").alias("b"))
            .unionByName(least.select("a", F.col("low").alias("b")))
            .where(a != b)
            .distinct(),
            "links",
        )
