"""Exact top-k by inner product, as a Voronoi kNN join.

One more component, sqrt(M^2 - |y|^2) for data and 0 for queries (M: the largest norm), makes the
largest inner products the smallest Euclidean distances. Rows belong to the cell of their nearest
pivot. From each cell's summary (radius, and the distances of the rows closest to the pivot) follows
an upper bound of the k-th smallest distance of any query of a group, and from that how near to its
own pivot a data row must be to matter to the group. Only such rows are sent to the group, and are
searched there. Groups are split by a hash into squares of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import pick, settle

PIVOTS = 16
#: Rows of data, and queries, that one task takes for a group.
DATA_SQUARE, QUERY_SQUARE = 20_000, 2_000
#: Doubles hold whole numbers exactly up to here.
EXACT = 2.0**53
LONG = (1 << 63) - 1


def vectors(rows: DataFrame, vec_id: str, embedding: str, scale: float) -> DataFrame:
    """(vec_id, v array<double>): floor(scale * x) of each component.

    Null vectors, and those that hold a null or non-finite component, are left out.
    """
    own = pick(rows, vec_id=vec_id, v=embedding).withColumn("v", F.col("v").cast("array<double>"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    # a component past the range of a long is a whole number as it is
    whole = F.transform(
        "v", lambda x: F.when(F.abs(x * scale) < EXACT, F.floor(x * scale).cast("double")).otherwise(x * scale)
    )
    return own.where(F.col("v").isNotNull() & ~bad).select("vec_id", whole.alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, the shorter ones filled up with zeros."""
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(flat.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, at] = flat
    return out


def _products(q: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; beyond the range of a long they stay at its ends."""
    if q.shape[1] * (np.abs(q).max(initial=0) * np.abs(y).max(initial=0)) < EXACT:
        return (q @ y.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    product = exact(q) @ exact(y).T if q.shape[1] else np.zeros((len(q), len(y)), object)
    return np.clip(product, -LONG - 1, LONG).astype(np.int64)


class Cells:
    """Pivots, with the extra component, and what the cells' summaries say about them."""

    def __init__(self, pivots: np.ndarray, largest: float):
        self.pivots, self.largest = pivots, largest

    def lifted(self, v: np.ndarray, query: bool) -> np.ndarray:
        rest = np.zeros(len(v)) if query else np.sqrt(np.maximum(self.largest - (v * v).sum(axis=1), 0.0))
        return np.c_[v, rest]

    def nearest(self, lifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and distance to its pivot."""
        square = (
            (lifted * lifted).sum(axis=1)[:, None] - 2 * lifted @ self.pivots.T + (self.pivots**2).sum(axis=1)[None, :]
        )
        cell = square.argmin(axis=1)
        gap = lifted - self.pivots[cell]
        return cell, np.sqrt((gap * gap).sum(axis=1))

    def reach(self, k: int, radius: dict[int, float], closest: dict[int, list[tuple]]) -> dict[int, np.ndarray]:
        """For each group of queries: per data cell, the distance from the pivot beyond which rows may matter.

        A row at distance d from pivot j is at least |p_i p_j| - U_i - d away from any query of
        group i (U_i: its radius), and at least d - |p_i p_j| - U_i. It is of no use if either
        exceeds the bound of the k-th distance. Given as the least and greatest useful d.
        ``closest`` has distances and ids of rows near to each pivot; as a query may have any one id,
        k + 1 different ids are within the bound.
        """
        gaps = np.sqrt(((self.pivots[:, None] - self.pivots[None]) ** 2).sum(axis=2))
        out = {}
        for i, u in radius.items():
            nearest: dict = {}
            for j, some in closest.items():
                for d, name in some:
                    nearest[name] = min(nearest.get(name, np.inf), u + gaps[i, j] + d)
            ends = sorted(nearest.values())
            bound = ends[k] if len(ends) > k else np.inf
            slack = 1e-6 * (1 + np.where(np.isfinite(bound), bound, 0) + gaps[i].max() + u)
            out[i] = np.c_[gaps[i] - u - bound - slack, gaps[i] + u + bound + slack]
        return out


def top_k(
    rows: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: float = 256.0,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows with the largest inner product.

    Components count as floor(scale * x). Ties go to the smaller vec_id. A row with the query's own
    id is no candidate of it. Null vectors, and those with null or non-finite components, take no
    part, nor do rows with a null id. Shorter vectors count as filled up with zeros. A repeated
    query id gives one list for each distinct vector under it; equal rows give one. With fewer
    candidates all are returned; an empty table gives no rows. ``is_query`` is a condition on the
    column vec_id. Scores beyond a long stay at its ends.
    """
    spark = rows.sparkSession
    data = settle(vectors(rows, vec_id, embedding, scale).where(F.col("vec_id").isNotNull()), "vectors")
    kind = data.schema["vec_id"].dataType.simpleString()
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    queries = data.where(is_query).distinct()
    facts = data.agg(
        F.max(norm).alias("largest"),
        F.max(F.size("v")).alias("width"),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))).alias("most"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    out = f"query_id {kind}, rank int, vec_id {kind}, score long"
    if not facts.n:
        return spark.createDataFrame([], out)
    width = facts.width
    # whole numbers travel in the smallest type that holds them
    number = "smallint" if facts.most < 1 << 15 else "int" if facts.most < 1 << 31 else "double"
    sent_type = pa.list_({"smallint": pa.int16(), "int": pa.int32(), "double": pa.float64()}[number])
    chosen = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).select("v").collect()
    if not chosen:
        return spark.createDataFrame([], out)
    points = np.zeros((len(chosen), width))
    for i, (v,) in enumerate(chosen):
        points[i, : len(v)] = v
    cells = Cells(np.unique(np.c_[points, np.zeros(len(points))], axis=0), facts.largest)

    def assigned(df: DataFrame, query: bool) -> DataFrame:
        def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in it:
                cell, gap = cells.nearest(cells.lifted(_matrix(b.column(1), width), query))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1).cast(sent_type), pa.array(cell.astype(np.int32)), pa.array(gap)],
                    names=["vec_id", "v", "cell", "gap"],
                )

        return settle(df.mapInArrow(batch, f"vec_id {kind}, v array<{number}>, cell int, gap double"), "cells")

    groups, placed = assigned(queries, True), assigned(data, False)
    # summaries: as many rows as there are pivots, times k + 1; of each id the closest row to a pivot
    radius = {r.cell: r.u for r in groups.groupBy("cell").agg(F.max("gap").alias("u")).collect()}
    most = max(k, 0)
    ids = placed.groupBy("cell", "vec_id").agg(F.min("gap").alias("gap"))
    nth = F.row_number().over(Window.partitionBy("cell").orderBy("gap"))
    few = ids.select("cell", "vec_id", "gap", nth.alias("nth")).where(F.col("nth") <= most + 1)
    closest: dict[int, list[tuple]] = {}
    for r in few.select("cell", "gap", "vec_id").collect():
        closest.setdefault(r.cell, []).append((r.gap, r.vec_id))
    reach = cells.reach(most, radius, closest)
    low = {i: x[:, 0] for i, x in reach.items()}
    high = {i: x[:, 1] for i, x in reach.items()}

    def useful(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            cell, gap = b.column(2).to_numpy(), b.column(3).to_numpy()
            for i in low:
                at = np.flatnonzero((gap >= low[i][cell]) & (gap <= high[i][cell]))
                if at.size:
                    take = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(at.size, i, np.int32)), b.column(0).take(take), b.column(1).take(take)],
                        names=["cell", "vec_id", "v"],
                    )

    sent = placed.mapInArrow(useful, f"cell int, vec_id {kind}, v array<{number}>")
    sizes = groups.groupBy("cell").agg(F.count(F.lit(1)).alias("q"))
    split = sizes.select(
        "cell",
        F.ceil(F.col("q") / QUERY_SQUARE).cast("int").alias("rows"),
        F.lit(-(-facts.n // DATA_SQUARE)).cast("int").alias("columns"),
    )

    def part(n: str, salt: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.col(n)).cast("int")

    def all_of(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    asked = groups.join(split, "cell").select("cell", part("rows", "q").alias("row"), all_of("columns").alias("column"), "vec_id", "v")
    offered = sent.join(split, "cell").select("cell", all_of("rows").alias("row"), part("columns", "d").alias("column"), "vec_id", "v")
    key = ["cell", "row", "column"]

    def solve(q: pa.Table, y: pa.Table) -> pa.Table:
        names = ["query_id", "seat", "vec_id", "score"]
        types = [q.schema.field("vec_id").type, pa.binary(), q.schema.field("vec_id").type, pa.int64()]
        piles: list[list] = [[], [], [], []]
        if q.num_rows and y.num_rows:
            yv, yid = _matrix(y["v"].combine_chunks(), width), y["vec_id"].combine_chunks()
            ids = yid.to_numpy(zero_copy_only=False)
            order = np.argsort(ids, kind="stable")
            yv, ids = yv[order], ids[order]
            qv, qid = _matrix(q["v"].combine_chunks(), width), q["vec_id"].combine_chunks().to_numpy(zero_copy_only=False)
            step = max(1, (1 << 22) // len(ids))
            for i in range(0, len(qid), step):
                scores = _products(qv[i : i + step], yv)
                for r in range(len(scores)):
                    others = np.flatnonzero(ids != qid[i + r])
                    s = scores[r][others]
                    if s.size > k:
                        edge = np.partition(s, s.size - k)[s.size - k]
                        at = np.r_[np.flatnonzero(s > edge), np.flatnonzero(s == edge)][: max(k, 0)]
                    else:
                        at = np.arange(s.size)
                    piles[0] += [qid[i + r]] * at.size
                    piles[1] += [qv[i + r].tobytes()] * at.size
                    piles[2] += ids[others[at]].tolist()
                    piles[3] += s[at].tolist()
        return pa.table([pa.array(p, t) for p, t in zip(piles, types)], names=names)

    local = (
        asked.groupBy(*key)
        .cogroup(offered.groupBy(*key))
        .applyInArrow(solve, f"query_id {kind}, seat binary, vec_id {kind}, score long")
    )
    best = Window.partitionBy("query_id", "seat").orderBy(F.desc("score"), "vec_id")
    # a vector is offered to a group once, so the lists of all squares are disjoint
    ranked = local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
