"""Compare fingerprints that share a key, and hand on links of a spanning forest.

A key with many rows is dealt out as a grid of tasks, so no task's share grows with a key, and
no task hands on more links than it has rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import settle
from riskloom.llm.components import roots
from riskloom.llm.simhash import apart

#: Which pairs of rows count.
Fits = Callable[[np.ndarray, np.ndarray], np.ndarray]

#: Rows of one kind that one square of the grid takes.
SQUARE = 20_000
#: Rows that are grouped for one call.
CALL = 50_000
#: Rows of a square whose links are all handed on, being no more than a few each.
FEW = 8
#: Pairs compared at a time.
STEP = 1 << 21


def dealt(
    rows: DataFrame, keys: list[str], salt: str, carry: list[str], call: int = CALL
) -> DataFrame:
    """The rows of each key that has a pair to compare, in squares of at most about SQUARE.

    ``rows`` has ``keys``, ``home`` (whether it is compared with all others of the key, or only
    with those at home), ``salt`` and ``carry``. Adds row, column and cell; rows of one square have
    the same cell. Everybody at home is in all columns of one row, everybody in all rows of one
    column. A cell has about ``call`` rows.
    """
    counts = rows.groupBy(*keys).agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("all"))
    met = settle(
        counts.where((F.col("homes") > 0) & (F.col("all") > 1)).select(
            *keys,
            "all",
            F.ceil(F.col("homes") / SQUARE).cast("int").alias("rows"),
            F.ceil(F.col("all") / SQUARE).cast("int").alias("columns"),
        ),
        "met",
    )
    total = met.agg(F.sum(F.col("all") * (F.col("rows") + F.col("columns")))).first()[0] or 0
    here = rows.join(met, keys)
    alone = (F.col("rows") == 1) & (F.col("columns") == 1)

    def part(n: str, name: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(name), salt), F.col(n)).cast("int")

    def all_of(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    at_home = here.where("home").select(
        *keys, "home", *carry, part("rows", "r").alias("row"), all_of("columns").alias("column")
    )
    # in a single square, whoever is at home is there already
    others = here.where(~(F.col("home") & alone)).select(
        *keys, F.lit(False).alias("home"), *carry, all_of("rows").alias("row"), part("columns", "c").alias("column")
    )
    cells = max(1, -(-total // call))
    cell = F.pmod(F.xxhash64(*keys, "row", "column"), F.lit(cells)).cast("long")
    return at_home.unionByName(others).withColumn("cell", cell)


def ordered(pdf: pd.DataFrame, keys: list[str]) -> tuple[pd.DataFrame, np.ndarray]:
    """The rows of a cell, square by square, and where each square begins and the last one ends."""
    by = [*keys, "row", "column"]
    pdf = pdf.sort_values(by, kind="stable", ignore_index=True)
    new = np.zeros(len(pdf), bool)
    for c in by:
        v = pdf[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return pdf, np.r_[0, np.flatnonzero(new), len(pdf)]


def squares(pdf: pd.DataFrame, keys: list[str]) -> list[pd.DataFrame]:
    """The squares of a cell."""
    pdf, cuts = ordered(pdf, keys)
    return [pdf.iloc[i:j] for i, j in zip(cuts, cuts[1:])]


def few(fp: np.ndarray, home: np.ndarray, cuts: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All links within squares of at most FEW rows, of all such squares at once."""
    size = np.diff(cuts)
    square = np.repeat(np.arange(size.size), size)
    small = np.repeat(size <= FEW, size)
    out = []
    for k in range(1, FEW):
        near = small[k:] & (square[k:] == square[:-k]) & (home[k:] | home[:-k])
        at = np.flatnonzero(near)
        gap = apart(fp[at], fp[at + k])
        at = at[(gap <= bits) & (gap > 0)]
        out.append((fp[at], fp[at + k]))
    return out


def forest(home: np.ndarray, here: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links (home, here) that span the same groups as all links of ``bits`` or fewer.

    Both hold distinct values. Each value keeps one link to each group at home that it joins.
    """
    root, out = np.arange(home.size), []
    step = max(1, STEP // home.size)
    for k in range(0, here.size, step):
        part = here[k : k + step]
        gap = apart(part[:, None], home[None, :])
        near = (gap <= bits) & (gap > 0)
        for v in np.flatnonzero(near.any(axis=1)):
            mates = np.flatnonzero(near[v])
            roots, first = np.unique(root[mates], return_index=True)
            out.append((home[mates[first]], np.full(first.size, part[v])))
            if roots.size > 1:
                root[np.isin(root, roots)] = roots[0]
    return out


def spanning_links(visits: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """(a, b) of fingerprints: what these links connect is what all links within ``bits`` connect.

    ``visits`` has ``keys``, ``home`` and ``fp``; only rows that share a key are compared, and at
    least one of the two is at home.
    """

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, cuts = ordered(pdf, keys)
        fp, home = pdf["fp"].to_numpy().view(np.uint64), pdf["home"].to_numpy()
        links = few(fp, home, cuts, bits)
        for i, j in zip(cuts, cuts[1:]):
            if j - i > FEW:
                at_home, here = np.unique(fp[i:j][home[i:j]]), np.unique(fp[i:j])
                if at_home.size and here.size > 1:
                    links += forest(at_home, here, bits)
        a = np.concatenate([x for x, _ in links]) if links else np.empty(0, np.uint64)
        b = np.concatenate([y for _, y in links]) if links else np.empty(0, np.uint64)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    cells = dealt(visits.select(*keys, "home", "fp"), keys, "fp", ["fp"])
    return cells.groupBy("cell").applyInPandas(meet, "a long, b long")


def _near(cuts: np.ndarray, fp: np.ndarray, home: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one square within ``bits``, one of them at home, each pair once."""
    size = np.diff(cuts)
    square, small = np.repeat(np.arange(size.size), size), np.repeat(size <= FEW, size)
    for k in range(1, FEW):
        at = np.flatnonzero(small[k:] & (square[k:] == square[:-k]) & (home[k:] | home[:-k]))
        at = at[apart(fp[at], fp[at + k]) <= bits]
        yield at, at + k
    for n in np.flatnonzero(size > FEW):
        here = np.arange(cuts[n], cuts[n + 1])
        seats = here[home[here]]
        for k in range(0, here.size if seats.size else 0, step := max(1, STEP // max(1, seats.size))):
            some = here[k : k + step]
            near = apart(fp[some, None], fp[None, seats]) <= bits
            near &= (some[:, None] > seats) | ~home[some, None]
            i, j = np.nonzero(near)
            yield some[i], seats[j]


def tied(cuts: np.ndarray, fp: np.ndarray, home: np.ndarray, bits: int, fits: Fits) -> np.ndarray:
    """For each row the lowest that it is tied to by pairs of one square within ``bits`` that ``fits`` lets count.

    ``cuts`` tells where each square begins and the last one ends; in one, fingerprints are distinct.
    Pairs are not kept: a square of near copies has many more of them than rows.
    """
    root, some, held = np.arange(fp.size), [], 0

    def tie() -> None:
        a, b = (root[np.concatenate(x)] for x in zip(*some))
        root[:] = roots(a, b, root.size)[root]
        some.clear()

    for i, j in _near(cuts, fp, home, bits):
        counts = fits(i, j)
        some.append((i[counts], j[counts]))
        held += some[-1][0].size
        if held > STEP:
            tie()
            held = 0
    if some:
        tie()
    return root
