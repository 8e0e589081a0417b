"""Quantiles of many columns at once, exact at any size.

One global ``percentile`` would gather every distinct value of a column in one
task. Here a mergeable sketch only *proposes* where a quantile lies; exact
counts then decide, and only rows near a quantile are ever shuffled:

1. sketch each column, giving cut points close around every wanted rank,
2. count the rows between the cut points (a tiny result) and keep the stretches,
   or brackets, that hold a wanted rank,
3. repeat inside a bracket while it holds more than ``limit`` rows,
4. count distinct values inside the brackets and read the ranks off.

A wrong sketch costs a further round, never a wrong answer.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.trees import number, quoted

SKETCH_K = 4096
SKETCH_SLACK = 0.002
SALT = 64
GRID = 512
#: Rows of a bracket that may be ranked in one task.
RANK_ROWS = 1_000_000
_LARGEST = sys.float_info.max


@dataclass
class _Bracket:
    """Rows with ``lo <= value <= hi``; ``below`` rows of the column come before."""

    lo: float
    hi: float
    below: int
    rows: int
    ranks: set[int] = field(default_factory=set)


def finite(value: str) -> str:
    """SQL for a double with the infinities moved to the ends of the range, where they can be ranked."""
    within = f"greatest(least({value}, {number(_LARGEST)}), {number(-_LARGEST)})"
    # both skip NULL, and NaN is above all numbers to them
    return f"CASE WHEN {value} IS NULL OR isnan({value}) THEN NULL ELSE {within} END"


def interpolated(low: float, high: float, share: float) -> float:
    """Between two ranked values; the ends of the range stand for the infinities."""
    low, high = (math.copysign(math.inf, v) if abs(v) == _LARGEST else v for v in (low, high))
    if low == high or share == 0:
        return low
    if math.isinf(low) and math.isinf(high):
        return low if share < 0.5 else high
    return low + (high - low) * share


def long_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value) rows, missing values left out and infinities at the ends of the range."""
    doubles = df.select(
        *[F.expr(finite(f"CAST({quoted(c)} AS DOUBLE)")).alias(c) for c in columns]
    )
    present = F.col("value").isNotNull() & ~F.isnan("value")
    return doubles.unpivot([], columns, "feature", "value").where(present)


def quantile_sketches(df: DataFrame, columns: list[str], k: int = SKETCH_K) -> DataFrame:
    """(feature, sketch, n, lo, hi): one quantile sketch per column, from one scan.

    Every task folds its rows into one sketch per column, all columns in one row; merging the
    tasks' sketches is salted. Missing values and NaN are left out, infinities stand at the ends
    of the range. A column without values has n 0 and an empty sketch.
    """
    doubles = df.select(
        (F.spark_partition_id() % SALT).alias("_salt"),
        *[F.expr(finite(f"CAST({quoted(c)} AS DOUBLE)")).alias(f"c{i}") for i, c in enumerate(columns)],
    )
    stats = []
    for i in range(len(columns)):
        c = F.col(f"c{i}")
        sketch = F.kll_sketch_agg_double(c, F.lit(k)).alias("sketch")
        stats.append((sketch, F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi")))
    wide = doubles.groupBy("_salt").agg(*[s.alias(f"s{i}_{j}") for i, four in enumerate(stats) for j, s in enumerate(four)])
    each = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), *[F.col(f"s{i}_{j}").alias(name) for j, name in enumerate(("sketch", "n", "lo", "hi"))])
            for i, c in enumerate(columns)
        ]
    )
    return merged_sketches(wide.select(F.inline(each)), k)


def merged_sketches(sketches: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One row per feature of what ``quantile_sketches`` gave for several loads or tasks."""
    return sketches.groupBy("feature").agg(
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
        F.sum("n").alias("n"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )


def _sketched(long: DataFrame, keys: list[str], k: int) -> DataFrame:
    """One sketch per key, with exact count and range.

    Each map task already folds its rows into one sketch per key. The salt
    spreads merging those over several reducers, so that a single reducer
    never merges one sketch from every map task.
    """
    partial = (
        long.withColumn("salt", F.spark_partition_id() % SALT)
        .groupBy(*keys, "salt")
        .agg(
            F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"),
            F.count("value").alias("n"),
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
        )
    )
    return partial.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
        F.sum("n").alias("n"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )


def _grid() -> Column:
    """0 to 1 in even steps; one text literal instead of hundreds of JVM calls."""
    return F.expr("array(" + ", ".join(f"{i / GRID!r}D" for i in range(GRID + 1)) + ")")


def sketch_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], k: int = SKETCH_K
) -> dict[str, list[float]]:
    """Approximate quantiles from one scan."""
    found = sketched_quantiles(quantile_sketches(df, columns, k), probabilities)
    return {c: found.get(c, []) for c in columns}


def sketched_quantiles(sketches: DataFrame, probabilities: list[float]) -> dict[str, list[float]]:
    """Approximate quantiles by feature; no values, no quantiles. As small as the list of features."""
    probs = F.array(*[F.lit(float(p)) for p in probabilities])
    q = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", probs)).alias("q")
    found = {r["feature"]: r["q"] or [] for r in sketches.select("feature", q).collect()}
    return {c: [interpolated(x, x, 0) for x in values] for c, values in found.items()}


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    limit: int = RANK_ROWS,
    k: int = SKETCH_K,
    slack: float = SKETCH_SLACK,
    sketches: DataFrame | None = None,
) -> dict[str, list[float]]:
    """Continuous quantiles with linear interpolation between the two ranks around each.

    A column without values maps to an empty list. ``df`` must be the same on
    every read; it is read three times, and twice more for every further round
    of narrowing. ``limit`` is how many rows of a bracket may be ranked in one
    task: a million takes one round up to about a hundred million rows, and two up to
    ten billion. Infinite values are ranked as the outermost ones. ``sketches`` (feature, sketch, n) of just
    these rows, as ``sketches.quantile_sketches`` and ``merged_sketches`` give them, save the first reading;
    sketches that do not fit the rows are an error.
    """
    whole = {c: [_Bracket(-math.inf, math.inf, 0, 0)] for c in columns}
    grids, sizes = _propose(df, whole, k) if sketches is None else _proposed(sketches, columns)
    ranks = {c: _ranks(n, probabilities) for c, n in sizes.items()}
    for c, n in sizes.items():
        whole[c][0].rows, whole[c][0].ranks = n, ranks[c]
    brackets = {c: whole[c] for c in sizes}
    if not brackets:
        return {c: [] for c in columns}

    while True:
        edges = {c: _edges(bs, grids[c], limit, slack) for c, bs in brackets.items()}
        brackets = _recount(df, edges, ranks, sizes)
        if not any(b.rows > limit and b.lo < b.hi for bs in brackets.values() for b in bs):
            break
        grids, _ = _propose(df, brackets, k)
    at_rank = _read_ranks(df, brackets)

    out: dict[str, list[float]] = {c: [] for c in columns}
    for c, n in sizes.items():
        for p in probabilities:
            position = p * (n - 1)
            low, high = at_rank[c, math.floor(position)], at_rank[c, math.ceil(position)]
            out[c].append(interpolated(low, high, position - math.floor(position)))
    return out


def _ranks(n: int, probabilities: list[float]) -> set[int]:
    return {r for p in probabilities for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}


def _after(value: float) -> float:
    """The next double: ``[v, after(v))`` holds the value ``v`` and nothing else."""
    return math.nextafter(value, math.inf)


def _segments(
    df: DataFrame, edges: dict[str, list[float]], numbers: dict[str, list[int | None]] | None = None
) -> DataFrame:
    """(feature, segment, value), the segment being the number of edges at or below,
    or what ``numbers`` says for it; rows without a segment are left out."""
    # found by binary search; a tree would repeat the value's expression at each of dozens of edges
    values = [f"_v{i}" for i in range(len(edges))]
    doubles = df.select(
        # adding zero makes one of both zeros, which the search would tell apart
        *[(F.expr(finite(f"CAST({quoted(c)} AS DOUBLE)")) + F.lit(0.0)).alias(v) for c, v in zip(edges, values)]
    )
    cuts = [[e + 0.0 for e in es if math.isfinite(e)] for es in edges.values()]
    cut = [i for i, es in enumerate(cuts) if es]
    found = doubles
    if cut:
        found = Bucketizer(
            inputCols=[f"_v{i}" for i in cut],
            outputCols=[f"_s{i}" for i in cut],
            splitsArray=[[-math.inf, *cuts[i], math.inf] for i in cut],
            handleInvalid="keep",
        ).transform(doubles)
    tagged = []
    for i, c in enumerate(edges):
        segment = F.col(f"_s{i}").cast("int") if cuts[i] else F.lit(0)
        if numbers is not None:
            leaves = ["CAST(NULL AS INT)" if n is None else number(n) for n in numbers[c]]
            segment = F.get(F.expr(f"array({', '.join(leaves)})"), segment)
        tagged.append(F.struct(segment.alias("segment"), F.col(values[i]).alias("value")).alias(c))
    present = F.col("value").isNotNull() & ~F.isnan("value") & F.col("segment").isNotNull()
    return (
        found.select(*tagged)
        .unpivot([], list(edges), "feature", "at")
        .select("feature", "at.segment", "at.value")
        .where(present)
    )


def _inside(df: DataFrame, brackets: dict[str, list[_Bracket]]) -> DataFrame:
    """(feature, bracket, value) for the rows within any bracket.

    Brackets of a column are apart or touching, so between their ends each
    stretch is one bracket or none.
    """
    edges: dict[str, list[float]] = {}
    numbers: dict[str, list[int | None]] = {}
    for c, bs in brackets.items():
        edges[c] = sorted({e for b in bs for e in (b.lo, _after(b.hi))})
        starts = {b.lo: i for i, b in enumerate(bs)}
        numbers[c] = [None, *[starts.get(e) for e in edges[c]]]
    return _segments(df, edges, numbers).withColumnRenamed("segment", "bracket")


def _propose(
    df: DataFrame, brackets: dict[str, list[_Bracket]], k: int
) -> tuple[dict[str, dict[int, list[float]]], dict[str, int]]:
    """A grid of approximate quantiles inside every bracket, and row counts by column."""
    if all(b.lo == -math.inf for bs in brackets.values() for b in bs):
        return _proposed(quantile_sketches(df, list(brackets), k), list(brackets))
    rows = _inside(df, brackets)
    grids: dict[str, dict[int, list[float]]] = {}
    sizes: dict[str, int] = {}
    for r in (
        _sketched(rows, ["feature", "bracket"], k)
        .select(
            "feature", "bracket", "n", F.kll_sketch_get_quantile_double("sketch", _grid()).alias("q")
        )
        .collect()
    ):
        grids.setdefault(r["feature"], {})[r["bracket"]] = r["q"]
        sizes[r["feature"]] = sizes.get(r["feature"], 0) + r["n"]
    return grids, sizes


def _proposed(
    sketches: DataFrame, columns: list[str]
) -> tuple[dict[str, dict[int, list[float]]], dict[str, int]]:
    """The same for whole columns, from sketches that were made before."""
    rows = sketches.where(F.col("feature").isin(columns) & (F.col("n") > 0)).select(
        "feature", "n", F.kll_sketch_get_quantile_double("sketch", _grid()).alias("q")
    )
    found = rows.collect()
    return {r["feature"]: {0: r["q"]} for r in found}, {r["feature"]: r["n"] for r in found}


def _edges(
    brackets: list[_Bracket], grids: dict[int, list[float]], limit: int, slack: float
) -> list[float]:
    """Cut points around every wanted rank. Each cut value also gets a segment of
    its own, so that a value filling many rows ends up alone."""
    out = set()
    for i, b in enumerate(brackets):
        out |= {b.lo, _after(b.hi)}
        if b.rows <= limit or b.lo == b.hi:
            continue
        for r in b.ranks:
            mark = (r - b.below) / max(b.rows - 1, 1)
            low = grids[i][max(0, math.floor((mark - slack) * GRID))]
            high = grids[i][min(GRID, math.ceil((mark + slack) * GRID))]
            out |= {low, _after(low), high, _after(high)}
    return sorted(e for e in out if math.isfinite(e))


def _recount(
    df: DataFrame, edges: dict[str, list[float]], ranks: dict[str, set[int]], sizes: dict[str, int]
) -> dict[str, list[_Bracket]]:
    """Exact counts between the cut points; the stretches holding a wanted rank stay."""
    counts = (
        _segments(df, edges)
        .groupBy("feature", "segment")
        .agg(F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .collect()
    )
    below = dict.fromkeys(edges, 0)
    out: dict[str, list[_Bracket]] = {c: [] for c in edges}
    for r in sorted(counts, key=lambda r: r["segment"]):
        c, before = r["feature"], below[r["feature"]]
        below[c] += r["n"]
        held = {x for x in ranks[c] if before <= x < below[c]}
        if held:
            out[c].append(_Bracket(r["lo"], r["hi"], before, r["n"], held))
    if odd := [c for c in edges if below[c] != sizes[c]]:
        raise ValueError(f"the sketches are of other rows: {odd}")
    return out


def _read_ranks(df: DataFrame, brackets: dict[str, list[_Bracket]]) -> dict[tuple[str, int], float]:
    """Values at the wanted ranks; every bracket is small or holds one value by now."""
    out = {(c, r): b.lo for c, bs in brackets.items() for b in bs if b.lo == b.hi for r in b.ranks}
    open_ones = {c: [b for b in bs if b.lo < b.hi] for c, bs in brackets.items()}
    open_ones = {c: bs for c, bs in open_ones.items() if bs}
    if not open_ones:
        return out
    counts = (
        _inside(df, open_ones).groupBy("feature", "bracket", "value").agg(F.count("*").alias("n"))
    )
    # One row per wanted rank: as small as the lists of columns and probabilities.
    wanted = df.sparkSession.createDataFrame(
        [(c, i, r - b.below) for c, bs in open_ones.items() for i, b in enumerate(bs) for r in b.ranks],
        "feature string, bracket int, rank bigint",
    )
    running = Window.partitionBy("feature", "bracket").orderBy("value")
    found = (
        counts.withColumn("through", F.sum("n").over(running))
        .join(F.broadcast(wanted), ["feature", "bracket"])
        .where((F.col("rank") < F.col("through")) & (F.col("rank") >= F.col("through") - F.col("n")))
        .select("feature", "bracket", "rank", "value")
        .collect()
    )
    for r in found:
        b = open_ones[r["feature"]][r["bracket"]]
        out[r["feature"], b.below + r["rank"]] = r["value"]
    return out
