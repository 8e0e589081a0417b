"""Supervised binning: prebins, counts by class, merging, and the fitted bin map.

The raw rows are only ever counted. Everything after ``bin_contingency`` works
on at most about twenty rows per feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.trees import choice_case, interval_case, number, quoted
from riskloom.operators.quantiles import exact_quantiles, sketch_quantiles

MAX_PREBINS = 20
MIN_BIN_SHARE = 0.05
MISSING_BIN = -1
OTHER_BIN = -2

BINS_SCHEMA = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("bin_id", T.IntegerType()),
        T.StructField("lo", T.DoubleType()),
        T.StructField("hi", T.DoubleType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("good", T.LongType()),
        T.StructField("bad", T.LongType()),
        T.StructField("woe", T.DoubleType()),
        T.StructField("iv", T.DoubleType()),
    ]
)


@dataclass
class Prebins:
    """Cut points per numeric feature, kept categories per categorical one, in feature order."""

    categories: dict[str, list[str]]
    edges: dict[str, list[float]]

    @property
    def features(self) -> list[str]:
        return [*self.categories, *self.edges]

    def bin_sql(self, feature: str) -> str:
        """SQL giving the prebin number of a value."""
        if feature in self.edges:
            edges = self.edges[feature]
            leaves = [number(i) for i in range(len(edges) + 1)]
            inner = interval_case(_as_double(feature), edges, leaves)
            return _guarded(feature, True, inner, MISSING_BIN)
        known = {c: number(i) for i, c in enumerate(self.categories[feature])}
        inner = choice_case(quoted(feature), known, number(OTHER_BIN))
        return _guarded(feature, False, inner, MISSING_BIN)

    def definitions(self, spark: SparkSession) -> DataFrame:
        """One row per possible prebin: (feature, ordinal, kind, bin_id, lo, hi, category)."""
        rows = []
        for ordinal, f in enumerate(self.features):
            if f in self.edges:
                ends = [-np.inf, *self.edges[f], np.inf]
                for i in range(len(ends) - 1):
                    rows.append((f, ordinal, "num", i, float(ends[i]), float(ends[i + 1]), None))
            else:
                for i, c in enumerate(self.categories[f]):
                    rows.append((f, ordinal, "cat", i, None, None, c))
                rows.append((f, ordinal, "other", OTHER_BIN, None, None, None))
            rows.append((f, ordinal, "missing", MISSING_BIN, None, None, None))
        return spark.createDataFrame(
            rows,
            "feature string, ordinal int, kind string, bin_id int, lo double, hi double, "
            "category string",
        )


def _as_double(feature: str) -> str:
    return f"CAST({quoted(feature)} AS DOUBLE)"


def _guarded(feature: str, numeric: bool, inner: str, missing: object) -> str:
    """NULL and NaN are looked at once, ahead of the tree."""
    absent = f"{quoted(feature)} IS NULL"
    if numeric:
        absent += f" OR isnan({_as_double(feature)})"
    return f"CASE WHEN {absent} THEN {number(missing)} ELSE {inner} END"


def prebin_numeric(
    df: DataFrame, columns: list[str], bins: int = MAX_PREBINS, method: str = "exact"
) -> dict[str, list[float]]:
    """Distinct quantile cut points of all columns together.

    ``exact`` reads the table three times and gives the same edges on every
    run; ``sketch`` reads it once and is off by a fraction of a percent in rank.
    """
    if not columns:
        return {}
    probabilities = [i / bins for i in range(1, bins)]
    if method == "sketch":
        found = sketch_quantiles(df, columns, probabilities)
    elif method == "exact":
        found = exact_quantiles(df, columns, probabilities)
    else:
        raise ValueError(f"unknown method {method!r}")
    return {c: sorted(set(found[c])) for c in columns}


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, category, n) over all categorical features in one pass."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        texts.unpivot([], columns, "feature", "category")
        .groupBy("feature", "category")
        .agg(F.count("*").alias("n"))
    )


def prebin_categorical(
    df: DataFrame, columns: list[str], min_share: float = MIN_BIN_SHARE
) -> DataFrame:
    """(feature, category, n, share, pooled): categories under the cutoff share one row.

    The pooled row has a NULL category and ``pooled`` set; missing values have
    a NULL category without it. At most ``1 / min_share + 2`` rows per feature.
    """
    # Every feature has the table's row count, which Parquet knows without a scan.
    total = F.lit(df.count())
    counts = category_counts(df, columns).withColumn(
        "rare", F.col("category").isNotNull() & (F.col("n") < min_share * total)
    )
    return (
        counts.groupBy(
            "feature",
            F.when(~F.col("rare"), F.col("category")).alias("category"),
            F.col("rare").alias("pooled"),
        )
        .agg(F.sum("n").alias("n"))
        .select("feature", "category", "n", F.try_divide("n", total).alias("share"), "pooled")
    )


def kept_categories(
    df: DataFrame, columns: list[str], min_share: float = MIN_BIN_SHARE
) -> dict[str, list[str]]:
    """Categories with a bin of their own, sorted by name."""
    if not columns:
        return {}
    rows = (
        prebin_categorical(df, columns, min_share)
        .where(F.col("category").isNotNull())
        .select("feature", "category")
        .collect()
    )
    kept: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        kept[r["feature"]].append(r["category"])
    return {c: sorted(v) for c, v in kept.items()}


def fit_prebins(
    df: DataFrame,
    cat: list[str],
    num: list[str],
    bins: int = MAX_PREBINS,
    min_share: float = MIN_BIN_SHARE,
    method: str = "exact",
) -> Prebins:
    return Prebins(kept_categories(df, cat, min_share), prebin_numeric(df, num, bins, method))


def binned(df: DataFrame, prebins: Prebins, keep: list[str]) -> DataFrame:
    """Every feature replaced by its prebin number."""
    return df.select(*keep, *[F.expr(prebins.bin_sql(f)).alias(f) for f in prebins.features])


def bin_contingency(df: DataFrame, label: str, prebins: Prebins) -> DataFrame:
    """(feature, bin_id, good, bad) of all features in one pass.

    Values become small bin numbers before the unpivot, so the partial
    aggregate of a task holds at most features x bins rows, and that is all
    that is shuffled.
    """
    t = F.col(label)
    return (
        binned(df, prebins, [label])
        .unpivot([label], prebins.features, "feature", "bin_id")
        .groupBy("feature", "bin_id")
        .agg(F.count(F.when(t == 0, 1)).alias("good"), F.count(F.when(t == 1, 1)).alias("bad"))
    )


def merge_bins(contingency: DataFrame, min_share: float = MIN_BIN_SHARE) -> DataFrame:
    """(feature, bin_id, merged_id, good, bad): prebins and the bin each was pooled into.

    Neighbours are pooled until the bad rate is monotone, in whichever
    direction keeps more information value, and every bin holds ``min_share``
    of the rows. Categories are ordered by bad rate first. The missing bin
    stays as it is. The input is a contingency table, so a group is at most
    about twenty rows.
    """
    schema = "feature string, bin_id int, merged_id int, good bigint, bad bigint"
    columns = contingency.select("feature", "kind", "bin_id", "good", "bad")

    def pool(frame: pd.DataFrame) -> pd.DataFrame:
        return _pool_feature(frame, min_share)

    return columns.groupBy("feature").applyInPandas(pool, schema)


def _pool_feature(frame: pd.DataFrame, min_share: float) -> pd.DataFrame:
    missing = frame.bin_id == MISSING_BIN
    rest = frame[~missing]
    if (rest.kind == "num").all():
        rest = rest.sort_values("bin_id")
    else:
        rate = rest.bad / (rest.good + rest.bad).clip(lower=1)
        rest = rest.assign(rate=rate).sort_values(["rate", "bin_id"])
    counts = rest[["good", "bad"]].to_numpy(dtype=float)
    groups = max(
        (_monotone(counts, sign) for sign in (1, -1)), key=lambda g: _information(counts, g)
    )
    groups = _enlarge(counts, groups, min_share * (frame.good.sum() + frame.bad.sum()))
    merged = pd.Series(MISSING_BIN, index=frame.index)
    for i, members in enumerate(groups):
        merged.loc[rest.index[members]] = i
    return frame.assign(merged_id=merged)[["feature", "bin_id", "merged_id", "good", "bad"]]


def _rate(counts: np.ndarray, members: list[int]) -> float:
    good, bad = counts[members].sum(axis=0)
    return bad / (good + bad) if good + bad else 0.0


def _monotone(counts: np.ndarray, sign: int) -> list[list[int]]:
    """Adjacent groups with strictly monotone bad rate; empty bins join a neighbour."""
    groups: list[list[int]] = []
    for i in range(len(counts)):
        groups.append([i])
        while len(groups) > 1 and (
            counts[groups[-1]].sum() == 0
            or counts[groups[-2]].sum() == 0
            or sign * _rate(counts, groups[-1]) <= sign * _rate(counts, groups[-2])
        ):
            last = groups.pop()
            groups[-1] = groups[-1] + last
    return groups


def _enlarge(counts: np.ndarray, groups: list[list[int]], least: float) -> list[list[int]]:
    """Pool the smallest group with the neighbour nearest in bad rate until none is too small."""
    groups = [list(g) for g in groups]
    while len(groups) > 1:
        sizes = [counts[g].sum() for g in groups]
        i = int(np.argmin(sizes))
        if sizes[i] >= least:
            break
        near = [j for j in (i - 1, i + 1) if 0 <= j < len(groups)]
        j = min(near, key=lambda j: abs(_rate(counts, groups[j]) - _rate(counts, groups[i])))
        first, second = min(i, j), max(i, j)
        groups[first : second + 1] = [groups[first] + groups[second]]
    return groups


def _information(counts: np.ndarray, groups: list[list[int]]) -> float:
    total = np.maximum(counts.sum(axis=0), 1)
    sides = np.array([counts[g].sum(axis=0) for g in groups])
    sides = np.where(sides == 0, 0.5, sides) / total
    return float(((sides[:, 0] - sides[:, 1]) * np.log(sides[:, 0] / sides[:, 1])).sum())


def with_evidence(bins: DataFrame) -> DataFrame:
    """Adds ``woe`` and ``iv`` to rows of (feature, good, bad).

    An empty side counts as half a row while the class totals stay as they
    are. Without goods or without bads in the feature, and for a bin without
    rows, there is no evidence: NULL.
    """
    whole = Window.partitionBy("feature")

    def share(c: str) -> Column:
        side = F.when(F.col(c) == 0, 0.5).otherwise(F.col(c).cast("double"))
        return F.when(
            F.col("good") + F.col("bad") > 0, F.try_divide(side, F.sum(c).over(whole))
        )

    return (
        bins.withColumn("_g", share("good"))
        .withColumn("_b", share("bad"))
        .withColumn("woe", F.log(F.try_divide(F.col("_g"), F.col("_b"))))
        .withColumn("iv", (F.col("_g") - F.col("_b")) * F.col("woe"))
        .drop("_g", "_b")
    )


def assemble_bins(definitions: DataFrame, contingency: DataFrame, merged: DataFrame) -> DataFrame:
    """Rows of the bin table from prebin definitions and the bins they were pooled into."""
    pooled = (
        definitions.join(merged, ["feature", "bin_id"])
        .groupBy("feature", "ordinal", F.col("merged_id").alias("bin_id"))
        .agg(
            F.max(F.when(F.col("kind") == "other", "cat").otherwise(F.col("kind"))).alias("kind"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            # Bounded: a feature keeps at most 1 / min_share categories.
            F.sort_array(F.collect_set("category")).alias("categories"),
            F.max((F.col("kind") == "other").cast("int")).alias("_other"),
            F.sum("good").alias("good"),
            F.sum("bad").alias("bad"),
        )
        .withColumn("kind", F.when(F.col("_other") == 1, "cat+other").otherwise(F.col("kind")))
    )
    return with_evidence(pooled).select(*[f.name for f in BINS_SCHEMA.fields])


@dataclass
class BinMap:
    """The fitted bins: at most about twenty rows per feature, so it lives on the driver.

    ``missing`` is what a missing value scores: ``"zero"`` evidence, or the
    ``"empirical"`` evidence of the missing bin. A category never seen in
    training belongs to the pooled rare ones, or scores zero without such a bin.
    """

    rows: list[dict]
    missing: str = "zero"

    @classmethod
    def from_table(cls, bins: DataFrame, missing: str = "zero") -> BinMap:
        found = bins.select(*[f.name for f in BINS_SCHEMA.fields]).collect()
        rows = sorted((r.asDict() for r in found), key=lambda r: (r["ordinal"], r["bin_id"]))
        return cls(rows, missing)

    def to_table(self, spark: SparkSession) -> DataFrame:
        names = [f.name for f in BINS_SCHEMA.fields]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in self.rows], BINS_SCHEMA)

    @property
    def features(self) -> list[str]:
        return list(dict.fromkeys(r["feature"] for r in self.rows))

    def only(self, features: list[str]) -> BinMap:
        names = set(features)
        return BinMap([r for r in self.rows if r["feature"] in names], self.missing)

    def of(self, feature: str) -> Iterator[dict]:
        return (r for r in self.rows if r["feature"] == feature)

    def _value_sql(self, feature: str, value: str, missing: str, unseen: str) -> str:
        rows = list(self.of(feature))
        numeric = sorted((r for r in rows if r["kind"] == "num"), key=lambda r: r["lo"])
        leaf = lambda r: number(0.0 if r[value] is None else r[value])
        absent = f"{quoted(feature)} IS NULL"
        if numeric:
            absent += f" OR isnan({_as_double(feature)})"
            edges = [r["lo"] for r in numeric[1:]]
            inner = interval_case(_as_double(feature), edges, [leaf(r) for r in numeric])
        else:
            options = {c: leaf(r) for r in rows for c in (r["categories"] or [])}
            pooled = [leaf(r) for r in rows if r["kind"] == "cat+other"]
            inner = choice_case(quoted(feature), options, pooled[0] if pooled else unseen)
        return f"CASE WHEN {absent} THEN {missing} ELSE {inner} END"

    def woe_column(self, feature: str) -> Column:
        """Weight of evidence of a feature's value: a CASE tree, no join."""
        missing = 0.0
        if self.missing == "empirical":
            own = [r["woe"] for r in self.of(feature) if r["kind"] == "missing"]
            missing = own[0] if own and own[0] is not None else 0.0
        return F.expr(self._value_sql(feature, "woe", number(missing), number(0.0)))

    def bin_column(self, feature: str) -> Column:
        """Bin number of a feature's value."""
        return F.expr(
            self._value_sql(feature, "bin_id", number(MISSING_BIN), number(OTHER_BIN))
        )


def fit_bins(
    df: DataFrame,
    label: str,
    cat: list[str],
    num: list[str],
    bins: int = MAX_PREBINS,
    min_share: float = MIN_BIN_SHARE,
    method: str = "exact",
    merge: bool = True,
    missing: str = "zero",
) -> BinMap:
    """Fit all features together: prebins, one counting pass, merging, evidence."""
    spark = df.sparkSession
    prebins = fit_prebins(df, cat, num, bins, min_share, method)
    definitions = prebins.definitions(spark)
    counts = bin_contingency(df, label, prebins)
    full = (
        definitions.join(F.broadcast(counts), ["feature", "bin_id"], "left")
        .fillna(0, ["good", "bad"])
        .where((F.col("kind") == "num") | (F.col("good") + F.col("bad") > 0))
    )
    if merge:
        merged = merge_bins(full, min_share)
    else:
        merged = full.select(
            "feature", "bin_id", F.col("bin_id").alias("merged_id"), "good", "bad"
        )
    return BinMap.from_table(assemble_bins(definitions, full, merged), missing)
