"""Population stability between a reference and a current set of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.binning import MISSING_BIN, OTHER_BIN, Prebins, bin_contingency, binned, fit_prebins
from riskloom.operators.evidence import iv_by_feature
from riskloom.operators.gauges import DRIFT_GAUGE

# Alert thresholds on the drift score, and the top of the shift gauge.
DRIFT_WARNING = 0.1
DRIFT_CRITICAL = 0.3
SHIFT_MAX = 5.0


def drift_level(psi: Column) -> Column:
    return (
        F.when(psi > DRIFT_CRITICAL, "critical")
        .when(psi > DRIFT_WARNING, "warning")
        .when(psi.isNotNull(), "ok")
    )


def drift_score(df: DataFrame, is_current: str, prebins: Prebins) -> DataFrame:
    """(feature, psi, level) with ``is_current`` 0 for reference rows and 1 for current ones.

    The stability index sum((p - q) * ln(p / q)) has the form of an
    information value with the period as label, an empty bin again counting
    as half a row; so it is one counting pass over both periods.
    """
    psi = iv_by_feature(bin_contingency(df, is_current, prebins))
    return psi.select("feature", F.col("iv").alias("psi"), drift_level(F.col("iv")).alias("level"))


def drift_between(
    reference: DataFrame, current: DataFrame, cat: list[str], num: list[str], bins: int = 10
) -> DataFrame:
    """The same for two tables, with bins fitted on the reference."""
    prebins = fit_prebins(reference, cat, num, bins)
    columns = [*cat, *num]
    both = reference.select(*columns, F.lit(0).alias("is_current")).unionByName(
        current.select(*columns, F.lit(1).alias("is_current"))
    )
    return drift_score(both, "is_current", prebins)


def distribution_shift(drift: DataFrame) -> DataFrame:
    """(distribution_shift, shown): one reading for the whole table, and what the gauge's scale shows."""
    whole = F.sum("psi")
    return drift.agg(
        whole.alias("distribution_shift"), F.least(whole, F.lit(SHIFT_MAX)).alias("shown")
    )


def _slots(prebins: Prebins) -> list[int]:
    """The bin numbers that any feature can have."""
    most = max([len(c) for c in prebins.categories.values()] + [len(e) + 1 for e in prebins.edges.values()])
    return [OTHER_BIN, MISSING_BIN, *range(most)]


def _counted(df: DataFrame, prebins: Prebins, keep: list[str], groups: list) -> DataFrame:
    """One row per group and feature with the number of rows in each bin, added up by all tasks."""
    rows = binned(df, prebins, keep).unpivot(keep, prebins.features, "feature", "bin_id")
    counts = [F.count_if(F.col("bin_id") == b).alias(f"_n{i}") for i, b in enumerate(_slots(prebins))]
    names = [f"_n{i}" for i in range(len(counts))]
    return rows.groupBy(*groups, "feature").agg(*counts).withColumn("counts", F.array(*names)).drop(*names)


def reference_counts(reference: DataFrame, prebins: Prebins) -> DataFrame:
    """(feature, reference): rows in each bin of the reference period; one row per feature."""
    return _counted(reference, prebins, [], []).withColumnRenamed("counts", "reference")


def stability_index(reference: Column, current: Column) -> Column:
    """Population stability between two arrays of counts by bin, as ``drift_score`` has it.

    An empty bin counts as half a row while the totals stay as they are; a bin that is empty on
    both sides adds nothing. Without rows on one side there is no index: NULL.
    """

    def whole(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0).cast("bigint"), lambda s, x: s + x).cast("double")

    def side(n: Column) -> Column:
        return F.when(n == 0, F.lit(0.5)).otherwise(n.cast("double"))

    def term(r: Column, c: Column) -> Column:
        q, p = F.try_divide(side(r), whole(reference)), F.try_divide(side(c), whole(current))
        return F.when(r + c > 0, (p - q) * F.log(F.try_divide(p, q))).otherwise(F.lit(0.0))

    return F.aggregate(F.zip_with(reference, current, term), F.lit(0.0), lambda s, x: s + x)


def windowed_drift(
    df: DataFrame,
    ts: str,
    width: str,
    prebins: Prebins,
    reference: DataFrame,
    keys: list[str] | None = None,
) -> DataFrame:
    """(window_start, window_end, keys, feature, n, psi): drift of each window against the reference.

    ``reference`` comes from ``reference_counts`` with the same bins; it has one row per feature, which
    is what bounds its broadcast. Works on a table and, with a watermark, on a stream, whose state
    is a row of counts per open window, key and feature. Features without reference rows have
    no index.
    """
    keys = keys or []
    windows = _counted(df, prebins, [ts, *keys], [F.window(ts, width).alias("_w"), *keys])
    return windows.join(F.broadcast(reference), "feature").select(
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *keys,
        "feature",
        F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("n"),
        stability_index(F.col("reference"), F.col("counts")).alias("psi"),
    )


def drift_readings(windows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Windows of ``windowed_drift`` as gauge readings (ts, keys, feature, metric, value), a series per feature."""
    return windows.select(
        F.col("window_start").alias("ts"), *(keys or []), "feature", F.lit(DRIFT_GAUGE).alias("metric"), F.col("psi").alias("value")
    )
