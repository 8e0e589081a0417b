"""Model quality from labels, predictions and scores."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordered import running_totals
from riskloom.session import settle

# Distinct scores are ranked in parts cut to about this many rows.
CURVE_ROWS = 1_000_000


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows for class 0, class 1, accuracy, and the macro and weighted averages.

    Four counts from one pass; an undefined ratio is 0.
    """
    y, p = F.col(label), F.col(prediction)

    def count(is_label: int, is_prediction: int) -> Column:
        return F.count(F.when((y == is_label) & (p == is_prediction), 1)).cast("double")

    cells = df.agg(*[count(a, b).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)])

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    n = {(a, b): F.col(f"n{a}{b}") for a in (0, 1) for b in (0, 1)}
    total = n[0, 0] + n[0, 1] + n[1, 0] + n[1, 1]
    measures = {}
    for c in (0, 1):
        hits, support = n[c, c], n[c, 0] + n[c, 1]
        precision, recall = ratio(hits, n[0, c] + n[1, c]), ratio(hits, support)
        measures[c] = (precision, recall, ratio(2 * hits, support + n[0, c] + n[1, c]), support)
    exact = ratio(n[0, 0] + n[1, 1], total)

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("row"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.cast("bigint").alias("support"),
        )

    macro = [(measures[0][i] + measures[1][i]) / 2 for i in range(3)]
    weighted = [
        ratio(measures[0][i] * measures[0][3] + measures[1][i] * measures[1][3], total)
        for i in range(3)
    ]
    nothing = F.lit(None).cast("double")
    return cells.select(
        F.inline(
            F.array(
                line("0", *measures[0]),
                line("1", *measures[1]),
                line("accuracy", nothing, nothing, exact, total),
                line("macro avg", *macro, total),
                line("weighted avg", *weighted, total),
            )
        )
    )


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg): one row per distinct score, combined on the map side."""
    y = F.col(label)
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count(F.when(y == 1, 1)).alias("pos"), F.count(F.when(y == 0, 1)).alias("neg")
    )


def _scored(df: DataFrame, label: str, score: str, decimals: int | None) -> DataFrame:
    """(y, score) of the rows that have both; ``decimals`` bounds the number of thresholds."""
    value = F.col(score) if decimals is None else F.round(F.col(score), decimals)
    return df.select(F.col(label).alias("y"), value.cast("double").alias("score")).where(
        F.col("score").isNotNull() & ~F.isnan("score") & F.col("y").isNotNull()
    )


def _ranked(rows: DataFrame, descending: bool) -> DataFrame:
    """Distinct scores with their counts by class and the running counts up to each."""
    counts = settle(score_counts(rows, "y", "score"), "scores")
    parts = max(1, math.ceil(counts.count() / CURVE_ROWS))
    return running_totals(counts, "score", {"cum_pos": "pos", "cum_neg": "neg"}, parts, descending)


def roc_curve(df: DataFrame, label: str, score: str, decimals: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score; a rate without its class is NULL."""
    rows = _scored(df, label, score, decimals)
    ranked = _ranked(rows, descending=True)
    totals = ranked.agg(F.sum("pos").alias("bads"), F.sum("neg").alias("goods")).first()
    return ranked.select(
        F.col("score").alias("threshold"),
        _share(F.col("cum_neg"), totals["goods"] or 0).alias("fpr"),
        _share(F.col("cum_pos"), totals["bads"] or 0).alias("tpr"),
    )


def _share(count: Column, total: int) -> Column:
    return F.try_divide(count.cast("double"), F.lit(float(total)))


def roc_auc(df: DataFrame, label: str, score: str, decimals: int | None = None) -> DataFrame:
    """Rank form: how often a positive outscores a negative, ties counting half."""
    ranked = _ranked(_scored(df, label, score, decimals), descending=False)
    below = F.col("cum_neg") - F.col("neg")
    wins = F.sum(F.col("pos").cast("double") * (below + F.col("neg") / F.lit(2.0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(wins, pairs).alias("roc_auc"))


def roc_auc_trapezoid(
    df: DataFrame, label: str, score: str, decimals: int | None = None
) -> DataFrame:
    """Area under the curve by trapezoids. A threshold's own counts are the step
    from the point before it, so no further ordering is needed."""
    ranked = _ranked(_scored(df, label, score, decimals), descending=True)
    area = F.sum(F.col("neg").cast("double") * (2 * F.col("cum_pos") - F.col("pos")) / F.lit(2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(area, pairs).alias("roc_auc_trapezoid"))
