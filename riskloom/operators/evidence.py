"""Weight of evidence, information value, and the feature gate."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.trees import interval_case, number, quoted
from riskloom.operators.binning import MISSING_BIN, BinMap, with_evidence

# The gate's bounds, inclusive on both ends.
MIN_IV = 0.02
MAX_IV = 0.5
MAX_MISSING_RATE = 0.1

#: Bins that a value is compared with in the range join.
BUCKET_BINS = 64


def woe_table(contingency: DataFrame) -> DataFrame:
    """(feature, bin_id, good, bad, woe, iv) per bin."""
    return with_evidence(contingency)


def iv_by_feature(contingency: DataFrame, group_by: str = "bin") -> DataFrame:
    """(feature, iv, iv_floor).

    ``group_by="woe"`` groups rows by the value they were transformed to, as
    one does who only has the transformed column: bins of equal evidence count
    as one, and a missing value stands at zero. ``iv_floor`` is about what a
    feature without any signal would show at this sample size.
    """
    table = with_evidence(contingency)
    if group_by == "woe":
        value = F.when(F.col("bin_id") == MISSING_BIN, 0.0).otherwise(F.col("woe"))
        table = with_evidence(
            table.groupBy("feature", value.alias("value")).agg(
                F.sum("good").alias("good"), F.sum("bad").alias("bad")
            )
        )
    elif group_by != "bin":
        raise ValueError(f"unknown grouping {group_by!r}")
    k = F.count(F.when(F.col("good") + F.col("bad") > 0, 1))
    floor = (k - 1) * (F.try_divide(F.lit(1.0), F.sum("good")) + F.try_divide(F.lit(1.0), F.sum("bad")))
    return table.groupBy("feature").agg(F.sum("iv").alias("iv"), floor.alias("iv_floor"))


def screening(iv: DataFrame, missing: DataFrame, order: list[str]) -> DataFrame:
    """(ordinal, feature, iv, missing_rate, kept) for every feature in ``order``."""
    places = iv.sparkSession.createDataFrame(
        [(i, f) for i, f in enumerate(order)], "ordinal int, feature string"
    )
    kept = F.col("iv").between(MIN_IV, MAX_IV) & (F.col("missing_rate") <= MAX_MISSING_RATE)
    return (
        places.join(iv.select("feature", "iv"), "feature", "left")
        .join(missing, "feature", "left")
        .withColumn("kept", F.coalesce(kept, F.lit(False)))
        .select("ordinal", "feature", "iv", "missing_rate", "kept")
    )


def feature_gate(
    iv: DataFrame,
    missing: DataFrame,
    order: list[str],
    min_iv: float = MIN_IV,
    max_iv: float = MAX_IV,
    max_missing: float = MAX_MISSING_RATE,
) -> DataFrame:
    """The features within the information-value band and missing limit, in feature order."""
    return (
        screening(iv, missing, order)
        .where(F.col("iv").between(min_iv, max_iv) & (F.col("missing_rate") <= max_missing))
        .drop("kept")
        .orderBy("ordinal")
    )


def woe_transform(df: DataFrame, bins: BinMap, keep: list[str]) -> DataFrame:
    """Key and label columns as they are, every feature as its weight of evidence.

    One narrow projection: the map is part of the plan and nothing is joined
    or shuffled.
    """
    return df.select(*keep, *[bins.woe_column(f).alias(f) for f in bins.features])


def woe_long(df: DataFrame, bins: BinMap, keep: list[str]) -> DataFrame:
    """The same as (keep..., feature, woe) rows.

    Every value goes through its tree once, then the columns become rows; nothing is joined, so an
    output row costs no lookup of its feature and bin.
    """
    return woe_transform(df, bins, keep).unpivot(keep, bins.features, "feature", "woe")


def woe_joined(df: DataFrame, bins: BinMap, keep: list[str]) -> DataFrame:
    """``woe_long`` by joining the bin table, for checks of the trees by other means.

    The bin table is at most about twenty rows per feature and comes from the
    driver, so its broadcast is bounded by the feature list.
    """
    numbered = df.select(*keep, *[bins.bin_column(f).alias(f) for f in bins.features])
    rows = numbered.unpivot(keep, bins.features, "feature", "bin_id")
    values = bins.to_table(df.sparkSession).select(
        "feature",
        "bin_id",
        F.when((F.col("kind") == "missing") & F.lit(bins.missing == "zero"), 0.0)
        .otherwise(F.col("woe"))
        .alias("woe"),
    )
    return rows.join(F.broadcast(values), ["feature", "bin_id"], "left").select(
        *keep, "feature", F.coalesce("woe", F.lit(0.0)).alias("woe")
    )


def woe_by_range(
    df: DataFrame, bins: DataFrame, keep: list[str], missing: str = "zero", per_bucket: int = BUCKET_BINS
) -> DataFrame:
    """``woe_long`` for maps of very many bins: (keep..., feature, woe) by a range join.

    ``bins`` is a table like ``BinMap.to_table``, of any size. Every ``per_bucket``-th edge of a numeric
    feature begins a bucket; a value finds its bucket in a tree over those, is joined on feature and
    bucket with at most ``per_bucket`` bins, and the one whose range holds it stays. Categories are
    joined as they are, rare and missing values by marks of their own. Numeric bins must not
    overlap; a value outside all of them, like an unseen category without pooled ones, is worth 0.
    """
    order = Window.partitionBy("feature").orderBy("lo")
    numeric = bins.where("kind = 'num'").withColumn(
        "bucket", F.floor((F.row_number().over(order) - 1) / F.lit(per_bucket)).cast("int")
    )
    # one edge for each per_bucket bins
    starts: dict[str, list[float]] = {}
    for r in numeric.groupBy("feature", "bucket").agg(F.min("lo").alias("lo")).orderBy("feature", "lo").collect():
        starts.setdefault(r["feature"], []).append(r["lo"])
    texts = [r["feature"] for r in bins.select("feature").distinct().collect() if r["feature"] not in starts]
    texts.sort()
    cells = []
    for f, edges in starts.items():
        value = f"CAST({quoted(f)} AS DOUBLE)"
        leaves = [number(i) for i in (0, *range(len(edges)))]
        place = F.expr(f"CASE WHEN {value} IS NULL OR isnan({value}) THEN -1 ELSE {interval_case(value, edges, leaves)} END")
        cells.append(F.struct(F.lit(f).alias("feature"), place.alias("bucket"), F.expr(value).alias("value"), F.lit("").alias("category")))
    for f in texts:
        column = F.col(quoted(f)).cast("string")
        place = F.when(column.isNull(), -1).otherwise(0)
        category = F.coalesce(column, F.lit(""))
        cells.append(F.struct(F.lit(f).alias("feature"), place.alias("bucket"), F.lit(0.0).alias("value"), category.alias("category")))
    rows = df.select(*keep, F.inline(F.array(*cells)))
    lost = F.lit(0.0) if missing == "zero" else F.col("woe")
    anywhere = [F.lit(-math.inf).alias("lo"), F.lit(math.inf).alias("hi")]
    absent = bins.where("kind = 'missing'").select("feature", F.lit(-1).alias("bucket"), F.lit("").alias("category"), *anywhere, lost.alias("woe"))
    named = bins.where("kind IN ('cat', 'cat+other')").select("feature", F.lit(0).alias("bucket"), F.explode("categories").alias("category"), *anywhere, "woe")
    ranges = numeric.select("feature", "bucket", F.lit("").alias("category"), "lo", "hi", "woe")
    known = ranges.unionByName(named).unionByName(absent)
    held = (F.col("b.lo") <= F.col("r.value")) & ((F.col("r.value") < F.col("b.hi")) | (F.col("b.hi") == math.inf))
    # a missing value has no place in a range
    held = held | (F.col("r.bucket") == -1)
    same = [F.col(f"r.{c}") == F.col(f"b.{c}") for c in ("feature", "bucket", "category")]
    found = rows.alias("r").join(known.alias("b"), [*same, held], "left")
    pooled = bins.where("kind = 'cat+other'").select("feature", F.col("woe").alias("_pooled"))
    # as small as the list of features
    found = found.select(*[F.col(f"r.{k}").alias(k) for k in keep], F.col("r.feature").alias("feature"), F.col("r.bucket").alias("_at"), F.col("b.woe").alias("woe"), F.col("b.feature").isNotNull().alias("_found"))
    found = found.join(F.broadcast(pooled), "feature", "left")
    unseen = F.when(F.col("_at") >= 0, F.col("_pooled"))
    return found.select(*keep, "feature", F.coalesce(F.when(F.col("_found"), F.col("woe")).otherwise(unseen), F.lit(0.0)).alias("woe"))


def anova_f(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """(feature, f_score): one-way ANOVA of each feature against the label, missing as 0.

    One pass keeps count, mean and variance per class, which Spark merges
    without cancellation; the rest is arithmetic on one row per class and
    feature. Without spread inside the classes the score is infinite, without
    any spread NULL. Rows whose label is neither 0 nor 1 take no part, as in ``bin_contingency``.
    """
    moments = df.where(F.col(label).isin(0, 1)).groupBy(label).agg(
        *[
            F.struct(
                F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean"), F.var_pop(x).alias("var")
            ).alias(f)
            for f in features
            for x in [F.coalesce(F.col(f).cast("double"), F.lit(0.0))]
        ]
    )
    rows = moments.unpivot([label], features, "feature", "s").select("feature", "s.*")
    whole = Window.partitionBy("feature")
    centre = F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole)
    sums = (
        rows.withColumn("off", F.col("mean") - centre)
        .groupBy("feature")
        .agg(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("k"),
            F.sum(F.col("n") * F.col("off") * F.col("off")).alias("between"),
            F.sum(F.col("n") * F.col("var")).alias("within"),
        )
    )
    ratio = F.try_divide(
        F.try_divide(F.col("between"), F.col("k") - 1),
        F.try_divide(F.col("within"), F.col("n") - F.col("k")),
    )
    endless = (F.col("within") == 0) & (F.col("between") > 0)
    return sums.select(
        "feature", F.when(endless, F.lit(float("inf"))).otherwise(ratio).alias("f_score")
    )


def select_k_best(scores: DataFrame, order: list[str], k: int | str = "auto") -> DataFrame:
    """The k features of highest score, listed in feature order.

    ``"auto"`` keeps all. On ties the later feature wins; a NULL score ranks last.
    """
    places = scores.sparkSession.createDataFrame(
        [(i, f) for i, f in enumerate(order)], "ordinal int, feature string"
    )
    ranked = places.join(scores, "feature").select("ordinal", "feature", "f_score")
    if k != "auto":
        best = F.col("f_score").desc_nulls_last()
        ranked = ranked.orderBy(best, F.col("ordinal").desc()).limit(int(k))
    return ranked.orderBy("ordinal")


def contribution_summary(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(feature, mean_abs_contribution) of a linear score.

    With independent features the Shapley value of ``x_j`` is
    ``w_j * (x_j - mean(x_j))``; its mean size ranks the features.
    """
    features = list(weights)
    means = df.agg(*[F.avg(f).alias(f) for f in features]).first()
    effect = {
        f: F.lit(float(w)) * (F.col(f) - F.lit(means[f]).cast("double")) for f, w in weights.items()
    }
    wide = df.agg(*[F.avg(F.abs(effect[f])).alias(f) for f in features])
    return wide.unpivot([], features, "feature", "mean_abs_contribution")
