"""Permutation importance: how much worse a model judges when one feature is another row's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a bucket within which values change places, about.
BUCKET_ROWS = 10_000


def _place(keys: list[str], seed: int, repeat: int) -> Column:
    """Where a row stands in a seeded order, as hexadecimal digits."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(f"{seed}:{repeat}"), *parts))


def permutation_importance(
    df: DataFrame,
    keys: list[str],
    label: str,
    features: list[str],
    score: Callable[[DataFrame], DataFrame],
    repeats: int = 1,
    seed: int = 42,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(feature, baseline, permuted, importance): accuracy as it is, with the feature's values
    exchanged between rows (the mean of ``repeats`` exchanges), and the loss.

    ``score`` adds a column ``prediction`` to a table of ``features``; it sees all exchanges in one
    pass. Rows are dealt to buckets by a hash of their keys, and within a bucket, in the order of
    another hash, each takes the value of the next row and the last that of the first: a
    permutation that is the same on every run and needs no order of the whole table. Every
    row takes part once for each feature and repeat. Rows without a label count as judged wrong.
    """
    n = df.count()
    buckets = max(1, n // bucket_rows)
    places = [_place(keys, seed, r) for r in range(repeats)]
    own = F.struct(*features)
    rows = df.select(F.col(label).alias("_label"), *keys, own.alias("_own"))
    rows = rows.withColumn("_bucket", F.conv(F.substring(places[0], 1, 8), 16, 10).cast("bigint") % buckets)
    for r, place in enumerate(places):
        order = Window.partitionBy("_bucket").orderBy(place, F.xxhash64("_own"))
        donor = F.coalesce(F.lead("_own").over(order), F.first("_own").over(order))
        rows = rows.withColumn(f"_donor{r}", donor)

    def variant(feature: int, r: int) -> Column:
        values = [F.col(f"_donor{r}" if i == feature else "_own")[f].alias(f) for i, f in enumerate(features)]
        return F.struct(F.lit(feature).alias("_feature"), F.lit(r).alias("_repeat"), *values)

    variants = [variant(-1, 0), *(variant(i, r) for i in range(len(features)) for r in range(repeats))]
    wide = rows.select("_label", F.explode(F.array(*variants)).alias("_v")).select("_label", "_v.*")
    right = F.coalesce((F.col("prediction") == F.col("_label")).cast("double"), F.lit(0.0))
    judged = score(wide).groupBy("_feature", "_repeat").agg(F.avg(right).alias("accuracy"))
    means = judged.groupBy("_feature").agg(F.avg("accuracy").alias("accuracy"))
    names = df.sparkSession.createDataFrame(list(enumerate(features)), "_feature int, feature string")
    baseline = means.where("_feature = -1").select(F.col("accuracy").alias("baseline"))
    return (
        means.join(F.broadcast(names), "_feature")  # a row per feature
        .crossJoin(F.broadcast(baseline))  # one row
        .select("feature", "baseline", F.col("accuracy").alias("permuted"), (F.col("baseline") - F.col("accuracy")).alias("importance"))
    )
