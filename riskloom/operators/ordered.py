"""Order-dependent work split into two levels, so no key is ever one task.

A running total or a run of readings needs its rows in order. A plain window
would put a whole key (or the whole table) in one task. Here rows are cut into
ordered buckets; each bucket is worked on by itself, one summary row per bucket
carries what the next one needs, and the carry is joined back. Only the
summaries of a key, as many as there are buckets, ever meet in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.scores import epoch_us
from riskloom.session import settle

_US = 1_000_000
# A key's rows are worked on hour by hour: even one key holding much of a table
# is hundreds of tasks a month, and its carry a few thousand rows a year.
BUCKET_S = 3600


def running_totals(
    df: DataFrame, order: str, totals: dict[str, str], parts: int, descending: bool = False
) -> DataFrame:
    """Adds running sums over distinct ``order`` values: ``{new column: summed column}``.

    Rows are dealt by ranges of the order column to ``parts`` buckets, and written out so that a
    row keeps its bucket; any number gives the same result.
    """
    ranged = df.repartitionByRange(parts, order)
    rows = settle(ranged.withColumn("_bucket", F.spark_partition_id()), "ranges")
    direction = F.col(order).desc() if descending else F.col(order).asc()
    local = Window.partitionBy("_bucket").orderBy(direction)
    place = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    # As many rows as there are buckets: one task is the right size for this window.
    earlier = Window.orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        rows.groupBy("_bucket")
        .agg(*[F.sum(c).alias(f"_sum_{name}") for name, c in totals.items()])
        .select(
            "_bucket",
            *[
                F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}")
                for name in totals
            ],
        )
    )
    summed = rows.select("*", *[F.sum(c).over(local).alias(name) for name, c in totals.items()])
    return summed.join(F.broadcast(carry), "_bucket").select(
        *df.columns, *[(F.col(name) + F.col(f"_before_{name}")).alias(name) for name in totals]
    )


def _bucket_of(ts: Column, width_s: int) -> Column:
    return F.floor(epoch_us(ts) / F.lit(width_s * _US)).cast("bigint")


def breach_runs(
    df: DataFrame,
    keys: list[str],
    ts: str,
    breach: str,
    max_gap_s: int | None = None,
    bucket_s: int = BUCKET_S,
) -> DataFrame:
    """Adds ``run_start``: when the unbroken run of breaches holding the row began.

    NULL on rows without a breach. A run ends at the first reading without
    one, and also at a silence longer than ``max_gap_s`` if that is given.
    Readings of a key at one time are one reading, a breach if any of them is. A key's
    rows are spread over time buckets of ``bucket_s`` seconds.
    """
    place = [*keys, "_bucket"]
    local = Window.partitionBy(*place).orderBy(ts)
    hit = F.coalesce(F.col(breach), F.lit(False))
    together = local.rangeBetween(Window.currentRow, Window.currentRow)

    def begins(previous: Column, ts_col: Column) -> Column:
        """Whether a breaching row begins a run, given the reading before it."""
        new = previous.isNull() | ~previous["hit"]
        if max_gap_s is not None:
            silence = epoch_us(ts_col) - epoch_us(previous["ts"])
            new = new | (silence > F.lit(max_gap_s * _US))
        return new

    reading = F.struct(F.col(ts).alias("ts"), F.max(hit).over(together).alias("hit"))
    rows = (
        df.withColumn("_bucket", _bucket_of(F.col(ts), bucket_s))
        .withColumn("_now", reading)
        .withColumn("_previous", F.lag("_now").over(local))
        .withColumn(
            "_start",
            F.when(
                F.col("_now.hit") & F.col("_previous").isNotNull() & begins(F.col("_previous"), F.col(ts)),
                F.col(ts),
            ),
        )
    )
    over_time = Window.partitionBy(*keys).orderBy("_bucket")
    carry = (
        rows.groupBy(*place)
        .agg(
            F.min_by("_now", ts).alias("_first"),
            F.max_by("_now", ts).alias("_last"),
            F.max("_start").alias("_inner"),
        )
        .withColumn("_before", F.lag("_last").over(over_time))
        .withColumn(
            "_opening",
            F.when(
                F.col("_first.hit") & begins(F.col("_before"), F.col("_first.ts")),
                F.col("_first.ts"),
            ),
        )
        .withColumn(
            "_open",
            F.coalesce(
                F.col("_opening"),
                F.max(F.coalesce("_inner", "_opening")).over(
                    over_time.rowsBetween(Window.unboundedPreceding, -1)
                ),
            ),
        )
        .select(*place, "_open")
    )
    started = F.max("_start").over(local.rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.withColumn("_started", started)
        .join(carry, place)
        .withColumn("run_start", F.when(hit, F.coalesce("_started", "_open")))
        .select(*df.columns, "run_start")
    )


def sessions(
    df: DataFrame, keys: list[str], ts: str, gap_s: int, bucket_s: int | None = None
) -> DataFrame:
    """(keys, first_ts, last_ts, readings): readings at most ``gap_s`` apart form a session.

    Sessions are formed inside time buckets; only those within a gap of a
    bucket's edge, at most two per bucket, are then joined across buckets.
    """
    bucket_s = max(BUCKET_S, 4 * gap_s) if bucket_s is None else bucket_s
    if bucket_s <= gap_s:
        raise ValueError("buckets must be wider than the gap")
    place = [*keys, "_bucket"]
    gap = F.lit(gap_s * _US)
    inner = (
        df.select(*keys, F.col(ts).alias("_ts"), _bucket_of(F.col(ts), bucket_s).alias("_bucket"))
        .groupBy(*place, F.session_window("_ts", f"{gap_s} seconds").alias("_session"))
        .agg(
            F.min("_ts").alias("first_ts"),
            F.max("_ts").alias("last_ts"),
            F.count("*").alias("readings"),
        )
        .drop("_session")
        .withColumn(
            "_edge",
            (epoch_us(F.col("first_ts")) - F.col("_bucket") * (bucket_s * _US) <= gap)
            | ((F.col("_bucket") + 1) * (bucket_s * _US) - epoch_us(F.col("last_ts")) <= gap),
        )
    )
    over_time = Window.partitionBy(*keys).orderBy("first_ts")
    apart = epoch_us(F.col("first_ts")) - epoch_us(F.lag("last_ts").over(over_time)) > gap
    edge_id = F.sum(F.coalesce(apart, F.lit(True)).cast("bigint")).over(over_time)
    columns = [*keys, "first_ts", "last_ts", "readings"]
    joined = (
        inner.where("_edge")
        .withColumn("_id", edge_id)
        .groupBy(*keys, "_id")
        .agg(
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.sum("readings").alias("readings"),
        )
    )
    return inner.where(~F.col("_edge")).select(*columns).unionByName(joined.select(*columns))
