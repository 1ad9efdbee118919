"""Overlapping look-backs from panes: a row is summed into one pane, however many look-backs hold it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

PANES_PER_BUCKET = 24 * 60


def pane_number(ts: Column, minutes: int = 1) -> Column:
    """Number of the pane a timestamp falls into, counted from the epoch."""
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(60 * minutes))


def pane_start(number: Column, minutes: int = 1) -> Column:
    return F.timestamp_seconds(number * F.lit(60 * minutes))


def pane_sums(df: DataFrame, keys: Sequence[str], ts: str, minutes: int = 1, **measures: Column) -> DataFrame:
    """``keys, pane`` and additive whole-number measures, one row per key and pane. The raw log moves only as partial sums."""
    return df.groupBy(*keys, pane_number(F.col(ts), minutes).alias("pane")).agg(*[m.alias(n) for n, m in measures.items()])


def look_backs(
    panes: DataFrame, keys: Sequence[str], sizes: Sequence[int], first: int | None = None, last: int | None = None, bucket: int = PANES_PER_BUCKET
) -> DataFrame:
    """``keys, size, upto`` and the measures of the ``size`` panes before pane ``upto``, for every ``upto`` whose look-back holds a row.

    Columns of ``panes`` besides ``keys`` and ``pane`` are measures; they have to be whole numbers, so that sums taken
    out again leave nothing behind. ``first`` and ``last`` bound ``upto``.

    A pane enters a look-back when it ends and leaves it ``size`` panes later: two signed rows for each size, whatever the size is,
    and two more where the stay crosses the end of a ``bucket``, in which running sums start anew. Sums between
    two such rows are constant and are spread over their panes after the shuffle. A group is one key's bucket, at most
    four rows a pane, so a hot key is split by time.
    """
    keys = list(keys)
    measures = [c for c in panes.columns if c not in (*keys, "pane")]
    if any(not 0 < s <= bucket for s in sizes):
        raise ValueError(f"look-backs of 1 to {bucket} panes")
    counted = panes.withColumn("_panes", F.lit(1).cast("long"))
    summed = [*measures, "_panes"]
    begin = F.col("pane") + 1

    def step(size: int, bucket_number: Column, at: Column, sign: int) -> Column:
        return F.struct(
            F.lit(size).alias("size"), bucket_number.alias("_bucket"), at.cast("long").alias("_at"), *[(F.col(c) * sign).cast("long").alias(c) for c in summed]
        )

    def steps(size: int) -> Column:
        end = begin + size
        own, then = F.floor(begin / F.lit(bucket)), F.floor(begin / F.lit(bucket)) + 1
        border = then * bucket
        inside = F.array(step(size, own, begin, 1), step(size, own, end, -1))
        ends_there = F.array(step(size, own, begin, 1))
        crosses = F.array(step(size, own, begin, 1), step(size, then, border, 1), step(size, then, end, -1))
        return F.when(end < border, inside).when(end == border, ends_there).otherwise(crosses)

    told = counted.select(*keys, F.explode(F.concat(*[steps(s) for s in sizes])).alias("_s")).select(*keys, "_s.*")
    group = [*keys, "size", "_bucket"]
    # dealt by group once: the sums of one moment and the running sums need no further shuffle
    moments = told.repartition(*group).groupBy(*group, "_at").agg(*[F.sum(c).alias(c) for c in summed])
    order = Window.partitionBy(*group).orderBy("_at")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    border = (F.col("_bucket") + 1) * bucket
    until = F.coalesce(F.lead("_at").over(order), border) - 1
    held = moments.select(*group, "_at", until.alias("_until"), *[F.sum(c).over(running).alias(c) for c in summed]).where("_panes > 0")
    low = F.col("_at") if first is None else F.greatest("_at", F.lit(first).cast("long"))
    high = F.col("_until") if last is None else F.least("_until", F.lit(last).cast("long"))
    bounded = held.withColumn("_at", low).withColumn("_until", high).where("_at <= _until")
    return bounded.select(*keys, "size", F.explode(F.sequence("_at", "_until")).alias("upto"), *measures)


def as_of(look_back: DataFrame, minutes: int = 1) -> DataFrame:
    """``upto`` as the instant at which the look-back ends."""
    return look_back.select(*[pane_start(F.col("upto"), minutes).alias("as_of") if c == "upto" else F.col(c) for c in look_back.columns])
