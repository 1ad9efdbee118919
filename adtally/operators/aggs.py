"""Grouped aggregates, top rows and period comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from adtally.functions.slots import SLOT, shift_slot, slot_ts
from adtally.operators.joins import attach_total


def rollup(df: DataFrame, keys: Sequence[str], **measures: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])


def rollup_known_keys(df: DataFrame, keys: Sequence[str], **measures: Column) -> DataFrame:
    """Grouping that drops rows with a NULL key."""
    return rollup(df.na.drop(subset=list(keys)), keys, **measures)


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).dropDuplicates(list(keys))


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key, the smallest by ``order``, as an aggregate.

    Combined on the map side, so a hot key is never gathered or sorted in one task.
    The remaining columns break ties, which makes the choice repeatable.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    best = F.min(F.struct(*rank, *[F.col(c) for c in rest]))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, *[f"_best.{c}" for c in rest])


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per key. Spark cuts each map task to ``n`` rows per key before the
    shuffle (WindowGroupLimit), so the window never sees more than ``n`` rows per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def partition_total(df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """``agg OVER (PARTITION BY keys)`` as an aggregate joined back: unlike a window, a key
    holding a third of the rows is never collected and sorted in one task."""
    sums = df.groupBy(*keys).agg(*[t.alias(n) for n, t in totals.items()])
    return attach_total(df, sums, keys)


def share_of_total(
    df: DataFrame, shares: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Add total columns over ``by`` (or the whole frame) for each total name -> measure.

    The whole-frame total is exactly one aggregate row, so it is the one side that may be
    broadcast outright; a window without keys would move every row into one task.
    """
    sums = {n: F.sum(m) for n, m in shares.items()}
    if by:
        return partition_total(df, list(by), sums)
    total = df.agg(*[t.alias(n) for n, t in sums.items()]).withColumn("_all", F.lit(1))
    return df.withColumn("_all", F.lit(1)).join(F.broadcast(total), "_all").drop("_all")


def hour_spine(spark: SparkSession, logs: Sequence[DataFrame], first: str | None, last: str | None, slot: str = "time_slot") -> DataFrame:
    """Every hour bucket from ``first`` to ``last``; an open end is the least or largest bucket of the logs.

    Only one row of bounds leaves the logs.
    """
    if first is not None and last is not None:
        bounds = spark.range(1).select(F.lit(first).alias("low"), F.lit(last).alias("high"))
    else:
        seen = [df.agg(F.min(slot).alias("low"), F.max(slot).alias("high")) for df in logs]
        ends = reduce(lambda a, b: a.union(b), seen).agg(F.min("low").alias("low"), F.max("high").alias("high"))
        bounds = ends.select(
            (F.lit(first) if first is not None else F.col("low")).alias("low"), (F.lit(last) if last is not None else F.col("high")).alias("high")
        )
    hours = F.sequence(slot_ts("low"), slot_ts("high"), F.make_dt_interval(hours=F.lit(1)))
    return bounds.where("low <= high").select(F.explode(hours).alias("at")).select(F.date_format("at", SLOT).alias(slot))


def period_compare(
    df: DataFrame, measure: Column, slot: str = "time_slot", offsets: Mapping[str, int] | None = None,
    hours: DataFrame | None = None,
) -> DataFrame:
    """Per hour bucket: its total and the totals ``offsets`` hours earlier.

    With ``hours`` (one bucket per row) exactly those buckets come out, with a total of 0 where there is no row.

    One scan and one small re-aggregation: every hourly total is also sent to the
    buckets that look back to it, instead of scanning the log once per period.
    """
    offsets = {"hour_ago": 1, "day_ago": 24} if offsets is None else offsets
    hourly = df.groupBy(slot).agg(measure.alias("current"))
    names = ["current", *offsets]

    def entry(name: str, hours: int) -> Column:
        values = [F.when(F.lit(n == name), F.col("current")).alias(n) for n in names]
        return F.struct(shift_slot(slot, hours).alias(slot), *values)

    sent = hourly.select(
        F.explode(F.array(entry("current", 0), *[entry(n, h) for n, h in offsets.items()])).alias("e")
    ).select("e.*")
    merged = sent.groupBy(slot).agg(*[F.sum(n).alias(n) for n in names])
    if hours is not None:
        return hours.join(merged, slot, "left").withColumn("current", F.coalesce("current", F.lit(0)))
    return merged.where(F.col("current").isNotNull())


def trailing_total(
    df: DataFrame, measures: Mapping[str, Column], hours: int, slot: str = "time_slot"
) -> DataFrame:
    """Per hour bucket: totals of the last ``hours`` buckets including itself."""
    hourly = df.groupBy(slot).agg(*[m.alias(n) for n, m in measures.items()])
    buckets = F.array(*[shift_slot(slot, h) for h in range(hours)])
    spread = hourly.withColumn(slot, F.explode(buckets))
    return spread.groupBy(slot).agg(*[F.sum(n).alias(n) for n in measures])


def head1(df: DataFrame) -> DataFrame:
    return df.limit(1)


def with_defaults(known: DataFrame, df: DataFrame, key: str, value: str, default) -> DataFrame:
    """Every known key with its value, or the default when there is no row."""
    return known.select(key).join(df, key, "left").withColumn(
        value, F.coalesce(F.col(value), F.lit(default))
    )
