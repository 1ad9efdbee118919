"""Exact distinct counts that can be merged: bitmaps over dense numbers, stored per hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from adtally.session import materialize

SHIFT = 33  # monotonically_increasing_id puts the partition above the row's place in it


def dense_numbers(values: DataFrame, value: str, known: DataFrame | None = None) -> DataFrame:
    """``value, number`` for every distinct non-NULL value, numbered without gaps from 1, as bitmap buckets begin there.

    Values in ``known`` (an earlier result) keep their numbers and new ones go on behind them, so stored bitmaps stay true.
    Values are numbered where they lie; only the number of values in each partition is added up in one place.
    """
    fresh = values.select(value).where(F.col(value).isNotNull()).distinct()
    begin = 1
    if known is not None:
        fresh = fresh.join(known.select(value), value, "left_anti")
        last = known.agg(F.max("number")).first()[0]
        begin = 1 if last is None else last + 1
    placed = materialize(fresh.withColumn("_place", F.monotonically_increasing_id()), "dense-numbers")
    part = F.shiftright("_place", SHIFT).alias("_part")
    sizes = placed.groupBy(part).agg(F.count("*").alias("_n"))  # a row per partition of the distinct values
    ahead = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    number = F.lit(begin) + F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << SHIFT) - 1))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(value, number.cast("long").alias("number"))
    return numbered if known is None else known.select(value, "number").unionByName(numbered)


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], number: str = "number") -> DataFrame:
    """``keys, bucket, bitmap``: which numbers occur, as bitmaps of 32,768 bits, combined in the scan's own tasks."""
    known = df.where(F.col(number).isNotNull())
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap")
    return known.groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket")).agg(bits)


def merged(bitmaps: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Bitmaps of coarser keys; the log is not read again."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counted(bitmaps: DataFrame, keys: Sequence[str | Column], name: str = "n") -> DataFrame:
    """Exact number of distinct values per key."""
    names = [k if isinstance(k, str) else bitmaps.select(k).columns[0] for k in keys]
    return merged(bitmaps, keys).groupBy(*names).agg(F.sum(F.bitmap_count("bitmap")).alias(name))


def trailing_counts(daily: DataFrame, keys: Sequence[str], day: str, days: int, name: str = "n") -> DataFrame:
    """Distinct values of the ``days`` days up to each ``day`` (a date) on which the key has any, from daily bitmaps."""
    ahead = F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("_ahead")
    spread = daily.select(*keys, F.col(day).alias("_day"), "bucket", "bitmap", ahead)
    sent = spread.groupBy(*keys, F.date_add("_day", F.col("_ahead")).alias(day), "bucket").agg(
        F.bitmap_or_agg("bitmap").alias("bitmap"), F.min("_ahead").alias("_nearest")
    )
    sums = sent.groupBy(*keys, day).agg(F.sum(F.bitmap_count("bitmap")).alias(name), F.min("_nearest").alias("_nearest"))
    return sums.where("_nearest = 0").drop("_nearest")
