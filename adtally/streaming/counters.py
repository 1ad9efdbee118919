"""Tumbling and cumulative counters over the conversion and click streams.

State is bounded by the watermark. Sinks go through ``foreachBatch`` into idempotent
loads, so a replayed batch leaves the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from adtally.functions import rules
from adtally.functions.numbers import count_where, from_units, to_units
from adtally.functions.slots import DAY, MINUTE_SLOT, SLOT, buckets_between
from adtally.functions.text import pack
from adtally.sinks.keyed import upsert_kv
from adtally.sinks.tables import replace_partition, store_batch

HOURLY, INSTALL_LOOKBACK, PACING_LOOKBACK, DAILY = "1 hour", "10 minutes", "5 minutes", "1 day"


def tumbling(
    stream: DataFrame, ts: str, size: str, keys: Sequence[str], late_by: str, **measures: Column
) -> DataFrame:
    """Measures per tumbling window and key; the window start is column ``bucket``."""
    grouped = stream.withWatermark(ts, late_by).groupBy(F.window(ts, size), *keys)
    out = grouped.agg(*[m.alias(n) for n, m in measures.items()])
    return out.select(F.col("window.start").alias("bucket"), *keys, *measures)


def hourly_conversions(stream: DataFrame, late_by: str = "2 hours") -> DataFrame:
    """Installs, events, revenue and cost per closed hour, offer, country and channel."""
    keys = ["offer_id", "country", "channel"]
    sums = tumbling(
        stream, "utctime", HOURLY, keys, late_by,
        install=count_where(F.col("event_type") == rules.INSTALL),
        conv=count_where(F.col("event_type") == rules.EVENT),
        revenue=F.sum(to_units("payout")),
        cost=F.sum(to_units("cost")),
    )
    return sums.select(
        *keys, "install", "conv", from_units("revenue").alias("revenue"), from_units("cost").alias("cost"),
        F.date_format("bucket", SLOT).alias("time_slot"),
    )


def install_windows(stream: DataFrame, late_by: str = "10 minutes") -> DataFrame:
    """Installs per ten-minute window, offer and site."""
    installs = stream.where(F.col("event_type") == rules.INSTALL)
    sums = tumbling(installs, "utctime", INSTALL_LOOKBACK, ["offer_id", "af_siteid"], late_by, install=F.count("*"))
    return sums.select(F.date_format("bucket", MINUTE_SLOT).alias("minute_slot"), "offer_id", "af_siteid", "install")


def pacing_windows(stream: DataFrame, late_by: str = "5 minutes") -> DataFrame:
    """Events per five-minute window, channel and offer."""
    events = stream.where((F.col("event_type") != rules.INSTALL) & ~F.col("adtype").isin("19", "38"))
    sums = tumbling(events, "utctime", PACING_LOOKBACK, ["channel", "offer_id"], late_by, conv=F.count("*"))
    return sums.select(F.date_format("bucket", MINUTE_SLOT).alias("minute_slot"), "channel", "offer_id", "conv")


def daily_clicks(stream: DataFrame, late_by: str = "1 day") -> DataFrame:
    """Click-throughs of the day so far, as day, key and value; use with update mode."""
    clicks = stream.where(F.col("click_through") == rules.CLICKED_THROUGH)
    sums = tumbling(clicks, "created", DAILY, ["routed_offer", "slot"], late_by, value=F.count("*"))
    return sums.select(
        F.date_format("bucket", DAY).alias("day"),
        pack("routed_offer", "slot").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def run_closed_windows(windows: DataFrame, table: str, checkpoint: str, name: str = "windows") -> StreamingQuery:
    """Append mode: each window arrives once, complete.

    A table partitioned by day and batch gets every batch in folders of its own (see ``store_batch``; ``name`` tells
    queries on one table apart); in a table partitioned by the window, each window replaces its partition, which suits hours at
    most. Other tables are refused: there, each batch would replace what earlier batches stored.
    """
    keys = {c.name for c in windows.sparkSession.catalog.listColumns(table) if c.isPartition}
    slots = [c for c in ("time_slot", "minute_slot") if c in windows.columns]
    if {"day", "batch"} <= keys and slots:
        store = lambda batch, number: store_batch(batch, table, f"{name}-{number}", slots[0])
    elif keys & {"time_slot", "minute_slot"}:
        store = lambda batch, _: replace_partition(batch, table)
    else:
        raise ValueError(f"{table} must be partitioned by day and batch, or by the window (time_slot or minute_slot)")
    return (
        windows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )


def run_cumulative(counters: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Update mode: changed counters overwrite their stored value. The snapshot is partitioned
    by day, so a batch rewrites the days it touches and leaves the history alone."""

    def store(batch: DataFrame, _: int) -> None:
        batch = batch.persist()  # read for its days and for its rows
        try:
            upsert_kv(batch.sparkSession, batch, path, partition_by="day")
        finally:
            batch.unpersist()

    return (
        counters.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )


def recompute_trailing(report: Callable[[str, str], DataFrame], table: str, first: str, last: str, grain: str = "hour") -> None:
    """Late data: recompute a trailing bucket range and replace every partition in it, also those left without rows.

    ``grain`` is that of the table's partitions, ``hour`` or ``day``.
    """
    replace_partition(report(first, last), table, covers=buckets_between(first, last, grain))
