"""Overlapping look-backs over a stream: closed panes are stored once, and each batch adds the look-backs that its panes complete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from adtally.operators.panes import as_of, look_backs, pane_number
from adtally.streaming.counters import tumbling

DAY_PANES = 24 * 60


def pane_stream(stream: DataFrame, ts: str, keys: Sequence[str], late_by: str, **measures: Column) -> DataFrame:
    """``keys, pane`` and whole-number measures of every closed minute; the state holds open minutes only."""
    sums = tumbling(stream, ts, "1 minute", keys, late_by, **measures)
    return sums.select(*keys, pane_number(F.col("bucket")).alias("pane"), *measures)


def run_look_backs(panes: DataFrame, keys: Sequence[str], sizes: Sequence[int], path: str, checkpoint: str) -> StreamingQuery:
    """Keep ``path/panes`` and ``path/look-backs``, each partitioned by day number and batch.

    Closed minutes arrive in order, so after a batch everything up to its last minute is final: the batch adds the
    look-backs that end after the last minute of earlier batches, and not after its own. It reads the stored panes of the
    longest look-back before that, by their days. A replayed batch sees the same earlier batches and overwrites its own folders.
    """
    spark, longest, schema = panes.sparkSession, max(sizes), panes.schema
    stored = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields], "day long", "batch long"])

    def save(df: DataFrame, name: str, at: str, batch: int) -> None:
        placed = df.withColumn("day", F.floor(F.col(at) / DAY_PANES)).withColumn("batch", F.lit(batch).cast("long"))
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("day", "batch").parquet(f"{path}/{name}")

    def step(batch: DataFrame, number: int) -> None:
        save(batch, "panes", "pane", number)
        every = spark.read.schema(stored).parquet(f"{path}/panes")
        # the bounds of a batch are two numbers
        newest = every.where(F.col("batch") == number).agg(F.max("pane")).first()[0]
        if newest is None:
            return
        before = every.where(F.col("batch") < number).agg(F.max("pane")).first()[0]
        needed = every.where(F.col("batch") <= number)
        if before is not None:
            low = before + 1 - longest
            needed = needed.where(F.col("day") >= low // DAY_PANES).where(F.col("pane") >= low)
        done = look_backs(needed.drop("day", "batch"), keys, sizes, None if before is None else before + 2, newest + 1)
        save(done, "look-backs", "upto", number)

    return panes.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(step).trigger(availableNow=True).start()


def stored_look_backs(panes: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """``keys, size, as_of`` and the measures of everything stored so far."""
    measures = [f for f in panes.schema.fields if f.name not in (*keys, "pane")]
    kinds = {f.name: f.dataType.simpleString() for f in panes.schema.fields}
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "size int", "upto long", *[f"`{f.name}` long" for f in measures], "day long", "batch long"])
    return as_of(panes.sparkSession.read.schema(schema).parquet(f"{path}/look-backs").drop("day", "batch"))
