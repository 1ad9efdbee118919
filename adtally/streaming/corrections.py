"""Late corrections: hourly sums are sent when their hour has ended, and what arrives later as signed differences.

The keyed state of an hour holds its sums and whether they were sent. Rows up to ``horizon`` late are
taken; a row for an hour already sent leaves at once as a correction, so the sum of all rows sent for
a key and hour is what a report over all its rows gives, at any time. When the horizon has passed the state is dropped,
so it holds the hours of one horizon, however long the stream runs. Corrections add up: a key may be dealt over salts.

The watermark trails the latest event by the horizon. An hour is sent by a timer set that much earlier, that is when the
latest event is ``grace`` past the hour's end.

State with timers has no built-in expression: groups go through Python here, in Arrow batches, a hot group in many of them.
The session needs ``spark.sql.streaming.stateStore.providerClass`` set to ``ROCKSDB``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FIRST, CORRECTION = "first", "correction"
HOUR_MS = 3_600_000


class HourSums(StatefulProcessor):
    """State and timers of one key and hour, whose start in milliseconds is the key's last part."""

    def __init__(self, keys: Sequence[str], measures: Sequence[str], grace_ms: int, horizon_ms: int):
        self.keys, self.measures, self.grace_ms, self.horizon_ms = list(keys), list(measures), grace_ms, horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = [*[StructField(m, LongType()) for m in self.measures], StructField("sent", BooleanType())]
        self.handle, self.held = handle, handle.getValueState("sums", StructType(fields))

    def _out(self, key: tuple, kind: str, sums: Sequence[int]) -> pd.DataFrame:
        return pd.DataFrame([[*key, kind, *sums]], columns=[*self.keys, "kind", *self.measures]).astype({m: "int64" for m in self.measures})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        added = [0] * len(self.measures)
        for part in rows:
            added = [a + int(part[m].sum()) for a, m in zip(added, self.measures, strict=True)]
        known, end = self.held.get(), int(key[-1]) + HOUR_MS
        if known is None and timerValues.getCurrentWatermarkInMs() >= end:  # the state was dropped already
            yield self._out(key, CORRECTION, added)
            return
        if known is None:
            self.handle.registerTimer(end + self.grace_ms - self.horizon_ms)
            self.handle.registerTimer(end)
            known = (*[0] * len(self.measures), False)
        *sums, sent = known
        self.held.update((*[s + a for s, a in zip(sums, added, strict=True)], sent))
        if sent and any(added):
            yield self._out(key, CORRECTION, added)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.held.get()
        if known is None:
            return
        *sums, sent = known
        if expiredTimerInfo.getExpiryTimeInMs() >= int(key[-1]) + HOUR_MS:
            self.held.clear()
        else:
            self.held.update((*sums, True))
        if not sent:
            yield self._out(key, FIRST, sums)


def hourly_corrections(
    stream: DataFrame, ts: str, keys: Sequence[str], grace_minutes: int, horizon_hours: int, salts: int = 1, **measures: Column
) -> DataFrame:
    """``keys, hour, kind`` and whole-number measures, each a term of the sum for its key and hour.

    Use with append mode. ``grace_minutes`` is less than the horizon; rows later than the horizon are dropped, as any
    watermark does.
    """
    if not 0 <= grace_minutes < 60 * horizon_hours:
        raise ValueError("the grace must be less than the horizon")
    group = [*keys, "_salt", "_hour"]
    late = stream.withWatermark(ts, f"{horizon_hours} hours")
    placed = late.select(
        *keys, F.pmod(F.xxhash64(*stream.columns), F.lit(salts)).alias("_salt"),
        F.unix_millis(F.date_trunc("hour", F.col(ts).cast("timestamp"))).alias("_hour"), *[m.cast("long").alias(n) for n, m in measures.items()], ts,
    )
    kinds = {f.name: f.dataType for f in placed.schema.fields}
    schema = StructType(
        [*[StructField(k, kinds[k]) for k in group], StructField("kind", StringType()), *[StructField(m, LongType()) for m in measures]]
    )
    terms = placed.groupBy(*group).transformWithStateInPandas(
        statefulProcessor=HourSums(group, list(measures), grace_minutes * 60_000, horizon_hours * HOUR_MS),
        outputStructType=schema, outputMode="Append", timeMode="EventTime",
    )
    return terms.select(*keys, F.timestamp_millis("_hour").alias("hour"), "kind", *measures)


def summed(terms: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The report that the terms sent so far add up to."""
    return terms.groupBy(*keys, "hour").agg(*[F.sum(m).alias(m) for m in measures])
