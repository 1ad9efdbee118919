"""Row selection by time bucket, key and look-back. Predicates stay on bare columns
so that they reach partition pruning and the parquet reader."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from adtally.functions import rules
from adtally.functions.slots import day_bounds, day_end, day_start, instant


def at_slot(df: DataFrame, slot: str, col: str = "time_slot") -> DataFrame:
    return df.where(F.col(col) == slot)


def between_slots(df: DataFrame, first: str | None, last: str | None, col: str = "time_slot") -> DataFrame:
    """Closed bucket range; an open end is None."""
    if first is not None:
        df = df.where(F.col(col) >= first)
    if last is not None:
        df = df.where(F.col(col) <= last)
    return df


def in_day(df: DataFrame, day: str, col: str = "time_slot") -> DataFrame:
    return between_slots(df, *day_bounds(day), col)


def since(df: DataFrame, slot: str | None, col: str = "time_slot") -> DataFrame:
    return between_slots(df, slot, None, col)


def like_day(df: DataFrame, day: str, col: str = "time_slot") -> DataFrame:
    return df.where(F.col(col).startswith(day))


def between_days(df: DataFrame, first: str | None, last: str | None, ts: str = "utctime") -> DataFrame:
    """Rows of a range of event days, as half-open bounds on the bare timestamp."""
    if first is not None:
        df = df.where(F.col(ts) >= day_start(first))
    if last is not None:
        df = df.where(F.col(ts) < day_end(last))
    return df


def on_event_day(df: DataFrame, day: str, ts: str = "utctime") -> DataFrame:
    return between_days(df, day, day, ts)


def scan_day(df: DataFrame, col: str, day: str) -> DataFrame:
    """Single-day slice on a stored day key."""
    return df.where(F.col(col) == day)


def last_minutes(df: DataFrame, as_of: datetime, minutes: int, ts: str = "utctime") -> DataFrame:
    """Look-back by instant, so it also works in the first minutes of an hour."""
    end = instant(as_of)
    return df.where(F.col(ts) >= end - F.make_dt_interval(mins=F.lit(minutes))).where(F.col(ts) < end)


def last_hours(df: DataFrame, as_of: datetime, hours: int, ts: str = "created") -> DataFrame:
    return last_minutes(df, as_of, hours * 60, ts)


def since_minute(df: DataFrame, bucket: str, ts: str = "utctime") -> DataFrame:
    """Look-back from a minute bucket."""
    return df.where(F.col(ts) >= instant(datetime.strptime(bucket, "%Y%m%d%H%M")))


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows whose keys are all non-empty (NULL is dropped too)."""
    return df.where(rules.non_empty(*cols))


def only(df: DataFrame, col: str, values: Sequence[str] | None) -> DataFrame:
    """IN list; None keeps everything."""
    return df if values is None else df.where(F.col(col).isin(list(values)))


def all_flags(df: DataFrame, **expected) -> DataFrame:
    """Conjunction of equality flags on a dimension."""
    test: Column = F.lit(True)
    for name, value in expected.items():
        test = test & (F.col(name) == value)
    return df.where(test)
