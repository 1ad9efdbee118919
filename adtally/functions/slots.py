"""Hour buckets (``yyyyMMddHH``), days (``yyyyMMdd`` or ``yyyy-MM-dd``) and look-backs.

Buckets stay strings: they are partition keys and compare correctly as text.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

SLOT = "yyyyMMddHH"
DAY = "yyyyMMdd"
ISO_DAY = "yyyy-MM-dd"
MINUTE_SLOT = "yyyyMMddHHmm"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def slot_of(ts) -> Column:
    return F.date_format(_c(ts), SLOT)


def event_day(ts) -> Column:
    return F.date_format(_c(ts), DAY)


def minute_slot(ts) -> Column:
    return F.date_format(_c(ts), MINUTE_SLOT)


def day_of(slot) -> Column:
    """Day part of an hour bucket; position 1, never 0, so all engines agree."""
    return F.substring(_c(slot), 1, 8)


def hour_of(slot) -> Column:
    return F.substring(_c(slot), 9, 2)


def slot_ts(slot) -> Column:
    return F.to_timestamp(_c(slot), SLOT)


def shift_slot(slot, hours: int) -> Column:
    """The bucket ``hours`` later (negative: earlier), across midnight."""
    return F.date_format(slot_ts(slot) + F.make_dt_interval(hours=F.lit(hours)), SLOT)


def iso_day(day) -> Column:
    """``yyyyMMdd`` to ``yyyy-MM-dd``."""
    return F.date_format(F.to_date(_c(day), DAY), ISO_DAY)


def compact_day(day) -> Column:
    """``yyyy-MM-dd`` to ``yyyyMMdd``."""
    return F.replace(_c(day), F.lit("-"), F.lit(""))


def as_date(slot) -> Column:
    return F.to_date(day_of(slot), DAY)


def instant(as_of: datetime) -> Column:
    """A UTC instant as a timestamp, whatever the time zone of the driver process is."""
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp")


def day_start(day: str) -> Column:
    """First instant of a ``yyyyMMdd`` day, as a literal."""
    return F.lit(datetime.strptime(day, "%Y%m%d").isoformat(sep=" ")).cast("timestamp")


def day_end(day: str) -> Column:
    """First instant after a ``yyyyMMdd`` day, as a literal."""
    return F.lit((datetime.strptime(day, "%Y%m%d") + timedelta(days=1)).isoformat(sep=" ")).cast("timestamp")


# --- job parameters: plain Python, always from an explicit instant -----------------


def day_bounds(day: str) -> tuple[str, str]:
    """First and last hour bucket of a day."""
    return f"{day}00", f"{day}23"


def iso_text(day: str | None) -> str | None:
    """``yyyyMMdd`` as ``yyyy-MM-dd``."""
    return day and f"{day[:4]}-{day[4:6]}-{day[6:]}"


def slot_instant(slot: str) -> datetime:
    """First instant of an hour bucket."""
    return datetime.strptime(slot, "%Y%m%d%H")


def slot_before(as_of: datetime, hours: int = 1) -> str:
    return (as_of - timedelta(hours=hours)).strftime("%Y%m%d%H")


def day_before(as_of: datetime, days: int = 1) -> str:
    return (as_of - timedelta(days=days)).strftime("%Y%m%d")


def trailing_days(as_of: datetime, days: int) -> tuple[str, str]:
    """Bucket bounds of the ``days`` full days before ``as_of``."""
    first = (as_of - timedelta(days=days)).strftime("%Y%m%d")
    return f"{first}00", f"{day_before(as_of)}23"


def buckets_between(first: str, last: str, grain: str = "hour") -> list[str]:
    """All hour buckets, or all days, from one bucket to another."""
    at, end = (datetime.strptime(x, "%Y%m%d%H") for x in (first, last))
    step, form = (timedelta(hours=1), "%Y%m%d%H") if grain == "hour" else (timedelta(days=1), "%Y%m%d")
    if grain != "hour":
        at, end = at.replace(hour=0), end.replace(hour=0)
    return [(at + k * step).strftime(form) for k in range(int((end - at) / step) + 1)]
