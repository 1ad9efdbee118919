"""Operational feeds: installs, redirect domains, forwarded postbacks, partner and device loads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from adtally.functions import rules
from adtally.functions.numbers import sum_money
from adtally.functions.slots import compact_day, slot_of
from adtally.functions.text import contains_text, first_part, part
from adtally.operators.aggs import first_by, rollup, rollup_known_keys
from adtally.operators.filters import between_slots, last_hours, last_minutes, on_event_day, scan_day
from adtally.operators.joins import drop_listed, flag_join

# Ad types of the install feed and its cap status.
FEED_ADTYPES = ["19", "38", "20", "40"]
OPEN, OVER_CAP = 1, 2

AF_COLUMNS = [
    "agency", "pid", "campaign", "impression", "click", "ctr", "install", "cvr", "cost", "ecpi", "roi",
    "pkg", "platform",
]


def blacklist(offers: DataFrame) -> DataFrame:
    """(offer_id, af_siteid), one row per listed site."""
    listed = offers.where(F.col("site_black_value") != "")
    return listed.select(
        F.col("adv_offer").alias("offer_id"), F.explode(F.split("site_black_value", ",", -1)).alias("af_siteid")
    ).distinct()


def capped_offers(conversions: DataFrame, caps: DataFrame, day: str | None = None) -> DataFrame:
    """(offer_id, status 2) for offers whose events have reached the cap. ``caps`` is
    (offer_id, event_cap); it stays a table instead of an IN list, and events are counted
    per offer before they meet it."""
    events = conversions.where(F.col("event_type") == rules.EVENT)
    if day is not None:
        events = on_event_day(events, day)
    counted = rollup(events, ["offer_id"], event_num=F.count("*"))
    limits = rollup(caps, ["offer_id"], event_cap=F.max("event_cap"))
    return (
        counted.join(limits, "offer_id")
        .where(F.col("event_num") >= F.col("event_cap").cast("long"))
        .select("offer_id", F.lit(OVER_CAP).alias("status"))
    )


def install_feed(
    conversions: DataFrame,
    offers: DataFrame,
    caps: DataFrame,
    as_of: datetime,
    minutes: int = 10,
    cap_day: str | None = None,
) -> DataFrame:
    """Recent installs by offer and site without blacklisted sites; status 2 when the
    offer's events of the cap day (all days when None) have reached its cap, else 1."""
    recent = last_minutes(conversions, as_of, minutes).where(
        (F.col("event_type") == rules.INSTALL)
        & F.col("adtype").isin(FEED_ADTYPES)
        & (F.col("offer_pkg") != rules.FEED_EXCLUDED_PACKAGE)
    )
    counted = rollup(recent, ["offer_id", "af_siteid"], install=F.count("*"))
    clean = drop_listed(counted, blacklist(offers), ["offer_id", "af_siteid"])
    return flag_join(clean, capped_offers(conversions, caps, cap_day), ["offer_id"], "status", OPEN)


def top_domains(redirects: DataFrame, as_of: datetime, hours: int = 12) -> DataFrame:
    """Most frequent domain per channel and offer; ties go to the first domain by name."""
    counted = rollup(last_hours(redirects, as_of, hours), ["channel", "offer", "domain_tag"], n=F.sum("count"))
    return first_by(counted, ["channel", "offer"], [-F.col("n"), F.col("domain_tag")]).select(
        "channel", F.col("offer").alias("offer_id"), "domain_tag"
    )


def changed_domains(top: DataFrame, stored: DataFrame) -> DataFrame:
    """Top domains that are new, or not part of the stored tag."""
    known = stored.select("channel", "offer_id", F.col("domain_tag").alias("stored_tag"))
    joined = top.join(known, ["channel", "offer_id"], "left")
    keep = F.col("stored_tag").isNull() | ~contains_text("domain_tag", "stored_tag")
    return joined.where(F.col("domain_tag").isNotNull() & keep).select("channel", "offer_id", "domain_tag")


def forwarded_postbacks(
    direct: DataFrame, first: str | None = None, last: str | None = None, pdate: str | None = None
) -> DataFrame:
    """Postbacks of an hour range; ``pdate`` prunes the partition."""
    rows = direct if pdate is None else scan_day(direct, "pdate", pdate)
    return between_slots(rows.withColumn("time_slot", slot_of("update_time")), first, last).select(
        "pb_channel", "pb_channel_id", "offer", "time_slot", "clk_id"
    )


def install_day(installs: DataFrame, day: str | None = None) -> DataFrame:
    """All columns plus the hour bucket of the install, for one day."""
    rows = installs if day is None else on_event_day(installs, day, "install_time")
    return rows.withColumn("time_slot", slot_of("install_time"))


def normalize_af_report(af_report: DataFrame, day: str | None = None) -> DataFrame:
    """One day with the publisher prefix as pid and a platform label."""
    rows = af_report if day is None else scan_day(af_report, "date", day)
    return rows.withColumns({"pid": first_part("pid"), "platform": rules.platform_label()}).select(*AF_COLUMNS)


def device_inventory(models: DataFrame, date: str) -> DataFrame:
    """Devices per ``country_platform_pkg`` key, split into columns."""
    counted = rollup(models, ["key"], device_num=F.count("*"))
    return counted.select(
        F.lit(date).alias("date"),
        part("key", 1).alias("country"),
        rules.platform_number_strict(part("key", 2), "android").alias("platform"),
        part("key", 3).alias("pkg_name"),
        "device_num",
    )


def device_counts(settings: DataFrame, iso_day: str | None = None) -> DataFrame:
    """Device settings with a compact day and platform labels, NULL when unknown."""
    rows = settings if iso_day is None else scan_day(settings, "day", iso_day)
    return rows.select(
        compact_day("day").alias("day"), rules.platform_from_number().alias("platform"),
        "country", "source", "label", "slot_id", "device_count",
    )


def partner_report(lines: DataFrame) -> DataFrame:
    """Partner measures summed per day, platform, channel, country and package."""
    keys: Sequence[str] = ["date", "channel_type", "platform", "channel", "country", "pkg"]
    return rollup_known_keys(
        lines, keys,
        conversion=F.sum("conversion"), revenue=sum_money("revenue"), cost=sum_money("cost"),
        click=F.sum("click"), install=F.sum("install"),
    )
