"""Pacing, cap and quota counters that steer delivery."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from adtally.functions import rules
from adtally.functions.numbers import half_even, truncated
from adtally.functions.slots import day_of, event_day, hour_of, iso_day
from adtally.functions.text import last_part, pack
from adtally.operators.aggs import first_by, rollup, with_defaults
from adtally.operators.filters import all_flags, between_days, between_slots, last_minutes, only, since as since_slot
from adtally.operators.joins import enrich, inner_join
from adtally.plans.rates import offer_map

# Ad type lists and rate constants of the counters.
UNPACED_ADTYPES = ["19", "38"]
CAPPED_ADTYPES = ["38", "39"]
PACING_SCALE = 10_000
HIDDEN_ADTYPE = "12"
QUOTA_SHARE = 0.9
COUNTED_SLOTS = ["62858868", "66725501"]
QUOTA_SLOTS = [
    "70403608", "42015747", "54839808", "32314900", "41571384", "54478080", "89851019", "31070908",
    "29342889", "43396577", "67349955", "63227553", "94855622", "85037174", "24721785", "78681516",
]


def target_pacing(conversions: DataFrame, offers: DataFrame, as_of: datetime, minutes: int = 5) -> DataFrame:
    """Conversions per minute in target units for every active offer with a target.

    An offer listed several times keeps its last listing (by listing id).
    """
    recent = last_minutes(conversions, as_of, minutes).where(F.col("event_type") != rules.INSTALL)
    counted = rollup(
        recent.where(~F.col("adtype").isin(UNPACED_ADTYPES)), ["channel", "offer_id"], conv=F.count("*")
    )
    active = all_flags(offers, channel_type=2, status=1, adv_status=1, cvr_status=1).select(
        "id", "channel", last_part("adv_offer").alias("offer_id"), "target_cvr"
    )
    paced = enrich(active, (counted, ["channel", "offer_id"])).na.drop(subset=["target_cvr"])
    value = F.col("conv") / F.col("target_cvr") * F.lit(float(PACING_SCALE)) / F.lit(float(minutes))
    rows = paced.where(F.col("target_cvr") > 0).select(
        pack("channel", "offer_id").alias("key"),
        F.coalesce(half_even(value), F.lit(0.0)).cast("long").alias("value"),
        "id",
    )
    return first_by(rows, ["key"], [-F.col("id")]).select("key", "value")


def cap_daily_counts(
    conversions: DataFrame, offers: DataFrame, first_day: str | None = None, last_day: str | None = None, ranked: bool = True
) -> DataFrame:
    """Installs of capped ad types per event day, with the internal offer, largest first.
    Installs of unlisted offers stay, without a key. ``ranked=False`` spares the global sort."""
    rows = (
        only(between_days(conversions, first_day, last_day), "adtype", CAPPED_ADTYPES)
        .where(F.col("event_type") == rules.INSTALL)
        .withColumns({"event_day": event_day("utctime"), "day": day_of("time_slot")})
    )
    counted = rollup(
        rows,
        ["event_day", "channel", "offer_id", "country", "slot", "day"],
        count=F.count("*"),
    )
    named = enrich(counted, (offer_map(offers), ["channel", "offer_id", "country"]))
    out = named.select("event_day", "offer", "slot", "count", pack("offer", "slot").alias("key"))
    return out.orderBy(F.desc("count")) if ranked else out


def click_counters(
    routed: DataFrame,
    slots: Sequence[str] | None = COUNTED_SLOTS,
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """Click-throughs per day, routed offer and slot, keyed ``offer_slot``."""
    clicked = only(between_slots(routed, first, last), "slot", slots).where(
        F.col("click_through") == rules.CLICKED_THROUGH
    )
    counted = rollup(
        clicked.withColumn("day", day_of("time_slot")), ["day", "routed_offer", "slot"], value=F.count("*")
    )
    return counted.select("day", pack("routed_offer", "slot").alias("key"), "value")


def affiliate_revenue(
    conversions: DataFrame, affiliates: DataFrame, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Affiliate offers' conversions per hour, and their revenue at the offer payout."""
    keys = ["time_slot", "channel", "offer", "slot", "country", "platform", "pkg"]
    counted = rollup(between_slots(conversions, first, last), keys, conversion=F.sum("count"))
    listed = rollup(
        affiliates.withColumnRenamed("ssp_offer_id", "offer"),
        ["id", "offer", "channel"],
        slot=F.min("slot"),
        payout=F.sum("payout"),
    )
    joined = inner_join(counted, listed, ["offer", "slot", "channel"])
    zero = F.lit(0).cast("long")
    return joined.select(
        iso_day(day_of("time_slot")).alias("date"),
        hour_of("time_slot").alias("hour"),
        "country", "platform", "pkg",
        F.col("id").alias("offer"),
        zero.alias("impression"), zero.alias("click"), "conversion",
        (F.col("conversion") * F.col("payout")).alias("revenue"),
    )


def affiliate_cap_counters(
    conversions: DataFrame, affiliates: DataFrame, since: str | None, key_suffix: str = "cap"
) -> DataFrame:
    """Conversions since a bucket for every affiliate offer that has any."""
    counted = rollup(since_slot(conversions, since), ["channel", "offer", "slot"], conv=F.sum("count"))
    listed = rollup(
        affiliates.withColumnRenamed("ssp_offer_id", "offer"), ["id", "offer", "channel"], slot=F.min("slot")
    )
    return inner_join(listed, counted, ["offer", "slot", "channel"]).where(F.col("conv").isNotNull()).select(
        pack("id", F.lit(key_suffix)).alias("key"), truncated("conv").alias("value")
    )


def slot_quota(
    impressions: DataFrame, slots: DataFrame, since: str | None = None, key_prefix: str = "summer"
) -> DataFrame:
    """Visible impressions of the listed slots, divided by the quota share and truncated;
    a listed slot without impressions gets 0. ``slots`` is a one-column (slot) table."""
    visible = since_slot(impressions, since).where((F.col("visible") == "1") & (F.col("adtype") != HIDDEN_ADTYPE))
    shown = rollup(visible, ["slot"], shown=F.sum("count"))
    value = truncated(F.col("shown") / F.lit(QUOTA_SHARE))
    quota = with_defaults(slots, shown.select("slot", value.alias("value")), "slot", "value", 0)
    return quota.select(pack(F.lit(key_prefix), "slot").alias("key"), "value")
