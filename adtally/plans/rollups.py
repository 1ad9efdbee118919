"""Daily and hourly rollups of the counter logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from adtally.functions import rules
from adtally.functions.numbers import from_units, sum_money, to_units, whole_share
from adtally.functions.slots import as_date, day_of, hour_of
from adtally.functions.text import pack
from adtally.operators.aggs import rollup, share_of_total
from adtally.operators.filters import between_slots, only, require
from adtally.operators.joins import merge_sums

SLOT_KEYS = ["time_slot", "slot", "country"]
# The listed channels and ad types of the impression/click report.
LISTED_CHANNELS = ["huk", "bin", "rcm4", "mbg", "real"]
LISTED_ADTYPES = ["0", "1", "2", "5", "6", "7", "10", "13", "14", "15", "16", "17"]
REQUEST_ADTYPE = "3"
HIDDEN_ADTYPE = "12"
HOME_COUNTRY = "CN"


def _slot_rollup(df: DataFrame, since: str | None, test: Column | None = None, **sums: Column) -> DataFrame:
    rows = between_slots(df, since, None)
    return rollup(rows if test is None else rows.where(test), SLOT_KEYS, c=F.sum("count"), **sums)


def slot_requests(requests: DataFrame, since: str | None = None) -> DataFrame:
    return _slot_rollup(requests, since, F.col("visible") == "1", filled=F.sum("filled"))


def slot_listed_requests(requests: DataFrame, since: str | None = None) -> DataFrame:
    return _slot_rollup(requests, since, F.col("adtype") == REQUEST_ADTYPE, filled=F.sum("filled"))


def slot_impressions(impressions: DataFrame, since: str | None = None) -> DataFrame:
    shown = (F.col("visible") == "1") & (F.col("adtype") != HIDDEN_ADTYPE)
    return _slot_rollup(impressions, since, shown)


def _sum_where(test: Column, x: str) -> Column:
    """NULL where no row passes, so that absent groups can be told from zero."""
    return F.sum(F.when(test, F.col(x)))


def request_rollups(requests: DataFrame, since: str | None = None) -> DataFrame:
    """Both request rollups from one scan; a pair is NULL where it has no rows."""
    visible, listed = F.col("visible") == "1", F.col("adtype") == REQUEST_ADTYPE
    return rollup(
        between_slots(requests, since, None).where(visible | listed), SLOT_KEYS,
        visible_c=_sum_where(visible, "count"), visible_filled=_sum_where(visible, "filled"),
        listed_c=_sum_where(listed, "count"), listed_filled=_sum_where(listed, "filled"),
    )


def impression_rollups(impressions: DataFrame, since: str | None = None) -> DataFrame:
    """Shown impressions and hidden ones (all clicks) from one scan; NULL where no rows."""
    shown = (F.col("visible") == "1") & (F.col("adtype") != HIDDEN_ADTYPE)
    hidden = F.col("visible") == "0"
    return rollup(
        between_slots(impressions, since, None).where(shown | hidden), SLOT_KEYS,
        shown_c=_sum_where(shown, "count"), hidden_c=_sum_where(hidden, "count"),
    )


def part_of(both: DataFrame, prefix: str) -> DataFrame:
    """One rollup of a pair, under its own column names."""
    own = [c for c in both.columns if c.startswith(f"{prefix}_")]
    return both.where(F.col(f"{prefix}_c").isNotNull()).select(
        *SLOT_KEYS, *[F.col(c).alias(c.removeprefix(f"{prefix}_")) for c in own]
    )


def slot_clicks(clicks: DataFrame, since: str | None = None) -> DataFrame:
    return _slot_rollup(clicks, since)


def slot_all_clicks(impressions: DataFrame, since: str | None = None) -> DataFrame:
    return _slot_rollup(impressions, since, F.col("visible") == "0")


def slot_conversions(conversions: DataFrame, since: str | None = None) -> DataFrame:
    return _slot_rollup(conversions, since, p=sum_money("payout"))


def offer_conv_click(
    conversions: DataFrame, impressions: DataFrame, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Conversions and revenue per offer, platform, country, day and package, with clicks.
    Clicks are NULL where the offer had none."""
    keys = ["offer", "platform", "country", "date", "pkg"]
    shared = [pack("channel", "offer").alias("offer"), "platform", "country", as_date("time_slot").alias("date"), "pkg"]

    def rows(df: DataFrame) -> DataFrame:
        return require(between_slots(df, first, last), "pkg")

    merged = merge_sums(
        rows(conversions).select(*shared, "count", to_units("payout").alias("revenue")),
        rows(impressions).select(*shared, F.col("count").alias("click")),
        keys,
        "left",
    )
    return merged.withColumn("revenue", from_units("revenue"))


def offer_share(
    impressions: DataFrame, conversions: DataFrame, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Per day and channel: offers with clicks, offers with conversions, payout, and their
    percentages of the day. Payout shares use whole currency units."""
    keys = ["day", "channel", "offer"]

    def rows(df: DataFrame) -> DataFrame:
        return between_slots(df, first, last).withColumn("day", day_of("time_slot"))

    per_offer = merge_sums(
        rows(impressions).select(*keys, F.lit(1).alias("clicked")),
        rows(conversions).select(*keys, F.lit(1).alias("converted"), to_units("payout").alias("payout_u")),
        keys,
        "left",
    )
    per_channel = rollup(
        per_offer, ["day", "channel"],
        click_offer_num=F.count("*"),
        conv_offer_num=F.count("converted"),
        payout_u=F.sum("payout_u"),
    )
    totals = {"all_click": "click_offer_num", "all_conv": "conv_offer_num", "all_payout": "payout_u"}
    return share_of_total(per_channel, totals, ["day"]).select(
        "day", "channel",
        "click_offer_num", whole_share("click_offer_num", "all_click").alias("click_offer_rate"),
        "conv_offer_num", whole_share("conv_offer_num", "all_conv").alias("conv_offer_rate"),
        whole_share("conv_offer_num", "all_click").alias("conv_all_offer_rate"),
        from_units("payout_u").alias("payout"),
        whole_share(from_units("payout_u"), from_units("all_payout")).alias("payout_rate"),
    )


def day_platform_report(
    impressions: DataFrame, conversions: DataFrame, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Clicks and conversions by day, hour, platform, country and channel outside the home
    country; a measure without rows is 0."""
    keys = ["day", "hour", "platform", "country", "channel"]

    def rows(df: DataFrame) -> DataFrame:
        kept = between_slots(df, first, last).where(F.col("country") != HOME_COUNTRY)
        return kept.withColumns({"day": day_of("time_slot"), "hour": hour_of("time_slot")})

    merged = merge_sums(
        rows(impressions).select(*keys, F.col("count").alias("click")),
        rows(conversions).select(*keys, F.col("count").alias("conv"), to_units("payout").alias("payout")),
        keys,
    )
    filled = merged.na.fill(0, ["click", "conv", "payout"])
    return filled.withColumn("payout", from_units("payout"))


def imp_click(
    impressions: DataFrame,
    clicks: DataFrame,
    first: str | None = None,
    last: str | None = None,
    channels: Sequence[str] | None = LISTED_CHANNELS,
    adtypes: Sequence[str] | None = LISTED_ADTYPES,
) -> DataFrame:
    """Impressions of listed channels and ad types with their clicks, NULL where none."""
    keys = ["date", "platform", "adtype", "country", "channel", "offer"]

    def rows(df: DataFrame) -> DataFrame:
        listed = only(only(between_slots(df, first, last), "channel", channels), "adtype", adtypes)
        return listed.withColumn("date", day_of("time_slot"))

    return merge_sums(
        rows(impressions).select(*keys, F.col("count").alias("imp")),
        rows(clicks).select(*keys, F.col("count").alias("click")),
        keys,
        "left",
    )


def offer_slot_conv(conversions: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Conversions and payout by day, country code, channel, offer and slot."""
    rows = between_slots(conversions, first, last).where(rules.country_code("country", at_most=2))
    return rollup(
        rows.withColumn("day", day_of("time_slot")), ["day", "country", "channel", "offer", "slot"],
        conv=F.sum("count"), payout=sum_money("payout"),
    )
