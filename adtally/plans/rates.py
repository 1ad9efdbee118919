"""Conversion rates: realtime by offer, by hour cut-off, and status against targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from adtally.functions import rules
from adtally.functions.numbers import half_even, half_up, hundredths, ratio, ratio_or_zero, short_decimal, zero_if_missing
from adtally.functions.slots import compact_day, day_bounds, day_of, event_day, hour_of, iso_text
from adtally.functions.text import last_part, pack
from adtally.operators.filters import between_days, between_slots, only
from adtally.operators.joins import inner_join, merge_sums
from adtally.operators.shape import union_all
from adtally.sinks.keyed import update_from

# Click scale of each source, and the ad types that count as clicks.
CLICK_SCALE = 10_000
DAILY_CLICK_SCALE = 1_000
CLICK_ADTYPES = ["3", "8", "9"]
HOURLY_INSTALL_ADTYPES = ["19", "38"]

OFFER_KEYS = ["day", "offer_id", "country", "channel"]


def offer_map(offers: DataFrame) -> DataFrame:
    """Internal offer by channel, advertiser offer and country."""
    return offers.select(
        "channel", last_part("adv_offer").alias("offer_id"), "country", F.col("offer_id").alias("offer")
    )


def _scaled(df: DataFrame, keys: Sequence, clicks: Column, scale: float) -> DataFrame:
    """Clicks in ``scale`` units, rounded to hundredths per group and kept as whole hundredths."""
    sums = df.groupBy(*keys).agg(clicks.alias("clicks"))
    return sums.select(*OFFER_KEYS, hundredths("clicks", scale).alias("click_h"))


def _of_days(df: DataFrame, first_day: str | None, last_day: str | None) -> DataFrame:
    """Hour buckets of a range of days, as bounds on the bare bucket."""
    return between_slots(df, first_day and day_bounds(first_day)[0], last_day and day_bounds(last_day)[1])


def realtime_cvr(
    stream: DataFrame,
    routed: DataFrame,
    synced: DataFrame,
    daily: DataFrame,
    conversions: DataFrame,
    first_day: str | None = None,
    last_day: str | None = None,
    scale: float = CLICK_SCALE,
    daily_scale: float = DAILY_CLICK_SCALE,
) -> DataFrame:
    """Clicks (in scaled units), attributable conversions and their ratio per day, offer,
    country and channel, over four click logs. Each log is rounded before the sum."""

    def dated(df: DataFrame) -> DataFrame:
        return _of_days(df, first_day, last_day).withColumn("day", day_of("time_slot"))

    keyed = rules.non_empty("country", "channel")
    package = rules.without_token("offer_pkg")
    day = compact_day("day")
    sources = union_all(
        _scaled(
            dated(stream).where(keyed & package & rules.non_empty("offer_id") & (F.col("clk_count") > 0)),
            OFFER_KEYS, F.sum("clk_count"), scale,
        ),
        _scaled(
            dated(routed)
            .where(keyed & package & (F.col("click_through") == rules.CLICKED_THROUGH))
            .withColumnRenamed("offer_id", "raw_offer")
            .withColumn("offer_id", rules.routed_offer(offer="raw_offer")),
            [*OFFER_KEYS, "adtype", "raw_offer"], F.count("*"), scale,
        ),
        _scaled(dated(synced).where(keyed & package), OFFER_KEYS, F.sum("clk_count"), scale),
        _scaled(
            between_slots(only(daily, "adtype", CLICK_ADTYPES), iso_text(first_day), iso_text(last_day), "day").withColumn("day", day),
            OFFER_KEYS, F.sum("count"), daily_scale,
        ),
    )
    counted = (
        dated(conversions)
        .where(event_day("utctime") >= F.col("day"))
        .where(rules.attributable() & package & rules.non_empty("offer_id") & keyed)
        .select(*OFFER_KEYS, F.lit(1).cast("long").alias("conversion"))
    )
    click = F.coalesce(F.col("click_h") / F.lit(100.0), F.lit(0.0))
    rate = F.when(click > 0, ratio("conversion", click))
    return (
        merge_sums(sources, counted, OFFER_KEYS)
        .withColumn("conversion", F.coalesce("conversion", F.lit(0)))
        .select(
            *OFFER_KEYS, click.alias("click"), "conversion",
            half_even(F.coalesce(rate, F.lit(0.0)), 2).alias("cvr"),
        )
    )


def cvr_by_hour(
    stream: DataFrame,
    conversions: DataFrame,
    first_day: str | None = None,
    last_day: str | None = None,
    click_hour: str = "23",
    install_hour: str = "23",
    scale: float = CLICK_SCALE,
) -> DataFrame:
    """Clicks up to one hour of the day against installs up to another, per day and offer.
    Offers without clicks are left out; a click count that rounds to zero has rate 0."""
    upto = _of_days(stream, first_day, last_day).where(F.col("clk_count") > 0).where(hour_of("time_slot") <= click_hour)
    clicks = _scaled(upto.withColumn("day", day_of("time_slot")), OFFER_KEYS, F.sum("clk_count"), scale)
    installs = (
        only(between_days(conversions, first_day, last_day), "adtype", HOURLY_INSTALL_ADTYPES)
        .where(F.col("event_type") == rules.INSTALL)
        .where(F.date_format("utctime", "HH") <= install_hour)
        .withColumn("day", event_day("utctime"))
        .select(*OFFER_KEYS, F.lit(1).cast("long").alias("conversion"))
    )
    click = F.col("click_h") / F.lit(100.0)
    return (
        merge_sums(clicks, installs, OFFER_KEYS, "left")
        .withColumn("conversion", F.coalesce("conversion", F.lit(0)))
        .select(*OFFER_KEYS, click.alias("click"), "conversion",
                half_even(ratio_or_zero("conversion", click), 2).alias("cvr"))
    )


def cvr_pairs(rates: DataFrame, offers: DataFrame) -> DataFrame:
    """Rates of known offers as key (internal offer) and value ``click_conversion_cvr``."""
    known = inner_join(rates, offer_map(offers), ["channel", "offer_id", "country"])
    return known.where(F.col("offer").isNotNull()).select(
        "day",
        F.col("offer").alias("key"),
        pack(short_decimal("click"), "conversion", short_decimal("cvr")).alias("value"),
    )


def cvr_status(
    impressions: DataFrame, conversions: DataFrame, targets: DataFrame, since: str | None = None
) -> DataFrame:
    """Targets with clicks, installs, rate and status.

    Status 1: conversions without clicks, or the rate reaches the target; 2 otherwise.
    """
    key = pack("channel", "offer").alias("channel_offer")
    clicks = between_slots(only(impressions, "adtype", CLICK_ADTYPES), since, None)
    convs = between_slots(conversions, since, None)
    live = merge_sums(
        clicks.select(key, F.col("count").alias("clicks")),
        convs.select(key, F.col("count").alias("install")),
        ["channel_offer"],
    )
    click_w = half_up(F.col("clicks") / F.lit(float(CLICK_SCALE)), 3)
    install = F.coalesce("install", F.lit(0))
    measured = live.select("channel_offer", click_w.alias("click_w"), install.alias("install")).withColumn(
        "cvr", half_up(F.when(F.col("click_w") == 0, F.lit(0.0)).otherwise(ratio("install", "click_w")), 3)
    )
    filled = (
        targets.select("channel_offer", "target_cvr")
        .join(measured, "channel_offer", "left")
        .withColumn("click_w", zero_if_missing("click_w"))
        .withColumn("install", F.coalesce("install", F.lit(0)))
        .withColumn("cvr", zero_if_missing("cvr"))
    )
    status = (
        F.when((F.col("click_w") == 0) & (F.col("install") > 0), 1)
        .when(F.col("cvr") < F.col("target_cvr"), 2)
        .otherwise(1)
    )
    return filled.withColumn("cvr_rate", status)


def update_cvr_targets(targets: DataFrame, status: DataFrame) -> DataFrame:
    """The target table with the measured columns replaced."""
    return update_from(targets, status, ["channel_offer"], ["click_w", "install", "cvr", "cvr_rate"])
