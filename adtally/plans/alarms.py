"""Data-quality alarms as a table: one row per hour bucket and rule.

Every bucket of the range is judged on closed hours, compared by instant, so buckets just
after midnight are judged like any other; without bounds the range is that of the logs. An hour
without any row is judged like the others: its volume is 0 and its change -100 %. Columns:
time_slot, alarm, rule, value, threshold, fired. A missing comparison period gives a NULL
rate, which never fires; a missing payout, conversion or volume counts as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adtally.functions import rules
from adtally.functions.numbers import pct_change, ratio, sum_money
from adtally.functions.slots import slot_of
from adtally.operators.aggs import hour_spine, period_compare, rollup, trailing_total
from adtally.operators.filters import between_slots

# Alarm thresholds.
DROP = -30.0
DEEP_DROP = -50.0
MIN_PAYOUT = 100.0
MIN_CLICKS = 100.0
MIN_IMPRESSIONS = 1000.0
VOLUME_ADTYPE = "16"
BUSY_CLICKS = 10_000
TRACKER = "Adjust"


def rates(compared: DataFrame, zero_previous_hour: bool) -> DataFrame:
    """Day and hour change in percent. With ``zero_previous_hour`` an absent previous hour
    counts as 0 over a base of 1."""
    if zero_previous_hour:
        ago = F.coalesce("hour_ago", F.lit(0))
        hour_rate = ratio(F.col("current") - ago, F.coalesce("hour_ago", F.lit(1))) * F.lit(100.0)
    else:
        hour_rate = pct_change("current", "hour_ago")
    return compared.select(
        "time_slot", "current", "hour_ago", "day_ago",
        pct_change("current", "day_ago").alias("day_rate"), hour_rate.alias("hour_rate"),
    )


def _rule(name: str, value: Column, threshold: float, fired: Column) -> Column:
    return F.struct(
        F.lit(name).alias("rule"),
        value.cast("double").alias("value"),
        F.lit(threshold).alias("threshold"),
        F.coalesce(fired, F.lit(False)).alias("fired"),
    )


def _table(df: DataFrame, alarm: str, rule_list: list[Column]) -> DataFrame:
    return df.select("time_slot", F.lit(alarm).alias("alarm"), F.explode(F.array(*rule_list)).alias("r")).select(
        "time_slot", "alarm", "r.*"
    )


def _drop_rules(prefix: str) -> list[Column]:
    day, hour = F.col(f"{prefix}_day"), F.col(f"{prefix}_hour")
    return [
        _rule(f"{prefix}_drop", F.greatest(day, hour), DROP, (day < DROP) & (hour < DROP)),
        _rule(f"{prefix}_deep_drop", day, DEEP_DROP, day < DEEP_DROP),
    ]


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(
        "time_slot", F.col("day_rate").alias(f"{prefix}_day"), F.col("hour_rate").alias(f"{prefix}_hour")
    )


def tracked_conversions(async_clicks: DataFrame, conversions: DataFrame) -> DataFrame:
    """Conversions attributed to hours and offers with many direct asynchronous clicks.

    Clicks are grouped per hour and offer and kept above the threshold (HAVING), then meet
    the conversions by the hour they are attributed to.
    """
    keys = ["time_slot", "offer"]
    busy = (
        rollup(
            async_clicks.where(F.col("pid") == "").withColumn("time_slot", slot_of("created")),
            keys, click=F.sum("count"),
        )
        .where(F.col("click") > BUSY_CLICKS)
    )
    attributed = rollup(
        conversions.where(F.col("adtype") == rules.MARGIN_ADTYPE).withColumn("time_slot", F.col("attr_hour")),
        keys, conv=F.sum("count"),
    )
    return busy.join(attributed, keys, "left")


def traffic_alarm(
    impressions: DataFrame,
    async_clicks: DataFrame,
    conversions: DataFrame,
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """Hour and day change of two click streams, the hour's payout, and conversions tracked
    in the last three hours."""
    asynchronous = async_clicks.withColumn("time_slot", slot_of("created"))
    hours = hour_spine(impressions.sparkSession, [impressions, asynchronous, conversions], first, last)
    served = _renamed(rates(period_compare(impressions, F.sum("count"), hours=hours), False), "served")
    async_rates = _renamed(rates(period_compare(asynchronous, F.sum("count"), hours=hours), True), "async")
    payout = rollup(conversions, ["time_slot"], payout=sum_money("payout"))
    tracked = trailing_total(
        tracked_conversions(async_clicks, conversions), {"conv": F.sum(F.coalesce("conv", F.lit(0)))}, hours=3
    )
    joined = served.join(async_rates, "time_slot").join(payout, "time_slot", "left").join(tracked, "time_slot", "left")
    judged = joined.na.fill({"payout": 0.0, "conv": 0})
    return _table(
        judged,
        "traffic",
        [
            *_drop_rules("async"),
            *_drop_rules("served"),
            _rule("low_payout", F.col("payout"), MIN_PAYOUT, F.col("payout") <= MIN_PAYOUT),
            _rule("no_conversion", F.col("conv"), 0.0, F.col("conv") == 0),
        ],
    )


def stream_alarm(
    stream: DataFrame, conversions: DataFrame, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Hour and day change of the stream clicks, and tracker conversions of the last six hours."""
    hours = hour_spine(stream.sparkSession, [stream, conversions], first, last)
    clicks = _renamed(rates(period_compare(stream, F.sum("clk_count"), hours=hours), True), "stream")
    tracked = trailing_total(
        conversions.where(F.col("attribute_provider") == TRACKER).withColumn("time_slot", F.col("attr_time")),
        {"conv": F.count("*")},
        hours=6,
    )
    judged = clicks.join(tracked, "time_slot", "left").na.fill({"conv": 0})
    return _table(
        judged,
        "stream",
        [*_drop_rules("stream"), _rule("no_conversion", F.col("conv"), 0.0, F.col("conv") == 0)],
    )


def volume_alarm(
    clicks: DataFrame, impressions: DataFrame, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Real clicks and impressions of one ad type below their hourly minimum."""
    hours = hour_spine(clicks.sparkSession, [clicks, impressions], first, last)
    real = rollup(between_slots(clicks, first, last), ["time_slot"], clicks=F.sum("count"))
    wanted = between_slots(impressions, first, last).where(F.col("adtype") == VOLUME_ADTYPE)
    shown = rollup(wanted, ["time_slot"], shown=F.sum("count"))
    judged = hours.join(real, "time_slot", "left").join(shown, "time_slot", "left").na.fill(0, ["clicks", "shown"])
    return _table(
        judged,
        "volume",
        [
            _rule("low_clicks", F.col("clicks"), MIN_CLICKS, F.col("clicks") < MIN_CLICKS),
            _rule("low_impressions", F.col("shown"), MIN_IMPRESSIONS, F.col("shown") < MIN_IMPRESSIONS),
        ],
    )


def fired_slots(alerts: DataFrame) -> DataFrame:
    """One row per bucket and alarm, with whether any rule fired and which."""
    return alerts.groupBy("time_slot", "alarm").agg(
        F.bool_or("fired").alias("fired"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("fired"), F.col("rule")))), ",").alias("rules"),
    )


def tracker_totals(conversions: DataFrame, since: str) -> DataFrame:
    """Count and payout of tracker conversions attributed since a bucket, as one row."""
    rows = conversions.where((F.col("attribute_provider") == TRACKER) & (F.col("attr_time") >= since))
    return rows.agg(F.count("*").alias("conv"), sum_money("payout").alias("payout"))
