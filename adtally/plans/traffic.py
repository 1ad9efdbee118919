"""Clicks, conversions and rejects per hour or day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adtally.functions import rules
from adtally.functions.numbers import from_units, half_even, to_units
from adtally.functions.slots import day_of
from adtally.functions.text import first_usable, usable
from adtally.operators.filters import between_slots
from adtally.operators.shape import union_all
from adtally.session import materialize

LABELS = ["channel", "pkg", "platform"]
REPORT_KEYS = ["period", "country", "offer", *LABELS]
MEASURES = ["click_all", "impression", "install", "conv", "reject", "revenue", "cost"]


def _period(grain: str) -> Column:
    return F.col("time_slot") if grain == "hour" else day_of("time_slot")


def click_sources(stream: DataFrame, routed: DataFrame, synced: DataFrame) -> list[DataFrame]:
    """The three click logs with the report's column names.

    Stream rows carry counters, routed rows are one click each, synced rows carry clicks.
    Only stream rows have a package and a platform.
    """
    common = rules.non_empty("country", "channel") & rules.without_token("offer_pkg")
    a = stream.where(common & rules.non_empty("offer_id")).select(
        "time_slot", F.col("offer_id").alias("offer"), "country", "channel",
        F.col("offer_pkg").alias("pkg"), "platform",
        F.col("clk_count").alias("click_all"), F.col("imp_count").alias("impression"),
    )
    b = routed.where(common & (F.col("click_through") == rules.CLICKED_THROUGH)).select(
        "time_slot", rules.routed_offer().alias("offer"), "country", "channel",
        F.lit(1).cast("long").alias("click_all"),
    )
    c = synced.where(common).select(
        "time_slot", F.col("offer_id").alias("offer"), "country", "channel",
        F.col("clk_count").alias("click_all"),
    )
    return [a, b, c]


def click_union(stream: DataFrame, routed: DataFrame, synced: DataFrame) -> DataFrame:
    """UNION ALL of the click logs, aligned with empty labels and zero impressions."""
    return union_all(*click_sources(stream, routed, synced), missing={"pkg": "", "platform": "", "impression": 0})


def _event_rows(conversions: DataFrame, rejects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversion and reject logs with the report's column names and measures per row."""
    labels = [F.col("offer_id").alias("offer"), "country", "channel", F.col("offer_pkg").alias("pkg"), "platform"]

    def is_type(code: str) -> Column:
        return F.when(F.col("event_type") == code, 1).otherwise(0).cast("long")

    convs = conversions.where(rules.non_empty("offer_pkg", "offer_id")).select(
        "time_slot", *labels,
        is_type(rules.INSTALL).alias("install"), is_type(rules.EVENT).alias("conv"),
        to_units("payout").alias("revenue"), to_units("cost").alias("cost"),
    )
    return convs, rejects.select("time_slot", *labels, F.lit(1).cast("long").alias("reject"))


def _per_key(rows: DataFrame, grain: str, first: str | None, last: str | None) -> DataFrame:
    """Measures summed per period and all labels of one log.

    Only sums and plain keys, so the raw log is hash aggregated in its scan stage and
    combined before the shuffle without a sort.
    """
    keys = [c for c in ("offer", "country", *LABELS) if c in rows.columns]
    measures = [c for c in rows.columns if c in MEASURES]
    dated = between_slots(rows, first, last).withColumn("period", _period(grain))
    return dated.groupBy("period", *keys).agg(*[F.sum(m).alias(m) for m in measures])


def _finish(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy(*REPORT_KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
    return sums.withColumns({m: half_even(from_units(m), 2) for m in ("revenue", "cost")})


def traffic_report(
    stream: DataFrame,
    routed: DataFrame,
    synced: DataFrame,
    conversions: DataFrame,
    rejects: DataFrame,
    grain: str = "hour",
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """One row per period, country, offer, channel, package and platform.

    Every measure is counted once, at the labels of its own log row; a label shorter than
    two characters counts as none, and routed and synced clicks have no package or platform.
    Each log is summed on its own first; the sums are unioned with zeros and added up per key
    in one hash aggregation, so there is no join that a hot key could skew.
    """
    def side(log: DataFrame) -> DataFrame:
        df, zero = _per_key(log, grain, first, last), F.lit(0).cast("long")
        keys = [(F.coalesce(usable(c), F.lit("")) if c in df.columns else F.lit("")).alias(c) for c in REPORT_KEYS[1:]]
        return df.select("period", *keys, *[(F.col(m) if m in df.columns else zero).alias(m) for m in MEASURES])

    logs = [*click_sources(stream, routed, synced), *_event_rows(conversions, rejects)]
    return _finish(union_all(*[side(log) for log in logs]))


def traffic_report_fanned(
    stream: DataFrame,
    routed: DataFrame,
    synced: DataFrame,
    conversions: DataFrame,
    rejects: DataFrame,
    grain: str = "hour",
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """The report with the fan-out of joining finer sides on (period, offer, country).

    Every click row pairs with every conversion row, and every conversion row with every
    reject row, so measures repeat. The repeats are computed from row counts: reject rows
    shrink to (count, sum) per key, and click rows that bring all their labels meet only
    the per-key conversion sums. A click row that lacks a package or platform but has a
    channel meets conversions summed per package and platform, as their channels do not
    show; only one without a channel meets single conversion rows.
    Reject-only rows have no labels in this form.
    """
    convs, rejected = [_per_key(d, grain, first, last) for d in _event_rows(conversions, rejects)]
    summed = [_per_key(d, grain, first, last) for d in click_sources(stream, routed, synced)]
    clicks = (
        union_all(*summed, missing={"pkg": "", "platform": "", "impression": 0})
        .groupBy("period", "offer", "country", "channel")
        .agg(
            *[F.max(c).alias(c) for c in ("pkg", "platform")],
            *[F.sum(m).alias(m) for m in ("click_all", "impression")],
        )
    )
    keys = ["period", "offer", "country"]
    rej = rejected.groupBy(*keys).agg(F.count("*").alias("rej_rows"), F.sum("reject").alias("rej_sum"))
    conv_sums = ["install", "conv", "revenue", "cost"]

    # both sides feed several branches: written once, so that each log is scanned once
    clicks = materialize(clicks, "clicks")
    convs = convs.join(rej, keys, "left").select(
        *keys,
        *LABELS,
        F.coalesce("rej_rows", F.lit(1)).alias("repeat"),
        *[(F.col(c) * F.coalesce("rej_rows", F.lit(1))).alias(c) for c in conv_sums],
        F.coalesce("rej_sum", F.lit(0)).alias("reject"),
    )
    convs = materialize(convs, "convs")
    per_key = convs.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ["repeat", *conv_sums, "reject"]])

    has_channel = usable("channel").isNotNull()
    complete = has_channel & usable("pkg").isNotNull() & usable("platform").isNotNull()
    full_rows = clicks.where(complete).join(per_key, keys, "left")

    def by(labels: list[str]) -> DataFrame:
        """Conversions summed over the labels that the click brings."""
        sums = convs.groupBy(*keys, *labels).agg(*[F.sum(c).alias(c) for c in ["repeat", *conv_sums, "reject"]])
        missing = {f"conv_{c}": F.lit("") for c in LABELS if c not in labels}
        return sums.withColumnsRenamed({c: f"conv_{c}" for c in labels}).withColumns(missing)

    open_rows = union_all(
        clicks.where(~complete & has_channel).join(by(["pkg", "platform"]), keys, "left"),
        clicks.where(~has_channel).join(by(LABELS), keys, "left"),
    )
    conv_only = convs.join(clicks.select(*keys).distinct(), keys, "left_anti")
    # a reject key without conversions stands alone, whether or not the key has clicks
    reject_only = rej.join(convs.select(*keys).distinct(), keys, "left_anti")

    zero = F.lit(0).cast("long")

    own_labels = [first_usable(c) for c in LABELS]
    open_labels = [first_usable(c, f"conv_{c}") for c in LABELS]

    def out(df: DataFrame, labels: list[Column], **measures: Column) -> DataFrame:
        return df.select(
            "period",
            *[first_usable(k).alias(k) for k in ("country", "offer")],
            *[c.alias(n) for n, c in zip(LABELS, labels)],
            *[F.coalesce(measures.get(m, zero), zero).alias(m) for m in MEASURES],
        )

    repeated = F.coalesce("repeat", F.lit(1))
    clicked = {m: F.col(m) * repeated for m in ("click_all", "impression")}
    converted = {m: F.col(m) for m in [*conv_sums, "reject"]}
    blank = F.lit("")
    rows = union_all(
        out(full_rows, own_labels, **clicked, **converted),
        out(open_rows, open_labels, **clicked, **converted),
        out(conv_only, own_labels, **converted),
        out(
            reject_only.withColumns({"country": blank, "offer": blank}),
            [blank, blank, blank],
            reject=F.col("rej_sum"),
        ),
    )
    return _finish(rows)
