"""Revenue and cost: publisher revenue, allocation, profit, channel day report, settlement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adtally.functions import rules
from adtally.functions.numbers import (
    count_where, from_units, half_even, ratio, sum_if, sum_money, to_units, truncated,
)
from adtally.functions.slots import DAY, compact_day, day_of
from adtally.functions.text import slot_or_id
from adtally.operators.aggs import partition_total, rollup, rollup_known_keys
from adtally.operators.asof import enrich_asof
from adtally.operators.filters import between_slots
from adtally.operators.joins import attach_total, enrich, inner_join, join_defaults
from adtally.session import materialize

# Allocation rates and the ad types outside publisher-revenue costing.
SHARE_RATE = 0.2
MARGIN_RATE = 0.8
OWN_COST_ADTYPES = ["39", "38", "19"]
# Settlement record constants, amounts in ten-thousandths, conversion rate.
OFFER_TYPE = "OFLX_GA"
RECORD_TYPE = "JSXMLX_1"
AMOUNT_SCALE = 10_000
LOCAL_CURRENCY = "CNY"
LOCAL_RATE = 6.5

BASE_KEYS = ["day", "slot", "country", "offer_id", "platform", "adtype", "offer_pkg", "channel"]


def publisher_revenue(
    reporting: DataFrame, countries: DataFrame, placements: DataFrame, day: str | None = None, ranked: bool = True
) -> DataFrame:
    """Publisher revenue per day, slot and country, largest first.

    ``reporting`` is (day, placement_id, country_id, re_real_revenue) with an ISO day.
    Pass ``ranked=False`` to feed another report, which spares the global sort.
    """
    rows = reporting if day is None else reporting.where(F.col("day") == day)
    sums = rollup(rows, ["day", "placement_id", "country_id"], re_real_revenue=sum_money("re_real_revenue"))
    country = countries.select(F.col("id").alias("country_id"), F.col("short_name").alias("country"))
    placement = placements.select(
        F.col("id").alias("placement_id"), slot_or_id("slot_str", "id").alias("slot")
    )
    named = enrich(sums, (country, ["country_id"]), (placement, ["placement_id"]))
    out = named.select("day", "slot", "country", "re_real_revenue")
    return out.orderBy(F.desc("re_real_revenue")) if ranked else out


def owner_dimension(placements: DataFrame, apps: DataFrame, users: DataFrame) -> DataFrame:
    """slot -> app, publisher user and payee code."""
    place = placements.select(slot_or_id("slot_str", "id").alias("slot"), F.col("app_id"))
    app = apps.select(F.col("id").alias("app_id"), "user_id")
    user = users.select(F.col("id").alias("user_id"), "payee_code")
    return enrich(place, (app, ["app_id"]), (user, ["user_id"])).select(
        "slot", F.col("app_id").cast("string"), F.col("user_id").cast("string"), "payee_code"
    )


def allocate(
    conversions: DataFrame, publisher: DataFrame, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Allocated revenue and cost per day and conversion grain.

    ``publisher`` is the output of ``publisher_revenue``. Several rows for one slot and
    country repeat the conversion row and weigh in the totals, as the joins define it.
    Totals are taken before the country filter. The conversion log and the publisher
    log are scanned once: their sums are written, and all side inputs come from the sums.
    """
    base = rollup(
        between_slots(conversions, first, last).withColumn("day", day_of("time_slot")),
        BASE_KEYS,
        payout_u=F.sum(to_units("payout")),
        cost_u=F.sum(to_units("cost")),
        conversion=F.count("*"),
    )
    base = materialize(base, "allocation-base")

    unpaid_keys = ["day", "channel", "offer_id", "country"]
    by_slot = rollup(base, ["slot", *unpaid_keys], spent_u=F.sum("cost_u"), paid_u=F.sum("payout_u"))
    units = rollup(by_slot, unpaid_keys, offer_cost_u=F.sum(F.when(F.col("paid_u") == 0, F.col("spent_u"))))
    pub = materialize(
        publisher.select(compact_day("day").alias("day"), "slot", "country", "re_real_revenue"), "publisher"
    )

    share_keys = ["day", "country", "offer_id", "platform", "offer_pkg", "channel"]
    unpaid_shares = base.where((F.col("adtype") == rules.SHARE_ADTYPE) & (F.col("payout_u") == 0))
    shares = partition_total(
        unpaid_shares.select("slot", *share_keys, "conversion"),
        share_keys,
        {"conversion_all": F.sum("conversion")},
    ).select("slot", *share_keys, ratio("conversion", "conversion_all").alias("rate"))

    # The totals see each base row once per publisher row of its slot and country. That
    # repeat is a count, so totals need no pass over the joined rows.
    place = ["day", "slot", "country"]
    by_place = rollup(base, [*place, "offer_id"], payout_u=F.sum("payout_u"))
    repeats = rollup(pub, place, repeat=F.count("*"))
    repeated = attach_total(by_place, repeats, place).withColumn(
        "payout_u", F.col("payout_u") * F.coalesce("repeat", F.lit(1))
    )
    offer_totals = rollup(repeated, ["day", "offer_id"], offer_payout_u=F.sum("payout_u"))
    place_totals = rollup(repeated, place, slot_payout_u=F.sum("payout_u")).join(pub, place, "left")

    # the publisher rows come last, because they repeat base rows
    # what depends on the offer is joined on while it is small, so that the base is dealt out once for both
    units = attach_total(units, offer_totals, ["day", "offer_id"])
    joined = attach_total(base.drop("conversion"), units, unpaid_keys).join(shares, ["slot", *share_keys], "left")
    joined = attach_total(joined, place_totals, place).na.fill(
        {"offer_cost_u": 0, "re_real_revenue": 0.0, "rate": 0.0}
    )

    payout, cost = from_units("payout_u"), from_units("cost_u")
    shared = F.col("rate") > 0
    published = ~F.col("adtype").isin(OWN_COST_ADTYPES) & (F.col("re_real_revenue") > 0)
    margin = (F.col("adtype") == rules.MARGIN_ADTYPE) & (F.col("offer_cost_u") > 0)
    revenue = (
        F.when(shared, from_units("offer_payout_u") * F.lit(SHARE_RATE) * F.col("rate"))
        .when(published, payout)
        .when(margin, payout * F.lit(MARGIN_RATE))
        .otherwise(payout)
    )
    # a slot without any payout has nothing to spread: its cost is 0
    spread = F.coalesce(payout * ratio("re_real_revenue", from_units("slot_payout_u")), F.lit(0.0))
    return (
        joined.where(rules.country_code("country", exact=2))
        .select(
            *BASE_KEYS,
            revenue.alias("revenue"),
            F.when(shared, cost).when(published, spread).otherwise(cost).alias("cost"),
        )
    )


def allocation_report(
    conversions: DataFrame,
    publisher: DataFrame,
    placements: DataFrame,
    apps: DataFrame,
    users: DataFrame,
    networks: DataFrame,
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """Allocation with owner and advertiser attributes; missing attributes are NULL."""
    owners = owner_dimension(placements, apps, users)
    advertisers = networks.select(F.col("short_name").alias("channel"), "adv_id")
    rows = allocate(conversions, publisher, first, last)
    return enrich(rows, (owners, ["slot"]), (advertisers, ["channel"])).select(
        *BASE_KEYS, "revenue", "cost", "app_id", "user_id", "payee_code", "adv_id"
    )


def profit_rollup(
    allocation: DataFrame,
    users: DataFrame,
    networks: DataFrame,
    first_day: str | None = None,
    last_day: str | None = None,
    hide_dashed_countries: bool = True,
) -> DataFrame:
    """Profit per day, ad type, slot, country, user and network type.

    Rows without a user, or whose user or network is unknown, are dropped. The day is in
    the key, so a backfill over many days is this one job with a wider range. Users or networks with
    a ``valid_from`` are taken as they were when each day began, others as they are.
    """
    rows = between_slots(allocation, first_day, last_day, "day").where(rules.has_money())
    rows = rows.where(F.col("user_id").isNotNull())
    if hide_dashed_countries:
        rows = rows.where(~F.contains("country", F.lit("-")))
    versioned = {d: [c for c in d.columns if c == "valid_from"] for d in (users, networks)}
    account = users.select(
        F.col("id").alias("user_id"), F.col("email").alias("account_email"), F.col("username").alias("user_name"), *versioned[users]
    )
    network = networks.select(F.col("short_name").alias("channel"), "channel_type", *versioned[networks])
    typed = rows.withColumn("user_id", F.col("user_id").cast("long"))
    if any(versioned.values()):
        typed = materialize(typed.withColumn("day_start", F.to_timestamp("day", DAY)), "allocated")
    keys = ["date", "adtype", "slot", "country", "user_id", "channel_type", "user_name", "account_email"]
    named = enrich_asof(typed, "day_start", (account, ["user_id"]), (network, ["channel"])).withColumnRenamed("day", "date")
    return rollup_known_keys(named, keys, revenue=sum_money("revenue"), cost=sum_money("cost"))


def channel_day_report(
    conversions: DataFrame, allocation: DataFrame, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Events and revenue per channel day, with the allocated cost."""
    event = F.col("event_type") != rules.INSTALL
    keys = ["date", "channel", "platform", "country", "pkg"]
    recoded = between_slots(conversions, first, last).select(
        day_of("time_slot").alias("date"), "channel_type", "channel",
        rules.platform_number().alias("platform"), "country", F.col("offer_pkg").alias("pkg"),
        "event_type", to_units("payout").alias("payout_u"),
    )
    events = rollup(
        recoded, [*keys, "channel_type"],
        conversion=count_where(event), revenue=from_units(sum_if(event, "payout_u")),
    )
    costs = rollup(
        allocation.select(
            F.col("day").alias("date"), "channel", rules.platform_number().alias("platform"),
            "country", F.col("offer_pkg").alias("pkg"), "cost",
        ),
        keys, cost=sum_money("cost"),
    )
    return join_defaults(events, costs, keys, "left", {"cost": 0.0}).select(
        "date", "channel_type", "channel", "platform", "country", "pkg", "conversion", "revenue", "cost"
    )


def settlement(
    allocation: DataFrame,
    advertisers: DataFrame,
    customers: DataFrame,
    channels: DataFrame,
    first_day: str | None = None,
    last_day: str | None = None,
) -> DataFrame:
    """Settlement records in ten-thousandths of the contract currency.

    Advertisers without a contract are left out. An unknown customer or channel contract
    leaves its currency empty. Amounts are truncated after the currency conversion.
    """
    rows = between_slots(allocation, first_day, last_day, "day").where(rules.non_empty("adv_id"))
    rows = rows.where(rules.settleable()).withColumn("payee_code", F.coalesce("payee_code", F.lit("")))
    amounts = rollup(
        rows, ["channel", "adv_id", "payee_code", "country", "day"],
        revenue=half_even(sum_money("revenue") * F.lit(AMOUNT_SCALE)),
        cost=half_even(sum_money("cost") * F.lit(AMOUNT_SCALE)),
    )
    signed = enrich(
        inner_join(amounts, advertisers, ["adv_id"]),
        (customers, ["contract_code"]),
        (channels, ["payee_code"]),
    ).na.fill("", ["adv_currency", "supplier_id", "payout_currency"])

    def local(amount: str, currency: str) -> Column:
        rate = F.when(F.col(currency) == LOCAL_CURRENCY, F.lit(LOCAL_RATE)).otherwise(F.lit(1.0))
        return truncated(F.col(amount) * rate).alias(amount)

    zero = F.lit(0)
    return signed.na.drop("any", subset=["contract_code", "channel", "country"]).select(
        F.col("channel").alias("offer_id"),
        F.lit(OFFER_TYPE).alias("offer_type"),
        "adv_id", "contract_code", "payee_code", "supplier_id",
        F.lit("").alias("traffic"),
        "country",
        F.concat("day", F.lit("000000")).alias("created"),
        F.lit(RECORD_TYPE).alias("type"),
        "adv_currency", local("revenue", "adv_currency"),
        zero.alias("t1"), zero.alias("t2"),
        "payout_currency", local("cost", "payout_currency"),
        zero.alias("t3"), zero.alias("t4"),
    )
