"""Properties that hold on the test tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from adtally.functions import rules
from adtally.plans import feeds, rollups
from testbed import QUERIES
from testbed.tables import Testbed

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tb(spark):
    return Testbed.of(spark, SF)


def test_shares_of_a_partition_sum_to_one(spark):
    sums = QUERIES["partition_share"](spark, SF).groupBy("day", "country").agg(F.sum("rate").alias("s"))
    assert sums.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_every_allocation_rule_fires(spark, tb):
    """Each rule leaves its trace: a changed revenue or cost where the rule may act."""
    paid = tb("conversion_events").groupBy(
        F.substring("time_slot", 1, 8).alias("day"), "slot", "country", "offer_id", "platform", "adtype", "offer_pkg", "channel"
    ).agg(F.sum("payout").alias("p"), F.sum("cost").alias("c"))
    keys = [c for c in paid.columns if c not in "pc"]
    rows = QUERIES["allocate_revenue_cost"](spark, SF).dropDuplicates(keys).join(paid, keys)
    changed = F.abs(F.col("revenue") - F.col("p")) > 1e-6
    margin = changed & (F.col("adtype") == rules.MARGIN_ADTYPE) & (F.abs(F.col("revenue") - F.col("p") * 0.8) < 1e-6)
    spread = ~changed & (F.abs(F.col("cost") - F.col("c")) > 1e-6)
    got = rows.agg(
        F.count_if(changed & ~margin).alias("shared"), F.count_if(spread).alias("published"),
        F.count_if(margin).alias("margin"), F.count_if(~changed & ~spread).alias("unchanged"),
    ).first()
    assert min(got) > 0, got


def test_feed_and_blacklist_are_disjoint(spark, tb):
    feed = QUERIES["install_feed"](spark, SF)
    assert feed.join(feeds.blacklist(tb("offers")), ["offer_id", "af_siteid"]).count() == 0
    assert feeds.blacklist(tb("offers")).join(tb("conversion_events"), ["offer_id", "af_siteid"]).count() > 0


def test_measures_are_kept_whole(spark, tb):
    """The plain report neither loses nor repeats an event; the fanned one repeats."""
    events = tb("conversion_events").where(rules.non_empty("offer_pkg", "offer_id"))
    want = events.agg(F.count_if(F.col("event_type") == "1"), F.count_if(F.col("event_type") == "2")).first()
    plain = QUERIES["day_report_all"](spark, SF).agg(F.sum("install"), F.sum("conv"), F.sum("reject")).first()
    assert tuple(plain)[:2] == tuple(want)
    assert plain[2] == tb("rejected").count()
    fanned = QUERIES["day_report_all_fanned"](spark, SF).agg(F.sum("install"), F.sum("conv")).first()
    assert fanned[0] > want[0] and fanned[1] > want[1]


def test_hour_report_rolls_up_to_the_day_report(spark):
    keys = ["country", "offer"]
    hour = QUERIES["hour_report"](spark, SF).groupBy(F.substring("period", 1, 8).alias("period"), *keys)
    day = QUERIES["day_report_all"](spark, SF).groupBy("period", *keys)
    sums = [F.sum(c).alias(c) for c in ("click_all", "impression", "install", "conv", "reject")]
    a, b = hour.agg(*sums), day.agg(*sums)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize(
    "pair, prefix, single",
    [
        ("request_rollups", "visible", "slot_requests"),
        ("request_rollups", "listed", "slot_listed_requests"),
        ("impression_rollups", "shown", "slot_impressions"),
        ("impression_rollups", "hidden", "slot_all_clicks"),
    ],
)
def test_one_scan_pairs_equal_their_rollups(spark, pair, prefix, single):
    a, b = rollups.part_of(QUERIES[pair](spark, SF), prefix), QUERIES[single](spark, SF)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
