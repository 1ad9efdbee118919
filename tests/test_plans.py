"""Shapes of physical plans that must hold at scale."""

from __future__ import annotations

import functools
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from adtally import jobs
from adtally.operators import filters
from adtally.plans import counters, feeds, rates, rollups, traffic
from testbed import QUERIES
from testbed.tables import Testbed

SF = "/root/testdata/sf0.001"
LAZY = [n for n in QUERIES if not n.startswith("stream_") and n not in ("clear_tables",)]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan(QUERIES[n](spark, SF)) for n in LAZY}


def test_no_python_in_any_plan(plans):
    bad = {n for n, p in plans.items() if re.search(r"EvalPython|InPandas|InArrow|BatchEvalPython|PythonUDF", p)}
    assert not bad


def test_no_cartesian_product(plans):
    assert not {n for n, p in plans.items() if "CartesianProduct" in p}


def test_nested_loop_joins_only_with_one_row(plans):
    """A nested loop join may only meet a global aggregate, which is one row."""
    looped = {n for n, p in plans.items() if "BroadcastNestedLoopJoin" in p}
    assert looped <= {"single_row_pairs", "slot_share"}


def test_no_window_over_all_rows(plans):
    """Windows are partitioned, and cut per task before the shuffle, or their groups are buckets: of time, or ranges of rows."""
    windowed = {n: p for n, p in plans.items() if re.search(r"\bWindow \[", p)}
    carried = {"profit_backfill_asof", "conversions_asof", "look_back_minutes", "apportioned_shares", "apportioned_revenue", "export_checksums"}
    for n, p in windowed.items():
        if n in carried:
            assert all("_bucket#" in line for line in p.splitlines() if re.search(r"\bWindow \[", line)), n
        else:
            assert "WindowGroupLimit" in p, n
    single = {n for n, p in plans.items() if re.search(r"Exchange SinglePartition", p)}
    # one row, or a count of rows
    alarms = {"traffic_alarm", "traffic_alarm_fired", "stream_alarm", "volume_alarm"}  # the range of hours, one row
    assert single <= {"single_row_pairs", "slot_share", "tracker_totals", "clear_tables"} | alarms


def test_logs_are_combined_before_the_shuffle(plans):
    """Below every hash exchange that reads a log there is a partial aggregate, never a sort."""
    for name in ("offer_conv_click", "hour_report", "realtime_cvr", "day_platform_report", "slot_conversions", "offer_share"):
        p = plans[name]
        assert "partial_sum" in p, name
        deepest = [ln for ln in p.splitlines() if "Aggregate" in ln][-1]
        assert "HashAggregate" in deepest and "SortAggregate" not in deepest, name


def test_common_grain_join_adds_no_shuffle(plans):
    """One exchange per log, below its aggregate; the join reuses the partitioning."""
    for name in ("day_platform_report", "offer_conv_click", "imp_click"):
        assert len(re.findall(r"Exchange hashpartitioning", plans[name])) == 2, name


def test_traffic_report_shuffles_each_log_once(plans):
    for name in ("hour_report", "day_report_all"):
        assert len(re.findall(r"Exchange hashpartitioning", plans[name])) == 6
        assert "Join" not in plans[name]


def test_partition_pruning_and_column_pruning(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame(
        [("2024010100", "s", "US", 1, "x"), ("2024010200", "s", "US", 1, "x")],
        "time_slot string, slot string, country string, count long, wide string",
    ).write.partitionBy("time_slot").parquet(path)
    p = plan(rollups.slot_clicks(filters.in_day(spark.read.schema(
        "slot string, country string, count long, wide string, time_slot string").parquet(path), "20240101")))
    assert re.search(r"PartitionFilters: \[[^\]]*time_slot", p)
    assert "wide" not in re.search(r"ReadSchema: \S+", p).group(0)


@pytest.fixture(scope="module")
def logs(spark, tmp_path_factory):
    """Logs partitioned by hour bucket, as files."""
    root = tmp_path_factory.mktemp("logs")
    tb = Testbed.of(spark, SF)

    def stored(name):
        df = tb(name)
        path = str(root / name)
        if "time_slot" in df.columns:
            hours = F.col("time_slot").between("2024011500", "2024011511")
            df.where(hours).coalesce(1).write.partitionBy("time_slot").parquet(path)
            return spark.read.schema(df.schema).parquet(path)
        df.write.parquet(path)
        return spark.read.parquet(path)

    return functools.cache(stored)


DAY = "20240115"
AS_OF = datetime(2024, 1, 15, 11, 10)
BY_SLOT, BY_TIME = r"PartitionFilters: \[[^\]]*time_slot[^\]]*>=", r"PushedFilters: \[[^\]]*GreaterThanOrEqual\((utctime|install_time|created)"
BOUNDED = {
    "capped_offers": (BY_TIME, lambda t: feeds.capped_offers(t("conversion_events"), t("event_caps"), DAY)),
    "install_feed": (BY_TIME, lambda t: feeds.install_feed(t("conversion_events"), t("offers"), t("event_caps"), AS_OF, cap_day=DAY)),
    "install_day": (BY_TIME, lambda t: feeds.install_day(t("af_installs"), DAY)),
    "cap_daily_counts": (BY_TIME, lambda t: counters.cap_daily_counts(t("conversion_events"), t("offers"), DAY, DAY, ranked=False)),
    "target_pacing": (BY_TIME, lambda t: counters.target_pacing(t("conversion_events"), t("offers"), AS_OF)),
    "cvr_installs": (BY_TIME, lambda t: rates.cvr_by_hour(t("stream"), t("conversion_events"), DAY, DAY)),
    "cvr_clicks": (BY_SLOT, lambda t: rates.cvr_by_hour(t("stream"), t("conversion_events"), DAY, DAY)),
    "realtime_cvr": (BY_SLOT, lambda t: rates.realtime_cvr(*[t(n) for n in ("stream", "routed", "synced", "daily_clicks", "conversion_events")], DAY, DAY)),
    "click_counters": (BY_SLOT, lambda t: counters.click_counters(t("routed"), first=f"{DAY}00", last=f"{DAY}23")),
    "recent": (BY_TIME, lambda t: jobs._recent(t("async_clicks"), AS_OF)),
    "hour_report": (BY_SLOT, lambda t: traffic.traffic_report(*[t(n) for n in jobs.TRAFFIC], first=f"{DAY}10", last=f"{DAY}10")),
}


@pytest.mark.parametrize("name", BOUNDED)
def test_time_bounds_reach_the_scan(logs, name):
    wanted, build = BOUNDED[name]
    found = plan(build(logs))
    scans = [line for line in found.splitlines() if "FileScan" in line and re.search("conversion_events|stream|af_installs|async_clicks|routed", line)]
    assert scans and any(re.search(wanted, line) for line in scans), found


def test_kind_filter_reaches_the_reader(plans):
    pushed = re.search(r"PushedFilters: \[(.*?)\], ", plans["slot_all_clicks"]).group(1)
    assert "EqualTo(event_type,view)" in pushed


def test_hot_key_is_split(spark):
    """Beyond the broadcast threshold the adaptive skew join splits the hot key's rows."""
    from adtally.operators.aggs import partition_total

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        df = spark.range(0, 60_000, 1, 8).select(key.alias("k"), F.col("id").alias("v"))
        out = partition_total(df, ["k"], {"t": F.sum("v")})
        rows = out.where("k = 'hot'").groupBy("k", "t").count().collect()
        assert [(r["t"], r["count"]) for r in rows] == [(sum(i for i in range(60_000) if i % 3), 40_000)]
        out.collect()
        assert re.search(r"AQEShuffleRead .*skewed", plan(out))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
