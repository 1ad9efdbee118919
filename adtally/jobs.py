"""Scheduled loads: one report for one instant, written to its table, snapshot or file.

A job takes its inputs by table name, its time from ``as_of`` and writes below ``root``.
Report tables live in the catalog with their files under ``root``; key/value snapshots are
parquet folders. Every load replaces what it wrote before, so a rerun changes nothing.

    spark-submit --py-files adtally.zip run_job.py hour_report --as-of 2024-01-15T11:10 --root /data/reports
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adtally.functions import slots
from adtally.plans import alarms, counters, dims, feeds, money, rates, rollups, traffic
from adtally.session import build_session, clear_scratch, materialize, replace_folder
from adtally.sinks import files, keyed, tables as sink
from adtally.sources import contracts, partner_csv

HOUR_REPORT_DAYS = 14
COUNTER_TABLES = ["cap_daily_counts", "click_counters", "target_pacing", "realtime_cvr"]


@dataclass
class Run:
    """What a job needs: session, table resolver, instant and output root."""

    spark: SparkSession
    table: Callable[[str], DataFrame]
    as_of: datetime
    root: str

    @property
    def last_slot(self) -> str:
        return slots.slot_before(self.as_of)

    @property
    def yesterday(self) -> str:
        return slots.day_before(self.as_of)

    @property
    def today(self) -> str:
        return slots.day_before(self.as_of, 0)

    def iso(self, days: int) -> str:
        return datetime.strptime(slots.day_before(self.as_of, days), "%Y%m%d").strftime("%Y-%m-%d")

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def several(self, *names: str) -> list[DataFrame]:
        return [self.table(n) for n in names]

    # loads

    def load(self, df: DataFrame, name: str, partition_by: str, covers: Sequence[str]) -> None:
        """Replace the partitions ``covers``, with what ``df`` has for them."""
        sink.create_table(df, name, [partition_by], self.path(name))
        sink.replace_partition(df, name, covers)

    def refresh(self, df: DataFrame, name: str) -> None:
        sink.create_table(df, name, (), self.path(name))
        sink.refresh(df, name)

    def upsert(self, df: DataFrame, name: str, order: Sequence[Column] = ()) -> None:
        path = self.path(name)
        df.limit(0).write.mode("append").parquet(path)
        keyed.upsert_kv(self.spark, df, path, order)

    def replace_all(self, df: DataFrame, name: str) -> None:
        """Key/value table replaced as a whole: keys without a row disappear."""
        replace_folder(keyed.merged(df.limit(0), df, ["key"]), self.path(name))


JOBS: dict[str, Callable[[Run], None]] = {}


def job(fn: Callable[[Run], None]) -> Callable[[Run], None]:
    JOBS[fn.__name__] = fn
    return fn


TRAFFIC = ("stream", "routed", "synced", "conversion_events", "rejected")


@job
def hour_report(run: Run) -> None:
    """The previous hour; the day two weeks back expires."""
    rows = traffic.traffic_report(*run.several(*TRAFFIC), grain="hour", first=run.last_slot, last=run.last_slot)
    run.load(rows.withColumnRenamed("period", "time_slot"), "hour_report", "time_slot", [run.last_slot])
    sink.expire(run.spark, "hour_report", "time_slot", slots.day_before(run.as_of, HOUR_REPORT_DAYS))


@job
def day_report_all(run: Run) -> None:
    first, last = slots.day_bounds(run.yesterday)
    rows = traffic.traffic_report(*run.several(*TRAFFIC), grain="day", first=first, last=last)
    run.load(rows.withColumnRenamed("period", "day"), "day_report_all", "day", [run.yesterday])


@job
def publisher_revenue(run: Run) -> None:
    rows = money.publisher_revenue(*run.several("publisher_log", "countries", "placements"), day=run.iso(1), ranked=False)
    run.load(rows, "publisher_revenue", "day", [run.iso(1)])


@job
def allocation(run: Run) -> None:
    """Needs ``publisher_revenue`` of the day."""
    first, last = slots.day_bounds(run.yesterday)
    publisher = run.spark.table("publisher_revenue").where(F.col("day") == run.iso(1))
    rows = money.allocation_report(
        run.table("conversion_events"), publisher, *run.several("placements", "apps", "users", "networks"),
        first=first, last=last,
    )
    run.load(rows, "allocation", "day", [run.yesterday])


def _profit(run: Run, days: list[str], hide: bool) -> None:
    rows = money.profit_rollup(
        run.spark.table("allocation"), *run.several("users", "networks"), days[0], days[-1], hide
    )
    run.load(rows, "profit_report", "date", days)


@job
def profit_report(run: Run) -> None:
    """Needs ``allocation`` of the day."""
    _profit(run, [run.yesterday], True)


@job
def profit_backfill(run: Run) -> None:
    """The days 50 to 3 before the run, as one job."""
    _profit(run, [slots.day_before(run.as_of, n) for n in range(50, 2, -1)], False)


@job
def channel_day_report(run: Run) -> None:
    """Needs ``allocation`` of the day."""
    first, last = slots.day_bounds(run.yesterday)
    costs = run.spark.table("allocation").where(F.col("day") == run.yesterday)
    rows = money.channel_day_report(run.table("conversion_events"), costs, first, last)
    run.load(rows, "channel_day_report", "date", [run.yesterday])


@job
def settlement_export(run: Run) -> None:
    """Settlement file parts and their manifest; contract feeds are under ``root/contracts``."""
    rows = money.settlement(
        run.spark.table("allocation"),
        contracts.read_advertisers(run.spark, run.path("contracts/advertisers")),
        contracts.read_customer_contracts(run.spark, run.path("contracts/customers")),
        contracts.read_channel_contracts(run.spark, run.path("contracts/channels")),
        run.yesterday, run.yesterday,
    )
    name = f"SD_{run.yesterday}000000"
    files.export_settlement(rows, run.path(f"settlement/{name}_000.dat"))
    manifest = files.export_manifest(run.spark, run.path(f"settlement/{name}_000.dat"))
    files.manifest_lines(manifest).write.mode("overwrite").option("lineSep", files.LINE_MARK).text(
        run.path(f"settlement/{name}.check")
    )


@job
def realtime_cvr(run: Run) -> None:
    """Today so far; offers without a row disappear."""
    found = rates.realtime_cvr(
        *run.several("stream", "routed", "synced", "daily_clicks", "conversion_events"), run.today, run.today
    )
    pairs = rates.cvr_pairs(found, run.table("offers")).select("key", "value")
    run.replace_all(pairs.withColumn("update_time", F.lit(run.as_of.strftime("%Y%m%d%H"))), "realtime_cvr")


@job
def cvr_by_offer(run: Run) -> None:
    """Clicks to the previous hour, installs to the hour before it, both of the previous hour's day."""
    click, install = (slots.slot_before(run.as_of, n) for n in (1, 2))
    day = click[:8]
    found = rates.cvr_by_hour(
        *run.several("stream", "conversion_events"), day, day,
        click_hour=click[8:], install_hour=install[8:] if install[:8] == day else "",
    )
    run.upsert(rates.cvr_pairs(found, run.table("offers")).select("key", "value"), "cvr_by_offer")


@job
def cvr_status(run: Run) -> None:
    targets = run.table("cvr_targets")
    status = rates.cvr_status(*run.several("impressions", "conversions"), targets, since=f"{run.today}00")
    run.refresh(rates.update_cvr_targets(targets, status), "cvr_status")


@job
def target_pacing(run: Run) -> None:
    rows = counters.target_pacing(*run.several("conversion_events", "offers"), run.as_of)
    run.upsert(keyed.snapshot_kv(rows, F.col("value"), "key"), "target_pacing")


@job
def cap_daily_counts(run: Run) -> None:
    """The day's installs per offer and slot, over all countries."""
    rows = counters.cap_daily_counts(*run.several("conversion_events", "offers"), run.today, run.today, ranked=False)
    run.upsert(keyed.snapshot_kv(rows.groupBy("key").agg(F.sum("count").alias("count")), F.col("count"), "key"), "cap_daily_counts")


@job
def click_counters(run: Run) -> None:
    rows = counters.click_counters(run.table("routed"), first=f"{run.today}00", last=f"{run.today}23")
    run.replace_all(keyed.snapshot_kv(rows, F.col("value"), "key"), "click_counters")


@job
def affiliate_revenue(run: Run) -> None:
    rows = counters.affiliate_revenue(*run.several("conversions", "affiliates"), run.last_slot, run.last_slot)
    slot = F.concat(slots.compact_day("date"), F.col("hour"))
    run.load(rows.withColumn("time_slot", slot), "affiliate_revenue", "time_slot", [run.last_slot])


@job
def affiliate_caps(run: Run) -> None:
    rows = counters.affiliate_cap_counters(
        *run.several("conversions", "affiliates"), since=slots.slot_before(run.as_of, 24)
    )
    run.upsert(keyed.snapshot_kv(rows, F.col("value"), "key"), "affiliate_caps")


@job
def slot_quota(run: Run) -> None:
    listed = run.spark.createDataFrame([(s,) for s in counters.QUOTA_SLOTS], "slot string")
    rows = counters.slot_quota(run.table("impressions"), listed, since=f"{run.today}00")
    run.upsert(keyed.snapshot_kv(rows, F.col("value"), "key"), "slot_quota")


@job
def install_feed(run: Run) -> None:
    rows = feeds.install_feed(
        *run.several("conversion_events", "offers", "event_caps"), run.as_of, cap_day=run.today
    )
    run.refresh(rows, "install_feed")


@job
def redirect_domains(run: Run) -> None:
    """Rows are replaced where the top domain is new; nothing else changes."""
    path = run.path("redirect_domains")
    top = feeds.top_domains(run.table("redirects"), run.as_of)
    top.limit(0).write.mode("append").parquet(path)
    changed = feeds.changed_domains(top, run.spark.read.parquet(path))
    keyed.replace_rows(run.spark, changed, path, ["channel", "offer_id"])


@job
def forwarded_postbacks(run: Run) -> None:
    slot = run.last_slot
    run.load(feeds.forwarded_postbacks(run.table("direct"), slot, slot, slot[:8]), "forwarded_postbacks", "time_slot", [slot])


@job
def install_export(run: Run) -> None:
    files.export_csv(feeds.install_day(run.table("af_installs"), run.yesterday), run.path(f"cvr_install_{run.yesterday}"))


@job
def af_report(run: Run) -> None:
    """The day is kept as a partition, so that a rerun replaces it."""
    day = slots.slot_before(run.as_of)[:8]
    rows = feeds.normalize_af_report(run.table("af_report"), day).withColumn("day", F.lit(day))
    run.load(rows, "af_report_normalized", "day", [day])


@job
def device_inventory(run: Run) -> None:
    run.load(feeds.device_inventory(run.table("models"), run.yesterday), "device_inventory", "date", [run.yesterday])


@job
def device_counts(run: Run) -> None:
    run.load(feeds.device_counts(run.table("device_settings"), run.iso(0)), "device_counts", "day", [run.today])


@job
def partner_report(run: Run) -> None:
    """The partner's file of yesterday is ``root/partner/<day>.csv``."""
    lines = partner_csv.read_partner_csv(run.spark, run.path(f"partner/{run.iso(1)}.csv"))
    run.load(feeds.partner_report(lines), "partner_report", "date", [run.iso(1)])


@job
def offer_dimension(run: Run) -> None:
    run.refresh(dims.offer_dimension(run.table("offers")), "offer_dimension")


@job
def stream_offer_dimension(run: Run) -> None:
    run.refresh(dims.stream_offer_dimension(run.table("stream_offers")), "stream_offer_dimension")


def _yesterday(report: Callable[..., DataFrame], name: str, partition_by: str, *inputs: str) -> None:
    def load(run: Run) -> None:
        rows = report(*run.several(*inputs), *slots.day_bounds(run.yesterday))
        typed = dict(rows.dtypes)[partition_by] == "date"
        run.load(rows, name, partition_by, [run.iso(1) if typed else run.yesterday])

    JOBS[name] = load


_yesterday(rollups.offer_conv_click, "offer_conv_click", "date", "conversions", "impressions")
_yesterday(rollups.offer_share, "offer_share", "day", "impressions", "conversions")
_yesterday(rollups.imp_click, "imp_click", "date", "impressions", "clicks")
_yesterday(rollups.offer_slot_conv, "offer_slot_conv", "day", "conversions")


@job
def day_platform_report(run: Run) -> None:
    """Three trailing days, so that late rows arrive; every touched day is replaced."""
    first, last = slots.trailing_days(run.as_of, 3)
    rows = rollups.day_platform_report(*run.several("impressions", "conversions"), first, last)
    run.load(rows, "day_platform_report", "day", [slots.day_before(run.as_of, n) for n in (3, 2, 1)])


@job
def slot_rollups(run: Run) -> None:
    """Six rollups over the seven trailing days, with one scan per log."""
    since = f"{slots.day_before(run.as_of, 7)}00"
    requests = materialize(rollups.request_rollups(run.table("requests"), since), "requests")
    impressions = materialize(rollups.impression_rollups(run.table("impressions"), since), "impressions")
    outputs = {
        "slot_requests": rollups.part_of(requests, "visible"),
        "slot_listed_requests": rollups.part_of(requests, "listed"),
        "slot_impressions": rollups.part_of(impressions, "shown"),
        "slot_all_clicks": rollups.part_of(impressions, "hidden"),
        "slot_clicks": rollups.slot_clicks(run.table("clicks"), since),
        "slot_conversions": rollups.slot_conversions(run.table("conversions"), since),
    }
    for name, rows in outputs.items():
        run.refresh(rows, name)


def _alarm(report: Callable[..., DataFrame], name: str, *inputs: str) -> None:
    def load(run: Run) -> None:
        # two days of log cover every period an hour is compared with
        recent = [_recent(run.table(n), run.as_of) for n in inputs]
        run.load(report(*recent, first=run.last_slot, last=run.last_slot), name, "time_slot", [run.last_slot])

    JOBS[name] = load


def _recent(df: DataFrame, as_of: datetime) -> DataFrame:
    if "time_slot" in df.columns:
        return df.where(F.col("time_slot").between(slots.slot_before(as_of, 48), slots.slot_before(as_of)))
    first, end = (slots.instant(slots.slot_instant(slots.slot_before(as_of, n))) for n in (48, 0))
    return df.where((F.col("created") >= first) & (F.col("created") < end))


_alarm(alarms.traffic_alarm, "traffic_alarm", "impressions", "async_clicks", "conversions")
_alarm(alarms.stream_alarm, "stream_alarm", "stream", "conversion_events")
_alarm(alarms.volume_alarm, "volume_alarm", "clicks", "impressions")


@job
def clear_counters(run: Run) -> None:
    """Empty the counter snapshots, as at the start of a day."""
    for name in COUNTER_TABLES:
        empty = run.spark.createDataFrame([], run.spark.read.parquet(run.path(name)).schema)
        replace_folder(empty, run.path(name))


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run scheduled reports.")
    parser.add_argument("jobs", nargs="+", choices=sorted(JOBS), metavar="JOB", help=", ".join(sorted(JOBS)))
    parser.add_argument("--as-of", required=True, type=datetime.fromisoformat, help="UTC instant of the run")
    parser.add_argument("--root", required=True, help="folder of report files")
    parser.add_argument("--database", default=None, help="catalog database of the input tables")
    args = parser.parse_args(argv)
    spark = build_session("adtally " + " ".join(args.jobs))
    prefix = f"{args.database}." if args.database else ""
    for name in args.jobs:
        try:
            JOBS[name](Run(spark, lambda t: spark.table(prefix + t), args.as_of, args.root))
        finally:
            clear_scratch(spark)


if __name__ == "__main__":
    main()
