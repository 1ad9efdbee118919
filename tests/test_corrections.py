"""Streams with late rows, overlapping look-backs and batch folders."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adtally.sinks import tables as sink
from adtally.streaming import corrections, look_backs
from adtally.streaming import counters as streams
from testbed import QUERIES, scaled
from testbed.tables import Testbed
from tests.conftest import got
from tests.test_reports import EVENTS, event
from tests.test_streaming import arriving, read  # noqa: F401

SF = "/root/testdata/sf0.001"
ROWS = "ts timestamp, k string, n long"
START = datetime(2024, 1, 1, 8)


def at(minutes: float) -> datetime:
    return START + timedelta(minutes=minutes)


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, corrections.ROCKSDB)
    yield
    spark.conf.set(name, before)


def collect(terms, tmp_path):
    """Rows of each batch, by its number, and the finished query."""
    seen = {}

    def note(batch, number):
        seen[number] = got(batch)

    run = terms.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(note)
    run = run.trigger(availableNow=True).start()
    run.awaitTermination()
    return [r for k in sorted(seen) for r in seen[k]], run


def test_first_sums_corrections_and_the_horizon(spark, arriving, tmp_path, rocks):  # noqa: F811
    path = arriving(
        ROWS,
        [(at(5), "a", 1), (at(10), "a", 2), (at(20), None, 5)],
        [(at(90), "a", 10)],  # the first hour has ended; the batch after this one sends it
        [(at(30), "a", 4), (at(95), "a", 10)],  # late, but still in the first sum
        [(at(31), "a", 6), (at(32), "a", -2)],  # a correction
        [(at(40), "b", 7), (at(300), "a", 100)],  # a key seen late only
        [(at(50), "a", -4)],  # past the horizon of three hours, but the first batch to know it
        [(at(55), "a", 1000), (at(310), "a", 1)],  # dropped
        [(at(320), "a", 1)],
    )
    terms = corrections.hourly_corrections(read(spark, ROWS, path), "ts", ["k"], 10, 3, n=F.col("n"))
    rows, _ = collect(terms.select("k", "hour", "kind", "n"), tmp_path)
    hours = {START: "8", at(60): "9", at(300): "13"}
    told = sorted((k or "", hours[h], kind, n) for k, h, kind, n in rows)
    assert told == [
        ("", "8", "first", 5), ("a", "8", "correction", -4), ("a", "8", "correction", 4), ("a", "8", "first", 7), ("a", "9", "first", 20), ("b", "8", "first", 7),
    ]


def test_terms_add_up_to_the_batch_report_with_bounded_state(spark):
    t = Testbed.of(spark, "/root/testdata/sf0.01")
    stored, run = scaled.run_corrections(t, scaled.shuffled_stream(t)("conversion_events"))
    kinds = {r["kind"]: r["count"] for r in stored.groupBy("kind").count().collect()}
    assert kinds[corrections.CORRECTION] > 10 and kinds[corrections.FIRST] > kinds[corrections.CORRECTION]
    events = t("conversion_events")
    total, hours = events.count(), events.select(F.date_trunc("hour", "utctime"), "channel").distinct().count()
    sent = stored.agg(F.sum("install") + F.sum("conv")).first()[0]
    latest = events.agg(F.max("utctime")).first()[0]
    waiting = events.where(F.date_trunc("hour", "utctime") + F.make_dt_interval(hours=F.lit(1), mins=F.lit(10)) > F.lit(latest)).count()
    assert sent == total - waiting
    # state of the last horizon only (two salts at most), of a month of hours
    kept = run.lastProgress["stateOperators"][0]["numRowsTotal"]
    recent = events.where(F.col("utctime") >= F.lit(latest) - F.make_dt_interval(hours=F.lit(scaled.HORIZON_HOURS + 1)))
    bound = 2 * recent.select(F.date_trunc("hour", "utctime"), "channel").distinct().count()
    assert 0 < kept and kept <= 4 * bound and kept < hours, (kept, bound, hours)


def test_grace_must_be_below_the_horizon(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="grace"):
        corrections.hourly_corrections(stream, "timestamp", ["value"], 120, 2, n=F.lit(1))


def test_look_backs_of_a_stream_over_several_runs(spark, arriving, tmp_path):  # noqa: F811
    """Batches that arrive in two runs give what one batch query gives, and a replayed batch changes nothing."""
    keys = ["k"]

    def run(path):
        closed = look_backs.pane_stream(read(spark, ROWS, path), "ts", keys, "2 minutes", s=F.sum("n"))
        look_backs.run_look_backs(closed, keys, (3, 30), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return closed

    first = [[(at(0), "a", 1), (at(1.5), "a", 2), (at(1.2), None, 3)], [(at(4), "a", 5), (at(3.1), "b", 1)], [(at(20), "b", 2)]]
    then = [[(at(21), "a", 4), (at(19.5), "a", 9)], [(at(16 * 60 + 5), "a", 1)], [(at(16 * 60 + 20), "a", 1)], [(at(16 * 60 + 30), "b", 1)]]
    run(arriving(ROWS, *first))
    closed = run(arriving(ROWS, *then))
    out = look_backs.stored_look_backs(closed, keys, str(tmp_path / "out"))
    last = 16 * 60 + 20  # the last minute closed by the latest event less two minutes
    want = []
    for size in (3, 30):
        for k in ("a", "b", None):
            for end in range(1, last + 2):
                inside = [n for ts, key, n in sum(first + then, []) if key == k and at(end - size) <= ts < at(end) and ts < at(last + 1)]
                if inside:
                    want.append((k, size, at(end), sum(inside)))
    assert got(out.select("k", "size", "as_of", "s")) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture
def windows_table(spark, tmp_path):
    schema = spark.createDataFrame([], "minute_slot string, offer_id string, af_siteid string, install long, day string, batch string")
    sink.create_table(schema, "batched_windows", ["day", "batch"], str(tmp_path / "t"))
    yield "batched_windows"
    spark.sql("DROP TABLE batched_windows")


def test_windows_of_a_batch_share_a_folder(spark, arriving, tmp_path, windows_table):  # noqa: F811
    """Partitions follow days and batches, not windows; a batch written twice leaves the same table."""
    days = [[event(code="1", ts=at(60 * 24 * d + 7 * k)) for k in range(60)] for d in range(3)]
    path = arriving(EVENTS, *days, [event(code="1", ts=at(60 * 24 * 4))])
    streams.run_closed_windows(streams.install_windows(read(spark, EVENTS, path)), windows_table, str(tmp_path / "cp")).awaitTermination()
    out = spark.table(windows_table)
    want = got(
        spark.read.schema(EVENTS).parquet(path).where((F.col("event_type") == "1") & (F.col("utctime") < F.lit(at(60 * 24 * 3))))
        .groupBy(F.date_format(F.window("utctime", "10 minutes").start, "yyyyMMddHHmm").alias("m")).count()
    )
    assert got(out.select("minute_slot", "install")) == want
    assert out.select("minute_slot").distinct().count() > 3 * len(spark.sql(f"SHOW PARTITIONS {windows_table}").collect())
    name = out.select("batch").first()[0]
    with sink.staged(out.where(F.col("batch") == name).drop("day", "batch"), "replay") as rows:
        sink.store_batch(rows, windows_table, name, "minute_slot")
    assert got(spark.table(windows_table).select("minute_slot", "install")) == want
    day = out.select("day").first()[0]
    sink.compact_batches(spark, windows_table, day)
    assert got(spark.table(windows_table).select("minute_slot", "install")) == want
    assert {r.batch for r in spark.table(windows_table).where(F.col("day") == day).select("batch").collect()} == {"compacted"}
    assert spark.table(windows_table).where(F.col("day") != day).count() > 0


def test_a_thousand_partitions_are_cleared_in_seconds(spark, tmp_path):
    """One catalog call for all partitions; files go, folders registered from elsewhere stay."""
    rows = spark.range(0, 1000, 1, 4).select("id", F.format_string("%04d", "id").alias("slot"))
    sink.create_table(rows, "many_slots", ["slot"], str(tmp_path / "t"))
    sink.replace_partition(rows, "many_slots")
    elsewhere = tmp_path / "elsewhere"
    spark.range(3).write.parquet(str(elsewhere))
    spark.sql(f"ALTER TABLE many_slots ADD PARTITION (slot='x') LOCATION '{elsewhere}'")
    assert len(spark.sql("SHOW PARTITIONS many_slots").collect()) == 1001
    start = time.perf_counter()
    sink.clear(spark, ["many_slots"])
    assert time.perf_counter() - start < 10
    assert spark.sql("SHOW PARTITIONS many_slots").count() == 0 and spark.table("many_slots").count() == 0
    assert not list((tmp_path / "t").glob("slot=*")) and list(elsewhere.glob("*.parquet"))
    spark.sql("DROP TABLE many_slots")


@pytest.mark.parametrize("name", ["stream_hourly_conversions", "stream_install_windows", "stream_pacing_windows"])
def test_registered_streams_store_few_partitions(spark, name, monkeypatch):
    seen = []
    whole = sink.store_batch
    monkeypatch.setattr(streams, "store_batch", lambda df, table, batch, slot: (seen.append(table), whole(df, table, batch, slot)))
    n = QUERIES[name](spark, SF).count()
    parts = len(spark.sql(f"SHOW PARTITIONS {seen[0]}").collect())
    assert n > 0 and parts <= 31 + 2 * len(seen)
