"""Streams over files that arrive in several batches, compared with batch results."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adtally.functions.numbers import count_where
from adtally.sinks.tables import create_table
from adtally.streaming import counters as streams
from tests.conftest import got
from tests.test_reports import EVENTS, event
from testbed.operators import SLICES, _event_stream

CLICKS = "created timestamp, routed_offer string, slot string, click_through string"


def at(minutes: int) -> datetime:
    return datetime(2024, 1, 1, 8) + timedelta(minutes=minutes)


def read(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture
def arriving(spark, tmp_path):
    """Write batches in order, one file each."""
    path = str(tmp_path / "in")

    def write(schema, *batches):
        for b in batches:
            spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(path)
        return path

    return write


def test_closed_hours_equal_batch_and_rerun(spark, arriving, tmp_path):
    batches = [
        [event(ts=at(5)), event(code="1", ts=at(10))],
        [event(ts=at(70), payout=2.5), event(ts=at(20))],  # second row is late but inside two hours
        [event(ts=at(60 * 6)), event("o2", ts=at(60 * 6))],
        [event(ts=at(60 * 6 + 1))],  # closes the first hours
        [event(ts=at(30))],  # too late: dropped
        [event(ts=at(60 * 12))],
    ]
    path = arriving(EVENTS, *batches)
    windows = streams.hourly_conversions(read(spark, EVENTS, path))
    create_table(spark.createDataFrame([], windows.schema), "closed_hours", ["time_slot"], str(tmp_path / "t"))
    streams.run_closed_windows(windows, "closed_hours", str(tmp_path / "cp")).awaitTermination()
    out = spark.table("closed_hours").select("time_slot", "offer_id", "install", "conv", "revenue")
    want = [
        ("2024010108", "o1", 1, 2, 3.0), ("2024010109", "o1", 0, 1, 2.5), ("2024010114", "o1", 0, 2, 2.0), ("2024010114", "o2", 0, 1, 1.0),
    ]
    assert got(out) == want
    streams.run_closed_windows(streams.hourly_conversions(read(spark, EVENTS, path)), "closed_hours", str(tmp_path / "cp")).awaitTermination()
    assert got(out) == want
    spark.sql("DROP TABLE closed_hours")


def test_daily_counters_accumulate_over_batches(spark, arriving, tmp_path):
    path = arriving(
        CLICKS,
        [(at(0), "r1", "s1", "1"), (at(1), "r1", "s1", "0")],
        [(at(2), "r1", "s1", "1"), (at(3), "r2", "s1", "1")],
        [(at(24 * 60), "r1", "s1", "1")],
    )
    counts = streams.daily_clicks(read(spark, CLICKS, path))
    target = tmp_path / "kv"
    spark.createDataFrame([], counts.schema).write.partitionBy("day").parquet(str(target))
    streams.run_cumulative(counts, str(target), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.schema(counts.schema).parquet(str(target)).select("day", "key", "value")
    assert got(out) == [("20240101", "r1_s1", "2"), ("20240101", "r2_s1", "1"), ("20240102", "r1_s1", "1")]


@pytest.mark.parametrize("windows, minutes", [(streams.install_windows, 10), (streams.pacing_windows, 5)])
def test_look_back_windows(spark, arriving, tmp_path, windows, minutes):
    rows = [event(code=c, ts=at(m)) for m in (0, 4, 6, 11) for c in "12"] + [event(code=c, ts=at(600)) for c in "12"]
    path = arriving(EVENTS, rows[:3], rows[3:6], rows[6:8], [event(code=c, ts=at(60 + m)) for c in "12" for m in (0, 1)], rows[8:])
    df = windows(read(spark, EVENTS, path))
    name = f"look_back_{minutes}"
    create_table(spark.createDataFrame([], df.schema), f"{name}_flat", (), str(tmp_path / "f"))
    with pytest.raises(ValueError, match="partitioned"):
        streams.run_closed_windows(df, f"{name}_flat", str(tmp_path / "cpf"))
    spark.sql(f"DROP TABLE {name}_flat")
    create_table(spark.createDataFrame([], df.schema), name, ("minute_slot",), str(tmp_path / "t"))
    streams.run_closed_windows(df, name, str(tmp_path / "cp")).awaitTermination()
    code = "1" if minutes == 10 else "2"
    batch = (
        spark.read.schema(EVENTS).parquet(path).where((F.col("event_type") == code) & (F.col("utctime") < F.lit(at(500))))
        .groupBy(F.date_format(F.window("utctime", f"{minutes} minutes").start, "yyyyMMddHHmm").alias("m"))
        .agg(count_where(F.lit(True)).alias("n"))
    )
    measure = "install" if minutes == 10 else "conv"
    assert got(spark.table(name).select("minute_slot", measure)) == got(batch)
    spark.sql(f"DROP TABLE {name}")


def test_trailing_recompute_empties_slots_without_rows(spark, rows, tmp_path):
    schema = "time_slot string, n long"
    create_table(rows(schema, ("x", 1)), "trailing", ["time_slot"], str(tmp_path / "t"))
    data = {"2024010100": 1, "2024010101": 2, "2024010102": 3}

    def report(first, last):
        return rows(schema, *[(k, v) for k, v in data.items() if first <= k <= last])

    streams.recompute_trailing(report, "trailing", "2024010100", "2024010102")
    del data["2024010101"]
    data["2024010102"] = 4
    streams.recompute_trailing(report, "trailing", "2024010101", "2024010102")
    assert got(spark.table("trailing").select("time_slot", "n")) == [("2024010100", 1), ("2024010102", 4)]
    spark.sql("DROP TABLE trailing")


def test_event_slices_arrive_whole_from_many_files(spark, tmp_path):
    sf, seen = "/root/testdata/sf0.001", []

    def note(batch, _):
        batch = batch.select(F.col("ts").cast("timestamp").alias("at"), F.input_file_name().alias("file"))
        seen.append(batch.agg(F.min("at"), F.max("at"), F.count("*"), F.count_distinct("file")).first())

    stream = _event_stream(spark, sf).writeStream.foreachBatch(note).option("checkpointLocation", str(tmp_path / "at"))
    stream.trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == SLICES and all(files > 1 for *_, files in seen) and len({files for *_, files in seen}) == 1
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))
    assert sum(n for _, _, n, _ in seen) == spark.read.parquet(f"{sf}/events.parquet").count()
