from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from adtally.session import clear_scratch, materialize, replace_folder, shared_dir, use_scratch
from adtally.sinks import files, keyed, tables
from adtally.sources.tables import target_schema
from tests.conftest import got

SLOTS = "time_slot string, k string, n long"


@pytest.fixture
def table(spark, rows, tmp_path, request):
    name = "t_" + request.node.name.replace("[", "_").replace("]", "_")
    tables.create_table(rows(SLOTS, ("x", "x", 1)), name, ["time_slot"], str(tmp_path / name))
    yield name
    spark.sql(f"DROP TABLE {name}")


def cols(spark, name):
    return got(spark.table(name).select("time_slot", "k", "n"))


def test_append_keeps_rows_and_conforms(spark, rows, table):
    tables.append(rows("n string, k string, time_slot string", ("1", "a", "2024010100")), table)
    tables.append(rows(SLOTS, ("2024010100", "a", 1)), table)
    assert cols(spark, table) == [("2024010100", "a", 1)] * 2
    assert target_schema(spark, table)["n"].dataType.simpleString() == "bigint"


def test_replace_touches_only_its_partitions_and_reruns(spark, rows, table):
    tables.replace_partition(rows(SLOTS, ("2024010100", "a", 1), ("2024010101", "b", 2)), table)
    for _ in range(2):
        tables.replace_partition(rows(SLOTS, ("2024010101", "c", 3), ("2024010102", "d", 4)), table)
    assert cols(spark, table) == [("2024010100", "a", 1), ("2024010101", "c", 3), ("2024010102", "d", 4)]


def test_a_covered_partition_without_rows_is_emptied(spark, rows, table):
    tables.replace_partition(rows(SLOTS, ("2024010100", "a", 1), ("2024010101", "b", 2)), table)
    tables.replace_partition(rows(SLOTS, *[]), table, covers=["2024010101"])
    assert cols(spark, table) == [("2024010100", "a", 1)]


def test_refresh_replaces_everything(spark, rows, table):
    tables.append(rows(SLOTS, ("2024010100", "a", 1)), table)
    tables.refresh(rows(SLOTS, ("2024010200", "z", 9)), table)
    assert cols(spark, table) == [("2024010200", "z", 9)]


def test_overwrite_mode_is_restored(spark, rows, table):
    before = spark.conf.get(tables.OVERWRITE_MODE)
    with pytest.raises(Exception):
        tables.refresh(rows("q string", ("x",)), table)
    tables.refresh(rows(SLOTS, ("2024010200", "z", 9)), table)
    assert spark.conf.get(tables.OVERWRITE_MODE) == before


def test_expire_by_day_prefix(spark, rows, table):
    tables.append(rows(SLOTS, ("2024010100", "a", 1), ("2024010123", "b", 1), ("2024010200", "c", 1)), table)
    assert sorted(tables.expire(spark, table, "time_slot", "20240101")) == ["2024010100", "2024010123"]
    assert cols(spark, table) == [("2024010200", "c", 1)]


def test_expired_files_are_gone(spark, rows, table, tmp_path):
    tables.append(rows(SLOTS, ("2024010100", "a", 1), ("2024010200", "c", 1)), table)
    tables.expire(spark, table, "time_slot", "20240101")
    assert spark.read.parquet(str(tmp_path / table)).count() == 1


def failing(spark, rows):
    """Rows that fail while they are computed."""
    return rows(SLOTS, ("2024010100", "new", 1), ("2024010101", "new", 2)).withColumn(
        "n", F.when(F.col("n") == 2, F.raise_error(F.lit("report failed")).cast("long")).otherwise(F.col("n"))
    )


@pytest.mark.parametrize("load", ["partition", "refresh", "refresh_flat", "rows", "kv"])
def test_a_failing_load_leaves_the_old_rows(spark, rows, tmp_path, load):
    old, bad = rows(SLOTS, ("2024010100", "a", 1), ("2024010101", "b", 2)), failing(spark, rows)
    name, path = f"kept_{load}", str(tmp_path / load)
    if load in ("rows", "kv"):
        old = old if load == "rows" else old.select(F.col("time_slot").alias("key"), "k")
        bad = bad if load == "rows" else bad.select(F.col("time_slot").alias("key"), F.concat("k", F.col("n").cast("string")).alias("k"))
        old.write.parquet(path)
        with pytest.raises(Exception, match="report failed"):
            keyed.replace_rows(spark, bad, path, ["time_slot"]) if load == "rows" else keyed.upsert_kv(spark, bad, path)
        assert got(spark.read.parquet(path)) == got(old)
        return
    tables.create_table(old, name, ["time_slot"] if load != "refresh_flat" else (), path)
    tables.append(old, name)
    with pytest.raises(Exception, match="report failed"):
        tables.replace_partition(bad, name, ["2024010100", "2024010101"]) if load == "partition" else tables.refresh(bad, name)
    assert cols(spark, name) == got(old)
    spark.sql(f"DROP TABLE {name}")


def test_refresh_without_partitions_swaps_the_folder(spark, rows, tmp_path):
    path = tmp_path / "flat"
    tables.create_table(rows(SLOTS, ("x", "x", 1)), "flat", (), str(path))
    for n in (1, 2):
        tables.refresh(rows(SLOTS, ("2024010100", "a", n)), "flat")
        assert cols(spark, "flat") == [("2024010100", "a", n)]
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("flat")] == ["flat"]
    spark.sql("DROP TABLE flat")


def test_a_failed_swap_is_undone(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "live")
    rows("a long", (1,)).write.parquet(path)
    with pytest.raises(Exception):
        replace_folder(rows("a string", ("x",)).select(F.raise_error(F.lit("no"))), path)
    assert got(spark.read.parquet(path)) == [(1,)] and [p.name for p in tmp_path.iterdir()] == ["live"]


def test_scratch_is_cleared(spark, rows):
    out = materialize(rows("a long", (1,)), "probe")
    folder = Path(out.inputFiles()[0].removeprefix("file://").removeprefix("file:")).parent
    assert folder.exists()
    clear_scratch(spark)
    assert not folder.exists()


def test_no_scratch_without_a_setting():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"getCheckpointDir": lambda self: None, "master": "yarn"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
    assert use_scratch(Session()).sparkContext.getCheckpointDir() is None


def test_clear(spark, rows, table):
    tables.append(rows(SLOTS, ("2024010100", "a", 1)), table)
    tables.clear(spark, [table])
    assert cols(spark, table) == []


def test_kv_upsert_is_idempotent_and_ordered(spark, rows, tmp_path):
    path = str(tmp_path / "kv")
    rows("key string, value string", ("a", "1"), ("b", "2")).write.parquet(path)
    updates = rows("value string, key string", ("9", "b"), ("7", "b"), ("3", "c"))
    for _ in range(2):
        keyed.upsert_kv(spark, updates, path, order=[-F.col("value").cast("int")])
        assert got(spark.read.parquet(path)) == [("a", "1"), ("b", "9"), ("c", "3")]


def test_partitioned_upsert_leaves_other_days_alone(spark, rows, tmp_path):
    path, schema = tmp_path / "kv", "day string, key string, value string"
    rows(schema, ("d1", "a", "1"), ("d2", "a", "2"), ("d2", "b", "3")).write.partitionBy("day").parquet(str(path))
    untouched = sorted(p.name for p in (path / "day=d1").iterdir())
    keyed.upsert_kv(spark, rows(schema, ("d2", "a", "9"), ("d3", "a", "7")), str(path), partition_by="day")
    out = spark.read.schema(schema).parquet(str(path)).select("day", "key", "value")
    assert got(out) == [("d1", "a", "1"), ("d2", "a", "9"), ("d2", "b", "3"), ("d3", "a", "7")]
    assert sorted(p.name for p in (path / "day=d1").iterdir()) == untouched


def test_update_may_set_null_over_a_stored_value(spark, rows):
    out = keyed.merged(rows("key string, value string", ("a", "1")), rows("key string, value string", ("a", None)), ["key"])
    assert got(out) == [("a", None)]


def test_update_from_adds_no_rows(rows):
    target = rows("k string, t double, n long", ("a", 1.0, 0), ("b", 2.0, 5))
    source = rows("k string, n long", ("a", 7), ("z", 9))
    assert got(keyed.update_from(target, source, ["k"], ["n"])) == [("a", 1.0, 7), ("b", 2.0, 5)]


def test_snapshot_drops_incomplete_pairs(rows):
    df = rows("id string, v long", ("f1", 3), (None, 4), ("f2", None))
    assert got(keyed.snapshot_kv(df, F.col("v"), "id", F.lit("cap"))) == [("f1_cap", "3")]


def test_settlement_bytes(spark, rows, tmp_path):
    path = tmp_path / "out"
    files.export_settlement(rows("a string, b long, c string", ("x\u0001y", 5, None)), str(path))
    parts = sorted(path.glob("*.gz"))
    assert b"".join(gzip.decompress(p.read_bytes()) for p in parts) == b"x y\x015\x01None\r\n"
    manifest = files.export_manifest(spark, str(path))
    assert got(manifest) == sorted((p.name, hashlib.md5(p.read_bytes()).hexdigest()) for p in parts)
    assert files.manifest_lines(manifest).first().value.count(",") == 1


def test_large_days_are_written_in_bounded_parts(spark, tmp_path):
    path, days = tmp_path / "daily", {"d1": 400, "d2": 30, "d3": 5, "d4": 130}
    lines = spark.createDataFrame([(d, f"{d} {k * 7919 % n:04d}") for d, n in days.items() for k in range(n)], "day string, value string")
    files.export_daily_lines(lines, str(path), lines_per_file=50)
    want = set()
    for day, n in days.items():
        parts = sorted((path / f"day={day}").glob("*.txt"))
        texts = [p.read_bytes() for p in parts]
        assert b"".join(texts).decode().splitlines() == sorted(f"{day} {k:04d}" for k in range(n))
        assert all(x.count(b"\n") <= 50 for x in texts) and (len(parts) == 1) == (n <= 50)
        want |= {(f"day={day}" + (f"/{p.name}" if len(parts) > 1 else ""), hashlib.md5(x).hexdigest()) for p, x in zip(parts, texts, strict=True)}
    assert {tuple(r) for r in files.export_manifest(spark, str(path), "*.txt", by_folder=True).collect()} == want
    assert len({name.split("-")[1] for name, _ in want if name.startswith("day=d1/")}) > 2  # several tasks wrote the largest day


def test_csv_and_tsv_have_no_header(rows, tmp_path):
    df = rows("a string, b long", ("x", 1))
    files.export_csv(df, str(tmp_path / "c"))
    files.export_tsv(df, str(tmp_path / "t"))
    text = {k: "".join(p.read_text() for p in (tmp_path / k).glob("part-*")) for k in "ct"}
    assert text == {"c": "x,1\n", "t": "x\t1\n"}


def test_materialize_cuts_lineage_in_the_shared_folder(spark, rows):
    out = materialize(rows("a string, b long", ("x", 1)).where("b = 1"), "probe")
    assert got(out) == [("x", 1)]
    assert "FileScan parquet" in out._jdf.queryExecution().executedPlan().toString()
    assert Path(out.inputFiles()[0].removeprefix("file://").removeprefix("file:")).is_relative_to(shared_dir(spark).removeprefix("file:"))
