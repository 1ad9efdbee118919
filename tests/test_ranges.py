"""Running sums by ranges, apportionment, combined checksums and bucketed snapshots: properties and plans."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from adtally.operators import apportion, ranges
from adtally.sinks import buckets, checksums, keyed
from testbed import scaled
from testbed.tables import Testbed
from tests.conftest import got
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"


# --- running sums -------------------------------------------------------------------------


def plain_before(data):
    seen, out = defaultdict(int), []
    for key, at, value in sorted(data, key=lambda r: r[1]):
        out.append((key, at, value, seen[key]))
        seen[key] += value or 0
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("n", [1, 3, 16])
def test_running_sums_equal_the_plain_version(spark, n):
    rng = random.Random(n)
    data = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), k, rng.choice([0, 1, 5, -2, None])) for k in range(400)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "key string, at long, value long")
    assert got(ranges.running_before(df, ["key"], [F.col("at")], {"before": "value"}, ranges=n)) == plain_before(data)


def test_running_sums_of_nothing(spark):
    empty = spark.createDataFrame([], "key string, at long, value long")
    assert ranges.running_before(empty, ["key"], [F.col("at")], {"before": "value"}).collect() == []


def test_a_hot_group_is_spread_over_ranges(spark):
    """Windows go over one group in one range, and no range holds more than a few times the average."""
    df = spark.range(8000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"), "id", F.lit(1).alias("one"))
    run = ranges.running_before(df, ["key"], [F.col("id")], {"before": "one"}, ranges=16)
    windows = [line for line in plan(run).splitlines() if re.search(r"\bWindow \[", line)]
    assert len(windows) == 2 and all("_bucket#" in line for line in windows)
    stored = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in run.inputFiles()})
    sizes = [r["count"] for r in stored.groupBy("_bucket").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 8000 / 16
    assert len({r[0] for r in stored.where("key = 'hot'").select("_bucket").distinct().collect()}) > 5


# --- apportionment -----------------------------------------------------------------------


def plain_shares(data, units):
    out, groups = [], defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    for rows in groups.values():
        whole = sum(w or 0 for *_, w in rows)
        if not whole:
            out += [(*r, None) for r in rows]
            continue
        exact = {r[:2]: Fraction((r[2] or 0) * units, whole) for r in rows}
        left = units - sum(int(x) for x in exact.values())
        first = sorted(rows, key=lambda r: (-(exact[r[:2]] % 1), r[1]))[:left]
        out += [(*r, int(exact[r[:2]]) + (r in first)) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("units", [0, 1, 7, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_shares_equal_the_plain_version_and_add_up(spark, units, seed):
    rng = random.Random(seed)
    # ties in a third of the rows, a group of zeros, a group of NULLs
    data = [(rng.choice(["hot", "hot", "a", "b", None]), k, rng.choice([1, 1, 1, 0, None, 10**12, rng.randrange(50)])) for k in range(300)]
    data += [("zeros", 1, 0), ("zeros", 2, 0), ("nothing", 1, None)]
    df = spark.createDataFrame(data, "key string, at long, weight long")
    shared = got(apportion.apportion(df, ["key"], "weight", [F.col("at")], units, ranges=8))
    assert shared == plain_shares(data, units)
    sums = defaultdict(int)
    for key, _, _, share in shared:
        if share is not None:
            sums[key] += share
    assert set(sums.values()) == {units} and set(sums) == {"hot", "a", "b", None}


def test_large_products_do_not_overflow(rows):
    df = rows("key string, at long, weight long", ("a", 1, 4 * 10**18), ("a", 2, 4 * 10**18), ("a", 3, 1))
    shares = [r.share for r in apportion.apportion(df, ["key"], "weight", [F.col("at")], 9 * 10**18 + 1).orderBy("at").collect()]
    assert sum(shares) == 9 * 10**18 + 1 and shares == [4500000000000000000, 4499999999999999999 + 1, 1]


def test_negative_measures_raise(rows):
    df = rows("key string, at long, weight long", ("a", 1, 3), ("a", 2, -1))
    with pytest.raises(PySparkException, match="negative weight"):
        apportion.apportion(df, ["key"], "weight", [F.col("at")]).collect()


def test_units_follow_the_group(rows):
    df = rows("key string, at long, weight long, amount long", ("a", 1, 1, 5), ("a", 2, 1, 5), ("b", 1, 2, 7), ("b", 2, 1, 7))
    shared = apportion.apportion(df, ["key"], "weight", [F.col("at")], F.col("amount"))
    assert got(shared.select("key", "at", "share")) == [("a", 1, 3), ("a", 2, 2), ("b", 1, 5), ("b", 2, 2)]


def test_apportioned_windows_are_cut_by_ranges(spark):
    found = plan(scaled._shares(Testbed.of(spark, SF)))
    windows = [line for line in found.splitlines() if re.search(r"\bWindow \[", line)]
    assert windows and all("_bucket#" in line for line in windows)


# --- checksums -----------------------------------------------------------------------------


def test_moved_crc_equals_zero_bytes(spark):
    cases = [(b"abc", 0), (b"abc", 1), (b"", 5), (b"x" * 50, 1000), (b"\xff\x00", 70_001)]
    df = spark.createDataFrame([(k, zlib.crc32(b), n) for k, (b, n) in enumerate(cases)], "k int, crc long, n long")
    found = [r[0] for r in df.orderBy("k").select(checksums.moved_crc32(F.col("crc"), F.col("n"))).collect()]
    tail = [zlib.crc32(b + b"\0" * n) ^ zlib.crc32(b"\0" * n) for b, n in cases]
    assert found == tail


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_combined_checksum_equals_the_joined_file(spark, n):
    rng = random.Random(n)
    bodies = {f: [rng.randbytes(rng.choice([0, 1, 3, 500, 5000])) for _ in range(n)] for f in "ab"}
    data = [(f, k, bytearray(b)) for f, parts in bodies.items() for k, b in enumerate(parts)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "file string, nth int, content binary")
    parts = df.select("file", "nth", F.crc32("content").alias("crc32"), F.octet_length("content").cast("long").alias("n_bytes"))
    found = got(checksums.combined_crc32(parts, ["file"], [F.desc("nth")], ranges=5))
    assert found == [(f, zlib.crc32(b"".join(p)), sum(map(len, p)), n) for f, p in sorted(bodies.items())]


@pytest.mark.parametrize("lines_per_file", [7, 1000])
def test_exported_checksums_do_not_depend_on_the_parts(spark, lines_per_file, tmp_path):
    from adtally.sinks import files

    lines = [(f"d{k % 3}", f"{k * 7919 % 100:04d},line") for k in range(100)]
    files.export_daily_lines(spark.createDataFrame(lines, "day string, value string"), str(tmp_path / "out"), lines_per_file)
    want = set()
    for day in ("d0", "d1", "d2"):
        body = "".join(v + "\n" for v in sorted(v for d, v in lines if d == day)).encode()
        n = len(list((tmp_path / "out" / f"day={day}").glob("*.txt")))
        want.add((f"day={day}", f"{zlib.crc32(body):08x}", len(body), n))
    assert {tuple(r) for r in checksums.export_checksums(spark, str(tmp_path / "out")).collect()} == want


def test_parts_follow_their_numbers_not_their_names(spark, tmp_path):
    folder = tmp_path / "f"
    folder.mkdir()
    names = ["part-99999-x.c000.txt", "part-99999-x.c001.txt", "part-100000-x.c000.txt", "part-100000-x.c1000.txt"]
    for k, name in enumerate(names):
        (folder / name).write_bytes(str(k).encode() * 3)
    [row] = checksums.export_checksums(spark, str(tmp_path)).collect()
    assert (row.crc32, row.n_bytes, row.parts) == (f"{zlib.crc32(b'000111222333'):08x}", 12, 4)


# --- snapshots in buckets --------------------------------------------------------------------


def by_cluster():
    return [F.substring_index("key", "_", 1)]


def bucket_files(path):
    return {p: p.stat().st_mtime_ns for p in path.glob("bucket=*/*.parquet")}


def test_bucketed_upsert_equals_the_whole_snapshot(spark, tmp_path):
    rng = random.Random(5)
    whole, cut = str(tmp_path / "whole"), str(tmp_path / "cut")
    rows = lambda n: spark.createDataFrame([(f"{rng.randrange(30)}_{rng.randrange(9)}", str(rng.randrange(99))) for _ in range(n)], "key string, value string")
    first = rows(200).dropDuplicates(["key"])
    first.write.parquet(whole)
    buckets.create_buckets(spark.read.parquet(whole), cut, 8, by_cluster())
    for n in (40, 3, 0, 25):
        fresh = spark.createDataFrame(rows(n).collect(), "key string, value string") if n else first.limit(0)
        keyed.upsert_kv(spark, fresh, whole)
        for _ in range(2):  # a rerun changes nothing
            buckets.upsert_buckets(fresh, cut, ["key"], by_cluster())
        assert got(buckets.read_buckets(spark, cut, first.schema).drop("bucket")) == got(spark.read.parquet(whole))


def test_an_update_reads_and_writes_only_its_buckets(spark, tmp_path):
    path = tmp_path / "kv"
    every = spark.range(3000).select(F.concat_ws("_", (F.col("id") % 100).cast("string"), "id").alias("key"), F.lit("0").alias("value"))
    buckets.create_buckets(every, str(path), 20, by_cluster())
    before = bucket_files(path)
    fresh = every.where("key like '7\\_%'").select("key", F.lit("1").alias("value"))  # 1 % of the keys, one cluster
    touched = buckets.upsert_buckets(fresh, str(path), ["key"], by_cluster())
    after = bucket_files(path)
    assert len(touched) == 1
    changed = {p.parent.name for p, _ in set(before.items()) ^ set(after.items())}
    assert changed == {f"bucket={touched[0]}"}
    found = buckets.read_buckets(spark, str(path), every.schema)
    assert found.count() == 3000 and found.where("value = '1'").count() == 30
    pruned = buckets.read_buckets(spark, str(path), every.schema, touched)
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan(pruned))
    assert all(f"bucket={touched[0]}/" in r[0] for r in pruned.select("_metadata.file_path").distinct().collect())


def test_bucketed_update_adds_no_key(spark, rows, tmp_path):
    path, kind = str(tmp_path / "kv"), "key string, n long, note string"
    stored = rows(kind, ("a_1", 1, "x"), ("a_2", 2, None), ("b_1", 3, "y"))
    buckets.create_buckets(stored, path, 4, by_cluster())
    source = rows("key string, n long", ("a_1", 10), ("a_9", 9), ("b_1", None))
    buckets.update_buckets_from(source, path, ["key"], ["n"], by_cluster(), stored.schema)
    found = buckets.read_buckets(spark, path, stored.schema).drop("bucket")
    assert got(found) == [("a_1", 10, "x"), ("a_2", 2, None), ("b_1", 3, "y")]


def test_a_failing_merge_leaves_the_buckets(spark, rows, tmp_path):
    path = tmp_path / "kv"
    stored = rows("key string, value string", ("a_1", "1"), ("b_1", "2"))
    buckets.create_buckets(stored, str(path), 4, by_cluster())
    before = bucket_files(path)
    broken = lambda current, fresh: fresh.withColumn("value", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(PySparkException, match="broken"):
        buckets.update_buckets(stored, str(path), by_cluster(), broken)
    assert bucket_files(path) == before


def test_a_bucketed_snapshot_may_start_empty(spark, rows, tmp_path):
    path = str(tmp_path / "kv")
    fresh = rows("key string, value string", ("a_1", "1"), (None, "n"))
    buckets.create_buckets(fresh.limit(0), path, 4, by_cluster())
    buckets.upsert_buckets(fresh, path, ["key"], by_cluster())
    assert got(buckets.read_buckets(spark, path, fresh.schema).drop("bucket")) == got(fresh)
