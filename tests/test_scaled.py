"""Salted full outer joins, as-of joins, panes and bitmaps: properties and plans."""

from __future__ import annotations

import random
import re
from collections import Counter
from contextlib import contextmanager
from datetime import datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from adtally.operators import asof, bitmaps, panes, skew
from adtally.plans import money
from testbed import QUERIES, scaled
from testbed.reports import _allocation
from testbed.tables import Testbed
from tests.conftest import got
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k.replace("__", "."), None) for k in values}
    for k, v in values.items():
        spark.conf.set(k.replace("__", "."), v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k.replace("__", ".")) if v is None else spark.conf.set(k.replace("__", "."), v)


# --- full outer join -----------------------------------------------------------------------


def plain_full(left, right, keys, also):
    match = F.lit(True) if also is None else F.expr(also)
    for k in keys:
        match = match & (F.col(f"l.{k}") == F.col(f"r.{k}"))
    whole = left.alias("l").join(right.alias("r"), match, "full")
    rest = [F.col(f"{s}.{c}") for s, df in (("l", left), ("r", right)) for c in df.columns if c not in keys]
    return whole.select(*[F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in keys], *rest)


@pytest.mark.parametrize("also", [None, "l.x < r.y"])
@pytest.mark.parametrize("seed", [1, 2])
def test_salted_join_equals_a_plain_full_join(spark, seed, also):
    rng = random.Random(seed)
    hot = [[1, 1, 1, 2, None], [1, 2, 2, 2, None]]
    left, right = (
        [(rng.choice([*h, rng.randint(3, 40)]), rng.choice(["a", "b", None]), rng.randint(0, 5)) for _ in range(n)] for h, n in zip(hot, (300, 90), strict=True)
    )
    l = spark.createDataFrame(left + left[:20], "k int, c string, x int").coalesce(3)
    r = spark.createDataFrame(right + right[:20], "k int, c string, y int").coalesce(2)
    out = skew.salted_full_join(l, r, ["k", "c"], also, share=0.03)
    want = plain_full(l, r, ["k", "c"], also)
    assert out.columns == want.columns
    assert Counter(map(tuple, out.collect())) == Counter(map(tuple, want.collect()))


def test_salted_join_of_empty_sides(spark, rows):
    l, r = rows("k int, x int", (1, 1), (None, 2)), rows("k int, y int")
    assert got(skew.salted_full_join(l, r, ["k"])) == got(l.withColumn("y", F.lit(None)))
    assert got(skew.salted_full_join(r, l, ["k"])) == got(l.select("k", F.lit(None), "x"))
    assert skew.salted_full_join(r, r.withColumnRenamed("y", "z"), ["k"]).count() == 0


def test_no_task_gets_a_hot_key(spark, tmp_path):
    """A third of all rows on one key and a sixth on NULL: no task of the join reads over three times the median."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 6 == 1, F.lit(None)).otherwise(F.col("id") % 5000)
    spark.range(0, 120_000, 1, 6).select(key.cast("long").alias("k"), F.col("id").alias("x")).write.parquet(str(tmp_path / "l"))
    spark.range(-1, 6000, 1, 2).select(F.col("id").alias("k"), F.lit(1).alias("y")).write.parquet(str(tmp_path / "r"))
    l, r = spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r"))
    with settings(spark, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="8"):
        def load(df):
            sizes = Counter({r["p"]: r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()})
            return [sizes[p] for p in range(8)]

        plain, salted = plain_full(l, r, ["k"], None), skew.salted_full_join(l, r, ["k"])
        before, after = load(plain), load(salted)
        found = plan(salted)
        assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, salted.collect()))
    assert max(before) > 3 * median(before) and max(after) <= 3 * median(after), (before, after)
    assert re.search(r"Exchange hashpartitioning\(k#\d+L, _salt#\d+, 8\)", found) and "FullOuter" in found
    # the only broadcast side is the written table of hot keys
    assert all("key-counts" in b for b in re.findall(r"BroadcastExchange[^\n]*\n(?:[^\n]*\n)*?[^\n]*FileScan([^\n]*)", found))


def test_hot_groups_are_few(spark):
    counts = spark.createDataFrame([(k, 100 if k < 40 else 1) for k in range(5000)], "k int, _rows long")
    hot = skew.large_groups(counts, ["k"], share=0.005).collect()
    assert len(hot) == 40 and {r.pieces for r in hot} == {3} and len(hot) < 1 / 0.005


# --- as-of join ----------------------------------------------------------------------------


def plain_asof(facts, versions):
    out = []
    for i, k, ts in facts:
        known = [v for v in versions if None not in (k, ts, v[1]) and v[0] == k and v[1] <= ts]
        latest = max((v[1] for v in known), default=None)
        out.append((i, k, ts, *max(((v[2] is not None, v[2] or "", v[3]) for v in known if v[1] == latest), default=(None, None, None))[1:]))
    return [(i, k, ts, name if n is None else name or None, n) for i, k, ts, name, n in out]


@pytest.mark.parametrize("seconds, share", [(3600 * 7, 0.02), (3600 * 24 * 365, 0.3), (60, None)])
def test_asof_join_equals_the_plain_version(spark, seconds, share):
    rng = random.Random(seconds)

    def at():
        return rng.choice([None] + [START + timedelta(minutes=rng.randint(0, 6000)) for _ in range(20)])

    facts = [(i, rng.choice([1, 1, 1, 2, None, rng.randint(3, 9)]), at()) for i in range(300)]
    versions = [(rng.choice([1, 1, 2, None, rng.randint(3, 12)]), at(), rng.choice(["p", "q", None]), rng.randint(0, 3)) for _ in range(100)]
    versions += [(1, START, "p", 1), (1, START, "q", 0), (2, START - timedelta(days=4000), "old", 1)]
    f = spark.createDataFrame(facts, "id int, k int, ts timestamp").coalesce(3)
    v = spark.createDataFrame(versions, "k int, valid_from timestamp, name string, n int")
    out = asof.asof_join(f, v, ["k"], "ts", seconds=seconds, share=share)
    assert out.columns == ["id", "k", "ts", "name", "n"]
    assert sorted(map(tuple, out.collect())) == sorted(plain_asof(facts, versions))


def test_asof_join_without_versions(spark, rows):
    f = rows("k int, ts timestamp", (1, START), (2, START))
    assert got(asof.asof_join(f, rows("k int, valid_from timestamp, name string"), ["k"], "ts").select("k", "name")) == [(1, None), (2, None)]
    with pytest.raises(ValueError, match="both sides"):
        asof.asof_join(f, rows("k int, valid_from timestamp, ts string"), ["k"], "ts")


def test_versionless_dimensions_give_todays_result(spark):
    """A dimension in force for ever, by the as-of path, equals the plain star join."""
    t = Testbed.of(spark, SF)
    today = QUERIES["profit_backfill"](spark, SF)
    then = money.profit_rollup(_allocation(t), asof.always(t("users")), asof.always(t("networks")), hide_dashed_countries=False)
    assert got(then) == got(today) and today.count() > 0


def test_asof_windows_are_cut_by_time(spark):
    t = Testbed.of(spark, SF)
    events = t("conversion_events").select("utctime", "channel", "payout")
    found = plan(asof.asof_join(events, t("network_versions").withColumnRenamed("short_name", "channel"), ["channel"], "utctime"))
    assert re.search(r"Window \[last\(_v#\d+, true\) windowspecdefinition\(_k0#\d+, _bucket#\d+L?, _salt#\d+, _t#\d+", found)
    # facts themselves meet nothing but the broadcast table of hot buckets
    assert not re.search(r"SortMergeJoin \[[^\]]*\], \[[^\]]*\], (LeftOuter|Inner|FullOuter)", found)


def test_hot_bucket_is_dealt_over_salts(spark, rows):
    f = spark.range(0, 4000, 1, 4).select(F.col("id"), F.lit(7).alias("k"), F.lit(START + timedelta(hours=1)).alias("ts"))
    v = rows("k int, valid_from timestamp, name string", (7, START, "a"), (7, START + timedelta(minutes=30), "b"))
    with settings(spark, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="8"):
        out = asof.asof_join(f, v, ["k"], "ts")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000
    assert got(out.select("name").distinct()) == [("b",)]


# --- look-backs by panes --------------------------------------------------------------------


@pytest.mark.parametrize("minutes, sizes, bucket", [(1, (5, 10), 1440), (1, (1, 7, 30), 30), (5, (1, 3), 4)])
def test_look_backs_equal_the_plain_version(spark, minutes, sizes, bucket):
    rng = random.Random(bucket)
    data = [(rng.choice(["a", "b", None]), START + timedelta(seconds=rng.randint(0, 400 * 60)), rng.randint(-5, 5)) for _ in range(200)]
    df = spark.createDataFrame(data, "k string, ts timestamp, x long")
    sums = panes.pane_sums(df, ["k"], "ts", minutes, n=F.count("*"), s=F.sum("x"))
    out = panes.as_of(panes.look_backs(sums, ["k"], sizes, bucket=bucket), minutes)
    want, step = [], timedelta(minutes=minutes)
    for size in sizes:
        for k in ("a", "b", None):
            for m in range(0, 600 // minutes):
                end = START + m * step
                inside = [x for key, ts, x in data if key == k and end - size * step <= ts < end]
                if inside:
                    want.append((k, size, end, len(inside), sum(inside)))
    assert got(out.select("k", "size", "as_of", "n", "s")) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_look_backs_within_bounds(spark):
    t = Testbed.of(spark, SF)
    sums = panes.pane_sums(scaled.paced(t("conversion_events")), ["channel"], "utctime", n=F.count("*"))
    whole = panes.look_backs(sums, ["channel"], (5, 10))
    low, high = whole.agg(F.min("upto"), F.max("upto")).first()
    first, last = low + (high - low) // 3, low + (high - low) // 2
    part = panes.look_backs(sums, ["channel"], (5, 10), first, last)
    assert got(part) == got(whole.where(F.col("upto").between(first, last))) and part.count() > 0


def shuffled_rows(df) -> int:
    """Rows that the exchange by bucket received, from the finished adaptive plan."""
    df.collect()
    found = []

    def visit(node):
        if node.nodeName() == "Exchange" and "_bucket#" in node.toString().split("\n")[0]:
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        below = {"AdaptiveSparkPlan": "executedPlan", "ShuffleQueryStage": "plan", "ResultQueryStage": "plan"}.get(node.nodeName())
        nodes = node.children() if below is None else None
        for child in [getattr(node, below)()] if below else [nodes.apply(k) for k in range(nodes.size())]:
            visit(child)

    visit(df._jdf.queryExecution().executedPlan())
    return found[0]


def test_shuffled_rows_do_not_grow_with_the_look_back(spark):
    """Two signed rows a pane (two more at a bucket's end) reach the shuffle, for 5 minutes as for 600."""
    t = Testbed.of(spark, SF)
    sums = panes.pane_sums(scaled.paced(t("conversion_events")), ["channel"], "utctime", n=F.count("*"))
    n = sums.count()
    for size in (5, 60, 600):
        df = panes.look_backs(sums, ["channel"], (size,))
        df.write.format("noop").mode("overwrite").save()
        sent = shuffled_rows(df)
        assert 2 * n <= sent <= 2 * n + 2 * n * size / 1440 + 50, (size, n, sent)
    p = plan(panes.look_backs(sums, ["channel"], (5, 60)))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 2
    assert re.search(r"Exchange hashpartitioning\(channel#\d+, size#\d+, _bucket#\d+L", p)
    assert re.search(r"Window [^\n]*\[channel#\d+, size#\d+, _bucket#\d+L\], \[_at", p)


def test_look_back_sizes_are_checked(spark, rows):
    for size in (0, 1441):
        with pytest.raises(ValueError, match="look-backs"):
            panes.look_backs(rows("k int, pane long, n long"), ["k"], (size,))


# --- bitmaps --------------------------------------------------------------------------------


def test_numbers_are_dense_and_stay(spark):
    first = spark.range(0, 3000).select(F.concat(F.lit("v"), F.col("id") % 1000).alias("v")).unionAll(spark.sql("SELECT CAST(NULL AS STRING) AS v"))
    known = bitmaps.dense_numbers(first.repartition(5), "v")
    assert sorted(r.number for r in known.collect()) == list(range(1, 1001))
    more = bitmaps.dense_numbers(spark.range(900, 1100).select(F.concat(F.lit("v"), F.col("id")).alias("v")), "v", known)
    assert sorted(r.number for r in more.collect()) == list(range(1, 1101))
    assert more.join(known, ["v", "number"]).count() == 1000
    one = bitmaps.dense_numbers(spark.createDataFrame([("x",)], "v string"), "v")
    assert sorted(r.number for r in bitmaps.dense_numbers(spark.createDataFrame([("y",), ("x",)], "v string"), "v", one).collect()) == [1, 2]


def test_counts_of_many_buckets(spark):
    """Numbers beyond one bitmap of 32,768 bits, merged over hours, count exactly."""
    df = spark.range(0, 200_000).select((F.col("id") % 5).cast("string").alias("hour"), (1 + F.col("id") * 7 % 90_000).alias("number"))
    maps = bitmaps.distinct_bitmaps(df, ["hour"])
    assert maps.count() == 5 * 3
    assert got(bitmaps.counted(maps, ["hour"])) == got(df.groupBy("hour").agg(F.count_distinct("number")))
    assert bitmaps.counted(maps, [F.lit("all").alias("k")]).first()["n"] == df.select("number").distinct().count()


def test_spans_read_bitmaps_only(spark):
    """Counts of days, weeks and trailing weeks come from the stored bitmaps; one day's needs only its folder."""
    stored = scaled.stored_bitmaps(Testbed.of(spark, SF))
    found = plan(scaled.distinct_spans(stored))
    scans = [line for line in found.splitlines() if "FileScan" in line]
    assert scans and all("bitmaps-" in line and "events" not in line for line in scans)
    day = stored.first()["day"]
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan(bitmaps.counted(stored.where(F.col("day") == day), ["channel"])))
