from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from adtally.operators import aggs, filters, joins, shape
from tests.conftest import got

KV = "k string, {} long"


def test_time_filters(rows):
    df = rows("time_slot string", ("2024010100",), ("2024010123",), ("2024010200",), (None,))
    assert got(filters.at_slot(df, "2024010123")) == [("2024010123",)]
    assert got(filters.in_day(df, "20240101")) == [("2024010100",), ("2024010123",)]
    assert got(filters.like_day(df, "20240101")) == got(filters.in_day(df, "20240101"))
    assert got(filters.since(df, "2024010123")) == [("2024010123",), ("2024010200",)]
    assert filters.between_slots(df, None, None).count() == 4


def test_look_back_works_in_the_first_minutes(rows):
    df = rows(
        "utctime timestamp",
        (datetime(2024, 1, 1, 9, 57),), (datetime(2024, 1, 1, 9, 58),), (datetime(2024, 1, 1, 10, 2),), (datetime(2024, 1, 1, 10, 3),),
    )
    out = filters.last_minutes(df, datetime(2024, 1, 1, 10, 3), 5)
    assert [r[0].minute for r in out.collect()] == [58, 2]
    assert filters.last_hours(df, datetime(2024, 1, 1, 10, 3), 1, "utctime").count() == 3
    assert filters.since_minute(df, "202401011002").count() == 2
    assert filters.on_event_day(df, "20240101").count() == 4


def test_key_filters(rows):
    df = rows("a string, b string", ("x", "1"), ("", "1"), (None, "1"), ("y", ""))
    assert got(filters.require(df, "a")) == [("x", "1"), ("y", "")]
    assert got(filters.require(df, "a", "b")) == [("x", "1")]
    assert filters.only(df, "a", None).count() == 4
    assert got(filters.only(df, "a", ["y"])) == [("y", "")]
    assert got(filters.all_flags(df, a="x", b="1")) == [("x", "1")]
    assert got(filters.scan_day(df, "b", "")) == [("y", "")]


def test_merge_sums_matches_outer_joins(rows):
    left = rows(KV.format("l"), ("a", 1), ("a", 2), ("b", 5), (None, 7))
    right = rows(KV.format("r"), ("a", 10), ("c", 30), (None, 70), ("b", None))
    full = [("a", 3, 10), ("b", 5, None), ("c", None, 30), (None, 7, None), (None, None, 70)]
    assert got(joins.merge_sums(left, right, ["k"])) == full
    assert got(joins.merge_sums(left, right, ["k"], "left")) == [full[0], full[1], full[3]]
    assert got(joins.merge_sums(left, right, ["k"], "right")) == [full[0], full[1], full[2], full[4]]
    assert got(joins.merge_sums(left, right, ["k"], "inner")) == full[:2]


keys = st.one_of(st.none(), st.sampled_from(["", "a", "b", "c"]))
table = st.lists(st.tuples(keys, st.integers(-5, 5)), max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(table, table, st.sampled_from(["full", "left", "right", "inner"]))
def test_merge_sums_property(spark, a, b, how):
    left, right = spark.createDataFrame(a, KV.format("l")), spark.createDataFrame(b, KV.format("r"))
    want = (
        left.groupBy("k").agg(F.sum("l").alias("l"))
        .join(right.groupBy("k").agg(F.sum("r").alias("r")), "k", how)
        .select("k", "l", "r")
    )
    assert got(joins.merge_sums(left, right, ["k"], how)) == got(want)


def test_defaults_fill_right_side_only(rows):
    left = rows("k string, x string", ("a", None), ("b", "q"))
    right = rows("k string, n long, t string", ("a", 1, "z"))
    out = joins.join_defaults(left, right, ["k"], "left", {"n": 0, "t": ""})
    assert got(out) == [("a", None, 1, "z"), ("b", "q", 0, "")]


def test_attach_total_equals_window(spark, rows):
    df = rows("g string, h string, v long", *[("hot" if i % 3 else None, str(i % 5), i) for i in range(200)])
    want = df.withColumn("t", F.sum("v").over(Window.partitionBy("g")))
    assert got(aggs.partition_total(df, ["g"], {"t": F.sum("v")})) == got(want)
    sums = df.groupBy("g").agg(F.sum("v").alias("t"))
    assert got(joins.attach_total(df, sums, ["g"], salts=4)) == got(want)


def test_attach_total_repeats_several_rows(rows):
    df = rows("g string, v long", ("a", 1), ("b", 2), ("c", 3))
    side = rows("g string, x long", ("a", 10), ("a", 11), ("b", 20))
    assert got(joins.attach_total(df, side, ["g"])) == [("a", 1, 10), ("a", 1, 11), ("b", 2, 20), ("c", 3, None)]


def test_duplicate_dimension_keys_fan_out(rows):
    df = rows("k string, v long", ("a", 1), ("z", 2))
    dim = rows("k string, n string", ("a", "x"), ("a", "y"))
    assert got(joins.enrich(df, (dim, ["k"]))) == [("a", 1, "x"), ("a", 1, "y"), ("z", 2, None)]
    assert got(joins.inner_join(df, dim, ["k"])) == [("a", 1, "x"), ("a", 1, "y")]
    assert got(joins.full_join(df, dim.where("n = 'x'"), ["k"])) == [("a", 1, "x"), ("z", 2, None)]


def test_semi_anti_and_flag(rows):
    df = rows("k string, v long", ("a", 1), ("b", 2), (None, 3))
    listed = rows("k string, status int", ("a", 2))
    assert got(joins.keep_listed(df, listed, ["k"])) == [("a", 1)]
    assert got(joins.drop_listed(df, listed, ["k"])) == [("b", 2), (None, 3)]
    assert got(joins.flag_join(df, listed, ["k"], "status", 1)) == [("a", 1, 2), ("b", 2, 1), (None, 3, 1)]


def test_single_rows_survive_an_empty_partner(rows):
    left, empty = rows("a long", (1,)), rows("b long", (1,)).where("b > 1")
    assert got(joins.pair_single_rows(left, empty)) == [(1, None)]


def test_first_by_breaks_ties(rows):
    df = rows("k string, d string, n long", ("a", "y", 3), ("a", "x", 3), ("a", "z", 1), ("b", "q", 0))
    assert got(aggs.first_by(df, ["k"], [-F.col("n"), F.col("d")])) == [("a", "x", 3), ("b", "q", 0)]
    assert got(aggs.top_n_per_group(df, ["k"], [F.desc("n"), F.asc("d")], 2)) == [("a", "x", 3), ("a", "y", 3), ("b", "q", 0)]


def test_share_of_total(rows):
    df = rows("g string, v long", ("a", 1), ("a", 3), ("b", 4))
    assert {r.t for r in aggs.share_of_total(df, {"t": "v"}).collect()} == {8}
    assert got(aggs.share_of_total(df, {"t": "v"}, ["g"]).select("v", "t")) == [(1, 4), (3, 4), (4, 4)]


def test_period_compare_over_midnight_and_gaps(rows):
    df = rows("time_slot string, n long", ("2024010123", 5), ("2024010200", 7), ("2024010200", 1), ("2024010223", 9))
    assert got(aggs.period_compare(df, F.sum("n"))) == [
        ("2024010123", 5, None, None), ("2024010200", 8, 5, None), ("2024010223", 9, None, 5),
    ]


def test_trailing_total(rows):
    df = rows("time_slot string, n long", ("2024010123", 5), ("2024010201", 7))
    assert got(aggs.trailing_total(df, {"n": F.sum("n")}, 3)) == [
        ("2024010123", 5), ("2024010200", 5), ("2024010201", 12), ("2024010202", 7), ("2024010203", 7),
    ]


def test_known_keys_and_defaults(rows):
    df = rows("k string, v long", ("a", 1), (None, 2), ("a", 3))
    assert got(aggs.rollup_known_keys(df, ["k"], v=F.sum("v"))) == [("a", 4)]
    assert got(aggs.rollup(df, ["k"], v=F.sum("v"))) == [("a", 4), (None, 2)]
    assert got(aggs.distinct_keys(df, "k")) == [("a",), (None,)]
    known = rows("k string", ("a",), ("q",))
    assert got(aggs.with_defaults(known, aggs.rollup(df, ["k"], v=F.sum("v")), "k", "v", 0)) == [("a", 4), ("q", 0)]
    assert aggs.head1(df).count() == 1


def test_group_by_recoded_column_not_by_raw(rows):
    df = rows("platform string", ("ios",), ("iOS",), ("Android",))
    out = aggs.rollup(df.select(F.lower("platform").alias("platform")), ["platform"], n=F.count("*"))
    assert got(out) == [("android", 1), ("ios", 2)]


def test_conform_casts_orders_and_keeps_nulls(rows):
    df = rows("d string, n string, x string, s string", ("20240102", "7", "1.5", None), ("2024-01-03", "8", "2", "v"))
    schema = StructType.fromDDL("s string, n long, x double, d date")
    out = got(shape.conform(df, schema))
    assert [(r[0], r[1], r[2], str(r[3])) for r in out] == [("v", 8, 2.0, "2024-01-03"), (None, 7, 1.5, "2024-01-02")]
    assert got(shape.conform(df, StructType.fromDDL("s string"), blank_strings=True)) == [("",), ("v",)]


def test_conform_raises_on_a_number_that_is_none(rows):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        shape.conform(rows("n string", ("nan_text",)), StructType.fromDDL("n long")).collect()


def test_conform_raises_on_a_bad_date(rows):
    with pytest.raises(Exception, match="PARSE|CAST_INVALID|DATETIME"):
        shape.conform(rows("d string", ("2024/01/02",)), StructType.fromDDL("d date")).collect()


def test_shape_helpers(rows):
    df = rows("`sum(x)` long, `a-b` string", (1, "q"))
    assert shape.sanitize_names(df).columns == ["sum_x_", "a_b"]
    a, b = rows("k string, v long", ("a", 1)), rows("v long", (2,))
    assert got(shape.union_all(a, b, missing={"k": ""})) == [("", 2), ("a", 1)]
    assert got(shape.union_distinct(a, a)) == [("a", 1)]
    assert shape.pick(shape.rename(a, {"v": "w"}), ["w", "k"]).columns == ["w", "k"]
