from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from adtally.functions import numbers, rules, slots, text


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_day_part_has_eight_characters(spark):
    r = one(spark, d=slots.day_of(F.lit("2024010112")), h=slots.hour_of(F.lit("2024010112")))
    assert (r.d, r.h) == ("20240101", "12")


@pytest.mark.parametrize(
    "slot, hours, want",
    [("2024010100", -1, "2023123123"), ("2024022823", 1, "2024022900"), ("2024030100", -24, "2024022900")],
)
def test_shift_slot_crosses_midnight(spark, slot, hours, want):
    assert one(spark, s=slots.shift_slot(F.lit(slot), hours)).s == want


def test_day_formats(spark):
    r = one(spark, i=slots.iso_day(F.lit("20240229")), c=slots.compact_day(F.lit("2024-02-29")), d=slots.as_date(F.lit("2024022905")))
    assert (r.i, r.c, str(r.d)) == ("2024-02-29", "20240229", "2024-02-29")


def test_instant_is_utc(spark):
    cet = timezone(timedelta(hours=1))
    r = one(spark, a=slots.slot_of(slots.instant(datetime(2024, 1, 1, 10, 5))), b=slots.slot_of(slots.instant(datetime(2024, 1, 1, 0, 30, tzinfo=cet))))
    assert tuple(r) == ("2024010110", "2023123123")


def test_job_parameters():
    at = datetime(2024, 1, 1, 0, 10)
    assert slots.slot_before(at) == "2023123123"
    assert slots.day_before(at, 14) == "20231218"
    assert slots.trailing_days(at, 3) == ("2023122900", "2023123123")
    assert slots.day_bounds("20240101") == ("2024010100", "2024010123")


def test_half_even_and_half_up(spark):
    r = one(
        spark, a=numbers.half_even(F.lit(2.5)), b=numbers.half_even(F.lit(3.5)), c=numbers.half_even(F.lit(0.125), 2),
        d=numbers.half_up(F.lit(2.5)), e=numbers.half_up(F.lit(0.125), 2),
    )
    assert tuple(r) == (2.0, 4.0, 0.12, 3.0, 0.13)


def test_ratios_never_raise(spark):
    r = one(
        spark, z=numbers.ratio(F.lit(1), F.lit(0)), n=numbers.ratio(F.lit(None).cast("long"), F.lit(2)),
        g=numbers.ratio_or_zero(F.lit(5), F.lit(0)), p=numbers.pct_change(F.lit(70), F.lit(100)),
        q=numbers.pct_change(F.lit(70), F.lit(0)),
    )
    assert tuple(r) == (None, None, 0.0, -30.0, None)


def test_money_sum_is_exact_in_any_order(spark):
    cents = [0.1, 0.2, 0.3, 1e6, -1e6, 0.005] * 500
    df = spark.createDataFrame([(c,) for c in cents], "x double").repartition(7)
    assert df.agg(numbers.sum_money("x").alias("s")).first().s == 302.5


def test_missing_to_zero_and_truncation(spark):
    r = one(
        spark, a=numbers.zero_if_missing(F.lit(float("nan"))), b=numbers.zero_if_missing(F.lit(None).cast("double")),
        c=numbers.truncated(F.lit(9) / F.lit(0.9)), d=numbers.truncated(F.lit(-1.9)),
    )
    assert tuple(r) == (0.0, 0.0, 10, -1)


@pytest.mark.parametrize("x, want", [(12.0, "12.0"), (0.5, "0.5"), (0.25, "0.25"), (12345678.1, "12345678.1"), (10.0, "10.0")])
def test_short_decimal_prints_like_a_script(spark, x, want):
    assert one(spark, s=numbers.short_decimal(F.lit(x))).s == want == str(x)


def test_whole_share_rounds_half_up(spark):
    r = one(spark, a=numbers.whole_share(F.lit(1), F.lit(3)), b=numbers.whole_share(F.lit(1.7), F.lit(2)), c=numbers.whole_share(F.lit(1), F.lit(0)))
    assert tuple(r) == (33.3333, 100.0, None)


def test_text_helpers(spark):
    r = one(
        spark, pk=text.pack(F.lit("a"), F.lit(1), F.lit(None).cast("string")), ok=text.pack(F.lit("a"), F.lit(1)),
        p2=text.part(F.lit("a_b"), 2), p3=text.part(F.lit("a_b"), 3), f=text.first_part(F.lit("a_b_c")), la=text.last_part(F.lit("a_b_c")),
        s=text.slot_or_id(F.lit(""), F.lit(7)), u=text.first_usable(F.lit("x"), F.lit(None).cast("string"), F.lit("yy")),
        none=text.first_usable(F.lit("x")), c=text.contains_text(F.lit("b"), F.lit("abc")),
    )
    assert tuple(r) == (None, "a_1", "b", "", "a", "c", "7", "yy", "", True)


@pytest.mark.parametrize(
    "adtype, event, pkg, want",
    [
        ("3", "2", "p", False),  # text order: '3' is not below '19'
        ("16", "2", "p", True),
        ("39", "2", "p", True),
        ("39", "1", "p", False),
        ("19", "1", "p", True),
        ("3", "1", "p", True),
        ("19", "1", "com.alibaba.aliexpresshd", False),
        ("38", "2", "com.alibaba.aliexpresshd", True),
    ],
)
def test_attribution_rule(spark, adtype, event, pkg, want):
    assert one(spark, ok=rules.attributable(F.lit(adtype), F.lit(event), F.lit(pkg))).ok is want


def test_platform_recodes(rows):
    df = rows("p string", ("iOS",), ("IOS",), ("Android",), ("android",), ("1",), ("2",), ("9",), (None,))
    out = df.select(
        rules.platform_number("p"), rules.platform_number_strict("p", "Android"), rules.platform_label("p"), rules.platform_from_number("p")
    ).collect()
    assert [r[0] for r in out] == [2, 2, 1, 1, 1, 1, 1, 1]
    assert [r[1] for r in out] == [2, 2, 1, 2, 2, 2, 2, 2]
    assert [r[2] for r in out] == ["iOS", "iOS", "iOS", "Android", "iOS", "iOS", "iOS", "iOS"]
    assert [r[3] for r in out] == [None] * 4 + ["Android", "iOS", None, None]


def test_settleable_and_money(rows):
    df = rows("code string, cost double", ("K", 5.0), ("", 0.0), ("", 5.0), (None, 0.0), (None, 5.0))
    assert [r[0] for r in df.select(rules.settleable("code", "cost")).collect()] == [True, True, False, True, False]


@pytest.mark.parametrize(
    "traffic, want",
    [
        ("[{'pub_status': 1, 'cap_daily': 5}, {'pub_status': 2, 'cap_daily': 9}]", 5),
        ("[{'pub_status': 1, 'cap_daily': 5, 'x': None}, {'pub_status': 1, 'cap_daily': 3, 'y': True}]", 8),
        ("[{'pub_status': 1, 'cap_daily': None}, {'pub_status': 1, 'cap_daily': 3}]", 0),
        ("[{'pub_status': 1}]", 0),
        ("[{'pub_status': 1, 'cap_daily': '5'}]", 0),
        ("[{'pub_status': True, 'cap_daily': 4}]", 4),
        ("[{'pub_status': '1', 'cap_daily': 4}]", 0),
        ("[]", 0),
        ("not a list", 0),
        ("", 0),
        (None, 0),
        ('[{"pub_status": 1, "cap_daily": 6, "note": "it\'s"}]', 6),
    ],
)
def test_active_cap(rows, traffic, want):
    assert rows("traffic string", (traffic,)).select(rules.active_cap()).first()[0] == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6), min_size=1, max_size=40))
def test_half_even_matches_rint(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    out = [r[0] for r in df.select(numbers.half_even("x", 2)).collect()]
    for x, y in zip(xs, out):
        assert math.isclose(y, round(x * 100) / 100, abs_tol=1e-12)
