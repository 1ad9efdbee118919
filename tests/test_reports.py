from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from adtally.plans import alarms, counters, dims, feeds, money, rates, rollups, traffic
from adtally.schemas import OFFER_SOURCE, STREAM_OFFER_SOURCE
from tests.conftest import got

STREAM = "time_slot string, offer_id string, country string, channel string, offer_pkg string, platform string, clk_count long, imp_count long"
ROUTED = "time_slot string, offer_id string, country string, channel string, adtype string, click_through string, offer_pkg string, routed_offer string, slot string"
SYNCED = "time_slot string, offer_id string, country string, channel string, offer_pkg string, clk_count long"
EVENTS = (
    "time_slot string, utctime timestamp, channel string, channel_type string, offer_id string, offer_pkg string, country string, "
    "platform string, slot string, adtype string, event_type string, af_siteid string, payout double, cost double"
)
REJECTS = "time_slot string, country string, platform string, offer_pkg string, offer_id string, channel string"
H = "2024010110"


def event(offer="o1", country="US", channel="ch1", pkg="com.a", platform="iOS", code="2", payout=1.0, cost=0.5, slot="s1",
          adtype="3", site="1", ts=datetime(2024, 1, 1, 10, 30), hour=H):
    return (hour, ts, channel, "1", offer, pkg, country, platform, slot, adtype, code, site, payout, cost)


# --- traffic ------------------------------------------------------------------------------


def fanned_by_hand(clicks, convs, rejects):
    """Pairs built one by one, as two full joins would."""
    def match(a, b):
        return a is not None and b is not None and a[:2] == b[:2]

    pairs = [(c, v) for c in clicks for v in convs if match(c, v)]
    pairs += [(c, None) for c in clicks if not any(match(c, v) for v in convs)]
    pairs += [(None, v) for v in convs if not any(match(c, v) for c in clicks)]
    triples = [(c, v, r) for c, v in pairs for r in rejects if match(v, r)]
    triples += [(c, v, None) for c, v in pairs if not any(match(v, r) for r in rejects)]
    triples += [(None, None, r) for r in rejects if not any(match(v, r) for _, v in pairs)]
    out = defaultdict(lambda: [0] * 5)
    for c, v, r in triples:
        key = tuple(
            next((s[i] for s in (c, v) if s is not None and len(s[i]) > 1), "") for i in (1, 0, 2, 3, 4)
        )
        acc = out[key]
        acc[0] += c[5] if c else 0
        acc[1] += v[5] if v else 0
        acc[2] += v[6] if v else 0
        acc[3] += r[5] if r else 0
    return sorted((*k, *v[:4]) for k, v in out.items())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fanned_report_equals_paired_rows(rows, seed):
    rng = random.Random(seed)
    offers, countries, channels, pkgs = ["o1", "o2", "7"], ["US", "IN"], ["ch1", "ch2"], ["com.a", "com.b"]
    stream = [(H, rng.choice(offers), rng.choice(countries), rng.choice(channels), rng.choice(pkgs), "iOS", rng.randint(1, 9), 1) for _ in range(6)]
    synced = [(H, rng.choice(offers), rng.choice(countries), rng.choice(channels), "com.a", rng.randint(1, 9)) for _ in range(5)]
    convs = [event(rng.choice(offers), rng.choice(countries), rng.choice(channels), rng.choice(pkgs), code=rng.choice("12")) for _ in range(7)]
    rejects = [(H, rng.choice(countries), "iOS", rng.choice(pkgs), rng.choice(offers), rng.choice(channels)) for _ in range(6)]

    clicks = {}
    for _, o, c, ch, p, pf, n, _i in stream:
        k = clicks.setdefault((o, c, ch), ["", "", 0])
        clicks[o, c, ch] = [max(k[0], p), max(k[1], pf), k[2] + n]
    for _, o, c, ch, _p, n in synced:
        k = clicks.setdefault((o, c, ch), ["", "", 0])
        k[2] += n
    cl = [(o, c, ch, p, pf, n) for (o, c, ch), (p, pf, n) in clicks.items()]
    cv = defaultdict(lambda: [0, 0])
    for e in convs:
        cv[e[4], e[6], e[2], e[5], e[7]][0 if e[10] == "1" else 1] += 1
    vs = [(*k, *n) for k, n in cv.items()]
    rj = defaultdict(int)
    for r in rejects:
        rj[r[4], r[1], r[5], r[3], r[2]] += 1
    rs = [(*k, n) for k, n in rj.items()]

    out = traffic.traffic_report_fanned(
        rows(STREAM, *stream), rows(ROUTED, *[]), rows(SYNCED, *synced), rows(EVENTS, *convs), rows(REJECTS, *rejects)
    )
    have = sorted(
        (r.country, r.offer, r.channel, r.pkg, r.platform, r.click_all, r.install, r.conv, r.reject) for r in out.collect()
    )
    assert have == fanned_by_hand(cl, vs, rs)


def test_report_counts_every_measure_once(rows):
    args = (
        rows(STREAM, (H, "o1", "US", "ch1", "com.a", "iOS", 10, 3), (H, "o1", "US", "ch2", "com.a", "iOS", 5, 1),
             (H, "o1", "US", "ch1", "com.lazada.x", "iOS", 99, 9), (H, "", "US", "ch1", "com.a", "iOS", 99, 9)),
        rows(ROUTED, (H, "ch1_o1", "US", "ch1", "39", "1", "com.a", "r", "s"), (H, "o1", "US", "ch1", "3", "0", "com.a", "r", "s")),
        rows(SYNCED, (H, "o1", "US", "ch1", "com.a", 2)),
        rows(EVENTS, event(code="1", payout=0.0625), event(code="2", payout=0.0625), event(platform="Android", code="2", payout=1.0)),
        rows(REJECTS, (H, "US", "iOS", "com.a", "o1", "ch1"), (H, "BR", "iOS", "com.z", "o9", "ch9")),
    )
    once = {
        (r.country, r.offer, r.channel, r.pkg, r.platform): (r.click_all, r.impression, r.install, r.conv, r.reject, r.revenue, r.cost)
        for r in traffic.traffic_report(*args).collect()
    }
    assert once == {
        ("US", "o1", "ch1", "com.a", "iOS"): (10, 3, 1, 1, 1, 0.12, 1.0),  # 0.125 rounds to the even hundredth
        ("US", "o1", "ch2", "com.a", "iOS"): (5, 1, 0, 0, 0, 0.0, 0.0),
        ("US", "o1", "ch1", "", ""): (3, 0, 0, 0, 0, 0.0, 0.0),
        ("US", "o1", "ch1", "com.a", "Android"): (0, 0, 0, 1, 0, 1.0, 0.5),
        ("BR", "o9", "ch9", "com.z", "iOS"): (0, 0, 0, 0, 1, 0.0, 0.0),
    }
    fanned = traffic.traffic_report_fanned(*args)
    f = {(x.country, x.offer, x.channel): x for x in fanned.collect()}
    assert (f["US", "o1", "ch1"].click_all, f["US", "o1", "ch2"].click_all) == (26, 10)
    assert ("", "", "") in f  # the reject-only row has no labels


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_measures_stay_at_their_labels(rows, seed):
    rng = random.Random(seed)

    def pick():
        return rng.choice(["ch1", "ch2", "c", None]), rng.choice(["com.a", "com.b", "p", None]), rng.choice(["iOS", "Android"])

    stream = [(H, "o1", "US", ch, pkg, pf, rng.randint(1, 9), 1) for ch, pkg, pf in (pick() for _ in range(15))]
    convs = [event(channel=ch, pkg=pkg, platform=pf, code=rng.choice("12"), payout=float(rng.randint(1, 9))) for ch, pkg, pf in (pick() for _ in range(15))]
    rejects = [(H, "US", pf, pkg, "o1", ch) for ch, pkg, pf in (pick() for _ in range(9))]
    out = traffic.traffic_report(rows(STREAM, *stream), rows(ROUTED, *[]), rows(SYNCED, *[]), rows(EVENTS, *convs), rows(REJECTS, *rejects)).collect()

    def shown(*labels):
        return tuple(x if x and len(x) > 1 else "" for x in labels)

    clicked = [(shown(r[3], r[4], r[5]), r[6]) for r in stream if r[3] and r[4] is not None]
    paid = [(shown(e[2], e[5], e[7]), e[12]) for e in convs if e[5]]
    refused = [(shown(r[5], r[3], r[2]), 1) for r in rejects]
    assert {(r.channel, r.pkg, r.platform) for r in out} <= {k for k, _ in clicked + paid + refused}
    for name, log in (("click_all", clicked), ("revenue", paid), ("reject", refused)):
        for at, label in enumerate(("channel", "pkg", "platform")):
            have, want = defaultdict(float), defaultdict(float)
            for r in out:
                have[r[label]] += r[name]
            for k, n in log:
                want[k[at]] += n
            assert {k: v for k, v in have.items() if v} == dict(want)


def test_day_grain_and_range(rows):
    stream = rows(STREAM, ("2024010100", "o1", "US", "ch1", "com.a", "iOS", 1, 0), ("2024010123", "o1", "US", "ch1", "com.a", "iOS", 2, 0),
                  ("2024010200", "o1", "US", "ch1", "com.a", "iOS", 4, 0))
    rest = [rows(ROUTED, *[]), rows(SYNCED, *[]), rows(EVENTS, *[]), rows(REJECTS, *[])]
    out = traffic.traffic_report(stream, *rest, grain="day")
    assert got(out.select("period", "click_all")) == [("20240101", 3), ("20240102", 4)]
    out = traffic.traffic_report(stream, *rest, grain="hour", first="2024010123", last="2024010123")
    assert got(out.select("period", "click_all")) == [("2024010123", 2)]


# --- money ---------------------------------------------------------------------------------


def alloc(rows, events, publisher=()):
    pub = rows("day string, slot string, country string, re_real_revenue double", *publisher)
    return money.allocate(rows(EVENTS, *events), pub)


def test_allocation_rules_in_order(rows):
    events = [
        event("o1", slot="s1", adtype="38", payout=0.0, cost=2.0),  # rule 1: shared
        event("o1", slot="s2", adtype="38", payout=0.0, cost=3.0),
        event("o1", slot="s3", adtype="3", payout=10.0, cost=1.0),
        event("o2", slot="s4", adtype="3", payout=4.0, cost=1.0),  # rule 2: publisher revenue
        event("o3", slot="s4", adtype="16", payout=6.0, cost=1.0),
        event("o4", slot="s5", adtype="19", payout=5.0, cost=1.0),  # rule 3: margin
        event("o4", slot="s6", adtype="3", payout=0.0, cost=7.0),
        event("o5", slot="s7", adtype="19", payout=5.0, cost=1.0),  # rule 4
        event("o1", slot="s8", adtype="3", payout=90.0, cost=0.0, country="USA"),  # dropped, but counts in totals
    ]
    out = {(r.offer_id, r.slot): (r.revenue, r.cost) for r in alloc(rows, events, [("2024-01-01", "s4", "US", 20.0)]).collect()}
    assert out["o1", "s1"] == (100.0 * 0.2 * 0.5, 2.0) and out["o1", "s2"] == (100.0 * 0.2 * 0.5, 3.0)
    assert out["o1", "s3"] == (10.0, 1.0)
    assert out["o2", "s4"] == (4.0, 8.0) and out["o3", "s4"] == (6.0, 12.0)
    assert out["o4", "s5"] == (4.0, 1.0)
    assert out["o5", "s7"] == (5.0, 1.0)
    assert ("o1", "s8") not in out


def test_share_applies_to_every_adtype_of_its_keys(rows):
    events = [event("o1", adtype="38", payout=0.0), event("o1", adtype="3", payout=10.0)]
    assert [r.revenue for r in alloc(rows, events).collect()] == [2.0, 2.0]


def test_repeated_publisher_rows_inflate_totals(rows):
    events = [event("o1", payout=10.0), event("o2", payout=30.0)]
    out = alloc(rows, events, [("2024-01-01", "s1", "US", 8.0), ("2024-01-01", "s1", "US", 8.0)])
    assert got(out.select("offer_id", "cost")) == [("o1", 1.0)] * 2 + [("o2", 3.0)] * 2  # 8 * 10 / 80


def test_slot_without_payout_costs_nothing(rows):
    out = alloc(rows, [event("o1", payout=0.0, cost=3.0)], [("2024-01-01", "s1", "US", 8.0)])
    assert got(out.select("revenue", "cost")) == [(0.0, 0.0)]


def test_no_rule_leaves_money_unchanged(rows):
    events = [event(f"o{i}", payout=float(i), cost=i / 2, slot=f"s{i}") for i in range(1, 6)]
    out = alloc(rows, events)
    assert got(out.select("offer_id", "revenue", "cost")) == [(f"o{i}", float(i), i / 2) for i in range(1, 6)]


ALLOC = "day string, slot string, country string, offer_id string, platform string, adtype string, offer_pkg string, channel string, revenue double, cost double, app_id string, user_id string, payee_code string, adv_id string"


def a_row(revenue=1.0, cost=1.0, user="1", code="K1", adv="A1", country="US", channel="ch1", day="20240101"):
    return (day, "s1", country, "o1", "iOS", "3", "com.a", channel, revenue, cost, "9", user, code, adv)


def test_profit_drops_unknown_users_and_networks(rows):
    allocation = rows(ALLOC, a_row(1.0), a_row(2.0), a_row(user=None), a_row(user="7"), a_row(channel="x"), a_row(0.0, 0.0), a_row(country="U-S"))
    users = rows("id long, email string, username string", (1, "e", "n"))
    networks = rows("short_name string, channel_type string", ("ch1", "2"))
    assert got(money.profit_rollup(allocation, users, networks)) == [("20240101", "3", "s1", "US", 1, "2", "n", "e", 3.0, 2.0)]
    assert money.profit_rollup(allocation, users, networks, hide_dashed_countries=False).count() == 2
    assert money.profit_rollup(allocation, users, networks, "20240102", "20240103").count() == 0


def test_settlement_rules(rows):
    allocation = rows(
        ALLOC, a_row(1.0, 2.0), a_row(0.00004, 0.0), a_row(code=None, cost=0.0, revenue=3.0), a_row(code="", cost=5.0),
        a_row(adv=None), a_row(adv="A9"), a_row(adv=""),
    )
    advertisers = rows("adv_id string, contract_code string", ("A1", "C1"))
    customers = rows("contract_code string, adv_currency string", ("C1", "CNY"))
    channels = rows("payee_code string, supplier_id string, payout_currency string", ("K1", "S1", "USD"))
    out = money.settlement(allocation, advertisers, customers, channels)
    assert got(out.select("payee_code", "supplier_id", "revenue", "payout_currency", "cost")) == [
        ("", "", 195000, "", 0), ("K1", "S1", 65000, "USD", 20000),
    ]
    r = out.first()
    assert (r.offer_type, r.type, r.created, r.traffic) == ("OFLX_GA", "JSXMLX_1", "20240101000000", "")


def test_channel_day_report(rows):
    events = rows(EVENTS, event(code="1"), event(code="2", payout=2.5, platform="IOS"), event(platform="Android"))
    out = money.channel_day_report(events, rows(ALLOC, a_row(cost=4.0)))
    assert got(out.select("platform", "conversion", "revenue", "cost")) == [(1, 1, 1.0, 0.0), (2, 1, 2.5, 4.0)]


def test_publisher_revenue_falls_back_to_the_id(rows):
    out = money.publisher_revenue(
        rows("day string, placement_id long, country_id long, re_real_revenue double", ("2024-01-01", 1, 1, 2.0), ("2024-01-01", 1, 1, 3.0), ("2024-01-01", 2, 9, 9.0)),
        rows("id long, short_name string", (1, "US")),
        rows("id long, slot_str string", (1, "s1"), (2, "")),
    )
    assert [tuple(r) for r in out.collect()] == [("2024-01-01", "2", None, 9.0), ("2024-01-01", "s1", "US", 5.0)]


# --- rates and counters ---------------------------------------------------------------------


def test_realtime_cvr(rows):
    daily = "day string, offer_id string, country string, channel string, adtype string, count long"
    out = rates.realtime_cvr(
        rows(STREAM, (H, "o1", "US", "ch1", "com.a", "iOS", 25_050, 0), (H, "o2", "US", "ch1", "com.a", "iOS", 0, 0)),
        rows(ROUTED, (H, "ch1_o1", "US", "ch1", "39", "1", "com.a", "r", "s")),
        rows(SYNCED, (H, "o1", "US", "ch1", "com.a", 10_000)),
        rows(daily, ("2024-01-01", "o1", "US", "ch1", "8", 500), ("2024-01-01", "o1", "US", "ch1", "7", 9000)),
        rows(EVENTS, event("o1"), event("o1", adtype="19", code="1"), event("o3"), event("o1", ts=datetime(2023, 12, 31, 23))),
    )
    # 25050 is 2.505 units, which rounds to 2.5 (2.504999... in binary); 10000 is 1; 500 of the daily log is 0.5
    assert got(out) == [("20240101", "o1", "US", "ch1", 4.0, 1, 0.25)]


def test_cvr_by_hour_and_pairs(rows):
    stream = rows(STREAM, (H, "o1", "US", "ch1", "com.a", "iOS", 20_000, 0), ("2024010123", "o1", "US", "ch1", "com.a", "iOS", 20_000, 0), (H, "o2", "US", "ch1", "com.a", "iOS", 3, 0))
    events = rows(EVENTS, event("o1", adtype="38", code="1"), event("o1", adtype="39", code="1"), event("o9", adtype="19", code="1"))
    out = rates.cvr_by_hour(stream, events, click_hour="12", install_hour="12")
    assert got(out.select("offer_id", "click", "conversion", "cvr")) == [("o1", 2.0, 1, 0.5), ("o2", 0.0, 0, 0.0)]
    offers = rows("channel string, adv_offer string, country string, offer_id string", ("ch1", "ch1_o1", "US", "77"), ("ch1", "o1", "IN", "78"))
    assert got(rates.cvr_pairs(out, offers)) == [("20240101", "77", "2.0_1_0.5")]


def test_cvr_status(rows):
    counter = "time_slot string, channel string, offer string, adtype string, count long"
    imps = rows(counter, (H, "ch1", "o1", "3", 20_000), (H, "ch1", "o2", "9", 10_000), (H, "ch1", "o2", "16", 10_000))
    convs = rows(counter, (H, "ch1", "o1", "3", 3), (H, "ch1", "o3", "3", 1))
    targets = rows("channel_offer string, target_cvr double, click_w double, install long, cvr double, cvr_rate int",
                   *[(f"ch1_o{i}", 1.5, 9.0, 9, 9.0, 9) for i in range(1, 5)])
    status = rates.cvr_status(imps, convs, targets)
    assert got(status) == [
        ("ch1_o1", 1.5, 2.0, 3, 1.5, 1), ("ch1_o2", 1.5, 1.0, 0, 0.0, 2), ("ch1_o3", 1.5, 0.0, 1, 0.0, 1), ("ch1_o4", 1.5, 0.0, 0, 0.0, 2),
    ]
    assert got(rates.update_cvr_targets(targets, status)) == got(status)


def test_target_pacing(rows):
    offers = rows(
        "id long, channel string, adv_offer string, target_cvr double, channel_type int, status int, adv_status int, cvr_status int",
        (1, "ch1", "ch1_o1", 8.0, 2, 1, 1, 1), (2, "ch1", "o1", 4.0, 2, 1, 1, 1), (3, "ch1", "o2", 5.0, 2, 1, 1, 1),
        (4, "ch1", "o3", 0.0, 2, 1, 1, 1), (5, "ch1", "o4", None, 2, 1, 1, 1), (6, "ch1", "o5", 5.0, 1, 1, 1, 1),
    )
    at = datetime(2024, 1, 1, 11, 2)
    events = rows(EVENTS, event(ts=datetime(2024, 1, 1, 10, 58)), event(ts=datetime(2024, 1, 1, 10, 56)), event(adtype="19", ts=datetime(2024, 1, 1, 11, 1)))
    assert got(counters.target_pacing(events, offers, at)) == [("ch1_o1", 500), ("ch1_o2", 0)]


def test_counters(rows):
    events = rows(EVENTS, event(adtype="38", code="1"), event(adtype="38", code="1"), event("zz", adtype="39", code="1"), event(adtype="3", code="1"))
    offers = rows("channel string, adv_offer string, country string, offer_id string", ("ch1", "x_o1", "US", "77"))
    assert got(counters.cap_daily_counts(events, offers)) == [("20240101", "77", "s1", 2, "77_s1"), ("20240101", None, "s1", 1, None)]
    routed = rows(ROUTED, (H, "o", "US", "c", "3", "1", "p", "r1", "s1"), (H, "o", "US", "c", "3", "1", "p", "r1", "s2"), (H, "o", "US", "c", "3", "0", "p", "r1", "s1"))
    assert got(counters.click_counters(routed, ["s1"])) == [("20240101", "r1_s1", 1)]
    assert counters.click_counters(routed).count() == 0
    imps = rows("time_slot string, slot string, visible string, adtype string, count long", (H, "s1", "1", "3", 10), (H, "s1", "1", "12", 99), (H, "s1", "0", "3", 99), (H, "s9", "1", "3", 5))
    assert got(counters.slot_quota(imps, rows("slot string", ("s1",), ("s2",)))) == [("summer_s1", 11), ("summer_s2", 0)]


def test_affiliates(rows):
    conv = "time_slot string, channel string, offer string, slot string, country string, platform string, pkg string, count long"
    convs = rows(conv, (H, "ch1", "o1", "s1", "US", "iOS", "p", 3), (H, "ch1", "o1", "s9", "US", "iOS", "p", 4))
    aff = rows("id string, ssp_offer_id string, channel string, slot string, payout double", ("f1", "o1", "ch1", "s2", 0.5), ("f1", "o1", "ch1", "s1", 0.25), ("f2", "o2", "ch1", "s1", 1.0))
    out = counters.affiliate_revenue(convs, aff)
    assert got(out) == [("2024-01-01", "10", "US", "iOS", "p", "f1", 0, 0, 3, 2.25)]
    assert got(counters.affiliate_cap_counters(convs, aff, H)) == [("f1_cap", 3)]
    assert counters.affiliate_cap_counters(convs, aff, "2024010111").count() == 0


# --- rollups --------------------------------------------------------------------------------


def test_offer_share(rows):
    imps = rows("time_slot string, channel string, offer string", (H, "a", "1"), (H, "a", "1"), (H, "a", "2"), (H, "b", "3"))
    convs = rows("time_slot string, channel string, offer string, payout double", (H, "a", "1", 1.4), (H, "a", "1", 0.2), (H, "b", "9", 5.0))
    assert got(rollups.offer_share(imps, convs)) == [
        ("20240101", "a", 2, 66.6667, 1, 100.0, 33.3333, 1.6, 100.0), ("20240101", "b", 1, 33.3333, 0, 0.0, 0.0, None, None),
    ]


def test_offer_shares_sum_to_a_hundred(rows):
    imps = rows("time_slot string, channel string, offer string", *[(H, f"c{i % 7}", str(i)) for i in range(50)])
    convs = rows("time_slot string, channel string, offer string, payout double", *[(H, f"c{i % 7}", str(i), float(i)) for i in range(0, 50, 3)])
    sums = rollups.offer_share(imps, convs).agg(F.sum("click_offer_rate"), F.sum("conv_offer_rate"), F.sum("payout_rate")).first()
    assert all(abs(s - 100) < 0.01 for s in sums)


def test_joined_rollups(rows):
    counter = "time_slot string, platform string, country string, channel string, offer string, adtype string, pkg string, count long, payout double"

    def row(country="US", channel="huk", adtype="16", n=1, pkg="p", offer="o"):
        return (H, "iOS", country, channel, offer, adtype, pkg, n, 0.5)

    imps, convs = rows(counter, row(n=3), row("CN"), row("BR")), rows(counter, row(n=2), row("IN"))
    assert got(rollups.day_platform_report(imps, convs)) == [
        ("20240101", "10", "iOS", "BR", "huk", 1, 0, 0.0), ("20240101", "10", "iOS", "IN", "huk", 0, 1, 0.5), ("20240101", "10", "iOS", "US", "huk", 3, 2, 0.5),
    ]
    assert got(rollups.imp_click(imps, convs).select("country", "imp", "click")) == [("BR", 1, None), ("CN", 1, None), ("US", 3, 2)]
    assert rollups.imp_click(rows(counter, row(channel="zz"), row(adtype="9")), convs).count() == 0
    out = rollups.offer_conv_click(convs, rows(counter, row(n=3), row(n=9, pkg="")))
    assert got(out.select("offer", "country", "count", "revenue", "click")) == [("huk_o", "IN", 1, 0.5, None), ("huk_o", "US", 2, 0.5, 3)]
    assert got(rollups.offer_slot_conv(rows(counter + ", slot string", (*row("USA"), "s"), (*row(), "s"))).select("country")) == [("US",)]


# --- feeds and dimensions -----------------------------------------------------------------------


def test_install_feed(rows):
    at = datetime(2024, 1, 1, 11, 0)
    ts = datetime(2024, 1, 1, 10, 55)
    events = rows(
        EVENTS, event("o1", code="1", adtype="19", site="1", ts=ts), event("o1", code="1", adtype="19", site="2", ts=ts),
        event("o2", code="1", adtype="38", site="1", ts=ts), event("o2", code="1", adtype="3", site="7", ts=ts),
        event("o2", code="1", adtype="38", site="9", ts=datetime(2024, 1, 1, 10, 40)),
        event("o2", code="1", adtype="38", site="8", pkg="com.dts.freefireth", ts=ts),
        event("o2", code="2"), event("o2", code="2"), event("o1", code="2"),
    )
    offers = rows("adv_offer string, site_black_value string", ("o1", "2,5"), ("o2", ""))
    caps = rows("offer_id string, event_cap int", ("o1", 2), ("o2", 2))
    feed = feeds.install_feed(events, offers, caps, at, cap_day="20240101")
    assert got(feed) == [("o1", "1", 1, 1), ("o2", "1", 1, 2)]
    assert feed.join(feeds.blacklist(offers), ["offer_id", "af_siteid"]).count() == 0
    assert got(feeds.install_feed(events, offers, caps, at, cap_day="20240102").select("status").distinct()) == [(1,)]


def test_redirect_domains(rows):
    at = datetime(2024, 1, 1, 12)
    hits = rows(
        "created timestamp, channel string, offer string, domain_tag string, count long",
        (datetime(2024, 1, 1, 11), "c", "1", "b.com", 2), (datetime(2024, 1, 1, 1), "c", "1", "a.com", 2), (datetime(2024, 1, 1, 11), "c", "2", "z.com", 1),
        (datetime(2023, 12, 31, 23), "c", "2", "old.com", 99), (datetime(2024, 1, 1, 11), "c", "3", "n.com", 1),
    )
    top = feeds.top_domains(hits, at)
    assert got(top) == [("c", "1", "a.com"), ("c", "2", "z.com"), ("c", "3", "n.com")]
    stored = rows("channel string, offer_id string, domain_tag string", ("c", "1", "x,a.com"), ("c", "2", "q.com"))
    assert got(feeds.changed_domains(top, stored)) == [("c", "2", "z.com"), ("c", "3", "n.com")]


def test_simple_feeds(rows):
    models = rows("key string", ("US_android_p",), ("US_android_p",), ("BR_ios",))
    assert got(feeds.device_inventory(models, "d")) == [("d", "BR", 2, "", 1), ("d", "US", 1, "p", 2)]
    direct = rows("pdate string, update_time timestamp, pb_channel string, pb_channel_id string, offer string, clk_id string",
                  ("20240101", datetime(2024, 1, 1, 10, 5), "c", "i", "o", "k"), ("20240101", datetime(2024, 1, 1, 11, 5), "c", "i", "o", "k"))
    assert got(feeds.forwarded_postbacks(direct, H, H, "20240101")) == [("c", "i", "o", H, "k")]
    settings = rows("day string, platform string, country string, source string, label string, slot_id string, device_count long", ("2024-01-01", "3", "US", "s", "l", "i", 4))
    assert got(feeds.device_counts(settings, "2024-01-01")) == [("20240101", None, "US", "s", "l", "i", 4)]


def test_dimension_columns(spark):
    offers = spark.range(1).select(*[F.lit("1").alias(c) for c in OFFER_SOURCE])
    out = dims.offer_dimension(offers)
    assert len(out.columns) == 28 and out.columns[5] == "cap_daily" and "id" not in out.columns
    stream = dims.stream_offer_dimension(spark.range(1).select(*[F.lit("1").alias(c) for c in STREAM_OFFER_SOURCE]))
    assert len(stream.columns) == 27 and {"offer_pkg", "siteid_type", "siteid_hour"} <= set(stream.columns)


# --- alarms --------------------------------------------------------------------------------------


def test_traffic_alarm_rules(rows):
    imps = rows("time_slot string, count long", ("2024010100", 100), ("2024010123", 100), ("2024010200", 60))
    asy = rows("created timestamp, offer string, pid string, count long", (datetime(2024, 1, 1, 0, 5), "o", "", 20_000), (datetime(2024, 1, 2, 0, 5), "o", "", 9_000), (datetime(2024, 1, 2, 0, 6), "o", "p", 90_000))
    convs = rows("time_slot string, attr_hour string, offer string, adtype string, count long, payout double", ("2024010200", "2024010100", "o", "19", 4, 500.0))
    fired = {(r.time_slot, r.rule): r.fired for r in alarms.traffic_alarm(imps, asy, convs).collect()}
    assert fired["2024010200", "served_drop"]  # -40 % against both yesterday and the previous hour, over midnight
    assert not fired["2024010200", "served_deep_drop"]
    assert not fired["2024010200", "low_payout"] and fired["2024010100", "low_payout"]
    assert not fired["2024010100", "no_conversion"] and fired["2024010200", "no_conversion"]
    assert not fired["2024010100", "async_drop"]  # nothing to compare with
    summary = {r.time_slot: r for r in alarms.fired_slots(alarms.traffic_alarm(imps, asy, convs)).collect()}
    assert summary["2024010200"].fired and "served_drop" in summary["2024010200"].rules


def test_stream_and_volume_alarms(rows):
    stream = rows("time_slot string, clk_count long", ("2024010100", 100), ("2024010200", 40))
    convs = rows("time_slot string, attribute_provider string, attr_time string, payout double", ("2024010121", "Adjust", "2024010120", 1.5), ("2024010200", "Other", "2024010123", 1.0))
    fired = {(r.time_slot, r.rule): (r.value, r.fired) for r in alarms.stream_alarm(stream, convs).collect()}
    assert fired["2024010200", "stream_deep_drop"] == (-60.0, True)
    assert fired["2024010200", "no_conversion"] == (1.0, False) and fired["2024010100", "no_conversion"] == (0.0, True)
    counter = "time_slot string, adtype string, count long"
    out = alarms.volume_alarm(rows(counter, (H, "3", 150)), rows(counter, (H, "16", 999), (H, "3", 9999)))
    assert got(out.select("rule", "value", "fired")) == [("low_clicks", 150.0, False), ("low_impressions", 999.0, True)]
    assert got(alarms.tracker_totals(convs, "2024010100")) == [(1, 1.5)]


def test_alarms_judge_hours_without_rows(rows):
    counter = "time_slot string, adtype string, count long"
    clicks, shown = rows(counter, ("2024010100", "3", 150), ("2024010103", "3", 150)), rows(counter, ("2024010101", "16", 2000))
    out = {(r.time_slot, r.rule): (r.value, r.fired) for r in alarms.volume_alarm(clicks, shown).collect()}
    assert len(out) == 8 and out["2024010102", "low_clicks"] == (0.0, True) and out["2024010102", "low_impressions"] == (0.0, True)
    wide = alarms.volume_alarm(clicks, shown, "2024010102", "2024010105")
    assert sorted({r.time_slot for r in wide.collect()}) == ["2024010102", "2024010103", "2024010104", "2024010105"]

    stream = rows("time_slot string, clk_count long", ("2024010100", 100), ("2024010101", 90))
    convs = rows("time_slot string, attribute_provider string, attr_time string", ("2024010203", "Adjust", "2024010203"))
    dead = {(r.time_slot, r.rule): (r.value, r.fired) for r in alarms.stream_alarm(stream, convs).collect()}
    assert dead["2024010200", "stream_deep_drop"] == (-100.0, True) and dead["2024010102", "no_conversion"][1]

    imps = rows("time_slot string, count long", *[(f"202401{d:02d}{h:02d}", 100) for d in (1, 2) for h in range(24)])
    asy = rows("created timestamp, offer string, pid string, count long", *[(datetime(2024, 1, 1, h), "o", "", 500) for h in range(24)])
    pay = rows("time_slot string, attr_hour string, offer string, adtype string, count long, payout double", ("2024010110", "2024010110", "o", "19", 4, 500.0))
    fired = {(r.time_slot, r.rule): r.fired for r in alarms.traffic_alarm(imps, asy, pay).collect()}
    assert fired["2024010200", "async_drop"] and fired["2024010200", "async_deep_drop"] and fired["2024010212", "async_deep_drop"]
    assert not fired["2024010212", "served_drop"]


def test_partner_report_drops_null_keys(rows):
    lines = rows("date string, channel_type string, platform string, channel string, country string, pkg string, conversion long, revenue double, cost double, click long, install long",
                 ("d", "6", "1", "c", "US", "p", 1, 0.1, 0.2, 3, 0), ("d", "6", "1", "c", "US", "p", 1, 0.2, 0.2, 3, 0), ("d", "6", "1", None, "US", "p", 1, 9.0, 9.0, 9, 0))
    assert got(feeds.partner_report(lines)) == [("d", "6", "1", "c", "US", "p", 2, 0.3, 0.4, 6, 0)]

