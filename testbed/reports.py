"""Report queries over the whole test tables, with their reference SQL."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from adtally.functions import slots
from adtally.plans import alarms, counters, dims, feeds, money as money_plans, rates, rollups, traffic
from adtally.session import scratch_path
from adtally.sources import contracts
from testbed.registry import big, exact, half_even, half_up, money, query, share, sum_units, units
from testbed.tables import Testbed

DAY = "SUBSTRING(time_slot, 1, 8)"



def whole_days(t: Testbed, table: str, ts: str) -> tuple[datetime, int]:
    """The midnight after the last row, and the minutes back to the midnight before the first."""
    low, high = t(table).agg(F.date_trunc("day", F.min(ts)), F.date_trunc("day", F.max(ts))).first()
    end = high + timedelta(days=1)
    return end, int((end - low).total_seconds()) // 60


_MINUTES = "(SELECT date_diff('minute', date_trunc('day', MIN(utctime)), date_trunc('day', MAX(utctime)) + INTERVAL 1 DAY) FROM conversion_events)"

# --- clicks, conversions and rejects ------------------------------------------------

TRAFFIC_TABLES = ("stream", "routed", "synced", "conversion_events", "rejected")
_CLEAN = "country <> '' AND channel <> '' AND offer_pkg NOT LIKE '%lazada%'"


def _rows_sql(period: str) -> str:
    """Every log row with the report's keys and measures."""
    conv = "FROM conversion_events WHERE offer_pkg <> '' AND offer_id <> ''"
    return f""", click_rows AS (
  SELECT {period} AS period, offer_id AS offer, country, channel, offer_pkg AS pkg, platform, clk_count AS clicks, imp_count AS shown
  FROM stream WHERE {_CLEAN} AND offer_id <> ''
  UNION ALL BY NAME
  SELECT {period} AS period, CASE WHEN adtype = '39' THEN SPLIT_PART(offer_id, '_', 2) ELSE offer_id END AS offer, country, channel,
    '' AS pkg, '' AS platform, 1 AS clicks, 0 AS shown FROM routed WHERE {_CLEAN} AND click_through = '1'
  UNION ALL BY NAME
  SELECT {period} AS period, offer_id AS offer, country, channel, '' AS pkg, '' AS platform, clk_count AS clicks, 0 AS shown FROM synced WHERE {_CLEAN}
),
conv_rows AS (
  SELECT {period} AS period, offer_id AS offer, country, channel, offer_pkg AS pkg, platform, CAST(event_type = '1' AS INT) AS install,
    CAST(event_type = '2' AS INT) AS conv, CAST(payout AS DECIMAL(28, 9)) AS payout, CAST(cost AS DECIMAL(28, 9)) AS cost {conv}
),
reject_rows AS (SELECT {period} AS period, offer_id AS offer, country, channel, offer_pkg AS pkg, platform FROM rejected)"""


_LABELS = ("country", "offer", "channel", "pkg", "platform")
_SUMMED = f"""{big('COALESCE(SUM(clicks), 0)')} AS click_all, {big('COALESCE(SUM(shown), 0)')} AS impression,
  {big('COALESCE(SUM(install), 0)')} AS install, {big('COALESCE(SUM(conv), 0)')} AS conv, {big('COALESCE(SUM(reject), 0)')} AS reject,
  {half_even('COALESCE(SUM(payout), 0)', 2)} AS revenue, {half_even('COALESCE(SUM(cost), 0)', 2)} AS cost"""


def _label(c: str) -> str:
    return f"CASE WHEN LENGTH({c}) >= 2 THEN {c} ELSE '' END"


def _clean_sql(period: str) -> str:
    """All rows under their own labels, then one grouping."""
    labels = ", ".join(f"{_label(c)} AS {c}" for c in _LABELS)
    return f"""{_rows_sql(period)},
every_row AS (
  SELECT * FROM click_rows UNION ALL BY NAME SELECT * FROM conv_rows UNION ALL BY NAME SELECT *, 1 AS reject FROM reject_rows)
SELECT period, {labels}, {_SUMMED} FROM every_row GROUP BY 1, 2, 3, 4, 5, 6"""


def _fanned_sql(period: str) -> str:
    """Row sets by what meets at a (period, offer, country): each click line, conversion line and reject line once per
    partner line. Rejects only multiply, so a key's reject lines are a number and a sum."""
    at = "period, offer, country"
    shown = ", ".join(_LABELS)

    def either(c: str) -> str:
        return f"COALESCE(NULLIF({_label('c.' + c)}, ''), {_label('v.' + c)}) AS {c}"

    return f"""{_rows_sql(period)},
c AS (SELECT {at}, channel, MAX(pkg) AS pkg, MAX(platform) AS platform, SUM(clicks) AS clicks, SUM(shown) AS shown FROM click_rows GROUP BY {at}, channel),
v0 AS (SELECT {at}, channel, pkg, platform, SUM(install) AS install, SUM(conv) AS conv, SUM(payout) AS payout, SUM(cost) AS cost FROM conv_rows GROUP BY ALL),
r AS (SELECT {at}, COUNT(*) AS lines, SUM(n) AS reject FROM (SELECT {at}, channel, pkg, platform, COUNT(*) AS n FROM reject_rows GROUP BY ALL) GROUP BY {at}),
v AS (
  SELECT v0.{at.replace(', ', ', v0.')}, channel, pkg, platform, COALESCE(lines, 1) AS lines, install * COALESCE(lines, 1) AS install,
    conv * COALESCE(lines, 1) AS conv, payout * COALESCE(lines, 1) AS payout, cost * COALESCE(lines, 1) AS cost, COALESCE(r.reject, 0) AS reject
  FROM v0 LEFT JOIN r ON v0.period = r.period AND v0.offer = r.offer AND v0.country = r.country),
line AS (
  SELECT c.period, {', '.join(either(x) for x in _LABELS)}, clicks * lines AS clicks, shown * lines AS shown, install, conv, payout, cost, reject
  FROM c JOIN v ON c.period = v.period AND c.offer = v.offer AND c.country = v.country
  UNION ALL BY NAME
  SELECT period, {', '.join(f'{_label(x)} AS {x}' for x in _LABELS)}, clicks, shown FROM c
  WHERE NOT EXISTS (FROM v WHERE c.period = v.period AND c.offer = v.offer AND c.country = v.country)
  UNION ALL BY NAME
  SELECT period, {', '.join(f'{_label(x)} AS {x}' for x in _LABELS)}, install, conv, payout, cost, reject FROM v
  WHERE NOT EXISTS (FROM c WHERE c.period = v.period AND c.offer = v.offer AND c.country = v.country)
  UNION ALL BY NAME
  SELECT period, {', '.join(f"'' AS {x}" for x in _LABELS)}, reject FROM r
  WHERE NOT EXISTS (FROM v WHERE r.period = v.period AND r.offer = v.offer AND r.country = v.country))
SELECT period, {shown}, {_SUMMED} FROM line GROUP BY ALL"""


def _both(slot: str) -> dict[str, str]:
    return {"first": slot, "last": slot}


def _traffic(name: str, fn, grain: str, sql: str) -> None:
    query(name, TRAFFIC_TABLES, sql)(lambda t: fn(*[t(n) for n in TRAFFIC_TABLES], grain=grain))


_traffic("hour_report", traffic.traffic_report, "hour", _clean_sql("time_slot"))
_traffic("hour_report_fanned", traffic.traffic_report_fanned, "hour", _fanned_sql("time_slot"))
query(
    "hour_report_one_hour", TRAFFIC_TABLES, f"{_clean_sql('time_slot')} HAVING period = (SELECT MAX(time_slot) FROM stream)"
)(lambda t: traffic.traffic_report(*[t(n) for n in TRAFFIC_TABLES], **_both(t("stream").agg(F.max("time_slot")).first()[0])))
query(
    "day_report_one_day", TRAFFIC_TABLES, f"{_clean_sql(DAY)} HAVING period = (SELECT SUBSTRING(MAX(time_slot), 1, 8) FROM stream)"
)(
    lambda t: traffic.traffic_report(
        *[t(n) for n in TRAFFIC_TABLES], "day", *slots.day_bounds(t("stream").agg(F.max("time_slot")).first()[0][:8])
    )
)
_traffic("day_report_all", traffic.traffic_report, "day", _clean_sql(DAY))
_traffic("day_report_all_fanned", traffic.traffic_report_fanned, "day", _fanned_sql(DAY))

# --- money ---------------------------------------------------------------------------

PUBLISHER_TABLES = ("publisher_log", "countries", "placements")
_PUB = f""", pub AS (
  SELECT a.day, CASE WHEN c.slot_str IS NULL OR c.slot_str = '' THEN CAST(c.id AS VARCHAR) ELSE c.slot_str END AS slot,
    b.short_name AS country, a.re_real_revenue
  FROM (SELECT day, placement_id, country_id, {money('re_real_revenue')} AS re_real_revenue FROM publisher_log GROUP BY 1, 2, 3) a
  LEFT JOIN countries b ON a.country_id = b.id LEFT JOIN placements c ON a.placement_id = c.id)"""
_PLACE = "day, slot, country"
_UNIT = "day, country, offer_id, platform, offer_pkg, channel"
_ALLOC = f"""{_PUB}
, sums AS (
  SELECT {DAY} AS day, slot, country, offer_id, platform, adtype, offer_pkg, channel, {exact('payout')} AS paid, {exact('cost')} AS spent, COUNT(*) AS n
  FROM conversion_events GROUP BY ALL),
listed AS (SELECT REPLACE(day, '-', '') AS day, slot, country, re_real_revenue FROM pub),
weights AS (SELECT {_PLACE}, COUNT(*) AS w FROM listed GROUP BY {_PLACE}),
offer_paid AS (
  SELECT day, offer_id, CAST(SUM(paid * COALESCE(w, 1)) AS DOUBLE) AS offer_total FROM sums LEFT JOIN weights USING ({_PLACE}) GROUP BY day, offer_id),
place_paid AS (SELECT {_PLACE}, CAST(SUM(paid * COALESCE(w, 1)) AS DOUBLE) AS place_total FROM sums LEFT JOIN weights USING ({_PLACE}) GROUP BY {_PLACE}),
free_places AS (SELECT day, channel, offer_id, country, slot, SUM(spent) AS spent FROM sums GROUP BY ALL HAVING SUM(paid) = 0),
free_offers AS (SELECT day, channel, offer_id, country, SUM(spent) AS offer_cost FROM free_places GROUP BY ALL),
free_shared AS (SELECT slot, {_UNIT}, SUM(n) AS n FROM sums WHERE adtype = '38' GROUP BY ALL HAVING SUM(paid) = 0),
unit_totals AS (SELECT {_UNIT}, SUM(n) AS total FROM free_shared GROUP BY ALL),
shares AS (SELECT s.*, CAST(n AS DOUBLE) / total AS rate FROM free_shared s JOIN unit_totals t USING ({_UNIT})),
ruled AS (
  SELECT sums.*, re_real_revenue, rate, offer_total, place_total, CAST(paid AS DOUBLE) AS p, CAST(spent AS DOUBLE) AS c, CASE
    WHEN rate > 0 THEN 1
    WHEN adtype NOT IN ('19', '38', '39') AND re_real_revenue > 0 THEN 2
    WHEN adtype = '19' AND offer_cost > 0 THEN 3
    ELSE 4 END AS rule
  FROM sums
  LEFT JOIN shares USING (slot, {_UNIT})
  LEFT JOIN free_offers USING (day, channel, offer_id, country)
  LEFT JOIN offer_paid USING (day, offer_id)
  LEFT JOIN place_paid USING ({_PLACE})
  LEFT JOIN listed USING ({_PLACE})
  WHERE LENGTH(country) = 2),
amounts_by_rule AS (
  SELECT *, offer_total * 0.2e0 * rate AS revenue, c AS cost FROM ruled WHERE rule = 1
  UNION ALL SELECT *, p AS revenue, CASE WHEN place_total = 0 THEN 0e0 ELSE p * (re_real_revenue / place_total) END AS cost FROM ruled WHERE rule = 2
  UNION ALL SELECT *, p * 0.8e0 AS revenue, c AS cost FROM ruled WHERE rule = 3
  UNION ALL SELECT *, p AS revenue, c AS cost FROM ruled WHERE rule = 4),
alloc AS (SELECT day, slot, country, offer_id, platform, adtype, offer_pkg, channel, revenue, cost FROM amounts_by_rule)"""
_OWNED = f"""{_ALLOC}
, owners AS (
  SELECT CASE WHEN p.slot_str IS NULL OR p.slot_str = '' THEN CAST(p.id AS VARCHAR) ELSE p.slot_str END AS slot,
    CAST(p.app_id AS VARCHAR) AS app_id, CAST(a.user_id AS VARCHAR) AS user_id, u.payee_code
  FROM placements p LEFT JOIN apps a ON p.app_id = a.id LEFT JOIN users u ON a.user_id = u.id),
alloc_report AS (
  SELECT alloc.*, o.app_id, o.user_id, o.payee_code, n.adv_id
  FROM alloc LEFT JOIN owners o ON alloc.slot = o.slot LEFT JOIN networks n ON alloc.channel = n.short_name)"""
ALLOC_TABLES = ("conversion_events", *PUBLISHER_TABLES, "apps", "users", "networks")


def _publisher(t: Testbed, ranked: bool = False):
    return money_plans.publisher_revenue(*[t(n) for n in PUBLISHER_TABLES], ranked=ranked)


def _allocation(t: Testbed):
    return money_plans.allocation_report(
        t("conversion_events"), _publisher(t), *[t(n) for n in ("placements", "apps", "users", "networks")]
    )


query("publisher_revenue", PUBLISHER_TABLES, f"{_PUB} SELECT * FROM pub")(
    lambda t: _publisher(t, ranked=True)
)
query("allocate_revenue_cost", ALLOC_TABLES, f"{_OWNED} SELECT * FROM alloc_report")(_allocation)


def _profit_sql(extra: str) -> str:
    return f"""{_OWNED}
SELECT a.day AS date, a.adtype, a.slot, a.country, CAST(a.user_id AS BIGINT) AS user_id, n.channel_type, u.username AS user_name,
  u.email AS account_email, {money('a.revenue')} AS revenue, {money('a.cost')} AS cost
FROM alloc_report a LEFT JOIN users u ON CAST(a.user_id AS BIGINT) = u.id LEFT JOIN networks n ON a.channel = n.short_name
WHERE (a.revenue <> 0 OR a.cost <> 0) AND a.user_id IS NOT NULL {extra}
  AND n.channel_type IS NOT NULL AND u.username IS NOT NULL AND u.email IS NOT NULL
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8"""


query("profit_rollup", ALLOC_TABLES, _profit_sql("AND a.country NOT LIKE '%-%'"))(
    lambda t: money_plans.profit_rollup(_allocation(t), t("users"), t("networks"))
)
query("profit_backfill", ALLOC_TABLES, _profit_sql(""))(
    lambda t: money_plans.profit_rollup(
        _allocation(t), t("users"), t("networks"), *t("conversion_events").agg(F.min(F.expr(DAY)), F.max(F.expr(DAY))).first(), hide_dashed_countries=False
    )
)
query(
    "channel_day_report",
    ALLOC_TABLES,
    f"""{_ALLOC}
, ev AS (
  SELECT {DAY} AS date, channel_type, channel, CASE WHEN LOWER(platform) = 'ios' THEN 2 ELSE 1 END AS pf, country, offer_pkg AS pkg,
    {big("SUM(CASE WHEN event_type <> '1' THEN 1 ELSE 0 END)")} AS conversion,
    {money("CASE WHEN event_type <> '1' THEN payout ELSE 0 END")} AS revenue
  FROM conversion_events GROUP BY 1, 2, 3, 4, 5, 6),
co AS (
  SELECT day AS date, channel, CASE WHEN LOWER(platform) = 'ios' THEN 2 ELSE 1 END AS pf, country, offer_pkg AS pkg, {money('cost')} AS cost
  FROM alloc GROUP BY 1, 2, 3, 4, 5)
SELECT ev.date, ev.channel_type, ev.channel, ev.pf AS platform, ev.country, ev.pkg, ev.conversion, ev.revenue, COALESCE(co.cost, 0e0) AS cost
FROM ev LEFT JOIN co ON ev.date = co.date AND ev.channel = co.channel AND ev.pf = co.pf AND ev.country = co.country AND ev.pkg = co.pkg""",
)(
    lambda t: money_plans.channel_day_report(
        t("conversion_events"), money_plans.allocate(t("conversion_events"), _publisher(t))
    )
)


SETTLE_TABLES = (*ALLOC_TABLES, "contract_advertisers", "contract_customers", "contract_channels")
SETTLE_SQL = f"""{_OWNED}
, amounts AS (
  SELECT channel, adv_id, COALESCE(payee_code, '') AS payee_code, country, day,
    {half_even(money('revenue') + ' * 10000')} AS revenue, {half_even(money('cost') + ' * 10000')} AS cost
  FROM alloc_report WHERE adv_id <> '' AND (COALESCE(payee_code, '') <> '' OR cost = 0) GROUP BY 1, 2, 3, 4, 5)
SELECT a.channel AS offer_id, 'OFLX_GA' AS offer_type, a.adv_id, ad.contract_code, a.payee_code, COALESCE(ch.supplier_id, '') AS supplier_id,
  '' AS traffic, a.country, a.day || '000000' AS created, 'JSXMLX_1' AS type, COALESCE(cu.adv_currency, '') AS adv_currency,
  CAST(TRUNC(CASE WHEN cu.adv_currency = 'CNY' THEN a.revenue * 6.5E0 ELSE a.revenue END) AS BIGINT) AS revenue, 0 AS t1, 0 AS t2,
  COALESCE(ch.payout_currency, '') AS payout_currency,
  CAST(TRUNC(CASE WHEN ch.payout_currency = 'CNY' THEN a.cost * 6.5E0 ELSE a.cost END) AS BIGINT) AS cost, 0 AS t3, 0 AS t4
FROM amounts a JOIN contract_advertisers ad ON a.adv_id = ad.adv_id
LEFT JOIN contract_customers cu ON ad.contract_code = cu.contract_code LEFT JOIN contract_channels ch ON a.payee_code = ch.payee_code"""


def _feed(t: Testbed, name: str, document: str) -> str:
    """Write one JSON document per row of a contract table; returns the folder."""
    path = scratch_path(t.spark, name)
    t(name).selectExpr(f"to_json({document}) AS value").write.text(path)
    return path


def contract_feeds(t: Testbed):
    advertisers = _feed(
        t, "contract_advertisers", "named_struct('data', array(named_struct('code', adv_id, 'contractCode', contract_code)))"
    )
    customers = _feed(
        t,
        "contract_customers",
        "named_struct('code', contract_code, 'data', if(adv_currency = '', NULL,"
        " named_struct('customerContractRes', named_struct('currency', adv_currency))))",
    )
    channels = _feed(
        t,
        "contract_channels",
        "named_struct('code', payee_code, 'data', named_struct('contractList', if(supplier_id = '', array(),"
        " array(named_struct('channelContractRes', named_struct('code', supplier_id, 'currency', payout_currency))))))",
    )
    return (
        contracts.read_advertisers(t.spark, advertisers),
        contracts.read_customer_contracts(t.spark, customers),
        contracts.read_channel_contracts(t.spark, channels),
    )


def settlement_rows(t: Testbed):
    return money_plans.settlement(_allocation(t), *contract_feeds(t))


query("settlement_export", SETTLE_TABLES, SETTLE_SQL)(settlement_rows)

# --- conversion rates ------------------------------------------------------------------

RATE_TABLES = ("stream", "routed", "synced", "daily_clicks", "conversion_events")
_KEYS = "day, offer_id, country, channel"


def _h(sum_sql: str, scale: int) -> str:
    return f"CAST({half_even(f'CAST({sum_sql} AS DOUBLE) / {scale}e0 * 100e0')} AS BIGINT)"


_OFFER_MAP = (
    "SELECT channel, SPLIT_PART(adv_offer, '_', -1) AS offer_id, country, offer_id AS offer FROM offers"
)
_REALTIME = f""", click_tb AS (
  SELECT {_KEYS}, CAST(SUM(h) AS BIGINT) / 100e0 AS click FROM (
    SELECT {DAY} AS day, offer_id, country, channel, {_h('SUM(clk_count)', 10000)} AS h FROM stream
    WHERE clk_count > 0 AND offer_id <> '' AND country <> '' AND channel <> '' AND offer_pkg NOT LIKE '%lazada%' GROUP BY 1, 2, 3, 4
    UNION ALL
    SELECT day, CASE WHEN adtype = '39' THEN SPLIT_PART(offer_id, '_', 2) ELSE offer_id END, country, channel, h FROM (
      SELECT {DAY} AS day, offer_id, adtype, country, channel, {_h('COUNT(*)', 10000)} AS h FROM routed
      WHERE click_through = '1' AND country <> '' AND channel <> '' AND offer_pkg NOT LIKE '%lazada%' GROUP BY 1, 2, 3, 4, 5) r
    UNION ALL
    SELECT {DAY}, offer_id, country, channel, {_h('SUM(clk_count)', 10000)} FROM synced
    WHERE country <> '' AND channel <> '' AND offer_pkg NOT LIKE '%lazada%' GROUP BY 1, 2, 3, 4
    UNION ALL
    SELECT REPLACE(day, '-', ''), offer_id, country, channel, {_h('SUM(count)', 1000)} FROM daily_clicks
    WHERE adtype IN ('3', '8', '9') GROUP BY 1, 2, 3, 4) u GROUP BY 1, 2, 3, 4),
conv_tb AS (
  SELECT {DAY} AS day, offer_id, country, channel, COUNT(*) AS conversion FROM conversion_events
  WHERE strftime(utctime, '%Y%m%d') >= {DAY}
    AND (((adtype < '19' OR adtype = '39') AND event_type = '2')
      OR (adtype >= '19' AND adtype <> '39' AND event_type = '1' AND offer_pkg <> 'com.alibaba.aliexpresshd')
      OR (offer_pkg = 'com.alibaba.aliexpresshd' AND event_type = '2'))
    AND offer_pkg NOT LIKE '%lazada%' AND offer_id <> '' AND country <> '' AND channel <> '' GROUP BY 1, 2, 3, 4),
rt AS (
  SELECT {_KEYS}, COALESCE(click, 0e0) AS click, COALESCE(conversion, 0) AS conversion,
    {half_even("CASE WHEN click > 0 THEN COALESCE(conversion, 0) / click ELSE 0e0 END", 2)} AS cvr
  FROM click_tb FULL JOIN conv_tb USING ({_KEYS}))"""


def _pairs(source: str) -> str:
    value = "CONCAT(CAST(click AS VARCHAR), '_', CAST(conversion AS VARCHAR), '_', CAST(cvr AS VARCHAR))"
    return f"""SELECT s.day, m.offer AS key, {value} AS value
FROM {source} s JOIN ({_OFFER_MAP}) m ON s.channel = m.channel AND s.offer_id = m.offer_id AND s.country = m.country"""


def _realtime(t: Testbed):
    return rates.realtime_cvr(*[t(n) for n in RATE_TABLES])


query("realtime_cvr", RATE_TABLES, f"{_REALTIME} SELECT * FROM rt")(_realtime)
query("realtime_cvr_pairs", (*RATE_TABLES, "offers"), f"{_REALTIME} {_pairs('rt')}")(
    lambda t: rates.cvr_pairs(_realtime(t), t("offers"))
)
query(
    "cvr_by_offer",
    ("stream", "conversion_events", "offers"),
    f""", click_tb AS (
  SELECT {DAY} AS day, offer_id, country, channel, {_h('SUM(clk_count)', 10000)} / 100e0 AS click FROM stream
  WHERE clk_count > 0 AND SUBSTRING(time_slot, 9, 2) <= '22' GROUP BY 1, 2, 3, 4),
conv_tb AS (
  SELECT strftime(utctime, '%Y%m%d') AS day, offer_id, country, channel, COUNT(*) AS conversion FROM conversion_events
  WHERE event_type = '1' AND adtype IN ('19', '38') AND strftime(utctime, '%H') <= '21' GROUP BY 1, 2, 3, 4),
rt AS (
  SELECT {_KEYS}, click, COALESCE(conversion, 0) AS conversion,
    {half_even("CASE WHEN click = 0 THEN 0e0 ELSE COALESCE(conversion, 0) / click END", 2)} AS cvr
  FROM click_tb LEFT JOIN conv_tb USING ({_KEYS}))
{_pairs('rt')}""",
)(
    lambda t: rates.cvr_pairs(
        rates.cvr_by_hour(t("stream"), t("conversion_events"), click_hour="22", install_hour="21"), t("offers")
    )
)

CVR_STATUS_SQL = f""", imp AS (
  SELECT channel || '_' || offer AS channel_offer, {half_up('CAST(SUM(count) AS DOUBLE) / 10000e0', 3)} AS click_w
  FROM impressions WHERE adtype IN ('3', '8', '9') GROUP BY channel, offer),
conv AS (SELECT channel || '_' || offer AS channel_offer, SUM(count) AS conv FROM conversions GROUP BY channel, offer),
live AS (
  SELECT COALESCE(imp.channel_offer, conv.channel_offer) AS channel_offer, click_w, COALESCE(conv, 0) AS conv,
    {half_up('CASE click_w WHEN 0 THEN 0e0 ELSE CAST(COALESCE(conv, 0) AS DOUBLE) / click_w END', 3)} AS cvr
  FROM imp FULL JOIN conv ON imp.channel_offer = conv.channel_offer),
st AS (
  SELECT t.channel_offer, t.target_cvr, COALESCE(l.click_w, 0e0) AS click_w, {big('COALESCE(l.conv, 0)')} AS install, COALESCE(l.cvr, 0e0) AS cvr,
    CASE WHEN COALESCE(l.click_w, 0) = 0 AND COALESCE(l.conv, 0) > 0 THEN 1 WHEN COALESCE(l.cvr, 0) < t.target_cvr THEN 2 ELSE 1 END AS cvr_rate
  FROM cvr_targets t LEFT JOIN live l ON t.channel_offer = l.channel_offer)"""


def _cvr_status(t: Testbed):
    return rates.cvr_status(t("impressions"), t("conversions"), t("cvr_targets"))


query("sdk_cvr_status", ("impressions", "conversions", "cvr_targets"), f"{CVR_STATUS_SQL} SELECT * FROM st")(_cvr_status)
query(
    "sdk_cvr_update",
    ("impressions", "conversions", "cvr_targets"),
    f"{CVR_STATUS_SQL} SELECT channel_offer, target_cvr, click_w, install, cvr, cvr_rate FROM st",
)(lambda t: rates.update_cvr_targets(t("cvr_targets"), _cvr_status(t)))

# --- counters ----------------------------------------------------------------------------

query(
    "target_pacing",
    ("conversion_events", "offers"),
    f""", conv AS (
  SELECT channel, offer_id, COUNT(*) AS conv FROM conversion_events
  WHERE event_type <> '1' AND adtype NOT IN ('19', '38') GROUP BY 1, 2),
active AS (
  SELECT id, channel, SPLIT_PART(adv_offer, '_', -1) AS offer_id, target_cvr FROM offers
  WHERE channel_type = 2 AND status = 1 AND adv_status = 1 AND cvr_status = 1 AND target_cvr > 0),
rows AS (
  SELECT a.channel || '_' || a.offer_id AS key, CAST(COALESCE({half_even('c.conv / a.target_cvr * 10000e0 / ' + _MINUTES)}, 0) AS BIGINT) AS value,
    ROW_NUMBER() OVER (PARTITION BY a.channel, a.offer_id ORDER BY a.id DESC) AS rn
  FROM active a LEFT JOIN conv c ON a.channel = c.channel AND a.offer_id = c.offer_id)
SELECT key, value FROM rows WHERE rn = 1""",
)(lambda t: counters.target_pacing(t("conversion_events"), t("offers"), *whole_days(t, "conversion_events", "utctime")))
query(
    "target_pacing_hour",
    ("conversion_events", "offers"),
    f""", conv AS (
  SELECT channel, offer_id, COUNT(*) AS conv FROM conversion_events
  WHERE utctime >= (SELECT MAX(utctime) FROM conversion_events) - INTERVAL 60 MINUTE AND utctime < (SELECT MAX(utctime) FROM conversion_events)
    AND event_type <> '1' AND adtype NOT IN ('19', '38') GROUP BY 1, 2),
active AS (
  SELECT channel, SPLIT_PART(adv_offer, '_', -1) AS offer_id, arg_max(target_cvr, id) AS target_cvr FROM offers
  WHERE channel_type = 2 AND status = 1 AND adv_status = 1 AND cvr_status = 1 AND target_cvr > 0 GROUP BY 1, 2)
SELECT a.channel || '_' || a.offer_id AS key, CAST(COALESCE({half_even('c.conv / a.target_cvr * 10000e0 / 60e0')}, 0) AS BIGINT) AS value
FROM active a LEFT JOIN conv c ON a.channel = c.channel AND a.offer_id = c.offer_id""",
)(lambda t: counters.target_pacing(t("conversion_events"), t("offers"), t("conversion_events").agg(F.max("utctime")).first()[0], 60))

query(
    "cap_daily_cost",
    ("conversion_events", "offers"),
    f""", c AS (
  SELECT strftime(utctime, '%Y%m%d') AS event_day, channel, offer_id, country, slot, {DAY} AS day, COUNT(*) AS count
  FROM conversion_events WHERE event_type = '1' AND adtype IN ('38', '39') GROUP BY ALL)
SELECT c.event_day, m.offer, c.slot, c.count, m.offer || '_' || c.slot AS key
FROM c LEFT JOIN ({_OFFER_MAP}) m ON c.channel = m.channel AND c.offer_id = m.offer_id AND c.country = m.country""",
)(lambda t: counters.cap_daily_counts(t("conversion_events"), t("offers")))

query(
    "click_counters",
    ("routed",),
    f"SELECT {DAY} AS day, routed_offer || '_' || slot AS key, COUNT(*) AS value FROM routed WHERE click_through = '1' GROUP BY 1, 2",
)(lambda t: counters.click_counters(t("routed"), slots=None))

query(
    "click_counters_listed",
    ("routed",),
    f"SELECT {DAY} AS day, routed_offer || '_' || slot AS key, COUNT(*) AS value FROM routed WHERE click_through = '1' AND slot IN ('62858868', '66725501') GROUP BY 1, 2",
)(lambda t: counters.click_counters(t("routed")))
query(
    "slot_quota_listed",
    ("impressions",),
    f""", listed AS (SELECT UNNEST([{', '.join(f"'{x}'" for x in counters.QUOTA_SLOTS)}]) AS slot),
shown AS (SELECT slot, SUM(count) AS c FROM impressions WHERE visible = '1' AND adtype <> '12'
  AND time_slot >= (SELECT SUBSTRING(MAX(time_slot), 1, 6) || '1500' FROM impressions) GROUP BY slot)
SELECT 'summer_' || l.slot AS key, CAST(TRUNC(COALESCE(s.c, 0) / 0.9E0) AS BIGINT) AS value FROM listed l LEFT JOIN shown s ON l.slot = s.slot""",
)(
    lambda t: counters.slot_quota(
        t("impressions"), t.spark.createDataFrame([(x,) for x in counters.QUOTA_SLOTS], "slot string"),
        since=t("impressions").agg(F.max("time_slot")).first()[0][:6] + "1500",
    )
)
query(
    "affiliate_caps_last_day",
    ("conversions", "affiliates"),
    """, conv AS (SELECT channel, offer, slot, CAST(SUM(count) AS BIGINT) AS conv FROM conversions
  WHERE time_slot >= (SELECT SUBSTRING(MAX(time_slot), 1, 8) || '00' FROM conversions) GROUP BY ALL),
aff AS (SELECT id, ssp_offer_id AS offer, channel, MIN(slot) AS slot FROM affiliates GROUP BY 1, 2, 3)
SELECT id || '_cap' AS key, conv AS value FROM conv JOIN aff ON conv.offer = aff.offer AND conv.slot = aff.slot AND conv.channel = aff.channel""",
)(
    lambda t: counters.affiliate_cap_counters(
        t("conversions"), t("affiliates"), since=t("conversions").agg(F.max("time_slot")).first()[0][:8] + "00"
    )
)
query(
    "affiliate_revenue",
    ("conversions", "affiliates"),
    """, conv AS (SELECT time_slot, channel, offer, slot, country, platform, pkg, CAST(SUM(count) AS BIGINT) AS conversion FROM conversions GROUP BY ALL),
aff AS (SELECT id, ssp_offer_id AS offer, channel, MIN(slot) AS slot, SUM(payout) AS payout FROM affiliates GROUP BY 1, 2, 3)
SELECT SUBSTRING(time_slot, 1, 4) || '-' || SUBSTRING(time_slot, 5, 2) || '-' || SUBSTRING(time_slot, 7, 2) AS date,
  SUBSTRING(time_slot, 9, 2) AS hour, country, platform, pkg, id AS offer, CAST(0 AS BIGINT) AS impression, CAST(0 AS BIGINT) AS click,
  conversion, conversion * payout AS revenue
FROM conv JOIN aff ON conv.offer = aff.offer AND conv.slot = aff.slot AND conv.channel = aff.channel""",
)(lambda t: counters.affiliate_revenue(t("conversions"), t("affiliates")))

query(
    "affiliate_cap_counters",
    ("conversions", "affiliates"),
    """, conv AS (SELECT channel, offer, slot, CAST(SUM(count) AS BIGINT) AS conv FROM conversions GROUP BY ALL),
aff AS (SELECT id, ssp_offer_id AS offer, channel, MIN(slot) AS slot FROM affiliates GROUP BY 1, 2, 3)
SELECT id || '_cap' AS key, conv AS value FROM conv JOIN aff ON conv.offer = aff.offer AND conv.slot = aff.slot AND conv.channel = aff.channel""",
)(lambda t: counters.affiliate_cap_counters(t("conversions"), t("affiliates"), since=None))

query(
    "slot_quota",
    ("impressions", "placements"),
    """, listed AS (SELECT DISTINCT CAST(100 + id AS VARCHAR) AS slot FROM placements),
shown AS (SELECT slot, SUM(count) AS c FROM impressions WHERE visible = '1' AND adtype <> '12' GROUP BY slot)
SELECT 'summer_' || l.slot AS key, CAST(TRUNC(COALESCE(s.c, 0) / 0.9E0) AS BIGINT) AS value
FROM listed l LEFT JOIN shown s ON l.slot = s.slot""",
)(
    lambda t: counters.slot_quota(
        t("impressions"), t("placements").selectExpr("CAST(100 + id AS STRING) AS slot").distinct()
    )
)

# --- rollups --------------------------------------------------------------------------------

_SLOT = "time_slot, slot, country"


def _slot_rollup(name: str, table: str, where: str, fn, extra: str = "") -> None:
    sql = f"SELECT {_SLOT}, CAST(SUM(count) AS BIGINT) AS c{extra} FROM {table} {where} GROUP BY ALL"
    query(name, (table,), sql)(lambda t: fn(t(table)))


_FILLED = ", CAST(SUM(filled) AS BIGINT) AS filled"
_slot_rollup("slot_requests", "requests", "WHERE visible = '1'", rollups.slot_requests, _FILLED)
_slot_rollup("slot_listed_requests", "requests", "WHERE adtype = '3'", rollups.slot_listed_requests, _FILLED)
_slot_rollup("slot_impressions", "impressions", "WHERE visible = '1' AND adtype <> '12'", rollups.slot_impressions)
_slot_rollup("slot_clicks", "clicks", "", rollups.slot_clicks)
_slot_rollup("slot_all_clicks", "impressions", "WHERE visible = '0'", rollups.slot_all_clicks)
_slot_rollup("slot_conversions", "conversions", "", rollups.slot_conversions, f", {money('payout')} AS p")

_VISIBLE, _REQUEST, _SHOWN, _HIDDEN = "visible = '1'", "adtype = '3'", "visible = '1' AND adtype <> '12'", "visible = '0'"


def _sum_where(test: str, x: str) -> str:
    return f"CAST(SUM({x}) FILTER (WHERE {test}) AS BIGINT)"


query(
    "request_rollups",
    ("requests",),
    f"""SELECT {_SLOT}, {_sum_where(_VISIBLE, 'count')} AS visible_c, {_sum_where(_VISIBLE, 'filled')} AS visible_filled,
  {_sum_where(_REQUEST, 'count')} AS listed_c, {_sum_where(_REQUEST, 'filled')} AS listed_filled
FROM requests WHERE {_VISIBLE} OR {_REQUEST} GROUP BY ALL""",
)(lambda t: rollups.request_rollups(t("requests")))
query(
    "impression_rollups",
    ("impressions",),
    f"""SELECT {_SLOT}, {_sum_where(_SHOWN, 'count')} AS shown_c, {_sum_where(_HIDDEN, 'count')} AS hidden_c
FROM impressions WHERE ({_SHOWN}) OR {_HIDDEN} GROUP BY ALL""",
)(lambda t: rollups.impression_rollups(t("impressions")))

query(
    "offer_conv_click",
    ("impressions", "conversions"),
    f"""SELECT ta.offer, ta.platform, ta.country, CAST(ta.date AS VARCHAR) AS date, ta.pkg, ta.count, ta.revenue, tb.click FROM (
  SELECT channel || '_' || offer AS offer, platform, country, CAST(strptime({DAY}, '%Y%m%d') AS DATE) AS date, pkg,
    {big('SUM(count)')} AS count, {money('payout')} AS revenue FROM conversions WHERE pkg <> '' GROUP BY 1, 2, 3, 4, 5) ta
LEFT JOIN (
  SELECT channel || '_' || offer AS offer, platform, country, CAST(strptime({DAY}, '%Y%m%d') AS DATE) AS date, pkg,
    {big('SUM(count)')} AS click FROM impressions WHERE pkg <> '' GROUP BY 1, 2, 3, 4, 5) tb
ON ta.offer = tb.offer AND ta.country = tb.country AND ta.platform = tb.platform AND ta.pkg = tb.pkg AND ta.date = tb.date""",
)(
    lambda t: rollups.offer_conv_click(t("conversions"), t("impressions")).withColumn("date", F.col("date").cast("string"))
)

query(
    "offer_share",
    ("impressions", "conversions"),
    f""", a AS (SELECT {DAY} AS day, channel, offer FROM impressions GROUP BY 1, 2, 3),
b AS (SELECT {DAY} AS day, channel, offer, {sum_units('payout')} AS payout FROM conversions GROUP BY 1, 2, 3),
c AS (
  SELECT a.day, a.channel, COUNT(*) AS click_offer_num, COUNT(b.offer) AS conv_offer_num, CAST(SUM(b.payout) AS BIGINT) AS payout_u
  FROM a LEFT JOIN b ON a.day = b.day AND a.channel = b.channel AND a.offer = b.offer GROUP BY 1, 2),
d AS (
  SELECT *, SUM(click_offer_num) OVER (PARTITION BY day) AS all_click, SUM(conv_offer_num) OVER (PARTITION BY day) AS all_conv,
    CAST(ROUND(payout_u / 1e9) AS HUGEINT) AS payout_w, CAST(ROUND(CAST(SUM(payout_u) OVER (PARTITION BY day) AS BIGINT) / 1e9) AS HUGEINT) AS all_payout FROM c)
SELECT day, channel, click_offer_num, {share('click_offer_num', 'all_click')} AS click_offer_rate,
  conv_offer_num, CASE WHEN all_conv = 0 THEN NULL ELSE {share('conv_offer_num', 'all_conv')} END AS conv_offer_rate,
  {share('conv_offer_num', 'all_click')} AS conv_all_offer_rate, payout_u / 1e9 AS payout,
  CASE WHEN all_payout = 0 THEN NULL ELSE {share('payout_w', 'all_payout')} END AS payout_rate
FROM d""",
)(lambda t: rollups.offer_share(t("impressions"), t("conversions")))

query(
    "day_platform_report",
    ("impressions", "conversions"),
    f""", ta AS (
  SELECT {DAY} AS day, SUBSTRING(time_slot, 9, 2) AS hour, platform, country, channel, SUM(count) AS click
  FROM impressions WHERE country <> 'CN' GROUP BY ALL),
tb AS (
  SELECT {DAY} AS day, SUBSTRING(time_slot, 9, 2) AS hour, platform, country, channel, SUM(count) AS conv, {sum_units('payout')} AS payout
  FROM conversions WHERE country <> 'CN' GROUP BY ALL)
SELECT day, hour, platform, country, channel, {big('COALESCE(click, 0)')} AS click, {big('COALESCE(conv, 0)')} AS conv, COALESCE(payout, 0) / 1e9 AS payout
FROM ta FULL JOIN tb USING (day, hour, platform, country, channel)""",
)(lambda t: rollups.day_platform_report(t("impressions"), t("conversions")))

_LISTED = "adtype IN ('0', '1', '2', '5', '6', '7', '10', '13', '14', '15', '16', '17')"
query(
    "imp_click",
    ("impressions", "clicks"),
    f""", ta AS (SELECT {DAY} AS date, platform, adtype, country, channel, offer, {big('SUM(count)')} AS imp FROM impressions WHERE {_LISTED} GROUP BY ALL),
tb AS (SELECT {DAY} AS date, platform, adtype, country, channel, offer, {big('SUM(count)')} AS click FROM clicks WHERE {_LISTED} GROUP BY ALL)
SELECT date, platform, adtype, country, channel, offer, imp, click FROM ta LEFT JOIN tb USING (date, platform, adtype, country, channel, offer)""",
)(lambda t: rollups.imp_click(t("impressions"), t("clicks"), channels=None))

query(
    "imp_click_listed",
    ("impressions", "clicks"),
    f""", ta AS (SELECT {DAY} AS date, platform, adtype, country, channel, offer, {big('SUM(count)')} AS imp FROM impressions
  WHERE {_LISTED} AND channel IN ('huk', 'bin', 'rcm4', 'mbg', 'real') GROUP BY ALL),
tb AS (SELECT {DAY} AS date, platform, adtype, country, channel, offer, {big('SUM(count)')} AS click FROM clicks WHERE {_LISTED} GROUP BY ALL)
SELECT date, platform, adtype, country, channel, offer, imp, click FROM ta LEFT JOIN tb USING (date, platform, adtype, country, channel, offer)""",
)(lambda t: rollups.imp_click(t("impressions"), t("clicks")))
query(
    "offer_slot_conv",
    ("conversions",),
    f"SELECT {DAY} AS day, country, channel, offer, slot, {big('SUM(count)')} AS conv, {money('payout')} AS payout FROM conversions WHERE LENGTH(country) <= 2 GROUP BY ALL",
)(lambda t: rollups.offer_slot_conv(t("conversions")))

# --- feeds ------------------------------------------------------------------------------------

query(
    "install_feed",
    ("conversion_events", "offers", "event_caps"),
    """, inst AS (
  SELECT offer_id, af_siteid, COUNT(*) AS install FROM conversion_events
  WHERE event_type = '1' AND adtype IN ('19', '38', '20', '40') AND offer_pkg <> 'com.dts.freefireth' GROUP BY 1, 2),
black AS (SELECT DISTINCT adv_offer AS offer_id, UNNEST(STRING_SPLIT(site_black_value, ',')) AS af_siteid FROM offers WHERE site_black_value <> ''),
over AS (
  SELECT e.offer_id FROM (SELECT offer_id, COUNT(*) AS n FROM conversion_events WHERE event_type = '2' GROUP BY 1) e
  JOIN event_caps c ON e.offer_id = c.offer_id WHERE e.n >= c.event_cap)
SELECT i.offer_id, i.af_siteid, i.install, CASE WHEN o.offer_id IS NULL THEN 1 ELSE 2 END AS status
FROM inst i LEFT JOIN over o ON i.offer_id = o.offer_id
WHERE NOT EXISTS (SELECT 1 FROM black b WHERE b.offer_id = i.offer_id AND b.af_siteid = i.af_siteid)""",
)(lambda t: feeds.install_feed(t("conversion_events"), t("offers"), t("event_caps"), *whole_days(t, "conversion_events", "utctime")))

_TOP = """, d AS (SELECT channel, offer, domain_tag, SUM(count) AS n FROM redirects GROUP BY 1, 2, 3),
top AS (SELECT channel, offer AS offer_id, domain_tag FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY channel, offer ORDER BY n DESC, domain_tag) AS rn FROM d) x WHERE rn = 1)"""


def _top(t: Testbed):
    end, minutes = whole_days(t, "redirects", "created")
    return feeds.top_domains(t("redirects"), end, minutes // 60)


query("top_domains", ("redirects",), f"{_TOP} SELECT * FROM top")(_top)
query(
    "redirect_domain",
    ("redirects", "stored_domains"),
    f"""{_TOP} SELECT t.channel, t.offer_id, t.domain_tag FROM top t
LEFT JOIN stored_domains s ON t.channel = s.channel AND t.offer_id = s.offer_id
WHERE s.domain_tag IS NULL OR POSITION(t.domain_tag IN s.domain_tag) = 0""",
)(lambda t: feeds.changed_domains(_top(t), t("stored_domains")))
query(
    "direct_conversion_append",
    ("direct",),
    "SELECT pb_channel, pb_channel_id, offer, strftime(update_time, '%Y%m%d%H') AS time_slot, clk_id FROM direct",
)(lambda t: feeds.forwarded_postbacks(t("direct")))
query(
    "cvr_install_day",
    ("af_installs",),
    "SELECT id, channel, offer, site, strftime(install_time, '%Y-%m-%d %H:%M:%S.%f') AS install_time, strftime(install_time, '%Y%m%d%H') AS time_slot FROM af_installs",
)(lambda t: feeds.install_day(t("af_installs")).withColumn("install_time", F.date_format("install_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")))
query(
    "af_report_normalize",
    ("af_report",),
    """SELECT agency, SPLIT_PART(pid, '_', 1) AS pid, campaign, impression, click, ctr, install, cvr, cost, ecpi, roi, pkg,
  CASE WHEN platform = 'android' THEN 'Android' ELSE 'iOS' END AS platform FROM af_report""",
)(lambda t: feeds.normalize_af_report(t("af_report")))
query(
    "device_inventory",
    ("models",),
    """SELECT '20240130' AS date, SPLIT_PART(key, '_', 1) AS country, CASE WHEN SPLIT_PART(key, '_', 2) = 'android' THEN 1 ELSE 2 END AS platform,
  SPLIT_PART(key, '_', 3) AS pkg_name, COUNT(*) AS device_num FROM models GROUP BY key""",
)(lambda t: feeds.device_inventory(t("models"), "20240130"))
query(
    "device_count_load",
    ("device_settings",),
    """SELECT REPLACE(day, '-', '') AS day, CASE platform WHEN '1' THEN 'Android' WHEN '2' THEN 'iOS' END AS platform,
  country, source, label, slot_id, device_count FROM device_settings""",
)(lambda t: feeds.device_counts(t("device_settings")))

# --- dimensions ------------------------------------------------------------------------------

query(
    "offer_dim_refresh",
    ("offers",),
    """SELECT offer_id, adv_offer, CAST(create_type AS BIGINT) AS create_type, channel, CAST(channel_type AS BIGINT) AS channel_type,
  CAST(CASE id % 5 WHEN 0 THEN event_cap WHEN 1 THEN event_cap + 3 ELSE 0 END AS BIGINT) AS cap_daily,
  CAST(adv_status AS BIGINT) AS adv_status, conversion_flow, CAST(status AS BIGINT) AS status, title, pkg, attribute_provider, pid,
  platform, country, revenue, adtype, adv_tracking_link, target_cvr, CAST(cvr_status AS BIGINT) AS cvr_status, CAST(is_s2s AS BIGINT) AS is_s2s,
  s2s_tracking_link, app_url, site_type, site_value, site_black_value, description, traffic FROM offers""",
)(lambda t: dims.offer_dimension(t("offers")))
query(
    "stream_offer_dim_refresh",
    ("stream_offers",),
    """SELECT id, channel, offer_id, attribute_provider, title, tracking_link, pid, pkg_name AS offer_pkg, payout, platform, country,
  CAST(max_clk_num AS BIGINT) AS max_clk_num, device, site_id AS siteid_type, hour AS siteid_hour, clk_id, site_clk_limit, site_clk_id, category_id,
  site_install_limitation, conversion_flow, COALESCE(event_name, '') AS event_name, CAST(status AS BIGINT) AS status, diy_siteid, note,
  start_hour, end_hour FROM stream_offers""",
)(lambda t: dims.stream_offer_dimension(t("stream_offers")))

# --- alarms -----------------------------------------------------------------------------------


def _slot_plus(col: str, hours: str) -> str:
    return f"strftime(strptime({col}, '%Y%m%d%H') + {hours} * INTERVAL 1 HOUR, '%Y%m%d%H')"


def _hours(*slots: str) -> str:
    """Every hour from the least to the largest bucket of the given (column FROM table) pairs."""
    seen = " UNION ALL ".join(f"SELECT {s}" for s in slots)
    return f"""hours AS (SELECT strftime(h, '%Y%m%d%H') AS time_slot FROM (
  SELECT UNNEST(generate_series(strptime(MIN(s), '%Y%m%d%H'), strptime(MAX(s), '%Y%m%d%H'), INTERVAL 1 HOUR)) AS h FROM ({seen}) AS x(s)))"""


def _rates(name: str, table: str, slot: str, measure: str, zero: bool) -> str:
    now = "COALESCE(a.n, 0)"
    hour = f"({now} - COALESCE(h.n, 0)) / COALESCE(h.n, 1) * 100e0" if zero else f"({now} - h.n) / h.n * 100e0"
    return f"""{name}_h AS (SELECT {slot} AS time_slot, CAST(SUM({measure}) AS DOUBLE) AS n FROM {table} GROUP BY 1),
{name} AS (
  SELECT s.time_slot, ({now} - d.n) / d.n * 100e0 AS day_rate, {hour} AS hour_rate FROM hours s
  LEFT JOIN {name}_h a ON s.time_slot = a.time_slot
  LEFT JOIN {name}_h d ON s.time_slot = {_slot_plus('d.time_slot', '24')}
  LEFT JOIN {name}_h h ON s.time_slot = {_slot_plus('h.time_slot', '1')})"""


def _rule(alarm: str, rule: str, value: str, threshold: float, fired: str) -> str:
    return (
        f"SELECT time_slot, '{alarm}' AS alarm, '{rule}' AS rule, CAST({value} AS DOUBLE) AS value, "
        f"CAST({threshold} AS DOUBLE) AS threshold, COALESCE({fired}, FALSE) AS fired FROM judged"
    )


def _drops(alarm: str, p: str) -> list[str]:
    return [
        _rule(alarm, f"{p}_drop", f"GREATEST({p}_day, {p}_hour)", -30, f"{p}_day < -30 AND {p}_hour < -30"),
        _rule(alarm, f"{p}_deep_drop", f"{p}_day", -50, f"{p}_day < -50"),
    ]


_CREATED = "strftime(created, '%Y%m%d%H')"
TRAFFIC_ALARM_SQL = f""", {_hours('time_slot FROM impressions', _CREATED + ' FROM async_clicks', 'time_slot FROM conversions')},
{_rates('served', 'impressions', 'time_slot', 'count', False)},
{_rates('asy', 'async_clicks', _CREATED, 'count', True)},
pay AS (SELECT time_slot, {money('payout')} AS payout FROM conversions GROUP BY 1),
busy AS (SELECT {_CREATED} AS time_slot, offer, SUM(count) AS click FROM async_clicks WHERE pid = '' GROUP BY 1, 2 HAVING SUM(count) > 10000),
att AS (SELECT attr_hour AS time_slot, offer, SUM(count) AS conv FROM conversions WHERE adtype = '19' GROUP BY 1, 2),
th AS (SELECT busy.time_slot, SUM(COALESCE(att.conv, 0)) AS conv FROM busy LEFT JOIN att USING (time_slot, offer) GROUP BY 1),
tracked AS (SELECT {_slot_plus('th.time_slot', 'g.i')} AS time_slot, SUM(conv) AS conv FROM th, (VALUES (0), (1), (2)) g(i) GROUP BY 1),
judged AS (
  SELECT s.time_slot, s.day_rate AS served_day, s.hour_rate AS served_hour,
    a.day_rate AS async_day, a.hour_rate AS async_hour, COALESCE(p.payout, 0) AS payout, COALESCE(t.conv, 0) AS conv
  FROM served s JOIN asy a ON s.time_slot = a.time_slot
  LEFT JOIN pay p ON p.time_slot = s.time_slot LEFT JOIN tracked t ON t.time_slot = s.time_slot),
alerts AS ({' UNION ALL '.join([*_drops('traffic', 'async'), *_drops('traffic', 'served'),
    _rule('traffic', 'low_payout', 'payout', 100, 'payout <= 100'), _rule('traffic', 'no_conversion', 'conv', 0, 'conv = 0')])})"""


def _traffic_alarm(t: Testbed):
    return alarms.traffic_alarm(t("impressions"), t("async_clicks"), t("conversions"))


query("traffic_alarm", ("impressions", "async_clicks", "conversions"), f"{TRAFFIC_ALARM_SQL} SELECT * FROM alerts")(
    _traffic_alarm
)
query(
    "traffic_alarm_fired",
    ("impressions", "async_clicks", "conversions"),
    f"""{TRAFFIC_ALARM_SQL} SELECT time_slot, alarm, BOOL_OR(fired) AS fired,
  COALESCE(STRING_AGG(CASE WHEN fired THEN rule END, ',' ORDER BY rule), '') AS rules FROM alerts GROUP BY 1, 2""",
)(lambda t: alarms.fired_slots(_traffic_alarm(t)))
query(
    "stream_alarm",
    ("stream", "conversion_events"),
    f""", {_hours('time_slot FROM stream', 'time_slot FROM conversion_events')},
{_rates('st', 'stream', 'time_slot', 'clk_count', True)},
th AS (SELECT attr_time AS time_slot, COUNT(*) AS conv FROM conversion_events WHERE attribute_provider = 'Adjust' GROUP BY 1),
tracked AS (SELECT {_slot_plus('th.time_slot', 'g.i')} AS time_slot, SUM(conv) AS conv FROM th, (VALUES (0), (1), (2), (3), (4), (5)) g(i) GROUP BY 1),
judged AS (SELECT s.time_slot, s.day_rate AS stream_day, s.hour_rate AS stream_hour, COALESCE(t.conv, 0) AS conv
  FROM st s LEFT JOIN tracked t ON s.time_slot = t.time_slot)
{' UNION ALL '.join([*_drops('stream', 'stream'), _rule('stream', 'no_conversion', 'conv', 0, 'conv = 0')])}""",
)(lambda t: alarms.stream_alarm(t("stream"), t("conversion_events")))
query(
    "volume_alarm",
    ("clicks", "impressions"),
    f""", {_hours('time_slot FROM clicks', 'time_slot FROM impressions')},
c AS (SELECT time_slot, SUM(count) AS clicks FROM clicks GROUP BY 1),
i AS (SELECT time_slot, SUM(count) AS shown FROM impressions WHERE adtype = '16' GROUP BY 1),
judged AS (
  SELECT time_slot, COALESCE(clicks, 0) AS clicks, COALESCE(shown, 0) AS shown FROM hours LEFT JOIN c USING (time_slot) LEFT JOIN i USING (time_slot))
{' UNION ALL '.join([_rule('volume', 'low_clicks', 'clicks', 100, 'clicks < 100'), _rule('volume', 'low_impressions', 'shown', 1000, 'shown < 1000')])}""",
)(lambda t: alarms.volume_alarm(t("clicks"), t("impressions")))
query(
    "tracker_totals",
    ("conversion_events",),
    f"SELECT COUNT(*) AS conv, {money('payout')} AS payout FROM conversion_events WHERE attribute_provider = 'Adjust' AND attr_time >= (SELECT SUBSTRING(MAX(attr_time), 1, 8) || '00' FROM conversion_events)",
)(lambda t: alarms.tracker_totals(t("conversion_events"), t("conversion_events").agg(F.max("attr_time")).first()[0][:8] + "00"))
