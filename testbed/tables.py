"""Source tables derived from the test parquet files.

One SQL text per table serves both engines; only date formatting differs. Every table is
derived from all rows of its parquet file (or all rows of one event kind), so the logs
grow with the data.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from adtally.session import pin_settings, use_scratch
from adtally.sources.tables import scan_parquet

SPARK = {"slot": "date_format({0}, 'yyyyMMddHH')", "day": "date_format({0}, 'yyyyMMdd')", "iso": "date_format({0}, 'yyyy-MM-dd')"}
DUCK = {"slot": "strftime({0}, '%Y%m%d%H')", "day": "strftime({0}, '%Y%m%d')", "iso": "strftime({0}, '%Y-%m-%d')"}

COUNTRY = "CASE {0} % 6 WHEN 0 THEN 'US' WHEN 1 THEN 'IN' WHEN 2 THEN 'CN' WHEN 3 THEN 'BR' WHEN 4 THEN '' ELSE 'U-S' END"

# name -> (inputs, select text); inputs that are parquet files come first in the chain
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "ad_log": (
        ("events",),
        """
SELECT event_id, user_id, ts, {slot:ts} AS time_slot, {day:ts} AS day, {iso:ts} AS iso_day, event_type AS kind,
  CASE WHEN event_id % 101 = 7 THEN 'c' WHEN event_id % 103 = 5 THEN NULL WHEN event_id % 59 = 6 THEN 'mbg'
    ELSE CONCAT('ch', CAST((user_id + CASE WHEN event_id % 5 = 0 THEN 1 + event_id % 3 ELSE 0 END) % 7 AS STRING)) END AS channel,
  CAST(user_id * 20 AS STRING) AS offer,
  CASE event_id % 41 WHEN 1 THEN '62858868' WHEN 2 THEN '70403608' ELSE CAST(100 + event_id % 37 AS STRING) END AS slot,
  CAST(event_id % 11 AS STRING) AS site,
  {country:user_id} AS country,
  CASE (user_id + event_id) % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'iOS' ELSE 'Android' END AS platform,
  CASE event_id % 8 WHEN 0 THEN '3' WHEN 1 THEN '8' WHEN 2 THEN '19' WHEN 3 THEN '38' WHEN 4 THEN '39'
    WHEN 5 THEN '16' WHEN 6 THEN '12' ELSE '0' END AS adtype,
  CASE user_id % 25 WHEN 7 THEN 'com.lazada.android' WHEN 8 THEN 'com.alibaba.aliexpresshd'
    WHEN 9 THEN 'com.dts.freefireth' WHEN 10 THEN '' ELSE CASE WHEN event_id % 97 = 3 THEN 'p' WHEN event_id % 89 = 4 THEN NULL
      WHEN event_id % 6 = 1 THEN CONCAT('com.alt', CAST(event_id % 4 AS STRING)) ELSE CONCAT('com.app', CAST(user_id % 4 AS STRING)) END END AS pkg,
  CASE event_type WHEN 'signup' THEN '1' WHEN 'purchase' THEN '2' ELSE '0' END AS event_code,
  CAST(event_id % 2 AS STRING) AS visible,
  1 + event_id % 3 AS cnt,
  CASE WHEN event_id % 7 = 0 OR (event_id % 8 = 3 AND event_id % 3 < 2) THEN 0.0E0 ELSE value END AS payout,
  value * 0.5E0 AS cost
FROM events""",
    ),
    "impressions": (
        ("ad_log",),
        "SELECT time_slot, channel, offer, slot, country, platform, pkg, adtype, visible, cnt AS count FROM ad_log WHERE kind = 'view'",
    ),
    "clicks": (
        ("ad_log",),
        "SELECT time_slot, channel, offer, slot, country, platform, pkg, adtype, cnt AS count FROM ad_log WHERE kind = 'click'",
    ),
    "conversions": (
        ("ad_log",),
        "SELECT time_slot, {slot:ts - INTERVAL 1 HOUR} AS attr_hour, channel, offer, slot, country, platform, pkg, adtype, cnt AS count, payout FROM ad_log WHERE kind IN ('signup', 'purchase')",
    ),
    "requests": (
        ("ad_log",),
        "SELECT time_slot, slot, country, adtype, visible, cnt + 2 AS count, cnt AS filled FROM ad_log",
    ),
    "async_clicks": (
        ("ad_log",),
        "SELECT ts AS created, offer, CASE WHEN event_id % 3 = 0 THEN 'p1' ELSE '' END AS pid, cnt * 6000 AS count FROM ad_log WHERE kind = 'click'",
    ),
    "redirects": (
        ("ad_log",),
        "SELECT ts AS created, channel, offer, CONCAT('d', CAST(event_id % 5 AS STRING), '.com') AS domain_tag, cnt AS count FROM ad_log WHERE kind = 'click'",
    ),
    "stream": (
        ("ad_log",),
        "SELECT time_slot, offer AS offer_id, country, channel, pkg AS offer_pkg, platform, cnt * 1000 + event_id % 700 AS clk_count, cnt AS imp_count FROM ad_log WHERE kind = 'view'",
    ),
    "synced": (
        ("ad_log",),
        "SELECT time_slot, offer AS offer_id, country, channel, pkg AS offer_pkg, platform, cnt * 10 AS clk_count FROM ad_log WHERE kind = 'error'",
    ),
    "routed": (
        ("ad_log",),
        "SELECT time_slot, ts AS created, CASE WHEN adtype = '39' THEN CONCAT(channel, '_', offer) ELSE offer END AS offer_id, CONCAT('r', offer) AS routed_offer, slot, country, channel, adtype, CASE WHEN event_id % 5 = 0 THEN '0' ELSE '1' END AS click_through, pkg AS offer_pkg, platform FROM ad_log WHERE kind = 'click'",
    ),
    "daily_clicks": (
        ("ad_log",),
        "SELECT iso_day AS day, offer AS offer_id, country, channel, adtype, cnt * 100 AS count FROM ad_log WHERE kind = 'view'",
    ),
    "conversion_events": (
        ("ad_log",),
        "SELECT time_slot, ts AS utctime, channel, CAST(user_id % 4 AS STRING) AS channel_type, offer AS offer_id, pkg AS offer_pkg, country, platform, slot, adtype, event_code AS event_type, site AS af_siteid, CASE WHEN user_id % 2 = 0 THEN 'Adjust' ELSE 'AppsFlyer' END AS attribute_provider, {slot:ts - INTERVAL 1 HOUR} AS attr_time, payout, cost FROM ad_log WHERE kind IN ('signup', 'purchase')",
    ),
    "rejected": (
        ("ad_log",),
        "SELECT time_slot, country, platform, pkg AS offer_pkg, offer AS offer_id, channel FROM ad_log WHERE kind = 'error'",
    ),
    "direct": (
        ("ad_log",),
        "SELECT day AS pdate, ts AS update_time, channel AS pb_channel, CONCAT(COALESCE(channel, ''), '-', site) AS pb_channel_id, offer, CAST(event_id AS STRING) AS clk_id FROM ad_log WHERE kind = 'purchase'",
    ),
    "publisher_log": (
        ("ad_log",),
        "SELECT iso_day AS day, event_id % 37 AS placement_id, user_id % 25 AS country_id, payout * 0.25E0 AS re_real_revenue FROM ad_log WHERE kind = 'view'",
    ),
    "af_installs": (
        ("ad_log",),
        "SELECT event_id AS id, channel, offer, site, ts AS install_time FROM ad_log WHERE kind = 'signup'",
    ),
    "af_report": (
        ("ad_log",),
        "SELECT day AS date, channel AS agency, CONCAT(COALESCE(channel, ''), '_', site) AS pid, offer AS campaign, cnt * 10 AS impression, cnt AS click, cnt * 0.5E0 AS ctr, cnt AS install, cnt * 0.25E0 AS cvr, cost, cost * 2.0E0 AS ecpi, cost * 4.0E0 AS roi, pkg, LOWER(platform) AS platform FROM ad_log WHERE kind = 'view'",
    ),
    "device_settings": (
        ("ad_log",),
        "SELECT iso_day AS day, CAST(1 + event_id % 3 AS STRING) AS platform, country, channel AS source, site AS label, slot AS slot_id, cnt AS device_count FROM ad_log",
    ),
    "models": (("ad_log",), "SELECT CONCAT(country, '_', LOWER(platform), '_', COALESCE(pkg, '')) AS key FROM ad_log"),
    "partner_lines": (
        ("ad_log",),
        """
SELECT CONCAT(CHR(34), iso_day, CHR(34), ',', country, ',', CASE WHEN platform = 'ios' THEN 'web' ELSE platform END, ',', pkg, ',x,', channel, ',',
  CAST(cnt * 10 AS STRING), ',', CAST(cnt AS STRING), ',', CAST(cnt % 2 AS STRING), ',', CAST(cnt * 0.5E0 AS STRING), ',', CAST(cnt * 0.25E0 AS STRING),
  CASE WHEN event_id % 10 = 0 THEN '' ELSE ',y' END) AS value,
  iso_day, country, platform, pkg, channel, cnt, event_id
FROM (SELECT iso_day, country, platform, COALESCE(pkg, '') AS pkg, COALESCE(channel, '') AS channel, cnt, event_id FROM ad_log) a""",
    ),
    "offers": (
        ("part",),
        """
SELECT p_partkey AS id, CAST(p_partkey AS STRING) AS offer_id,
  CASE WHEN p_partkey % 2 = 0 THEN CONCAT(channel, '_', CAST(p_partkey AS STRING)) ELSE CAST(p_partkey - 1 AS STRING) END AS adv_offer,
  1 AS create_type, channel, p_size % 3 AS channel_type, CASE WHEN p_partkey % 9 = 0 THEN 0 ELSE 1 END AS adv_status,
  'cpi' AS conversion_flow, CASE WHEN p_size % 5 = 4 THEN 0 ELSE 1 END AS status, p_name AS title, 'com.app1' AS pkg,
  'Adjust' AS attribute_provider, 'p1' AS pid, 'ios' AS platform, country, p_retailprice AS revenue, '3' AS adtype,
  'http://x' AS adv_tracking_link, CASE WHEN p_size % 7 = 0 THEN NULL ELSE CAST(p_size % 5 AS DOUBLE) END AS target_cvr,
  p_size % 2 AS cvr_status, 0 AS is_s2s, '' AS s2s_tracking_link, 'http://y' AS app_url, 'a' AS site_type, '' AS site_value,
  CASE p_partkey % 4 WHEN 1 THEN '1,4' WHEN 3 THEN '2' ELSE '' END AS site_black_value, p_type AS description,
  REPLACE(REPLACE(REPLACE(CASE p_partkey % 5
    WHEN 0 THEN CONCAT('[<~pub_status~: 1, ~cap_daily~: ', CAST(p_size AS STRING), '>, <~pub_status~: 2, ~cap_daily~: 9>]')
    WHEN 1 THEN CONCAT('[<~pub_status~: 1, ~cap_daily~: ', CAST(p_size AS STRING), ', ~pub~: None>, <~pub_status~: 1, ~cap_daily~: 3>]')
    WHEN 2 THEN '[<~pub_status~: 1, ~cap_daily~: None>, <~pub_status~: 1, ~cap_daily~: 3>]'
    WHEN 3 THEN 'not a list' ELSE '[]' END, '~', CHR(39)), '<', CHR(123)), '>', CHR(125)) AS traffic,
  p_size AS event_cap, p_size
FROM (SELECT *, CONCAT('ch', CAST(CAST(FLOOR(p_partkey / 20) AS BIGINT) % 7 AS STRING)) AS channel,
        {country:CAST(FLOOR(p_partkey / 20) AS BIGINT)} AS country FROM part) p""",
    ),
    "stream_offers": (
        ("part",),
        """
SELECT p_partkey AS id, CONCAT('ch', CAST(p_partkey % 7 AS STRING)) AS channel, CAST(p_partkey AS STRING) AS offer_id,
  'Adjust' AS attribute_provider, p_name AS title, 'http://t' AS tracking_link, 'p1' AS pid, p_brand AS pkg_name,
  p_retailprice AS payout, 'ios' AS platform, 'US' AS country, p_size AS max_clk_num, 'd' AS device, 's' AS site_id,
  CAST(p_size % 24 AS STRING) AS hour, 'c' AS clk_id, '5' AS site_clk_limit, 'k' AS site_clk_id, '1' AS category_id,
  '2' AS site_install_limitation, 'cpi' AS conversion_flow, CASE WHEN p_size % 2 = 0 THEN NULL ELSE 'e' END AS event_name,
  p_size % 2 AS status, 'x' AS diy_siteid, p_type AS note, '0' AS start_hour, '23' AS end_hour
FROM part""",
    ),
    "event_caps": (("offers",), "SELECT offer_id, event_cap FROM offers"),
    "affiliates": (
        ("part",),
        """
SELECT CONCAT('f', CAST(p_partkey AS STRING)) AS id, CAST(CAST(FLOOR(p_partkey / 20) AS BIGINT) * 20 AS STRING) AS ssp_offer_id,
  CONCAT('ch', CAST(CAST(FLOOR(p_partkey / 20) AS BIGINT) % 7 AS STRING)) AS channel,
  CAST(100 + p_partkey % 37 AS STRING) AS slot, CAST(p_size AS DOUBLE) * 0.25E0 AS payout
FROM part""",
    ),
    "cvr_targets": (
        ("offers",),
        "SELECT CONCAT(channel, '_', offer_id) AS channel_offer, CAST(p_size % 5 AS DOUBLE) * 1000 AS target_cvr, 0.0E0 AS click_w, CAST(0 AS BIGINT) AS install, 0.0E0 AS cvr, 0 AS cvr_rate FROM offers",
    ),
    "stored_domains": (
        ("offers",),
        "SELECT channel, offer_id, CONCAT('d', CAST(p_size % 5 AS STRING), '.com,d4.com') AS domain_tag FROM offers",
    ),
    "networks": (
        ("region",),
        "SELECT CONCAT('ch', CAST(r_regionkey AS STRING)) AS short_name, CASE WHEN r_regionkey = 3 THEN NULL ELSE CONCAT('A', CAST(r_regionkey AS STRING)) END AS adv_id, CAST(r_regionkey % 3 AS STRING) AS channel_type FROM region",
    ),
    "contract_advertisers": (
        ("region",),
        "SELECT CONCAT(CASE WHEN r_regionkey = 2 THEN 'B' ELSE 'A' END, CAST(r_regionkey AS STRING)) AS adv_id, CONCAT('C', CAST(r_regionkey AS STRING)) AS contract_code FROM region",
    ),
    "contract_customers": (
        ("region",),
        "SELECT CONCAT('C', CAST(r_regionkey AS STRING)) AS contract_code, CASE WHEN r_regionkey = 4 THEN '' WHEN r_regionkey % 2 = 0 THEN 'CNY' ELSE 'USD' END AS adv_currency FROM region",
    ),
    "contract_channels": (
        ("customer",),
        "SELECT CONCAT('K', CAST(c_custkey AS STRING)) AS payee_code, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE CONCAT('S', CAST(c_custkey AS STRING)) END AS supplier_id, CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN 'CNY' ELSE 'USD' END AS payout_currency FROM customer",
    ),
    "countries": (("nation",), "SELECT n_nationkey AS id, {country:n_nationkey} AS short_name FROM nation"),
    "placements": (
        ("supplier",),
        "SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(100 + s_suppkey AS STRING) END AS slot_str, s_nationkey AS app_id FROM supplier",
    ),
    "apps": (
        ("nation",),
        "SELECT n_nationkey AS id, CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE CAST(n_nationkey * 7 AS BIGINT) END AS user_id FROM nation",
    ),
    "users": (
        ("customer",),
        "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CONCAT('K', CAST(c_custkey AS STRING)) END AS payee_code, CONCAT('u', CAST(c_custkey AS STRING), '@example.org') AS email, CASE WHEN c_custkey % 11 = 10 THEN NULL ELSE c_name END AS username FROM customer",
    ),
    "contract_texts": (
        ("customer",),
        """
SELECT c_custkey AS id, REPLACE(REPLACE(REPLACE(CASE c_custkey % 10
    WHEN 5 THEN CONCAT('<~code~: ~K', CAST(c_custkey AS STRING), '~, ~data~: ')
    WHEN 6 THEN CONCAT('<~code~: ~K', CAST(c_custkey AS STRING), '~, ~data~: <~amount~: ~on request~, ~currency~: ~USD~>>')
    WHEN 7 THEN CONCAT('<~data~: <~amount~: ', CAST(c_custkey AS STRING), '.5, ~currency~: ~USD~>>')
    WHEN 8 THEN CONCAT('<~code~: ~K', CAST(c_custkey AS STRING), '~, ~data~: <~currency~: null>, ~extra~: [1, 2]>')
    WHEN 9 THEN CONCAT('<~data~: <~amount~: [1], ~currency~: ~CNY~>>')
    ELSE CONCAT('<~code~: ~K', CAST(c_custkey AS STRING), '~, ~data~: <~amount~: ', CAST(c_custkey AS STRING), '.25, ~currency~: ~CNY~>>') END,
  '~', CHR(34)), '<', CHR(123)), '>', CHR(125)) AS text
FROM customer""",
    ),
    "user_versions": (
        ("customer",),
        """
SELECT c_custkey AS id, TIMESTAMP '2024-01-01 00:00:00' + CAST((c_custkey * 7 + v * 9) % 30 AS INT) * INTERVAL '1' DAY AS valid_from,
  CONCAT('u', CAST(c_custkey AS STRING), '@v', CAST(v AS STRING), '.example.org') AS email,
  CASE WHEN (c_custkey + v) % 11 = 10 THEN NULL ELSE CONCAT(c_name, '-', CAST(v AS STRING)) END AS username
FROM (SELECT *, 0 AS v FROM customer UNION ALL SELECT *, 1 AS v FROM customer UNION ALL SELECT *, 2 AS v FROM customer UNION ALL SELECT *, 3 AS v FROM customer) versions""",
    ),
    "network_versions": (
        ("region",),
        """
SELECT CONCAT('ch', CAST(r_regionkey AS STRING)) AS short_name, CASE WHEN v = 2 THEN NULL ELSE CONCAT('A', CAST(r_regionkey * 10 + v AS STRING)) END AS adv_id,
  TIMESTAMP '2024-01-01 12:00:00' + CAST(r_regionkey * 3 + v * 5 AS INT) * INTERVAL '1' DAY AS valid_from, CAST((r_regionkey + v) % 3 AS STRING) AS channel_type
FROM (SELECT *, 0 AS v FROM region UNION ALL SELECT *, 1 AS v FROM region UNION ALL SELECT *, 2 AS v FROM region UNION ALL SELECT *, 3 AS v FROM region) versions""",
    ),
}


def _render(text: str, dialect: dict[str, str]) -> str:
    out, rest = "", text
    while "{" in rest:
        head, rest = rest.split("{", 1)
        inner, rest = rest.split("}", 1)
        kind, arg = inner.split(":", 1)
        out += head + (COUNTRY if kind == "country" else dialect[kind]).format(arg)
    return out + rest


def _chain(names: tuple[str, ...]) -> list[str]:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in TABLES and name not in order:
            for dep in TABLES[name][0]:
                visit(dep)
            order.append(name)

    for n in names:
        visit(n)
    return order


def duck_with(*names: str) -> str:
    """WITH clause that defines the named tables for DuckDB."""
    return "WITH " + ",\n".join(f"{n} AS ({_render(TABLES[n][1], DUCK)})" for n in _chain(names))


_INSTANCES: dict[tuple[str, int, str], Testbed] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, int, str]:
    return spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/")


class Testbed:
    """Lazily built source tables: ``tb("impressions")``."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str, given: dict[str, DataFrame] | None = None):
        self.spark = pin_settings(use_scratch(spark))
        self.sf_dir = sf_dir.rstrip("/")
        self.given = given or {}
        self.table = functools.cache(self._table)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Testbed:
        """One instance per session and folder: queries share the table plans (not data)."""
        key = _key(spark, sf_dir)
        if key not in _INSTANCES:
            _INSTANCES[key] = cls(spark, sf_dir)
        pin_settings(spark)
        return _INSTANCES[key]

    def __call__(self, name: str) -> DataFrame:
        return self.table(name)

    def _table(self, name: str) -> DataFrame:
        if name in self.given:
            return self.given[name]
        if name not in TABLES:
            return scan_parquet(self.spark, f"{self.sf_dir}/{name}.parquet")
        deps, text = TABLES[name]
        if name == "ad_log" and "events" in self.given:
            text = text.replace("user_id, ts,", "user_id, CAST(ts AS TIMESTAMP) AS ts,", 1)
        rendered = _render(text, SPARK)
        views = {d: self.table(d) for d in deps}
        for dep in deps:
            rendered = rendered.replace(f"FROM {dep}", "FROM {" + dep + "}")
        return self.spark.sql(rendered, **views)
