"""Queries for single operators: predicates, functions, joins, windows, loads, exports, streams."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from adtally.functions import numbers, rules, slots, text
from adtally.operators import aggs, filters, joins, shape
from adtally.plans import counters, feeds, rollups, traffic
from adtally.session import scratch_path
from adtally.sinks import files, keyed, tables as sink
from adtally.sources import partner_csv, tables as source
from adtally.streaming import counters as streams
from testbed.registry import big, half_even, half_up, money, query, sum_units
from testbed.reports import (
    DAY, SETTLE_SQL, SETTLE_TABLES, TRAFFIC_TABLES, _top, _TOP, settlement_rows,
)
from testbed.tables import Testbed

# --- predicates and scalar functions ---------------------------------------------------

PREDICATES = {
    "at_slot": (lambda: F.col("time_slot") == "2024011510", "time_slot = '2024011510'"),
    "in_day": (lambda: F.col("time_slot").between(*slots.day_bounds("20240115")), "time_slot >= '2024011500' AND time_slot <= '2024011523'"),
    "since": (lambda: F.col("time_slot") >= "2024011500", "time_slot >= '2024011500'"),
    "like_day": (lambda: F.col("time_slot").startswith("20240115"), "time_slot LIKE '20240115%'"),
    "without_token": (lambda: rules.without_token("offer_pkg"), "offer_pkg NOT LIKE '%lazada%'"),
    "in_list": (lambda: rules.any_of("adtype", ["38", "39"]), "adtype IN ('38', '39')"),
    "not_in_list": (lambda: ~rules.any_of("adtype", ["19", "38"]), "adtype NOT IN ('19', '38')"),
    "non_empty": (lambda: rules.non_empty("country", "offer_pkg"), "country <> '' AND offer_pkg <> ''"),
    "not_home": (lambda: F.col("country") != "CN", "country <> 'CN'"),
    "text_order": (lambda: F.col("adtype") < "19", "adtype < '19'"),
    "attributable": (
        lambda: rules.attributable(),
        "((adtype < '19' OR adtype = '39') AND event_type = '2') OR (adtype >= '19' AND adtype <> '39' AND event_type = '1' "
        "AND offer_pkg <> 'com.alibaba.aliexpresshd') OR (offer_pkg = 'com.alibaba.aliexpresshd' AND event_type = '2')",
    ),
    "country_two": (lambda: rules.country_code(exact=2), "LENGTH(country) = 2"),
    "country_short": (lambda: rules.country_code(at_most=2), "LENGTH(country) <= 2"),
    "minute_of_hour": (lambda: F.minute("utctime") >= 55, "EXTRACT(minute FROM utctime) >= 55"),
    "since_minute": (lambda: slots.minute_slot("utctime") >= "202401151030", "strftime(utctime, '%Y%m%d%H%M') >= '202401151030'"),
    "event_day": (lambda: slots.event_day("utctime") == "20240115", "strftime(utctime, '%Y%m%d') = '20240115'"),
    "has_money": (lambda: rules.has_money("payout", "cost"), "payout <> 0 OR cost <> 0"),
    "settleable": (lambda: rules.settleable("country", "payout"), "country <> '' OR (country = '' AND payout = 0)"),
}

query(
    "predicate_counts",
    ("conversion_events",),
    f"SELECT {DAY} AS day, "
    + ", ".join(f"{big(f'SUM(CASE WHEN {sql} THEN 1 ELSE 0 END)')} AS {n}" for n, (_, sql) in PREDICATES.items())
    + " FROM conversion_events GROUP BY 1",
)(
    lambda t: t("conversion_events")
    .groupBy(slots.day_of("time_slot").alias("day"))
    .agg(*[numbers.count_where(test()).alias(n) for n, (test, _) in PREDICATES.items()])
)

_hour_earlier = "strftime(strptime(time_slot, '%Y%m%d%H') - INTERVAL 1 HOUR, '%Y%m%d%H')"
query(
    "scalar_functions",
    ("ad_log",),
    f"""SELECT event_id, SUBSTRING(time_slot, 1, 8) AS day, SUBSTRING(time_slot, 9, 2) AS hour, {_hour_earlier} AS hour_earlier,
  strftime(strptime(time_slot, '%Y%m%d%H') - INTERVAL 14 DAY, '%Y%m%d%H') AS fortnight_earlier, iso_day,
  REPLACE(iso_day, '-', '') AS compact_day, strftime(ts, '%Y%m%d%H%M') AS minute_slot, CAST(CAST(strptime(day, '%Y%m%d') AS DATE) AS VARCHAR) AS as_date,
  CAST(EXTRACT(hour FROM ts) AS INTEGER) AS hour_number, LOWER(platform) AS lowered, channel || '_' || offer AS packed,
  SPLIT_PART(channel || '_' || offer, '_', 2) AS second_part, SPLIT_PART(channel, '_', 2) AS absent_part,
  SPLIT_PART(channel || '_' || offer, '_', 1) AS first_part, SPLIT_PART(channel || '_' || offer, '_', -1) AS last_part,
  CONTAINS(pkg, 'app1') AS has_app1, LENGTH(country) AS country_length, COALESCE(NULLIF(country, ''), slot) AS blank_filled,
  CASE WHEN LENGTH(country) > 1 THEN country WHEN LENGTH(offer) > 1 THEN offer ELSE '' END AS usable,
  CASE WHEN LOWER(platform) = 'ios' THEN 2 ELSE 1 END AS platform_number,
  CASE platform WHEN 'ios' THEN NULL ELSE 'k' END AS maybe,
  {half_even('cost / 3e0', 2)} AS even2, {half_up('cost / 3e0', 3)} AS up3, CAST(TRUNC(cost / 0.9e0) AS BIGINT) AS truncated,
  CASE WHEN user_id = 0 THEN 0e0 ELSE cost / CAST(user_id AS DOUBLE) END AS guarded,
  CASE WHEN payout = 0 THEN NULL ELSE (cost - payout) / payout * 100e0 END AS pct,
  CASE WHEN adtype = '39' THEN SPLIT_PART(channel || '_' || offer, '_', 2) ELSE channel || '_' || offer END AS routed
FROM ad_log""",
)(
    lambda t: t("ad_log").select(
        "event_id",
        slots.day_of("time_slot").alias("day"),
        slots.hour_of("time_slot").alias("hour"),
        slots.shift_slot("time_slot", -1).alias("hour_earlier"),
        slots.shift_slot("time_slot", -14 * 24).alias("fortnight_earlier"),
        slots.iso_day("day").alias("iso_day"),
        slots.compact_day("iso_day").alias("compact_day"),
        slots.minute_slot("ts").alias("minute_slot"),
        slots.as_date("time_slot").cast("string").alias("as_date"),
        F.hour("ts").alias("hour_number"),
        F.lower("platform").alias("lowered"),
        text.pack("channel", "offer").alias("packed"),
        text.part(text.pack("channel", "offer"), 2).alias("second_part"),
        text.part("channel", 2).alias("absent_part"),
        text.first_part(text.pack("channel", "offer")).alias("first_part"),
        text.last_part(text.pack("channel", "offer")).alias("last_part"),
        text.contains_text(F.lit("app1"), "pkg").alias("has_app1"),
        F.length("country").cast("long").alias("country_length"),
        text.blank_to("country", "slot").alias("blank_filled"),
        text.first_usable("country", "offer").alias("usable"),
        rules.platform_number().alias("platform_number"),
        F.when(F.col("platform") != "ios", F.lit("k")).alias("maybe"),
        numbers.half_even(F.col("cost") / 3, 2).alias("even2"),
        numbers.half_up(F.col("cost") / 3, 3).alias("up3"),
        numbers.truncated(F.col("cost") / 0.9).alias("truncated"),
        numbers.ratio_or_zero("cost", "user_id").alias("guarded"),
        numbers.pct_change("cost", "payout").alias("pct"),
        rules.routed_offer("adtype", text.pack("channel", "offer")).alias("routed"),
    )
)

# --- joins, windows, set operations -----------------------------------------------------

query(
    "right_join_sums",
    ("impressions", "conversions"),
    f"""SELECT b.day, b.channel, b.country, a.shown, b.conv FROM
  (SELECT {DAY} AS day, channel, country, {big('SUM(count)')} AS shown FROM impressions GROUP BY ALL) a
  RIGHT JOIN (SELECT {DAY} AS day, channel, country, {big('SUM(count)')} AS conv FROM conversions GROUP BY ALL) b
  ON a.day = b.day AND a.channel = b.channel AND a.country = b.country""",
)(
    lambda t: joins.merge_sums(
        t("impressions").select(slots.day_of("time_slot").alias("day"), "channel", "country", F.col("count").alias("shown")),
        t("conversions").select(slots.day_of("time_slot").alias("day"), "channel", "country", F.col("count").alias("conv")),
        ["day", "channel", "country"],
        "right",
    )
)
query(
    "full_join_costs",
    ("conversion_events", "rejected"),
    f"""SELECT COALESCE(a.offer_id, b.offer_id) AS offer_id, COALESCE(a.cost, 0) AS cost, COALESCE(b.rejects, 0) AS rejects FROM
  (SELECT offer_id, {money('cost')} AS cost FROM conversion_events WHERE country <> 'US' GROUP BY 1) a
  FULL JOIN (SELECT offer_id, COUNT(*) AS rejects FROM rejected WHERE country <> 'IN' GROUP BY 1) b ON a.offer_id = b.offer_id""",
)(
    lambda t: joins.full_join(
        aggs.rollup(t("conversion_events").where("country != 'US'"), ["offer_id"], cost=numbers.sum_money("cost")),
        aggs.rollup(t("rejected").where("country != 'IN'"), ["offer_id"], rejects=F.count("*")),
        ["offer_id"],
    ).na.fill({"cost": 0.0, "rejects": 0})
)
query(
    "single_row_pairs",
    ("impressions", "clicks", "conversions"),
    f"""SELECT {big('(SELECT SUM(count) FROM impressions)')} AS shown, {big('(SELECT SUM(count) FROM clicks)')} AS clicked,
  (SELECT {money('payout')} FROM conversions) AS payout""",
)(
    lambda t: joins.pair_single_rows(
        t("impressions").agg(F.sum("count").alias("shown")),
        t("clicks").agg(F.sum("count").alias("clicked")),
        t("conversions").agg(numbers.sum_money("payout").alias("payout")),
    )
)
query(
    "listed_offer_events",
    ("conversion_events", "event_caps"),
    """SELECT offer_id, COUNT(*) AS events FROM conversion_events e WHERE event_type = '2'
  AND EXISTS (SELECT 1 FROM event_caps c WHERE c.offer_id = e.offer_id) GROUP BY 1""",
)(
    lambda t: joins.keep_listed(
        aggs.rollup(t("conversion_events").where("event_type = '2'"), ["offer_id"], events=F.count("*")),
        t("event_caps"),
        ["offer_id"],
    )
)
query(
    "clean_sites",
    ("conversion_events", "offers"),
    """SELECT offer_id, af_siteid, COUNT(*) AS n FROM conversion_events e WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT adv_offer, UNNEST(STRING_SPLIT(site_black_value, ',')) AS site FROM offers WHERE site_black_value <> '') b
  WHERE b.adv_offer = e.offer_id AND b.site = e.af_siteid) GROUP BY 1, 2""",
)(
    lambda t: joins.drop_listed(
        aggs.rollup(t("conversion_events"), ["offer_id", "af_siteid"], n=F.count("*")),
        feeds.blacklist(t("offers")),
        ["offer_id", "af_siteid"],
    )
)
query(
    "union_distinct_keys",
    ("impressions", "conversions"),
    f"SELECT {DAY} AS day, channel, offer FROM impressions UNION SELECT {DAY}, channel, offer FROM conversions",
)(
    lambda t: shape.union_distinct(
        *[t(n).select(slots.day_of("time_slot").alias("day"), "channel", "offer") for n in ("impressions", "conversions")]
    )
)
query("click_union", TRAFFIC_TABLES[:3], f"""SELECT {DAY} AS day, COUNT(*) AS n, {big('SUM(click)')} AS click, {big('SUM(imp)')} AS imp, MAX(pkg) AS pkg FROM (
  SELECT time_slot, offer_pkg AS pkg, clk_count AS click, imp_count AS imp FROM stream
  WHERE offer_id <> '' AND country <> '' AND channel <> '' AND offer_pkg NOT LIKE '%lazada%'
  UNION ALL SELECT time_slot, '', 1, 0 FROM routed WHERE click_through = '1' AND country <> '' AND channel <> '' AND offer_pkg NOT LIKE '%lazada%'
  UNION ALL SELECT time_slot, '', clk_count, 0 FROM synced WHERE country <> '' AND channel <> '' AND offer_pkg NOT LIKE '%lazada%') u GROUP BY 1""")(
    lambda t: aggs.rollup(
        traffic.click_union(*[t(n) for n in TRAFFIC_TABLES[:3]]).withColumn("day", slots.day_of("time_slot")),
        ["day"], n=F.count("*"), click=F.sum("click_all"), imp=F.sum("impression"), pkg=F.max("pkg"),
    )
)
query(
    "top_slots_per_channel",
    ("impressions",),
    """, s AS (SELECT channel, slot, CAST(SUM(count) AS BIGINT) AS shown FROM impressions GROUP BY 1, 2)
SELECT channel, slot, shown FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY channel ORDER BY shown DESC, slot) AS rn FROM s) x WHERE rn <= 3""",
)(
    lambda t: aggs.top_n_per_group(
        aggs.rollup(t("impressions"), ["channel", "slot"], shown=F.sum("count")),
        ["channel"], [F.desc("shown"), F.asc("slot")], 3,
    )
)
query(
    "slot_share",
    ("impressions",),
    """, s AS (SELECT slot, CAST(SUM(count) AS BIGINT) AS shown FROM impressions GROUP BY 1)
SELECT slot, shown, CAST(SUM(shown) OVER () AS BIGINT) AS all_shown, CAST(shown AS DOUBLE) / CAST(SUM(shown) OVER () AS DOUBLE) AS part FROM s""",
)(
    lambda t: aggs.share_of_total(
        aggs.rollup(t("impressions"), ["slot"], shown=F.sum("count")), {"all_shown": "shown"}
    ).withColumn("part", numbers.ratio("shown", "all_shown"))
)
query(
    "partition_share",
    ("conversion_events",),
    f""", g AS (SELECT {DAY} AS day, slot, country, offer_id, COUNT(*) AS n, {sum_units('payout')} AS paid_u FROM conversion_events GROUP BY ALL)
SELECT day, slot, country, offer_id, n, CAST(n AS DOUBLE) / CAST(SUM(n) OVER (PARTITION BY day, country) AS DOUBLE) AS rate,
  CAST(SUM(paid_u) OVER (PARTITION BY day, country) AS BIGINT) / 1e9 AS country_paid FROM g""",
)(
    lambda t: aggs.partition_total(
        aggs.rollup(
            t("conversion_events").withColumn("day", slots.day_of("time_slot")), ["day", "slot", "country", "offer_id"],
            n=F.count("*"), paid_u=F.sum(numbers.to_units("payout")),
        ),
        ["day", "country"], {"n_all": F.sum("n"), "paid_all": F.sum("paid_u")},
    ).select(
        "day", "slot", "country", "offer_id", "n", numbers.ratio("n", "n_all").alias("rate"),
        numbers.from_units("paid_all").alias("country_paid"),
    )
)
query(
    "recoded_platforms",
    ("conversion_events",),
    "SELECT CASE WHEN LOWER(platform) = 'ios' THEN 2 ELSE 1 END AS platform_code, COUNT(*) AS n FROM conversion_events GROUP BY 1",
)(
    lambda t: aggs.rollup(
        t("conversion_events").select(rules.platform_number().alias("platform_code")), ["platform_code"], n=F.count("*")
    )
)
query(
    "period_compare",
    ("impressions",),
    f""", h AS (SELECT time_slot, SUM(count) AS n FROM impressions GROUP BY 1),
k AS (SELECT *, strptime(time_slot, '%Y%m%d%H') AS at FROM h)
SELECT a.time_slot, {big('a.n')} AS current, {big('b.n')} AS hour_ago, {big('d.n')} AS day_ago FROM k a
LEFT JOIN k b ON b.at = a.at - INTERVAL 1 HOUR LEFT JOIN k d ON d.at = a.at - INTERVAL 1 DAY""",
)(lambda t: aggs.period_compare(t("impressions"), F.sum("count")))
query(
    "known_key_rollup",
    ("users", "apps"),
    """SELECT u.username, u.payee_code, COUNT(*) AS apps FROM users u LEFT JOIN apps a ON a.user_id = u.id
WHERE u.username IS NOT NULL AND u.payee_code IS NOT NULL GROUP BY 1, 2""",
)(
    lambda t: aggs.rollup_known_keys(
        joins.enrich(t("users"), (t("apps").select(F.col("user_id").alias("id"), F.col("id").alias("app_id")), ["id"])),
        ["username", "payee_code"], apps=F.count("*"),
    )
)
query(
    "sanitized_names",
    ("impressions",),
    "SELECT channel, CAST(SUM(count) AS BIGINT) AS sum_count_, MAX(slot) AS max_slot_ FROM impressions GROUP BY 1",
)(lambda t: source.scan_sanitized(t("impressions").groupBy("channel").agg(F.sum("count"), F.max("slot"))))


# --- one bucket, one day, one list: bounds that cut, taken from the data ------------------------


def _bound(t: Testbed, table: str, value) -> str:
    return t(table).agg(value).first()[0]


_LAST = "(SELECT MAX(time_slot) FROM conversion_events)"
_LAST_DAY = "(SELECT SUBSTRING(MAX(time_slot), 1, 8) FROM conversion_events)"
_LAST_TIME = "(SELECT MAX(utctime) FROM conversion_events)"
_BOUNDED = {
    "at_slot": f"time_slot = {_LAST}",
    "in_day": f"SUBSTRING(time_slot, 1, 8) = {_LAST_DAY}",
    "since": f"time_slot >= {_LAST_DAY} || '06'",
    "like_day": f"time_slot LIKE {_LAST_DAY} || '%'",
    "since_minute": f"strftime(utctime, '%Y%m%d%H%M') >= strftime({_LAST_TIME} - INTERVAL 90 MINUTE, '%Y%m%d%H%M')",
    "on_event_day": f"strftime(utctime, '%Y%m%d') = {_LAST_DAY}",
    "last_hours": f"utctime >= date_trunc('hour', {_LAST_TIME}) - INTERVAL 12 HOUR AND utctime < date_trunc('hour', {_LAST_TIME})",
    "listed_adtypes": "adtype IN ('38', '39')",
}


@query(
    "bounded_events",
    ("conversion_events",),
    " UNION ALL ".join(f"SELECT '{n}' AS bound, time_slot, utctime, channel, offer_id, payout FROM conversion_events WHERE {w}" for n, w in _BOUNDED.items()),
)
def _bounded(t: Testbed) -> DataFrame:
    """The rows that each kind of bound keeps."""
    events = t("conversion_events")
    last, end = events.agg(F.max("time_slot"), F.max("utctime")).first()
    day, hour = last[:8], end.replace(minute=0, second=0, microsecond=0)
    kept = {
        "at_slot": filters.at_slot(events, last),
        "in_day": filters.in_day(events, day),
        "since": filters.since(events, f"{day}06"),
        "like_day": filters.like_day(events, day),
        "since_minute": filters.since_minute(events, (end - timedelta(minutes=90)).strftime("%Y%m%d%H%M")),
        "on_event_day": filters.on_event_day(events, day),
        "last_hours": filters.last_hours(events, hour, 12, "utctime"),
        "listed_adtypes": filters.only(events, "adtype", counters.CAPPED_ADTYPES),
    }
    return shape.union_all(
        *[d.select(F.lit(n).alias("bound"), "time_slot", "utctime", "channel", "offer_id", "payout") for n, d in kept.items()], missing={}
    )


query(
    "last_day_postbacks",
    ("direct",),
    "SELECT pb_channel, pb_channel_id, offer, strftime(update_time, '%Y%m%d%H') AS time_slot, clk_id FROM direct WHERE pdate = (SELECT MAX(pdate) FROM direct)",
)(lambda t: feeds.forwarded_postbacks(t("direct"), pdate=_bound(t, "direct", F.max("pdate"))))
query(
    "one_busiest_slot",
    ("impressions",),
    "SELECT slot, CAST(SUM(count) AS BIGINT) AS shown FROM impressions GROUP BY slot ORDER BY 2 DESC, 1 LIMIT 1",
)(lambda t: aggs.head1(aggs.rollup(t("impressions"), ["slot"], shown=F.sum("count")).orderBy(F.desc("shown"), "slot")))
# --- loads and exports: written to the shared folder and read back ------------------------


def _table(t: Testbed, df: DataFrame, partition_by: tuple[str, ...] = ()) -> str:
    name = f"adtally_{uuid.uuid4().hex}"
    sink.create_table(df, name, partition_by, scratch_path(t.spark, "table"))
    return name


SLOT_CONV_SQL = f"SELECT {DAY} AS day, country, channel, offer, slot, {big('SUM(count)')} AS conv, {money('payout')} AS payout FROM conversions WHERE LENGTH(country) <= 2 GROUP BY ALL"


@query("append_load", ("conversions",), f"SELECT * FROM ({SLOT_CONV_SQL}) UNION ALL SELECT * FROM ({SLOT_CONV_SQL})")
def _append(t: Testbed) -> DataFrame:
    rows = rollups.offer_slot_conv(t("conversions"))
    table = _table(t, rows)
    sink.append(rows, table)
    sink.append(rows, table)
    return t.spark.table(table)


@query("replace_partition_load", ("conversions",), SLOT_CONV_SQL)
def _replace(t: Testbed) -> DataFrame:
    """A wrong first load, then the right one, then a rerun of its second half."""
    rows = rollups.offer_slot_conv(t("conversions"))
    table = _table(t, rows, ("day",))
    sink.replace_partition(rows.withColumn("conv", F.col("conv") + 1), table)
    sink.replace_partition(rows, table)
    streams.recompute_trailing(
        lambda first, last: rollups.offer_slot_conv(t("conversions"), first, last), table, "2024011500", "2024013023", grain="day",
    )
    return t.spark.table(table)


@query("refresh_load", ("conversions",), SLOT_CONV_SQL)
def _refresh(t: Testbed) -> DataFrame:
    rows = rollups.offer_slot_conv(t("conversions"))
    table = _table(t, rows, ("day",))
    sink.append(rows, table)
    sink.refresh(rows, table)
    return t.spark.table(table)


@query("expire_partitions", ("conversions",), f"SELECT * FROM ({SLOT_CONV_SQL}) WHERE day NOT LIKE '2024010%'")
def _expire(t: Testbed) -> DataFrame:
    rows = rollups.offer_slot_conv(t("conversions"))
    table = _table(t, rows, ("day",))
    sink.replace_partition(rows, table)
    sink.expire(t.spark, table, "day", "2024010")
    return t.spark.table(table)


@query("clear_tables", ("conversions",), SLOT_CONV_SQL)
def _clear(t: Testbed) -> DataFrame:
    """Two of three tables are emptied; what is left in all of them is the third."""
    rows = rollups.offer_slot_conv(t("conversions"))
    tables = [_table(t, rows), _table(t, rows), _table(t, rows, ("day",))]
    for table in tables:
        sink.append(rows, table)
    sink.clear(t.spark, tables[1:])
    return shape.union_all(*[t.spark.table(x) for x in tables], missing={})


_COUNTS = f"SELECT {DAY} || '_' || routed_offer || '_' || slot AS key, CAST(COUNT(*) AS VARCHAR) AS value FROM routed WHERE click_through = '1' GROUP BY 1"


@query(
    "kv_upsert",
    ("routed",),
    f""", fresh AS ({_COUNTS}), old AS (SELECT DISTINCT {DAY} || '_' || routed_offer || '_' || slot AS key FROM routed)
SELECT old.key, COALESCE(fresh.value, '0') AS value FROM old LEFT JOIN fresh ON old.key = fresh.key""",
)
def _upsert(t: Testbed) -> DataFrame:
    path = scratch_path(t.spark, "kv")
    every = t("routed").select(text.pack(slots.day_of("time_slot"), "routed_offer", "slot").alias("key")).distinct()
    every.withColumn("value", F.lit("0")).write.parquet(path)
    counts = counters.click_counters(t("routed"), slots=None)
    fresh = keyed.snapshot_kv(counts, F.col("value"), "day", F.col("key"))
    keyed.upsert_kv(t.spark, fresh, path)
    keyed.upsert_kv(t.spark, fresh, path)
    return t.spark.read.parquet(path)


@query(
    "row_replace",
    ("redirects", "stored_domains"),
    f"""{_TOP} SELECT COALESCE(t.channel, s.channel) AS channel, COALESCE(t.offer_id, s.offer_id) AS offer_id, COALESCE(t.domain_tag, s.domain_tag) AS domain_tag
FROM stored_domains s FULL JOIN top t ON s.channel = t.channel AND s.offer_id = t.offer_id""",
)
def _row_replace(t: Testbed) -> DataFrame:
    path = scratch_path(t.spark, "domains")
    t("stored_domains").write.parquet(path)
    keyed.replace_rows(t.spark, _top(t), path, ["channel", "offer_id"])
    return t.spark.read.parquet(path)


@query(
    "counter_snapshot",
    ("conversions", "affiliates"),
    """, conv AS (SELECT channel, offer, slot, SUM(count) AS conv FROM conversions GROUP BY ALL),
aff AS (SELECT id, ssp_offer_id AS offer, channel, MIN(slot) AS slot FROM affiliates GROUP BY 1, 2, 3)
SELECT id || '_cap' AS key, CAST(CAST(conv AS BIGINT) AS VARCHAR) AS value FROM conv JOIN aff USING (offer, slot, channel)""",
)
def _snapshot(t: Testbed) -> DataFrame:
    rows = counters.affiliate_cap_counters(t("conversions"), t("affiliates"), since=None)
    return keyed.snapshot_kv(rows, F.col("value"), "key")


@query(
    "csv_export",
    ("af_installs",),
    "SELECT id, channel, offer, site, strftime(install_time, '%Y-%m-%d %H:%M:%S.%f') AS install_time, strftime(install_time, '%Y%m%d%H') AS time_slot FROM af_installs",
)
def _csv(t: Testbed) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    rows = feeds.install_day(t("af_installs")).withColumn("install_time", F.date_format("install_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    files.export_csv(rows, path)
    schema = "id long, channel string, offer string, site string, install_time string, time_slot string"
    return t.spark.read.schema(schema).csv(path)


@query("tsv_export", ("impressions",), "SELECT time_slot, slot, country, CAST(SUM(count) AS BIGINT) AS c FROM impressions WHERE visible = '0' GROUP BY ALL")
def _tsv(t: Testbed) -> DataFrame:
    path = scratch_path(t.spark, "tsv")
    files.export_tsv(rollups.slot_all_clicks(t("impressions")), path)
    schema = "time_slot string, slot string, country string, c long"
    return t.spark.read.schema(schema).option("sep", "\t").option("nullValue", "\\N").csv(path).na.fill("", ["country"])


_SETTLE_FIELDS = (
    "offer_id offer_type adv_id contract_code payee_code supplier_id traffic country created type adv_currency revenue t1 t2 "
    "payout_currency cost t3 t4"
).split()


def _settle_select() -> str:
    fields = ", ".join(f"CAST({c} AS VARCHAR)" for c in _SETTLE_FIELDS)
    head, tail = SETTLE_SQL.rsplit("SELECT a.channel AS offer_id", 1)
    return f"{head}, settled AS (SELECT a.channel AS offer_id{tail}) SELECT CONCAT_WS(CHR(1), {fields}) AS value FROM settled"


def _settlement_file(t: Testbed) -> str:
    path = scratch_path(t.spark, "settlement")
    files.export_settlement(settlement_rows(t), path)
    return path


@query("settlement_file", SETTLE_TABLES, _settle_select())
def _settle_lines(t: Testbed) -> DataFrame:
    return t.spark.read.option("lineSep", "\r\n").text(_settlement_file(t))


@query(
    "export_manifest",
    ("impressions",),
    f"""SELECT 'day=' || day AS file, md5(string_agg(line, CHR(10) ORDER BY line) || CHR(10)) AS md5 FROM (
  SELECT {DAY} AS day, time_slot || ',' || slot || ',' || country || ',' || CAST(CAST(SUM(count) AS BIGINT) AS VARCHAR) AS line
  FROM impressions WHERE visible = '0' GROUP BY time_slot, slot, country) GROUP BY day""",
)
def _manifest(t: Testbed) -> DataFrame:
    path = scratch_path(t.spark, "daily-lines")
    line = F.concat_ws(",", "time_slot", "slot", "country", F.col("c").cast("string"))
    files.export_daily_lines(rollups.slot_all_clicks(t("impressions")).select(slots.day_of("time_slot").alias("day"), line.alias("value")), path)
    return files.export_manifest(t.spark, path, "*.txt", by_folder=True)


@query(
    "partner_report",
    ("partner_lines",),
    f"""SELECT iso_day AS date, '6' AS channel_type, CASE WHEN platform = 'Android' THEN '1' ELSE '2' END AS platform, channel, country, pkg,
  {big('SUM(cnt % 2)')} AS conversion, {money('cnt * 0.5e0')} AS revenue, {money('cnt * 0.25e0')} AS cost, {big('SUM(cnt)')} AS click, CAST(0 AS BIGINT) AS install
FROM partner_lines WHERE event_id % 10 <> 0 GROUP BY 1, 2, 3, 4, 5, 6""",
)
def _partner(t: Testbed) -> DataFrame:
    path = scratch_path(t.spark, "partner")
    header = t.spark.createDataFrame([("day,country,platform,pkg,x,channel,imp,click,conversion,revenue,cost,y",)], "value string")
    t("partner_lines").select("value").unionByName(header).write.text(path)
    return feeds.partner_report(partner_csv.read_partner_csv(t.spark, path))


@query(
    "registered_partitions",
    ("direct",),
    "SELECT pb_channel, pb_channel_id, offer, strftime(update_time, '%Y%m%d%H') AS time_slot, clk_id FROM direct",
)
def _registered(t: Testbed) -> DataFrame:
    """Partitions written by another job become visible when they are registered."""
    path = scratch_path(t.spark, "direct")
    t("direct").hint("rebalance", "pdate").write.partitionBy("pdate").parquet(path)
    table = _table(t, t("direct"), ("pdate",))
    for day in [r.pdate for r in t("direct").select("pdate").distinct().collect()]:
        source.add_partition(t.spark, table, "pdate", day, f"{path}/pdate={day}")
    return feeds.forwarded_postbacks(t.spark.table(table))


# --- streams ---------------------------------------------------------------------------------


SLICES = 5
FILE_BYTES = 64 << 20


def _stored_bytes(spark: SparkSession, path: str) -> int:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def _event_stream(spark: SparkSession, sf_dir: str, events: DataFrame | None = None, by: str = "ts", slices: int = SLICES) -> DataFrame:
    """All events as files that arrive one slice after the other, a slice's files per trigger, in the order of ``by``.

    Every slice has the same number of files, taken from the bytes of the table, so that no trigger mixes slices: rows of a
    slice that were read after those of the next would be late.
    """
    source = f"{sf_dir}/events.parquet"
    events = spark.read.parquet(source) if events is None else events
    at = F.col(by).cast("timestamp")
    low, high = events.agg(F.min(at), F.max(at)).first()
    path, step = scratch_path(spark, "arriving"), (high - low) / slices
    inside = [
        (at >= F.lit(low + k * step)) & (at < F.lit(low + (k + 1) * step)) if k < slices - 1 else at >= F.lit(low + k * step)
        for k in range(slices)
    ]
    dealt = events.withColumn("part", F.spark_partition_id())
    parts, *sizes = dealt.agg(F.count_distinct("part"), *[F.count_if(x) for x in inside]).first()
    n = max(2, -(-_stored_bytes(spark, source) // (slices * FILE_BYTES)))
    # rows are dealt in turn from each input part, so some part with a row for every file leaves no file out
    n = n if min(sizes) >= n * parts else 1
    for x in inside:
        events.where(x).repartition(n).write.mode("append").parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", n).parquet(path)


def _streamed(t: Testbed) -> Testbed:
    return Testbed(t.spark, t.sf_dir, {"events": _event_stream(t.spark, t.sf_dir)})


def _closed_windows(t: Testbed, windows: DataFrame) -> DataFrame:
    stored = windows.withColumn("day", F.lit("")).withColumn("batch", F.lit(""))
    table = _table(t, t.spark.createDataFrame([], stored.schema), ("day", "batch"))
    streams.run_closed_windows(windows, table, scratch_path(t.spark, "stream")).awaitTermination()
    return t.spark.table(table).select(*windows.columns)


def _bucket(minutes: int) -> str:
    return f"time_bucket(INTERVAL {minutes} MINUTE, utctime)"


def _closed(minutes: int, late: str, where: str = "TRUE") -> str:
    """The watermark is the latest event the aggregate sees, less the allowed lateness."""
    return (
        f"{where} AND {_bucket(minutes)} + INTERVAL {minutes} MINUTE <= "
        f"(SELECT date_trunc('milliseconds', MAX(utctime)) - INTERVAL {late} FROM conversion_events WHERE {where})"
    )


query(
    "stream_hourly_conversions",
    ("conversion_events",),
    f"""SELECT time_slot, offer_id, country, channel, {big("SUM(CASE WHEN event_type = '1' THEN 1 ELSE 0 END)")} AS install,
  {big("SUM(CASE WHEN event_type = '2' THEN 1 ELSE 0 END)")} AS conv, {money('payout')} AS revenue, {money('cost')} AS cost
FROM conversion_events WHERE {_closed(60, '2 HOUR')} GROUP BY 1, 2, 3, 4""",
)(lambda t: _closed_windows(t, streams.hourly_conversions(_streamed(t)("conversion_events"))))
query(
    "stream_install_windows",
    ("conversion_events",),
    f"""SELECT strftime({_bucket(10)}, '%Y%m%d%H%M') AS minute_slot, offer_id, af_siteid, COUNT(*) AS install FROM conversion_events
WHERE {_closed(10, '10 MINUTE', "event_type = '1'")} GROUP BY 1, 2, 3""",
)(lambda t: _closed_windows(t, streams.install_windows(_streamed(t)("conversion_events"))))
query(
    "stream_pacing_windows",
    ("conversion_events",),
    f"""SELECT strftime({_bucket(5)}, '%Y%m%d%H%M') AS minute_slot, channel, offer_id, COUNT(*) AS conv FROM conversion_events
WHERE {_closed(5, '5 MINUTE', "event_type <> '1' AND adtype NOT IN ('19', '38')")} GROUP BY 1, 2, 3""",
)(lambda t: _closed_windows(t, streams.pacing_windows(_streamed(t)("conversion_events"))))


@query(
    "stream_daily_clicks",
    ("routed",),
    f"SELECT {DAY} AS day, routed_offer || '_' || slot AS key, CAST(COUNT(*) AS VARCHAR) AS value FROM routed WHERE click_through = '1' GROUP BY 1, 2",
)
def _daily(t: Testbed) -> DataFrame:
    path = scratch_path(t.spark, "daily")
    counts = streams.daily_clicks(_streamed(t)("routed"))
    empty = t.spark.createDataFrame([], counts.schema)
    empty.write.partitionBy("day").parquet(path)
    streams.run_cumulative(counts, path, scratch_path(t.spark, "stream")).awaitTermination()
    return t.spark.read.schema(empty.schema).parquet(path).select("day", "key", "value")
