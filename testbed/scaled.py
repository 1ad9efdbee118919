"""Queries for joins and sums that have to hold for hot keys, changing dimensions, overlapping windows and repeated merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from adtally.functions import rules, slots, text
from adtally.functions.numbers import count_where, from_units, to_units
from adtally.operators import apportion, asof, bitmaps, panes, skew
from adtally.operators.joins import attach_total
from adtally.plans import counters, money as money_plans, rollups
from adtally.session import materialize, scratch_path
from adtally.sinks import buckets, checksums, files, keyed
from adtally.sources import documents, ledger, partner_csv
from adtally.streaming import corrections
from adtally.streaming.counters import run_closed_windows
from adtally.streaming.look_backs import pane_stream, run_look_backs, stored_look_backs
from testbed.operators import _COUNTS, _event_stream, _streamed, _table
from testbed.registry import big, money, query, sum_units
from testbed.reports import _OWNED, ALLOC_TABLES, DAY, _allocation
from testbed.tables import Testbed

# --- full outer joins of raw rows ---------------------------------------------------------


def _conversion_sums(t: Testbed) -> DataFrame:
    return t("conversions").groupBy("channel", "country").agg(F.sum("count").alias("conv"), F.min("time_slot").alias("since"))


_SUMS = "SELECT channel, country, CAST(SUM(count) AS BIGINT) AS conv, MIN(time_slot) AS since FROM conversions GROUP BY 1, 2"
_CLICK_ROWS = "SELECT channel, country, time_slot, slot, CAST(count AS BIGINT) AS clicks FROM clicks WHERE offer < '5'"


def _click_rows(t: Testbed) -> DataFrame:
    return t("clicks").where("offer < '5'").select("channel", "country", "time_slot", "slot", F.col("count").cast("long").alias("clicks"))


@query(
    "raw_full_join",
    ("clicks", "conversions"),
    f"""SELECT COALESCE(c.channel, s.channel) AS channel, COALESCE(c.country, s.country) AS country, time_slot, slot, clicks, conv, since
FROM ({_CLICK_ROWS}) c FULL JOIN ({_SUMS}) s ON c.channel = s.channel AND c.country = s.country""",
)
def _raw_full(t: Testbed) -> DataFrame:
    """Raw clicks and the sums of their channel and country: a seventh of all rows on each of few keys."""
    return skew.salted_full_join(_click_rows(t), _conversion_sums(t), ["channel", "country"])


@query(
    "raw_full_join_since",
    ("clicks", "conversions"),
    f"""SELECT COALESCE(c.channel, s.channel) AS channel, COALESCE(c.country, s.country) AS country, time_slot, slot, clicks, conv, since
FROM ({_CLICK_ROWS}) c FULL JOIN ({_SUMS}) s ON c.channel = s.channel AND c.country = s.country AND c.time_slot < s.since""",
)
def _raw_full_since(t: Testbed) -> DataFrame:
    """Clicks before the first conversion of their channel and country; most sums match no click and are kept once."""
    return skew.salted_full_join(_click_rows(t), _conversion_sums(t), ["channel", "country"], also="l.time_slot < r.since")


@query(
    "raw_full_chain",
    ("clicks", "conversions", "rejected"),
    f"""SELECT COALESCE(c.channel, s.channel, r.channel) AS channel, COALESCE(c.country, s.country, r.country) AS country, time_slot, slot, clicks, conv, since, rejects
FROM ({_CLICK_ROWS}) c FULL JOIN ({_SUMS}) s ON c.channel = s.channel AND c.country = s.country
FULL JOIN (SELECT channel, country, COUNT(*) AS rejects FROM rejected GROUP BY 1, 2) r
  ON COALESCE(c.channel, s.channel) = r.channel AND COALESCE(c.country, s.country) = r.country""",
)
def _raw_chain(t: Testbed) -> DataFrame:
    keys = ["channel", "country"]
    joined = materialize(skew.salted_full_join(_click_rows(t), _conversion_sums(t), keys), "joined")
    return skew.salted_full_join(joined, t("rejected").groupBy(*keys).agg(F.count("*").alias("rejects")), keys)


# --- dimensions as they were ----------------------------------------------------------------


_MET = "ON CAST(a.user_id AS BIGINT) = u.id AND strptime(a.day, '%Y%m%d') >= u.valid_from"


@query(
    "profit_backfill_asof",
    (*ALLOC_TABLES, "user_versions", "network_versions"),
    f"""{_OWNED}
SELECT a.day AS date, a.adtype, a.slot, a.country, CAST(a.user_id AS BIGINT) AS user_id, n.channel_type, u.username AS user_name,
  u.email AS account_email, {money('a.revenue')} AS revenue, {money('a.cost')} AS cost
FROM alloc_report a ASOF LEFT JOIN user_versions u {_MET}
ASOF LEFT JOIN network_versions n ON a.channel = n.short_name AND strptime(a.day, '%Y%m%d') >= n.valid_from
WHERE (a.revenue <> 0 OR a.cost <> 0) AND a.user_id IS NOT NULL AND n.channel_type IS NOT NULL AND u.username IS NOT NULL AND u.email IS NOT NULL
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""",
)
def _profit_asof(t: Testbed) -> DataFrame:
    return money_plans.profit_rollup(_allocation(t), t("user_versions"), t("network_versions"), hide_dashed_countries=False)


@query(
    "conversions_asof",
    ("conversion_events", "network_versions"),
    f"""SELECT {DAY} AS day, e.channel, n.channel_type AS then_type, n.adv_id, {big("SUM(CASE WHEN event_type = '1' THEN 1 ELSE 0 END)")} AS install,
  {big("SUM(CASE WHEN event_type <> '1' THEN 1 ELSE 0 END)")} AS conv, {money('payout')} AS revenue
FROM conversion_events e ASOF LEFT JOIN network_versions n ON e.channel = n.short_name AND e.utctime >= n.valid_from GROUP BY 1, 2, 3, 4""",
)
def _conversions_asof(t: Testbed) -> DataFrame:
    """Every raw conversion with the network as it was at that instant; a seventh of the rows on each channel."""
    events = t("conversion_events").select("time_slot", "utctime", "channel", "event_type", "payout")
    met = asof.asof_join(events, t("network_versions").withColumnsRenamed({"short_name": "channel", "channel_type": "then_type"}), ["channel"], "utctime")
    return met.groupBy(slots.day_of("time_slot").alias("day"), "channel", "then_type", "adv_id").agg(
        count_where(F.col("event_type") == rules.INSTALL).alias("install"),
        count_where(F.col("event_type") != rules.INSTALL).alias("conv"),
        from_units(F.sum(to_units("payout"))).alias("revenue"),
    )


# --- overlapping look-backs ------------------------------------------------------------------

LOOK_BACKS = (5, 10)
_PACED = "event_type <> '1' AND adtype NOT IN ('19', '38')"
_PANES = f"""SELECT channel, offer_id, time_bucket(INTERVAL 1 MINUTE, utctime) AS pane, COUNT(*) AS conv, {sum_units('payout')} AS payout_units
  FROM conversion_events WHERE {_PACED} GROUP BY 1, 2, 3"""


def _look_back_sql(where: str = "TRUE") -> str:
    return f"""SELECT channel, offer_id, size, as_of, {big('SUM(conv)')} AS conv, {big('SUM(payout_units)')} AS payout_units FROM (
  SELECT p.*, size, unnest(generate_series(pane + INTERVAL 1 MINUTE, pane + size * INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS as_of
  FROM ({_PANES}) p, (VALUES {', '.join(f'({s})' for s in LOOK_BACKS)}) sizes(size)) WHERE {where} GROUP BY 1, 2, 3, 4"""


def paced(events: DataFrame) -> DataFrame:
    return events.where((F.col("event_type") != rules.INSTALL) & ~F.col("adtype").isin("19", "38"))


@query("look_back_minutes", ("conversion_events",), _look_back_sql())
def _look_backs(t: Testbed) -> DataFrame:
    """Events of the last five and of the last ten minutes, at every minute."""
    keys = ["channel", "offer_id"]
    sums = panes.pane_sums(paced(t("conversion_events")), keys, "utctime", conv=F.count("*"), payout_units=F.sum(to_units("payout")))
    return panes.as_of(panes.look_backs(sums, keys, LOOK_BACKS))


_CLOSED = f"(SELECT date_trunc('milliseconds', MAX(utctime)) - INTERVAL 5 MINUTE FROM conversion_events WHERE {_PACED})"


@query(
    "stream_look_backs",
    ("conversion_events",),
    f""", closed AS (SELECT MAX(time_bucket(INTERVAL 1 MINUTE, utctime)) AS minute FROM conversion_events
  WHERE {_PACED} AND time_bucket(INTERVAL 1 MINUTE, utctime) + INTERVAL 1 MINUTE <= {_CLOSED})
{_look_back_sql("pane <= (SELECT minute FROM closed) AND as_of <= (SELECT minute FROM closed) + INTERVAL 1 MINUTE")}""",
)
def _stream_look_backs(t: Testbed) -> DataFrame:
    """The same from a stream in several batches, up to the last closed minute."""
    keys = ["channel", "offer_id"]
    events = paced(_streamed(t)("conversion_events"))
    closed = pane_stream(events, "utctime", keys, "5 minutes", conv=F.count("*"), payout_units=F.sum(to_units("payout")))
    path = scratch_path(t.spark, "look-backs")
    run_look_backs(closed, keys, LOOK_BACKS, path, scratch_path(t.spark, "stream")).awaitTermination()
    return stored_look_backs(closed, keys, path)


# --- late corrections -------------------------------------------------------------------------

LATE_HOURS, HORIZON_HOURS, GRACE_MINUTES, ARRIVALS = 240, 264, 10, 8


def shuffled_stream(t: Testbed) -> Testbed:
    """The events as files that arrive in several batches, every seventh event ten days late, after its hour has been sent."""
    events = t.spark.read.parquet(f"{t.sf_dir}/events.parquet")
    arrival = F.col("ts") + F.make_dt_interval(hours=F.when(F.col("event_id") % 7 == 3, F.lit(LATE_HOURS)).otherwise(F.lit(0)))
    stream = _event_stream(t.spark, t.sf_dir, events.withColumn("arrival", arrival), "arrival", ARRIVALS)
    return Testbed(t.spark, t.sf_dir, {"events": stream.drop("arrival")})


def run_corrections(t: Testbed, stream: DataFrame) -> tuple[DataFrame, StreamingQuery]:
    """The terms that a stream of conversions sends, in a table of batches."""
    sums = {
        "install": (F.col("event_type") == rules.INSTALL).cast("long"), "conv": (F.col("event_type") != rules.INSTALL).cast("long"),
        "payout_units": to_units("payout"),
    }
    terms = corrections.hourly_corrections(stream, "utctime", ["channel"], GRACE_MINUTES, HORIZON_HOURS, salts=2, **sums)
    terms = terms.withColumn("time_slot", slots.slot_of("hour"))
    stored = terms.withColumn("day", F.lit("")).withColumn("batch", F.lit(""))
    table = _table(t, t.spark.createDataFrame([], stored.schema), ("day", "batch"))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = t.spark.conf.get(provider)
    t.spark.conf.set(provider, corrections.ROCKSDB)
    try:
        run = run_closed_windows(terms, table, scratch_path(t.spark, "stream"))
        run.awaitTermination()
    finally:
        t.spark.conf.set(provider, before)
    return t.spark.table(table), run


@query(
    "stream_corrections",
    ("conversion_events",),
    f"""SELECT channel, date_trunc('hour', utctime) AS hour, {big("SUM(CASE WHEN event_type = '1' THEN 1 ELSE 0 END)")} AS install,
  {big("SUM(CASE WHEN event_type <> '1' THEN 1 ELSE 0 END)")} AS conv, {sum_units('payout')} AS payout_units
FROM conversion_events WHERE date_trunc('hour', utctime) + INTERVAL {60 + GRACE_MINUTES} MINUTE
  <= (SELECT date_trunc('milliseconds', MAX(utctime)) FROM conversion_events) GROUP BY 1, 2""",
)
def _corrections(t: Testbed) -> DataFrame:
    """First sums and corrections of a stream with late events add up to the batch report of all ended hours."""
    terms, _ = run_corrections(t, shuffled_stream(t)("conversion_events"))
    return corrections.summed(terms, ["channel"], ["install", "conv", "payout_units"])


# --- distinct counts from stored bitmaps -----------------------------------------------------


def stored_bitmaps(t: Testbed) -> DataFrame:
    """Bitmaps of the offers clicked per channel and hour, stored by day."""
    clicks = t("clicks").select("channel", "time_slot", "offer")
    numbers = materialize(bitmaps.dense_numbers(clicks, "offer"), "offer-numbers")
    hourly = bitmaps.distinct_bitmaps(clicks.join(numbers, "offer"), ["channel", "time_slot"])
    path = scratch_path(t.spark, "bitmaps")
    hourly.withColumn("day", slots.day_of("time_slot")).write.partitionBy("day").parquet(path)
    return t.spark.read.schema("channel string, time_slot string, bucket long, bitmap binary, day string").parquet(path)


@query(
    "distinct_offers",
    ("clicks",),
    f"""SELECT 'day' AS span, channel, CAST(strptime({DAY}, '%Y%m%d') AS DATE) AS upto, COUNT(DISTINCT offer) AS offers FROM clicks GROUP BY 2, 3
UNION ALL SELECT 'week', channel, CAST(date_trunc('week', strptime({DAY}, '%Y%m%d')) AS DATE), COUNT(DISTINCT offer) FROM clicks GROUP BY 2, 3
UNION ALL SELECT 'trailing', d.channel, d.upto, COUNT(DISTINCT c.offer) FROM (SELECT DISTINCT channel, CAST(strptime({DAY}, '%Y%m%d') AS DATE) AS upto FROM clicks) d
  JOIN clicks c ON c.channel IS NOT DISTINCT FROM d.channel AND CAST(strptime(SUBSTRING(c.time_slot, 1, 8), '%Y%m%d') AS DATE) BETWEEN d.upto - INTERVAL 6 DAY AND d.upto GROUP BY 2, 3""",
)
def _distinct_offers(t: Testbed) -> DataFrame:
    """Offers with clicks per channel: each day, each week, and the seven days up to each day."""
    return distinct_spans(stored_bitmaps(t))


def distinct_spans(hourly: DataFrame) -> DataFrame:
    """Counts of all spans from hourly bitmaps alone."""
    daily = bitmaps.merged(hourly, ["channel", F.to_date("day", slots.DAY).alias("upto")])
    week = bitmaps.counted(daily, ["channel", F.date_trunc("week", "upto").cast("date").alias("upto")], "offers")
    parts = {
        "day": bitmaps.counted(daily, ["channel", "upto"], "offers"),
        "week": week,
        "trailing": bitmaps.trailing_counts(daily, ["channel"], "upto", 7, "offers"),
    }
    named = [df.select(F.lit(span).alias("span"), "channel", "upto", "offers") for span, df in parts.items()]
    return named[0].unionAll(named[1]).unionAll(named[2])


# --- documents without a fixed schema ----------------------------------------------------------

CONTRACT_FIELDS = [
    documents.Field("code", "$.code", "string", required=True), documents.Field("currency", "$.data.currency", "string"),
    documents.Field("amount", "$.data.amount", "double"),
]
_DOCS = """, docs AS (SELECT id, text, json_valid(text) AS ok, CASE WHEN json_valid(text) THEN text END AS j FROM contract_texts),
told AS (SELECT *, j->>'$.code' AS code, j->>'$.data.currency' AS currency, TRY_CAST(j->>'$.data.amount' AS DOUBLE) AS amount,
  CASE WHEN NOT ok THEN 'unreadable' ELSE NULLIF(CONCAT_WS('; ',
    CASE WHEN j->>'$.data.amount' IS NOT NULL AND TRY_CAST(j->>'$.data.amount' AS DOUBLE) IS NULL THEN 'drifted: amount' END,
    CASE WHEN j->>'$.code' IS NULL THEN 'missing: code' END), '') END AS reason FROM docs)"""
CAP_FIELDS = [documents.Field("pub_status", "$.pub_status", "long", required=True), documents.Field("cap_daily", "$.cap_daily", "long", required=True)]
_CAPS = """, texts AS (SELECT offer_id, REPLACE(REPLACE(traffic, CHR(39), CHR(34)), 'None', 'null') AS text FROM offers),
listed AS (SELECT offer_id, text, json_valid(text) AS ok, CASE WHEN json_valid(text) THEN text::JSON END AS j FROM texts),
entries AS (SELECT offer_id, unnest(range(CAST(json_array_length(j) AS BIGINT))) AS entry, unnest(CAST(j AS JSON[])) AS e FROM listed WHERE ok),
told AS (SELECT offer_id, CAST(entry AS INTEGER) AS entry, CAST(e->>'$.pub_status' AS BIGINT) AS pub_status, CAST(e->>'$.cap_daily' AS BIGINT) AS cap_daily,
  CASE WHEN e->>'$.cap_daily' IS NULL THEN 'missing: cap_daily' END AS reason FROM entries)"""


def contract_documents(t: Testbed) -> tuple[DataFrame, DataFrame]:
    return documents.read_documents(t("contract_texts"), "text", CONTRACT_FIELDS)


def cap_entries(t: Testbed) -> tuple[DataFrame, DataFrame]:
    texts = t("offers").select("offer_id", documents.literal_json(F.col("traffic")).alias("text"))
    return documents.read_entries(texts, "text", "$", CAP_FIELDS)


query("contract_documents", ("contract_texts",), f"{_DOCS} SELECT id, code, currency, amount FROM told WHERE reason IS NULL")(lambda t: contract_documents(t)[0])
query("contract_documents_rejected", ("contract_texts",), f"{_DOCS} SELECT id, text, reason FROM told WHERE reason IS NOT NULL")(lambda t: contract_documents(t)[1])
query("cap_entries", ("offers",), f"{_CAPS} SELECT offer_id, entry, pub_status, cap_daily FROM told WHERE reason IS NULL")(lambda t: cap_entries(t)[0])
query(
    "cap_entries_rejected",
    ("offers",),
    f"""{_CAPS} SELECT offer_id, entry, reason FROM told WHERE reason IS NOT NULL
UNION ALL SELECT offer_id, NULL, 'unreadable' FROM listed WHERE NOT ok""",
)(lambda t: cap_entries(t)[1].drop("text"))

# --- ledger of input files -----------------------------------------------------------------------


@query(
    "ledger_loads",
    ("partner_lines",),
    """SELECT CASE WHEN iso_day <= '2024-01-10' THEN 'first' WHEN iso_day <= '2024-01-20' THEN 'second' ELSE 'third' END AS load,
  iso_day AS date, COUNT(*) AS lines, CAST(SUM(cnt) AS BIGINT) AS click FROM partner_lines WHERE event_id % 10 <> 0 GROUP BY 1, 2""",
)
def _ledger(t: Testbed) -> DataFrame:
    """Four runs over a folder to which files are added three times; each file is taken once."""
    root = scratch_path(t.spark, "ledger")
    lines = t("partner_lines").select("value", "iso_day")
    bounds = [("first", "", "2024-01-10"), ("second", "2024-01-10", "2024-01-20"), ("third", "2024-01-20", "9999")]
    for load, low, high in bounds:
        days = lines.where((F.col("iso_day") > low) & (F.col("iso_day") <= high)).hint("rebalance", "iso_day")
        days.withColumn("load", F.lit(load)).write.mode("append").partitionBy("load", "iso_day").text(f"{root}/in")
        for name in (load, f"{load} again"):
            ledger.load_new(
                t.spark, lambda path: partner_csv.parse_lines(t.spark.read.option("recursiveFileLookup", True).text(path)), f"{root}/in", f"{root}/rows",
                f"{root}/files", pattern="*.txt", load=name,
            )
    rows = ledger.loaded(t.spark, f"{root}/rows", f"{root}/files", "date string, click long")
    return rows.groupBy("load", "date").agg(F.count("*").alias("lines"), F.sum("click").alias("click"))

# --- shares that add up ------------------------------------------------------------------------


def _apportioned(keys: str, measure: str, units: str, order: str, name: str) -> str:
    """Largest remainders over ``parts``."""
    return f""", whole AS (SELECT *, SUM({measure}) OVER (PARTITION BY {keys}) AS total, CAST({units} AS HUGEINT) AS units FROM parts),
cut AS (SELECT *, CAST({measure} AS HUGEINT) * units // NULLIF(total, 0) AS quota, CAST({measure} AS HUGEINT) * units % NULLIF(total, 0) AS remainder FROM whole),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY remainder DESC, {order}) AS place, SUM(quota) OVER (PARTITION BY {keys}) AS given FROM cut)
SELECT * EXCLUDE (total, units, quota, remainder, place, given), CAST(quota + CASE WHEN place <= units - given THEN 1 ELSE 0 END AS BIGINT) AS {name} FROM ranked"""


@query(
    "apportioned_shares",
    ("clicks",),
    ", parts AS (SELECT channel, offer, country, slot, CAST(SUM(count) AS BIGINT) AS clicks FROM clicks GROUP BY ALL)"
    + _apportioned("channel", "clicks", "10000", "offer NULLS FIRST, country NULLS FIRST, slot NULLS FIRST", "share"),
)
def _shares(t: Testbed) -> DataFrame:
    """Clicks as ten-thousandths of their channel's; every channel's add up to 10,000."""
    parts = t("clicks").groupBy("channel", "offer", "country", "slot").agg(F.sum("count").cast("long").alias("clicks"))
    return apportion.apportion(parts, ["channel"], "clicks", [F.col("offer"), F.col("country"), F.col("slot")])


@query(
    "apportioned_revenue",
    ("conversion_events",),
    f""", paid AS (SELECT {DAY} AS day, channel, country, offer_pkg, {sum_units('payout')} AS units_paid FROM conversion_events GROUP BY 1, 2, 3, 4),
parts AS (SELECT *, SUM(units_paid) OVER (PARTITION BY day, channel) // 100000 AS amount FROM paid),
shared AS (WITH nothing AS (SELECT 1)
{_apportioned('day, channel', 'units_paid', 'amount', 'country NULLS FIRST, offer_pkg NULLS FIRST', 'revenue')})
SELECT * EXCLUDE (units_paid, amount) FROM shared""",
)
def _shared_revenue(t: Testbed) -> DataFrame:
    """The truncated amount of a channel's day, in ten-thousandths, over countries and packages without losing any."""
    parts = rollup_paid(t("conversion_events"))
    owed = parts.groupBy("day", "channel").agg(F.expr("sum(units_paid) div 100000").alias("amount"))
    met = attach_total(parts, owed, ["day", "channel"])
    shared = apportion.apportion(met, ["day", "channel"], "units_paid", [F.col("country"), F.col("offer_pkg")], F.col("amount"), "revenue")
    return shared.drop("units_paid", "amount")


def rollup_paid(events: DataFrame) -> DataFrame:
    keys = [slots.day_of("time_slot").alias("day"), "channel", "country", "offer_pkg"]
    return events.groupBy(*keys).agg(F.sum(to_units("payout")).alias("units_paid"))


# --- one checksum for many parts -----------------------------------------------------------------

PART_LINES = 40
_BYTE_TABLE = (
    "list_transform(range(256), lambda b: list_reduce(list_concat([b], [0, 0, 0, 0, 0, 0, 0, 0]), "
    "lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"
)


@query(
    "export_checksums",
    ("impressions",),
    f""", lines AS (SELECT {DAY} AS day, time_slot || ',' || slot || ',' || country || ',' || CAST(CAST(SUM(count) AS BIGINT) AS VARCHAR) AS line
  FROM impressions WHERE visible = '0' GROUP BY time_slot, slot, country),
days AS (SELECT day, COUNT(*) AS n, string_agg(line, CHR(10) ORDER BY line) || CHR(10) AS body FROM lines GROUP BY day),
table_of AS (SELECT {_BYTE_TABLE} AS t),
summed AS (SELECT day, n, body, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(body, ''), lambda c: ascii(c)::BIGINT)),
  lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])) AS x FROM days, table_of)
SELECT 'day=' || day AS file, lpad(lower(printf('%x', xor(x, 4294967295))), 8, '0') AS crc32, CAST(strlen(body) AS BIGINT) AS n_bytes FROM summed""",
)
def _checksums(t: Testbed) -> DataFrame:
    """CRC-32 of every day's lines, written in parts of at most 40 lines."""
    return checksums.export_checksums(t.spark, exported_lines(t, PART_LINES)).drop("parts")


def exported_lines(t: Testbed, lines_per_file: int) -> str:
    path = scratch_path(t.spark, "daily-parts")
    line = F.concat_ws(",", "time_slot", "slot", "country", F.col("c").cast("string"))
    lines = rollups.slot_all_clicks(t("impressions")).select(slots.day_of("time_slot").alias("day"), line.alias("value"))
    files.export_daily_lines(lines, path, lines_per_file)
    return path


# --- snapshots in buckets --------------------------------------------------------------------------

BUCKETS = 16


def day_part(key: str = "key") -> Column:
    """The day that a counter's key begins with; counters of one day share a bucket."""
    return F.substring_index(key, "_", 1)


def counter_buckets(t: Testbed) -> tuple[str, DataFrame]:
    """A snapshot with 0 for every key, and the counters of all days."""
    path = scratch_path(t.spark, "kv-buckets")
    every = t("routed").select(text.pack(slots.day_of("time_slot"), "routed_offer", "slot").alias("key")).distinct()
    buckets.create_buckets(every.withColumn("value", F.lit("0")), path, BUCKETS, [day_part()])
    counts = counters.click_counters(t("routed"), slots=None)
    return path, keyed.snapshot_kv(counts, F.col("value"), "day", F.col("key"))


@query(
    "bucketed_upsert",
    ("routed",),
    f""", fresh AS ({_COUNTS}), old AS (SELECT DISTINCT {DAY} || '_' || routed_offer || '_' || slot AS key FROM routed)
SELECT old.key, COALESCE(fresh.value, '0') AS value FROM old LEFT JOIN fresh ON old.key = fresh.key""",
)
def _bucketed(t: Testbed) -> DataFrame:
    """All counters, then those of the last day again, which rewrites one bucket."""
    path, fresh = counter_buckets(t)
    fresh = materialize(fresh, "fresh")
    buckets.upsert_buckets(fresh, path, ["key"], [day_part()])
    last = fresh.agg(F.max(day_part())).first()[0]
    buckets.upsert_buckets(fresh.where(day_part() == last), path, ["key"], [day_part()])
    return buckets.read_buckets(t.spark, path, fresh.schema).drop(buckets.BUCKET)


@query(
    "bucketed_update",
    ("routed",),
    f""", fresh AS ({_COUNTS}), old AS (SELECT DISTINCT {DAY} || '_' || routed_offer || '_' || slot AS key FROM routed)
SELECT old.key, CASE WHEN old.key < (SELECT MAX(SUBSTRING(key, 1, 8)) FROM fresh) THEN COALESCE(fresh.value, '0') ELSE '0' END AS value
FROM old LEFT JOIN fresh ON old.key = fresh.key""",
)
def _bucketed_update(t: Testbed) -> DataFrame:
    """Stored counters take the values of all days but the last; keys that are not stored stay out."""
    path, fresh = counter_buckets(t)
    last = fresh.agg(F.max(day_part())).first()[0]
    unknown = fresh.select(F.concat("key", F.lit("_unknown")).alias("key"), "value")
    source = fresh.where(day_part() < last).unionByName(unknown)
    buckets.update_buckets_from(source, path, ["key"], ["value"], [day_part()], fresh.schema)
    return buckets.read_buckets(t.spark, path, fresh.schema).drop(buckets.BUCKET)
