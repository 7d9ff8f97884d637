"""Queries of the general training-data problems, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import delivery, late, orphans, spikes
from tidemark.session import fresh_dir
from tidemark.sources.tables import table

STORE = "s3://lume-market/"


def _arrivals(spark: SparkSession, d: str) -> late.PartialStore:
    """A store that was fed all pointers and packets, batches with odd numbers first, so that later feeds correct earlier ones."""
    both = late.pointer_records(table(spark, d, "raw_event_pointers")).unionByName(late.packet_records(table(spark, d, "structured_packets")))
    store = late.PartialStore(spark, fresh_dir(spark, "late"), buckets=max(8, -(-both.count() // 200_000)))
    odd = F.coalesce(F.col("batch_id") % 2 != 0, F.lit(False))
    for feed in (both.where(odd), both.where(~odd)):
        store.add(feed)
    return store


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """What the store merged late and what it refused."""
    return _arrivals(spark, d).corrections().distinct()


def p1_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Figures merged from the partials of all batches."""
    return _arrivals(spark, d).figures()


def _delivered(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """All deliveries, and the admitted one of each identifier."""
    pointers = table(spark, d, "raw_event_pointers")
    rows = delivery.pointer_deliveries(pointers)
    # about one shard for a million identifiers keeps every numbering in one small task
    shards = max(16, -(-pointers.count() // 1_000_000))
    return rows, delivery.admitted(rows, delivery.SeenIds(spark, fresh_dir(spark, "seen"), shards))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return delivery.surplus(*_delivered(spark, d)).select("delivery_id").distinct()


def p5_kept(spark: SparkSession, d: str) -> DataFrame:
    """The one delivery of each event."""
    return _delivered(spark, d)[1].select("delivery_id", F.col("id").alias("event_id"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return spikes.implausible(table(spark, d, "market_symbol_summaries"))


def _references(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """All references, and all objects they must find."""
    t = lambda n: table(spark, d, n)
    stored = lambda n, key, of: t(n).select(F.lit(of).alias("from_table"), F.col(key).alias("object_key"), "stored_at_ms", "deleted_at_ms")
    refs = [
        orphans.references(t("l1_index"), "l1_index", "index_key", "canonical_manifest_key", "finished_at_ms", STORE),
        orphans.references(t("l1_manifest"), "l1_manifest", "manifest_key", "report_key", "finished_at_ms", STORE),
        orphans.references(t("market_context_snapshots"), "market_context_snapshots", "snapshot_id", "symbol_universe_snapshot_key", "captured_at_ms", STORE),
    ]
    objects = [
        stored("l1_manifest", "manifest_key", "l1_index"), stored("l1_report", "report_key", "l1_manifest"),
        stored("symbol_universe_snapshots", "snapshot_key", "market_context_snapshots"),
    ]
    return orphans.gathered(refs), reduce(DataFrame.unionByName, objects)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    refs, objects = _references(spark, d)
    return orphans.orphans(refs, objects, STORE).select("from_table", "record_key", "day_utc", "reason").distinct()


def p7_counts(spark: SparkSession, d: str) -> DataFrame:
    refs, objects = _references(spark, d)
    return orphans.orphan_counts(refs, orphans.orphans(refs, objects, STORE))


_TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_ID = f"nullif(lower({_TRIM.format('event_id')}), '')"
_MS = (
    "CASE WHEN published_at_ms IS NULL OR published_at_ms = 0 THEN fetched_at_ms"
    " WHEN abs(published_at_ms) < 100000000000 THEN published_at_ms * 1000"
    " WHEN abs(published_at_ms) < 100000000000000 THEN published_at_ms"
    " WHEN abs(published_at_ms) < 100000000000000000 THEN published_at_ms // 1000 ELSE published_at_ms // 1000000 END"
)
_LATE = f"""
WITH a AS (
  SELECT DISTINCT 'pointer' AS record_kind, {_ID} AS record_id, {_MS} AS event_ms, fetched_at_ms AS arrival_ms FROM raw_event_pointers
  UNION
  SELECT DISTINCT 'packet', packet_id, nullif(event_timestamp_ms, 0), decision_available_at_ms FROM structured_packets
), c AS (
  SELECT *, event_ms - event_ms % 3600000 AS period_start_ms FROM a
  WHERE record_id IS NOT NULL AND event_ms IS NOT NULL AND arrival_ms IS NOT NULL
), v AS (
  SELECT *, CASE WHEN arrival_ms < period_start_ms + 3600000 THEN 'on_time'
    WHEN arrival_ms < period_start_ms + 7 * 3600000 THEN 'late' ELSE 'too_late' END AS verdict FROM c
)"""
_DELIVERIES = f"""
WITH d AS (SELECT DISTINCT delivery_id, {_ID} AS id, created_at_ms FROM raw_event_pointers),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_at_ms NULLS LAST, delivery_id) AS k FROM d WHERE id IS NOT NULL)"""
_BARE = r"nullif(regexp_replace(regexp_replace(regexp_replace({}, '^\s+|\s+$', '', 'g'), '^s3://lume-market/', ''), '^[\s/]+|[\s/]+$', '', 'g'), '')"


def _orphan_sql(tail: str) -> str:
    refs, objects = [], []
    for t, record, key, at, target, tk in (
        ("l1_index", "index_key", "canonical_manifest_key", "finished_at_ms", "l1_manifest", "manifest_key"),
        ("l1_manifest", "manifest_key", "report_key", "finished_at_ms", "l1_report", "report_key"),
        ("market_context_snapshots", "CAST(snapshot_id AS VARCHAR)", "symbol_universe_snapshot_key", "captured_at_ms", "symbol_universe_snapshots", "snapshot_key"),
    ):
        refs.append(f"SELECT DISTINCT '{t}' AS from_table, {record} AS record_key, {_BARE.format(key)} AS k, {at} AS t FROM {t}")
        objects.append(f"SELECT DISTINCT '{t}' AS from_table, {_BARE.format(tk)} AS k, stored_at_ms AS s, deleted_at_ms AS x FROM {target}")
    return f"""
WITH r AS ({' UNION ALL '.join(refs)}), o AS ({' UNION ALL '.join(objects)}),
j AS (
  SELECT r.from_table, r.record_key, strftime(make_timestamp(r.t * 1000), '%Y-%m-%d') AS day_utc, r.k, r.t,
    count(o.k) AS n, coalesce(bool_or(o.s <= r.t), false) AS was, coalesce(bool_or(o.s <= r.t AND (o.x IS NULL OR o.x > r.t)), false) AS live
  FROM r LEFT JOIN o ON r.from_table = o.from_table AND r.k = o.k WHERE r.k IS NOT NULL
  GROUP BY r.from_table, r.record_key, r.k, r.t
), f AS (SELECT *, CASE WHEN live THEN NULL WHEN n = 0 THEN 'missing' WHEN was THEN 'deleted' ELSE 'late' END AS reason FROM j)
{tail}"""


_SPIKES = """
WITH s AS (SELECT DISTINCT slice_id, symbol, venue, window_start_ms AS t, trade_count AS tc, trade_volume AS tv, mid_price, spread_bps FROM market_symbol_summaries),
r AS (
  SELECT slice_id, symbol, venue, t, tc, tv, 'mid_price' AS field_name, mid_price AS x FROM s WHERE mid_price IS NOT NULL UNION ALL
  SELECT slice_id, symbol, venue, t, tc, tv, 'spread_bps', spread_bps FROM s WHERE spread_bps IS NOT NULL UNION ALL
  SELECT slice_id, symbol, venue, t, tc, tv, 'trade_volume', tv FROM s WHERE tv IS NOT NULL
), q AS (SELECT *, coalesce(tc = 0 AND tv = 0, false) AS quiet FROM r),
bad AS (
  SELECT slice_id, field_name FROM q WHERE NOT isfinite(x) OR (field_name = 'mid_price' AND x <= 0)
    OR (field_name = 'spread_bps' AND (x < 0 OR x >= 10000)) OR (field_name = 'trade_volume' AND (x < 0 OR ((tc = 0) <> (tv = 0))))
), l AS (
  SELECT *, median(x) OVER (PARTITION BY symbol, venue, field_name ORDER BY t RANGE BETWEEN 7200000 PRECEDING AND 7200000 FOLLOWING) AS lev
  FROM q WHERE isfinite(x) AND NOT quiet
), u AS (SELECT *, abs(x - lev) > 10 * median(abs(x - lev)) OVER (PARTITION BY symbol, venue, field_name) AS far FROM l),
g AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, venue, field_name ORDER BY t, slice_id)
    - row_number() OVER (PARTITION BY symbol, venue, field_name, far ORDER BY t, slice_id) AS grp FROM u
), z AS (SELECT *, count(*) OVER (PARTITION BY symbol, venue, field_name, far, grp) AS n FROM g),
live AS (SELECT *, coalesce(tc > 0, false) AND NOT quiet AND isfinite(x) AS ok FROM q),
h AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, venue, field_name ORDER BY t, slice_id)
    - row_number() OVER (PARTITION BY symbol, venue, field_name, ok, x ORDER BY t, slice_id) AS grp FROM live
), k AS (SELECT *, count(*) OVER (PARTITION BY symbol, venue, field_name, ok, x, grp) AS n FROM h)
SELECT slice_id, field_name FROM bad UNION SELECT slice_id, field_name FROM z WHERE far AND n <= 3
UNION SELECT slice_id, field_name FROM k WHERE ok AND n >= 12"""


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_hourly, p5_found, p5_kept, p6_found, p7_found, p7_counts)}


def oracle_sql() -> dict[str, str]:
    kept = "CASE WHEN verdict <> 'too_late' THEN {} END"
    return {
        "p1_found": _LATE + " SELECT DISTINCT record_kind, record_id, period_start_ms, verdict FROM v WHERE verdict <> 'on_time'",
        "p1_hourly": _LATE
        + f""" SELECT record_kind, period_start_ms, count({kept.format(1)}) AS n_records,
  count(CASE WHEN verdict = 'on_time' THEN 1 END) AS n_on_time, count(CASE WHEN verdict = 'late' THEN 1 END) AS n_late,
  count(CASE WHEN verdict = 'too_late' THEN 1 END) AS n_refused, CAST(sum({kept.format('arrival_ms - event_ms')}) AS BIGINT) AS sum_delay_ms,
  max({kept.format('arrival_ms - event_ms')}) AS max_delay_ms FROM v GROUP BY ALL""",
        "p5_found": _DELIVERIES + " SELECT delivery_id FROM n WHERE k > 1",
        "p5_kept": _DELIVERIES + " SELECT delivery_id, id AS event_id FROM n WHERE k = 1",
        "p6_found": _SPIKES,
        "p7_found": _orphan_sql("SELECT DISTINCT from_table, record_key, day_utc, reason FROM f WHERE reason IS NOT NULL"),
        "p7_counts": _orphan_sql(
            "SELECT from_table, day_utc, count(*) AS n_references, count(CASE WHEN reason = 'missing' THEN 1 END) AS n_missing,"
            " count(CASE WHEN reason = 'deleted' THEN 1 END) AS n_deleted, count(CASE WHEN reason = 'late' THEN 1 END) AS n_late FROM f GROUP BY ALL"
        ),
    }
