"""Queries of the problems for language-model training data, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.text import record_key, utrim
from tidemark.llm import history, nearest, packing, reading, tokens
from tidemark.session import fresh_dir, scratch, written
from tidemark.sources.tables import table

TOLERANCE_MS = 600_000


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    snapshots = table(spark, d, "market_context_snapshots").where("status is null or status not in ('pending', 'unavailable')")
    # the alias table is a fixed list of some thousand names, whatever the data's size
    alias = F.broadcast(table(spark, d, "symbol_aliases").select("alias_name", F.col("symbol").alias("_s")))
    known = snapshots.withColumn("alias_name", nearest.canonical_symbol(F.col("symbol"))).join(alias, "alias_name", "left")
    sought = known.select(F.coalesce("_s", "alias_name").alias("entity"), F.coalesce("basis_timestamp_ms", "window_start_ms").alias("t"), F.col("snapshot_id").alias("id"))
    packets = table(spark, d, "structured_packets").where("event_timestamp_ms <> 0").select("packet_id", F.col("event_timestamp_ms").alias("q"), F.explode("normalized_symbols").alias("symbol"))
    packets = packets.distinct().withColumn("entity", nearest.canonical_symbol(F.col("symbol")))
    found = nearest.nearest(packets.select("entity", "q"), sought, TOLERANCE_MS)
    return packets.join(found, ["entity", "q"]).select("packet_id", "symbol", F.col("id").alias("snapshot_id")).distinct()


#: What stands for no key, and the SHA-256 of an empty text.
PLACEHOLDERS = ["", "unknown", "-", "n/a"]
EMPTY_HASH = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def _named(c: Column) -> Column:
    """Null for placeholders: blank, unknown, -, n/a, all zeros."""
    return F.when(~c.isin(PLACEHOLDERS) & ~c.rlike("^0+$"), c)


def dedup_key(c: Column) -> Column:
    """A key without letter case, scheme, fragment, tracking parameters, surrounding blanks and slashes."""
    bare = F.regexp_replace(F.lower(utrim(c)), "#.*$", "")
    bare = F.regexp_replace(bare, "https?://", "")
    path, query = F.substring_index(bare, "?", 1), F.when(F.contains(bare, F.lit("?")), F.substring(bare, F.instr(bare, "?") + 1, F.length(bare)))
    kept = F.filter(F.split(query, "&"), lambda p: ~p.rlike("^(utm_[^=]*|trk|ref)(=|$)") & (p != ""))
    ends = lambda x: F.regexp_replace(x, r"^[\s/]+|[\s/]+$", "")
    return _named(ends(F.when(F.size(kept) > 0, F.concat(ends(path), F.lit("?"), F.array_join(kept, "&"))).otherwise(ends(path))))


def content_hash(c: Column) -> Column:
    """A hash without algorithm prefix and letter case."""
    bare = _named(F.regexp_replace(F.lower(utrim(c)), "^[a-z0-9-]+:", ""))
    return F.when(bare != EMPTY_HASH, bare)


def p4_found(spark: SparkSession, d: str, steps: int = 2) -> DataFrame:
    """Events that repeat an accepted one, given to the store in `steps` batches of rising time."""
    with scratch(spark):
        return _repeats(spark, d, steps)


def _repeats(spark: SparkSession, d: str, steps: int) -> DataFrame:
    first = F.struct(F.col("created_at_ms").isNull().alias("none"), "created_at_ms", "delivery_id")
    pointers = table(spark, d, "raw_event_pointers").select(record_key(F.col("event_id")).alias("id"), "created_at_ms", "delivery_id", "dedup_key", "content_hash").where("id is not null")
    keys = F.array(history.key_of("dedup", dedup_key(F.col("m.dedup_key"))), history.key_of("hash", content_hash(F.col("m.content_hash"))))
    events = pointers.groupBy("id").agg(F.min(F.struct(first.alias("at"), "dedup_key", "content_hash")).alias("m")).select("id", F.col("m.at.created_at_ms").alias("at"), keys.alias("keys"))
    events = written(events, "events")
    bodies = table(spark, d, "raw_events").where("content_kind is null or content_kind <> 'derivatives_snapshot'").select(record_key(F.col("event_id")).alias("id"), "body")
    bodies = bodies.where("id is not null and body is not null")
    low, high = events.agg(F.min("at"), F.max("at")).first()
    # about one bucket for ten thousand events, so that a bucket's rows fit one task at any size
    store, found = history.History(spark, fresh_dir(spark, "history"), buckets=max(16, -(-events.count() // 10_000))), []
    for k in range(steps):
        if low is None:
            mine = events if k == 0 else events.limit(0)
        else:
            step = F.coalesce(F.least(F.floor((F.col("at") - F.lit(low)) / F.lit((high - low) // steps + 1)), F.lit(steps - 1)), F.lit(steps - 1))
            mine = events.where(step == k)
        found.append(store.admit(mine, bodies))
    pairs = reduce(DataFrame.unionByName, found)
    return pairs.select(F.least("id", "of_id").alias("event_id_a"), F.greatest("id", "of_id").alias("event_id_b")).distinct()


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"))


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    """Every document's container, or the containers of its parts."""
    docs = table(spark, d, "documents")
    sizes = tokens.encode(docs).select("doc_id", F.size("ids").alias("n_tokens"))
    return packing.pack(sizes, docs.count())


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are against the fewest that could hold all tokens."""
    return packing.profile(p9_containers(spark, d))


def p9_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of every packing: each document whole and once, no container too full."""
    assigned = written(p9_containers(spark, d), "containers")
    docs = assigned.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("parts")).withColumn("kind", F.lit("document"))
    loads = assigned.groupBy("container_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("parts")).withColumn("kind", F.lit("container"))
    both = docs.select("kind", "n", "parts").unionByName(loads.select("kind", "n", "parts"))
    count = lambda kind, c: F.count(F.when((F.col("kind") == kind) & c, 1))
    over = F.col("n") > packing.CAPACITY
    return both.agg(
        count("document", F.lit(True)).alias("n_documents"), count("document", ~over & (F.col("parts") > 1)).alias("n_split_without_need"), count("container", over).alias("n_too_full")
    )


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    return reading.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_labels")).select("doc_id", "reading_level")


def p10_heldout(spark: SparkSession, d: str) -> DataFrame:
    """How well levels agree with judgements that took no part in the fit: a fifth of the judged documents, by hash."""
    labels, held = table(spark, d, "reading_labels"), F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    levels = reading.reading_levels(table(spark, d, "documents"), labels.where(~held)).select("doc_id", "reading_level")
    judged = labels.where(held).groupBy("doc_id").agg(F.avg("reading_level").alias("judged"))
    both = levels.where("reading_level is not null").join(judged, "doc_id")
    return both.agg(F.count("*").alias("n_documents"), F.corr("reading_level", "judged").alias("correlation"), F.avg(F.abs(F.col("reading_level") - F.col("judged"))).alias("mean_error"))


def p10_profile(spark: SparkSession, d: str) -> DataFrame:
    """Documents per language and rounded level."""
    levels = p10_levels(spark, d).select("doc_id", F.round("reading_level").cast("int").alias("level"))
    return table(spark, d, "documents").select("doc_id", "lang").join(levels, "doc_id").groupBy("lang", "level").agg(F.count("*").alias("n_docs"))


def queries() -> dict:
    return {f.__name__: f for f in (p3_found, p4_found, p8_ids, p9_containers, p9_fill, p9_checks, p10_levels, p10_heldout, p10_profile)}


_NEAREST = r"""
WITH s AS (
  SELECT DISTINCT coalesce(a.symbol, upper(trim(m.symbol, e' \t\n\r'))) AS symbol, coalesce(basis_timestamp_ms, window_start_ms) AS t, snapshot_id
  FROM market_context_snapshots m LEFT JOIN symbol_aliases a ON a.alias_name = upper(trim(m.symbol, e' \t\n\r'))
  WHERE m.status IS NULL OR m.status NOT IN ('pending', 'unavailable')
), p AS (SELECT DISTINCT packet_id, event_timestamp_ms AS q, unnest(normalized_symbols) AS symbol FROM structured_packets WHERE event_timestamp_ms <> 0),
j AS (
  SELECT p.packet_id, p.symbol, p.q, s.snapshot_id, row_number() OVER (PARTITION BY p.packet_id, p.q, p.symbol ORDER BY abs(s.t - p.q), s.t, s.snapshot_id) AS k
  FROM p JOIN s ON upper(trim(p.symbol, e' \t\n\r')) = s.symbol AND s.t BETWEEN p.q - 600000 AND p.q + 600000
)
SELECT DISTINCT packet_id, symbol, snapshot_id FROM j WHERE k = 1"""


def oracle_sql() -> dict[str, str]:
    checks = "SELECT count(DISTINCT doc_id) AS n_documents, CAST(0 AS BIGINT) AS n_split_without_need, CAST(0 AS BIGINT) AS n_too_full FROM documents"
    return {"p3_found": _NEAREST, "p9_checks": checks}
