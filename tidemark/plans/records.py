"""Queries of record-level reading, checking, publishing and scanning, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.ids import dated_key
from tidemark.operators import gates, market, packets, rules, stories
from tidemark.session import fresh_dir
from tidemark.sources import slices
from tidemark.sources.tables import table

NOW, HOURS, MOST = 1_704_067_200_000 + 96 * market.HOUR + 5, 6, 512
FAMILY = "structured-intel-packet/schema=structured_intel_packet_v1"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_object_lines").where("payload is not null").select("record_kind", "object_key", "line_number", "payload").distinct()


def _claims(spark: SparkSession, d: str) -> DataFrame:
    """A pointer to every packet line, some of them wrong: by line number modulo 11, a missing object, a range
    beyond the end, a range one byte short, and another identity."""
    lines = _lines(spark, d).where("record_kind = 'structured_packet'")
    made = gates.locators(lines, "object_key", "line_number", "payload")
    numbered = lines_with_ids(spark, d)
    wrong = F.pmod("line_no", F.lit(11))
    return made.join(numbered, ["object_key", "line_no"]).select(
        F.when(wrong == 4, "someone_else").otherwise(F.col("packet_id")).alias("event_id"), F.when(wrong == 1, F.concat("object_key", F.lit(".gone"))).otherwise(F.col("object_key")).alias("object_key"),
        "line_no", F.when(wrong == 2, F.col("byte_offset") + 10_000_000_000).otherwise(F.col("byte_offset")).alias("byte_offset"),
        F.when(wrong == 3, F.col("byte_length") - 1).otherwise(F.col("byte_length")).alias("byte_length"), "content_sha256",
    )


def lines_with_ids(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    rows = _lines(spark, d).where("record_kind = 'structured_packet'")
    number = F.row_number().over(Window.partitionBy("object_key").orderBy("line_number", "payload"))
    return rows.select("object_key", number.alias("line_no"), F.get_json_object("payload", "$.packet_id").alias("packet_id"))


def verified_records(spark, d):
    """Every pointer read by byte range and checked: range, checksum, JSON, schema version, identity."""
    objects = gates.jsonl_objects(_lines(spark, d).where("record_kind = 'structured_packet'"), "object_key", "line_number", "payload")
    read = gates.verified(gates.read_ranges(_claims(spark, d), objects), "structured_intel_packet_v1", "packet_id")
    return read.select("object_key", "line_no", F.octet_length("record").alias("n_bytes"), "error")


def lines_by_number(spark, d):
    """The second line of every file, and the one after its last."""
    objects = gates.jsonl_objects(_lines(spark, d), "object_key", "line_number", "payload")
    n = _lines(spark, d).groupBy("object_key").agg(F.count("*").cast("int").alias("n"))
    wanted = n.select("object_key", F.explode(F.array(F.lit(2), F.col("n") + 1)).alias("line_no")).distinct()
    return gates.lines_of(objects, wanted).select("object_key", "line_no", F.sha2("line", 256).alias("line_sha"))


def delivery_outcomes(spark, d):
    p = table(spark, d, "raw_event_pointers")
    done = table(spark, d, "structured_packets").select(F.col("raw_event_id").alias("event_id")).where("event_id is not null")
    return gates.outcomes(p, gates.pointer_error(p, "raw_intel_event_created_v2", "aws_s3_jsonl_record"), done, table(spark, d, "raw_events"))


def start_positions(spark, d):
    return gates.start_positions(table(spark, d, "raw_event_pointers"), "source_id", "delivery_id")


def _packet_keys(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "structured_packets").where("packet_id is not null").distinct()
    raw = F.coalesce("raw_event_id", F.lit("unknown"))
    return p.withColumn("object_key", dated_key("structured-intel-packet", "structured_intel_packet_v1", F.col("structured_at_ms"), raw, "packet_id", F.col("packet_id"), "/part-000001.jsonl"))


def recent_packet_keys(spark, d):
    """Packets stored in the hours before a time, newest hour first, so many of each."""
    keys = _packet_keys(spark, d).select("object_key").distinct()
    return slices.under_prefixes(keys, "object_key", slices.recent_prefixes([], NOW, HOURS, FAMILY), MOST)


def _payload() -> "F.Column":
    return F.concat(F.lit('{"packet_id":"'), "packet_id", F.lit('","revision":'), F.coalesce(F.col("revision").cast("string"), F.lit("null")), F.lit("}\n"))


def packet_pointers(spark, d):
    """What would be published of each packet; the fields of storage_ref side by side."""
    p = packets.pointers(_packet_keys(spark, d), _payload(), F.col("object_key"), "output", "structured_intel_packet_v1", F.col("market_context_ref.manifest_key"))
    return p.select("packet_id", "raw_event_id", "terminal_decision", "storage_ref.bucket", "storage_ref.key", "storage_ref.content_sha256", "manifest_key", "created_at_ms")


def merged_snapshots(spark, d):
    """Snapshots of a symbol and window as one."""
    s = table(spark, d, "market_context_snapshots").where("symbol is not null and window_start_ms is not null").distinct()
    s = s.withColumn("symbol", F.upper(F.trim("symbol")))
    m = market.merged_snapshots(s, ["symbol", "window_start_ms"], ["snapshot_id"], ["snapshot_id", "captured_at_ms", "basis_kind"], ["manifest_key", "symbol_universe_snapshot_key"], "output_object_keys")
    return m.withColumn("output_object_keys", F.array_join("output_object_keys", ","))


def slice_scan(spark, d):
    """Market slices written by day and hour, then scanned: two hours of them, of wanted symbols."""
    s = table(spark, d, "market_symbol_summaries").where("window_start_ms is not null and symbol is not null").distinct()
    at = F.timestamp_millis("window_start_ms")
    shaped = s.select(
        F.regexp_replace("symbol", "USDT$", "").alias("base_asset"), F.col("symbol").alias("symbol_canonical"), "venue", "slice_completeness", "window_start_ms", "window_end_ms", "trade_count",
        "trade_volume", F.nanvl("mid_price", F.lit(None)).alias("mid_price"), "spread_bps", F.date_format(at, "yyyy-MM-dd").alias("dt"), F.date_format(at, "HH").alias("hour"),
    )
    path = fresh_dir(spark, "slices")
    shaped.repartition("dt", "hour").write.partitionBy("dt", "hour").parquet(path)
    first = 1_704_067_200_000 + 30 * market.HOUR
    read = spark.read.parquet(path).where(slices.within_hours("dt", "hour", first, first + market.HOUR))
    names = table(spark, d, "symbol_aliases").select("symbol").distinct()
    return slices.wanted(read, names).select("symbol_canonical", "venue", "window_start_ms", "trade_count", "mid_price")


def cited_excerpts(spark, d):
    """The first and third excerpt of every event as a response would cite them; null where there is no third."""
    pack = rules.excerpts(table(spark, d, "raw_events").where("event_id is not null").distinct().dropDuplicates(["event_id"]))
    held = pack.groupBy("event_id").agg(F.map_from_entries(F.collect_list(F.struct("rank", "excerpt"))).alias("excerpts"))
    both = packets.cited(F.array(F.lit("E1"), F.lit("E3")), held)
    return both.select("event_id", F.array_join("cited", "|").alias("cited"))


def response_errors(spark, d):
    """Responses made from packets, with words around the JSON, checked against two known evidence ids."""
    p = table(spark, d, "structured_packets").distinct()
    ids = F.when(F.col("revision") % 3 == 0, F.array(F.lit("E1"))).when(F.col("revision") % 3 == 1, F.array(F.lit("E2"), F.lit("E7"))).otherwise(F.array().cast("array<string>"))
    made = F.to_json(F.struct(
        "normalized_symbols", F.col("symbol_confidence_band"), "event_type", F.coalesce("event_type", F.lit("")).alias("topic_summary"), F.lit("neutral").alias("stance_summary"),
        F.lit("none known").alias("risk_summary"), "regime_hint", "scenario_hint", "contradiction_flags", ids.alias("evidence_ids"), (F.col("novelty_score") * 1.2).alias("confidence_score"),
        "confidence_band", "novelty_score", "terminal_decision",
    ))
    raw = F.when(F.pmod(F.length("packet_id") + F.col("revision"), F.lit(2)) == 0, F.concat(F.lit("Here it is: "), made, F.lit(" Done."))).otherwise(made)
    return p.select("packet_id", "revision", packets.response_error(raw, F.array(F.lit("E1"), F.lit("E2"))).alias("error"))


def processed_members(spark, d):
    """Of each story, how many events and how many that were processed: a semi-join on the success index."""
    e = rules.hints(rules.assess(table(spark, d, "raw_events").distinct()))
    members = e.select(stories.story_key(e).alias("story_hint_key"), "event_id").where("event_id is not null").distinct()
    done = table(spark, d, "structured_packets").select(F.col("raw_event_id").alias("event_id")).where("event_id is not null").distinct()
    mine = members.join(done, "event_id", "left_semi").groupBy("story_hint_key").agg(F.count("*").alias("n_processed"))
    return members.groupBy("story_hint_key").agg(F.count("*").alias("n_events")).join(mine, "story_hint_key", "left").withColumn("n_processed", F.coalesce("n_processed", F.lit(0).cast("long")))


def redacted_documents(spark, d):
    """Documents whose whole text holds a forbidden term: how often, and the text's checksum after redaction."""
    docs = table(spark, d, "documents").where(gates.forbidden(F.col("text")))
    clean = gates.redacted(F.col("text"))
    return docs.select("doc_id", F.sha2(clean, 256).alias("clean_sha"), F.regexp_count(clean, F.lit(r"\[blocked_output_term\]")).alias("n_terms"))


QUERIES = (
    verified_records, lines_by_number, delivery_outcomes, start_positions, recent_packet_keys, packet_pointers, merged_snapshots, slice_scan, cited_excerpts, response_errors,
    processed_members, redacted_documents,
)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    from tidemark.plans.pipeline import _A, _BLANK, _HINT, _PACK, _REDACT, _SEGMENT, _TIME, _BAD

    key = f"""'structured-intel-packet/schema=structured_intel_packet_v1/dt=' || {_TIME('structured_at_ms', '%Y-%m-%d')} || '/hour=' || {_TIME('structured_at_ms', '%H')}
  || '/raw_event_id=' || {_SEGMENT("coalesce(raw_event_id, 'unknown')")} || '/packet_id=' || {_SEGMENT('packet_id')} || '/part-000001.jsonl'"""
    lines = "SELECT DISTINCT record_kind, object_key, line_number, payload FROM raw_object_lines WHERE payload IS NOT NULL"
    ranks = "['available_symbol_context', 'nearest_available', 'symbol_context_only', 'stale_but_usable', 'available', 'available_general_context', 'pending', 'unavailable']"
    wrong_pointer = f"""p.schema_version IS DISTINCT FROM 'raw_intel_event_created_v2' OR {_BLANK('p.event_id')} OR storage_ref.kind IS DISTINCT FROM 'aws_s3_jsonl_record'
    OR {_BLANK('storage_ref.bucket')} OR {_BLANK('storage_ref.key')} OR coalesce(storage_ref.byte_length <= 0, true) OR NOT coalesce(starts_with(storage_ref.content_sha256, 'sha256:'), false)"""
    ids = "CASE revision % 3 WHEN 0 THEN ['E1'] WHEN 1 THEN ['E2', 'E7'] ELSE [] END"
    return {
        "verified_records": f"""WITH l AS ({lines}), n AS (SELECT *, row_number() OVER (PARTITION BY object_key ORDER BY line_number, payload) AS k, strlen(payload) AS size FROM l WHERE record_kind = 'structured_packet')
  SELECT CASE k % 11 WHEN 1 THEN object_key || '.gone' ELSE object_key END AS object_key, CAST(k AS INTEGER) AS line_no, CASE WHEN k % 11 NOT IN (1, 2) AND size > CAST(k % 11 = 3 AS INTEGER) THEN size - CAST(k % 11 = 3 AS INTEGER) END AS n_bytes,
    CASE WHEN k % 11 = 1 THEN 'missing_object' WHEN k % 11 = 2 OR size <= CAST(k % 11 = 3 AS INTEGER) THEN 'out_of_range' WHEN k % 11 = 3 THEN 'checksum'
      WHEN NOT json_valid(payload) OR coalesce(json_type(payload), '') <> 'OBJECT' THEN 'not_json' WHEN json_extract_string(payload, '$.schema_version') IS DISTINCT FROM 'structured_intel_packet_v1' THEN 'schema_version'
      WHEN k % 11 = 4 THEN 'identity' END AS error FROM n""",
        "lines_by_number": f"""WITH l AS ({lines}), n AS (SELECT *, row_number() OVER (PARTITION BY object_key ORDER BY line_number, payload) AS k, count(*) OVER (PARTITION BY object_key) AS n FROM l),
  w AS (SELECT DISTINCT object_key, CAST(unnest([2, n + 1]) AS INTEGER) AS line_no FROM n)
  SELECT w.object_key, w.line_no, sha256(payload) AS line_sha FROM w LEFT JOIN n ON n.object_key = w.object_key AND n.k = w.line_no""",
        "delivery_outcomes": f"""WITH h AS (SELECT event_id, min(content_hash) AS low, max(content_hash) AS high FROM raw_events WHERE event_id IS NOT NULL GROUP BY event_id),
  o AS (SELECT delivery_id, CASE WHEN {wrong_pointer} THEN 'invalid_pointer' WHEN p.event_id IN (SELECT raw_event_id FROM structured_packets WHERE raw_event_id IS NOT NULL) THEN 'duplicate'
    WHEN h.event_id IS NULL THEN 'retry' WHEN p.content_hash IS NOT DISTINCT FROM low OR p.content_hash IS NOT DISTINCT FROM high THEN 'processed' ELSE 'permanent_input_failure' END AS outcome
    FROM raw_event_pointers p LEFT JOIN h ON p.event_id = h.event_id)
  SELECT *, outcome IN ('invalid_pointer', 'permanent_input_failure') AS quarantined FROM o""",
        "start_positions": """SELECT 'all' AS policy, CAST(NULL AS VARCHAR) AS subject, min(delivery_id) AS start FROM raw_event_pointers UNION ALL SELECT 'new', NULL, max(delivery_id) + 1 FROM raw_event_pointers
  UNION ALL SELECT 'last', NULL, max(delivery_id) FROM raw_event_pointers UNION ALL SELECT 'last_per_subject', source_id, max(delivery_id) FROM raw_event_pointers GROUP BY source_id""",
        "recent_packet_keys": f"""WITH k AS (SELECT DISTINCT {key} AS object_key, structured_at_ms - structured_at_ms % 3600000 AS h FROM structured_packets WHERE packet_id IS NOT NULL),
  r AS (SELECT DISTINCT object_key, regexp_extract(object_key, '^.*/hour=../') AS prefix FROM k WHERE h <= 1704067200000 + 96 * 3600000 AND h > 1704067200000 + 90 * 3600000)
  SELECT object_key, prefix, CAST(pos AS INTEGER) AS pos FROM (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY object_key) AS pos FROM r) WHERE pos <= 512""",
        "packet_pointers": f"""SELECT packet_id, raw_event_id, terminal_decision, 'output' AS bucket, {key} AS key,
    'sha256:' || sha256('{{"packet_id":"' || packet_id || '","revision":' || coalesce(CAST(revision AS VARCHAR), 'null') || '}}' || chr(10)) AS content_sha256,
    market_context_ref.manifest_key AS manifest_key, structured_at_ms AS created_at_ms FROM (SELECT DISTINCT * FROM structured_packets WHERE packet_id IS NOT NULL)""",
        "merged_snapshots": f"""WITH s AS (SELECT DISTINCT * REPLACE (upper(trim(symbol, ' ')) AS symbol), list_position({ranks}, status) AS r FROM market_context_snapshots WHERE symbol IS NOT NULL AND window_start_ms IS NOT NULL)
  SELECT symbol, window_start_ms, min(snapshot_id) AS snapshot_id, arg_min(struct_pack(v := captured_at_ms), snapshot_id).v AS captured_at_ms, arg_min(struct_pack(v := basis_kind), snapshot_id).v AS basis_kind,
    ({ranks})[min(r)] AS status, arg_min(manifest_key, snapshot_id) FILTER (manifest_key IS NOT NULL) AS manifest_key,
    arg_min(symbol_universe_snapshot_key, snapshot_id) FILTER (symbol_universe_snapshot_key IS NOT NULL) AS symbol_universe_snapshot_key,
    array_to_string(flatten(coalesce(list(output_object_keys ORDER BY snapshot_id) FILTER (output_object_keys IS NOT NULL), [])), ',') AS output_object_keys, count(*) AS n_merged FROM s GROUP BY ALL""",
        "slice_scan": """WITH s AS (SELECT DISTINCT symbol, venue, window_start_ms, trade_count, mid_price, slice_id, window_end_ms, spread_bps, trade_volume, slice_completeness FROM market_symbol_summaries)
  SELECT symbol AS symbol_canonical, venue, window_start_ms, trade_count, CASE WHEN NOT isnan(mid_price) THEN mid_price END AS mid_price FROM s
  WHERE window_start_ms >= 1704067200000 + 30 * 3600000 AND window_start_ms < 1704067200000 + 32 * 3600000
    AND (upper(regexp_replace(symbol, 'USDT$', '')) IN (SELECT upper(symbol) FROM symbol_aliases) OR upper(symbol) IN (SELECT upper(symbol) FROM symbol_aliases))""",
        "cited_excerpts": f"""WITH x AS ({_PACK}), c AS (SELECT event_id, max(excerpt) FILTER (rank = 'E1') AS a, max(excerpt) FILTER (rank = 'E3') AS b FROM x WHERE event_id IS NOT NULL GROUP BY event_id)
  SELECT event_id, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN a || '|' || b END AS cited FROM c""",
        "response_errors": f"""WITH p AS (SELECT *, {ids} AS ids FROM (SELECT DISTINCT * FROM structured_packets))
  SELECT packet_id, revision, CASE WHEN list_contains(ids, 'E7') THEN 'unknown_evidence' WHEN coalesce(symbol_confidence_band NOT IN ('weak', 'moderate', 'strong'), true) THEN 'symbol_band'
    WHEN coalesce(confidence_band NOT IN ('low', 'medium', 'high'), true) THEN 'confidence_band' WHEN confidence_band = 'high' AND len(ids) = 0 THEN 'high_without_evidence'
    WHEN terminal_decision IN ('high_confidence_structured', 'conflicted') AND len(ids) = 0 THEN 'decision_without_evidence' WHEN terminal_decision = 'quarantine_only' THEN 'decision'
    WHEN NOT coalesce(novelty_score * 1.2 BETWEEN 0 AND 1, false) THEN 'confidence_score' WHEN NOT coalesce(novelty_score BETWEEN 0 AND 1, false) THEN 'novelty_score'
    WHEN {_BLANK('event_type')} OR {_BLANK('regime_hint')} OR {_BLANK('scenario_hint')} THEN 'text_empty'
    WHEN len(list_filter(coalesce(normalized_symbols, []), lambda s: NOT coalesce(regexp_full_match(trim(s), '[A-Z0-9]{{1,16}}'), false))) > 0 THEN 'symbol' END AS error FROM p""",
        "processed_members": f"""WITH {_A}, m AS (SELECT DISTINCT {_HINT} AS story_hint_key, event_id FROM a WHERE event_id IS NOT NULL)
  SELECT story_hint_key, count(*) AS n_events, count(CASE WHEN event_id IN (SELECT raw_event_id FROM structured_packets WHERE raw_event_id IS NOT NULL) THEN 1 END) AS n_processed FROM m GROUP BY story_hint_key""",
        "redacted_documents": f"""SELECT doc_id, sha256({_REDACT('text')}) AS clean_sha, CAST(len(string_split({_REDACT('text')}, '[blocked_output_term]')) - 1 AS INTEGER) AS n_terms FROM documents WHERE {_BAD('text')}""",
    }
