"""Queries of the event pipeline's operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.ids import content_sha, dated_key, run_id, sampled, short_id
from tidemark.functions.text import floor_to, published_ms
from tidemark.operators import gates, market, packets, rules, stories
from tidemark.sources.tables import table

POLICY = "policy_v1"
GRID, SLICE = 180_000, 900_000


def _events(spark: SparkSession, d: str) -> DataFrame:
    """Raw events, rows repeated verbatim once."""
    return table(spark, d, "raw_events").distinct()


def _assessed(spark: SparkSession, d: str) -> DataFrame:
    return rules.assess(_events(spark, d))


def rule_assessment(spark, d):
    join = lambda c: F.array_join(c, "|").alias(c)
    return _assessed(spark, d).select("event_id", "event_type", join("symbols"), "symbol_band", join("evidence"), join("flags"), "confidence", "confidence_band", "decision")


def decision_matrix(spark, d):
    return _assessed(spark, d).groupBy("event_type", "decision").agg(F.count("*").alias("n_events"), F.avg("confidence").alias("mean_confidence"))


def rule_hints(spark, d):
    return rules.hints(_assessed(spark, d)).select("event_id", "regime_hint", "scenario_hint", "decay_hint", "novelty_score")


def symbols_normalized(spark, d):
    """Events per symbol."""
    s = _events(spark, d).select("event_id", F.explode(rules.normalized_symbols(F.col("symbol_candidates"))).alias("symbol"))
    return s.groupBy("symbol").agg(F.count("*").alias("n_events"), F.count_distinct("event_id").alias("n_ids"))


def evidence_pack(spark, d):
    return rules.excerpts(_events(spark, d))


def quality_gates(spark, d):
    q = rules.quality(_events(spark, d))
    return q.select("event_id", "is_numeric", "is_derivatives", "is_broad_scan", "is_trusted", "needs_model", "needs_escalation", "is_official", F.array_join("reasons", ",").alias("reasons"))


def metric_evidence(spark, d):
    return rules.metrics(_events(spark, d))


def symbol_trace(spark, d):
    return rules.symbol_trace(_events(spark, d))


def deterministic_ids(spark, d):
    e, v = F.col("event_id"), F.lit("structured_intel_packet_v1")
    return _events(spark, d).where("event_id is not null").select(
        "event_id", short_id("intel_pkt_family", e, v, F.lit(POLICY)).alias("family_id"), short_id("intel_pkt", e, v, F.lit(POLICY)).alias("packet_id"),
        content_sha(F.coalesce("body", F.lit(""))).alias("body_sha"), run_id(F.lit(POLICY), F.col("observed_at_ms")).alias("run_id"),
    )


def object_keys(spark, d):
    p = table(spark, d, "structured_packets").distinct()
    key = dated_key("structured-intel-packet", "structured_intel_packet_v1", F.col("structured_at_ms"), F.coalesce("raw_event_id", F.lit("unknown")), "packet_id", F.col("packet_id"), "/part-000001.jsonl")
    return p.select("packet_id", key.alias("object_key"), gates.key_error(key).alias("key_error"))


def key_errors(spark, d):
    """Malformed references of the market index, as written."""
    i = table(spark, d, "l1_index").distinct()
    return i.select("index_key", "canonical_manifest_key", gates.key_error(F.col("canonical_manifest_key")).alias("error")).where("error is not null")


def hash_sample(spark, d):
    return _events(spark, d).where("event_id is not null").select("event_id", sampled(F.col("event_id"), 0.15).alias("in_sample"))


def pointer_errors(spark, d):
    p = table(spark, d, "raw_event_pointers")
    return p.select("delivery_id", gates.pointer_error(p, "raw_intel_event_created_v2", "aws_s3_jsonl_record").alias("error"))


def forbidden_terms(spark, d):
    """Events whose title or body holds a forbidden term, with the title redacted."""
    e = _events(spark, d)
    return e.where(gates.forbidden(F.col("title")) | gates.forbidden(F.col("body"))).select("event_id", gates.redacted(F.col("title")).alias("title"))


def document_terms(spark, d):
    """Documents per language whose whole text holds a forbidden term."""
    docs = table(spark, d, "documents")
    return docs.groupBy("lang").agg(F.count("*").alias("n_docs"), F.count(F.when(gates.forbidden(F.col("text")), 1)).alias("n_with_term"))


def unprocessed_events(spark, d):
    """Events that no packet was made of, each once."""
    e = _events(spark, d).select("event_id").where("event_id is not null")
    return gates.unseen(e, table(spark, d, "structured_packets").select(F.col("raw_event_id").alias("event_id")), "event_id")


def jsonl_locators(spark, d):
    lines = table(spark, d, "raw_object_lines").select("object_key", "line_number", "payload").where("payload is not null").distinct()
    return gates.locators(lines, "object_key", "line_number", "payload")


def index_admission(spark, d):
    t = lambda n: table(spark, d, n).distinct()
    return market.admitted(t("l1_index"), t("l1_manifest"), t("l1_report")).select("index_key", "canonical_manifest_key", "l1_run_id", "finished_at_ms", "indexed_window_start_ms")


def _placed(spark, d):
    """Each event id once, with its basis time and symbols; of several rows the earliest."""
    e = _events(spark, d).where("event_id is not null and fetched_at_ms is not null").withColumn("symbols", rules.normalized_symbols(F.col("symbol_candidates")))
    basis = published_ms(F.col("published_at_ms"), F.col("fetched_at_ms"))
    return e.groupBy("event_id").agg(F.min(F.struct(basis.alias("basis_ms"), "symbols")).alias("m")).select("event_id", "m.*")


def window_radius_join(spark, d):
    windows = table(spark, d, "l1_index").where("status = 'success' and indexed_window_start_ms is not null").select(F.col("indexed_window_start_ms").alias("window_start_ms"))
    return market.around(_placed(spark, d), windows, GRID).select("event_id", "base_ms", "k", "window_start_ms")


def asof_window(spark, d):
    windows = table(spark, d, "l1_index").where("status = 'success' and indexed_window_start_ms is not null").select(F.col("indexed_window_start_ms").alias("window_start_ms"))
    return market.as_of(_placed(spark, d), windows, GRID).select("event_id", "base_ms", "asof_window_ms")


def first_slices(spark, d):
    s = table(spark, d, "market_symbol_summaries").select("slice_id", "symbol", "venue", "window_start_ms", "mid_price")
    return market.first_slices(s, "slice_id")


def context_status(spark, d):
    s = table(spark, d, "market_symbol_summaries").select("slice_id", "symbol", "venue", "window_start_ms")
    return market.context(_placed(spark, d), s, SLICE)


def story_clusters(spark, d):
    return stories.merge(rules.hints(_assessed(spark, d)))


def story_running(spark, d):
    return stories.running(_assessed(spark, d))


def latest_revisions(spark, d):
    return stories.latest(table(spark, d, "structured_packets"))


def health_by_tier(spark, d):
    p = table(spark, d, "structured_packets").distinct()
    n = lambda c: F.count(F.when(c, 1))
    return p.groupBy("model_tier_used").agg(
        F.count("*").alias("n_packets"), n(F.col("market_context_status").isin("pending", "unavailable")).alias("n_waiting"),
        n(F.array_contains("contradiction_flags", "rumor_vs_official")).alias("n_rumors"), n(F.col("revision") > 0).alias("n_revised"), F.avg("novelty_score").alias("mean_novelty"),
    )


def event_grid(spark, d):
    """Clicks and other events per day and type on a fixed grid."""
    e = table(spark, d, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return e.groupBy(floor_to(ms, 86_400_000).alias("day_ms"), "event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"), F.max("value").alias("max_value"))


def last_per_subject(spark, d):
    """Where a consumer that starts at the last message of each source begins."""
    p = table(spark, d, "raw_event_pointers").distinct()
    return p.groupBy("source_id").agg(F.max("delivery_id").alias("last_delivery_id"), F.min("delivery_id").alias("first_delivery_id"), F.count("*").alias("n"))


def keys_by_prefix(spark, d):
    """The first 20 index keys, by key, of each window family; the limit is the operator's."""
    from pyspark.sql import Window

    k = table(spark, d, "l1_index").select("index_key").where("index_key is not null").distinct().withColumn("prefix", F.substring_index("index_key", "/", 2))
    return k.withColumn("pos", F.row_number().over(Window.partitionBy("prefix").orderBy("index_key"))).where("pos <= 20")


def packet_times(spark, d):
    t = packets.times(rules.hints(_assessed(spark, d)))
    return t.select("event_id", "decision_available_at_ms", "relevant_from_ms", "relevant_to_ms", "source_quality_summary")


def text_evidence(spark, d):
    return packets.text_evidence(_assessed(spark, d))


def evidence_supported(spark, d):
    """Events per type, and how many have all their sentences in the first 50,000 characters of their text."""
    ok = packets.supported(F.col("evidence"), rules.text("title"), rules.text("body"))
    return _assessed(spark, d).groupBy("event_type").agg(F.count("*").alias("n_events"), F.count(F.when(ok, 1)).alias("n_supported"), F.sum(F.size("evidence")).alias("n_sentences"))


def packet_families(spark, d):
    p = table(spark, d, "structured_packets").distinct()
    return p.select("packet_id", packets.family_id(p).alias("family_id"), "revision")


def retry_schedule(spark, d):
    p = table(spark, d, "structured_packets").distinct()
    retry, expire = packets.retry_times(F.col("market_context_status"), F.col("decision_available_at_ms"))
    return p.select("packet_id", retry.alias("retry_after_ms"), expire.alias("expire_at_ms"))


def stories_applied(spark, d):
    made = rules.hints(_assessed(spark, d))
    made = made.withColumn("story_hint_key", stories.story_key(made))
    return packets.apply_stories(made.select("event_id", "story_hint_key").distinct(), stories.merge(made)).select("event_id", "cluster_id", "event_count", "conflict_level", "health")


def output_manifest(spark, d):
    lines = table(spark, d, "raw_object_lines").where("payload is not null").select("record_kind", "object_key", "line_number", "payload").distinct()
    return packets.output_manifest(lines, "object_key", "record_kind", "payload")


QUERIES = (
    packet_times, text_evidence, evidence_supported, packet_families, retry_schedule, stories_applied, output_manifest,
    rule_assessment, decision_matrix, rule_hints, symbols_normalized, evidence_pack, quality_gates, metric_evidence, symbol_trace, deterministic_ids,
    object_keys, key_errors, hash_sample, pointer_errors, forbidden_terms, document_terms, unprocessed_events, jsonl_locators, index_admission,
    window_radius_join, asof_window, first_slices, context_status, story_clusters, story_running, latest_revisions, health_by_tier, event_grid,
    last_per_subject, keys_by_prefix,
)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


# --- SQL -------------------------------------------------------------------------------

#: The SQL has its own copy of all fixed values, so that a wrong list in an operator shows.
SQL_EVIDENCE = ["list", "delist", "deposit", "withdraw", "hack", "exploit", "regulat", "proposal", "unlock", "funding", "partnership"]
SQL_HIGH_RISK = ["delisting", "incident", "regulatory", "deposit_withdrawal"]
SQL_METRIC_KEYS = [
    (["open_interest", "open interest"], ["open_interest", "open-interest"], ["open_interest", "openInterest", "value"]),
    (["funding"], ["funding"], ["last_funding_rate", "funding_rate", "lastFundingRate", "fundingRate", "value"]),
    (["liquidation"], ["liquidation"], ["liquidation", "liquidations", "liquidation_value", "notional", "value"]),
]
SQL_OTHER_METRIC = ["metric_value", "value"]
SQL_RANKED = ["listing", "delisting", "remove", "suspend", "withdrawal", "deposit", "hack", "exploit", "incident", "security", "regulatory", "sec", "unlock", "governance", "proposal", "partnership", "funding", "open interest"]
SQL_TYPES = [
    ("delisting", ["delist", "remove trading pair", "trading pair removal"]),
    ("listing", ["list", "listing", "new trading pair"]),
    ("deposit_withdrawal", ["deposit", "withdrawal", "suspend deposits", "suspend withdrawals"]),
    ("incident", ["exploit", "hack", "breach", "incident", "outage", "halt"]),
    ("regulatory", ["sec", "cftc", "lawsuit", "regulator", "regulatory", "sanction"]),
    ("token_unlock", ["unlock", "vesting"]),
    ("governance", ["governance", "proposal", "vote"]),
    ("partnership", ["partnership", "integrates", "collaboration"]),
    ("funding_shift", ["funding rate", "open interest", "liquidation"]),
    ("social_backlash", ["backlash", "criticism", "controversy"]),
    ("social_hype", ["hype", "viral", "surge in mentions"]),
    ("macro_event", ["fomc", "inflation", "cpi", "rate cut", "fed"]),
]
SQL_FORBIDDEN = ["buy", "sell", "long", "short", "position_size", "live_ready", "execution_approved"]
SQL_EMITTED = "normalized_market_slice_v1"
SQL_PROJECTIONS = ["market_data_quality_summary_key", "market_feature_delta_key", "market_feature_delta_summary_key", "market_regime_context_key", "symbol_universe_snapshot_key"]
SQL_RANKS = ["available_symbol_context", "nearest_available", "symbol_context_only", "stale_but_usable", "available", "available_general_context", "pending", "unavailable"]
SQL_FLAGS = ["time_mismatch", "symbol_ambiguity", "source_claim_conflict", "rumor_vs_official", "title_body_mismatch", "evidence_weak"]
SQL_STOPWORDS = ["about", "after", "amid", "from", "into", "over", "that", "this", "with", "will"]
SQL_WIDTHS = {"minutes": 1800000, "hours": 21600000, "day": 86400000, "multi_day": 259200000, "structural": 1209600000}

_UP, _LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
low = lambda x: f"translate({x}, {_UP}, {_LOW})"
up = lambda x: f"translate({x}, {_LOW}, {_UP})"
#: White space of any Unicode kind; RE2's \s is ASCII only.
_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
trim = lambda x: rf"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"
txt = lambda c: f"coalesce({c}, '')"
has = lambda x, words: "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"
isin = lambda x, words: f"{x} IN (" + ", ".join(f"'{w}'" for w in words) + ")"
_RAW = "list_transform(coalesce(symbol_candidates, CAST([] AS VARCHAR[])), lambda s: " + up(trim("s")) + ")"
_SYMBOLS = f"list_sort(list_distinct(list_filter({_RAW}, lambda s: regexp_full_match(s, '[A-Z0-9]{{1,12}}'))))"
_SOURCE = f"CASE WHEN {trim(txt('body'))} = '' THEN {txt('title')} ELSE body END"
_EVIDENCE = f"list_slice(list_filter(list_transform(string_split_regex({_SOURCE}, '[.\n]'), lambda s: {trim('s')}), lambda s: strlen(s) >= 12 AND {has(low('s'), SQL_EVIDENCE)}), 1, 3)"
_TYPE = "CASE " + " ".join(f"WHEN {has('t', w)} THEN '{n}'" for n, w in SQL_TYPES) + " ELSE 'other' END"
_KIND = lambda *names: isin("event_type", names)
_E = "e AS (SELECT DISTINCT * FROM raw_events)"
_A = f"""
{_E}, a0 AS (
  SELECT *, {low(f"{txt('title')} || ' ' || {txt('body')}")} AS t, {_SYMBOLS} AS symbols, {_EVIDENCE} AS evidence FROM e
), a1 AS (
  SELECT *, {_TYPE} AS event_type, CASE WHEN len(symbols) = 0 THEN 'weak' WHEN contains({txt('source_category')}, 'project') THEN 'strong' ELSE 'moderate' END AS symbol_band FROM a0
), a2 AS (
  SELECT *, list_filter([CASE WHEN contains({low(txt('title'))}, 'rumor') OR contains(t, 'unconfirmed') THEN 'rumor_vs_official' END,
    CASE WHEN len(symbols) > 3 THEN 'symbol_ambiguity' END, CASE WHEN len(evidence) = 0 AND event_type <> 'other' THEN 'evidence_weak' END], lambda f: f IS NOT NULL) AS flags FROM a1
), a3 AS (
  SELECT *, greatest(least(CASE WHEN event_type = 'other' THEN 0.35::DOUBLE WHEN {_KIND('listing', 'delisting', 'deposit_withdrawal')} THEN 0.72::DOUBLE
    WHEN {_KIND('incident', 'regulatory')} THEN 0.62::DOUBLE ELSE 0.55::DOUBLE END
    + CASE WHEN len(evidence) > 0 THEN 0.12::DOUBLE ELSE 0::DOUBLE END + CASE WHEN symbol_band = 'strong' THEN 0.08::DOUBLE ELSE 0::DOUBLE END
    - CASE WHEN len(flags) > 0 THEN 0.2::DOUBLE ELSE 0::DOUBLE END, 1::DOUBLE), 0::DOUBLE) AS confidence FROM a2
), a AS (
  SELECT *, CASE WHEN confidence >= 0.8::DOUBLE THEN 'high' WHEN confidence >= 0.55::DOUBLE THEN 'medium' ELSE 'low' END AS confidence_band,
    CASE WHEN len(flags) > 0 THEN 'conflicted' WHEN confidence >= 0.8::DOUBLE THEN 'high_confidence_structured'
      WHEN len(symbols) = 0 AND confidence >= 0.45::DOUBLE THEN 'general_market_context' WHEN confidence >= 0.55::DOUBLE THEN 'low_confidence_structured'
      WHEN {_KIND(*SQL_HIGH_RISK)} THEN 'unsupported_or_weak' ELSE 'irrelevant_or_noise' END AS decision,
    CASE WHEN contains({txt('source_category')}, 'official') OR contains({txt('source_category')}, 'project') THEN 0.72::DOUBLE WHEN event_type = 'other' THEN 0.35::DOUBLE ELSE 0.58::DOUBLE END AS novelty_score FROM a3
)"""
_PACK = f"""
WITH {_E}, r AS (
  SELECT event_id, row_number() OVER () AS rid, symbol_candidates, {txt('title')} AS title, {txt('body')} AS body,
    CASE WHEN {has(txt('source_category'), ['notice', 'exchange'])} THEN 2 ELSE 0 END + CASE WHEN {txt('trust_tier')} = 'T1' THEN 1 ELSE 0 END AS bonus FROM e
), s AS (
  SELECT *, list_concat([title], flatten(list_transform(list_transform(string_split(body, chr(10)), lambda x: {trim('x')}), lambda x: regexp_extract_all(x, '[^.!?。]*[.!?。]|[^.!?。]+$')))) AS parts FROM r
), u AS (SELECT rid, event_id, symbol_candidates, bonus, unnest(parts) AS raw, generate_subscripts(parts, 1) AS ord FROM s),
n AS (SELECT *, {trim(f"regexp_replace(raw, '{_WS}+', ' ', 'g')")} AS excerpt FROM u),
k AS (SELECT *, row_number() OVER (PARTITION BY rid, {low('excerpt')} ORDER BY ord) AS dup FROM n WHERE length(excerpt) >= 12),
c AS (
  SELECT *, CASE WHEN ord = 1 THEN 10 ELSE 0 END + bonus + {' + '.join(f"CASE WHEN contains({low('excerpt')}, '{w}') THEN 4 ELSE 0 END" for w in SQL_RANKED)}
    + 3 * len(list_filter({_RAW}, lambda y: y <> '' AND contains({up('excerpt')}, y))) AS score FROM k WHERE dup = 1
), o AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, ord) AS pos FROM c)
SELECT event_id, 'E' || pos AS rank, substring(excerpt, 1, 420) AS excerpt, CAST(score AS INTEGER) AS score FROM o WHERE pos <= 10"""
_SQ, _CQ, _SCOPE = "coalesce(source_quality, 'unknown')", "coalesce(content_quality, 'unknown')", txt("source_relevance_scope")
_NUM = f"({_SQ} = 'market_snapshot' OR {_CQ} = 'numeric_observation')"
_TITLE_ONLY = isin(_CQ, ["title_only", "metadata_fallback"])
_QUALITY = f"""
WITH {_E} SELECT event_id, {_NUM} AS is_numeric,
  {has(low(txt('source_id')), ['funding', 'open_interest', 'open-interest', 'liquidation'])} OR contains({low("coalesce(content_kind, 'unknown')")}, 'derivatives') AS is_derivatives,
  {_TITLE_ONLY} OR {isin(_SQ, ['global_symbol_scan', 'metadata_fallback'])} OR {_SCOPE} = 'global_symbol_scan' AS is_broad_scan,
  {txt('trust_tier')} = 'T0' OR {has(txt('source_id'), ['official', 'exchange'])} OR {has(txt('source_category'), ['official', 'exchange', 'project'])}
    OR {isin(_SQ, ['official_source', 'official_notice', 'exchange_notice', 'project_notice', 'trusted_symbol_match'])} AS is_trusted,
  {isin(_SQ, ['community_reaction', 'market_snapshot'])} OR {_TITLE_ONLY} AS needs_model,
  coalesce(content_quality_score < 45, false) OR {_SCOPE} = 'global_symbol_scan' AS needs_escalation,
  {has(low(f"{txt('source_id')} || ' ' || {txt('source_category')} || ' ' || {_SQ}"), ['official', 'exchange', 'binance', 'upbit', 'bithumb', 'project', 'notice'])} AS is_official,
  array_to_string(list_filter([CASE WHEN {_NUM} THEN 'baseline_missing' END, CASE WHEN {_NUM} THEN 'single_numeric_snapshot' END, 'single_source_only',
    CASE WHEN {_CQ} = 'title_only' THEN 'title_only' END, CASE WHEN len({_SYMBOLS}) > 1 OR coalesce(len(symbol_candidates), 0) > 1 THEN 'symbol_ambiguous' END,
    CASE WHEN {has(_SQ, ['syndicated', 'duplicate'])} THEN 'duplicate_or_syndicated_source' END], lambda r: r IS NOT NULL), ',') AS reasons FROM e"""
_BODY = r"CASE WHEN json_valid(body) AND regexp_matches(coalesce(body, ''), '^\s*\{') THEN body END"
_VALUE = lambda keys: "coalesce(" + ", ".join(f"CASE WHEN regexp_full_match(json_extract_string(j, '$.{k}'), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') AND isfinite(TRY_CAST(json_extract_string(j, '$.{k}') AS DOUBLE)) THEN TRY_CAST(json_extract_string(j, '$.{k}') AS DOUBLE) END" for k in keys) + ")"
_METRICS = f"""
WITH {_E}, n AS (SELECT event_id, coalesce(event_category_hint, content_kind, 'unknown') AS metric_name, source_id AS venue, {low(txt('source_id'))} AS src, {_BODY} AS j, {_SYMBOLS} AS symbols FROM e WHERE {_NUM}),
v AS (SELECT *, CASE {' '.join(f"WHEN {has(low('metric_name'), a)} OR {has('src', b)} THEN {_VALUE(k)}" for a, b, k in SQL_METRIC_KEYS)} ELSE {_VALUE(SQL_OTHER_METRIC)} END AS value FROM n)
SELECT event_id, metric_name, venue, value, unnest(CASE WHEN len(symbols) = 0 THEN [NULL] ELSE symbols END) AS symbol FROM v"""
_TRACE = f"""
WITH {_E}, r AS (SELECT event_id, array_to_string(list_sort(list_distinct(list_filter({_RAW}, lambda s: s <> ''))), ',') AS raw_mentions, {_SYMBOLS} AS y FROM e),
x AS (SELECT event_id, raw_mentions, len(y) AS n, unnest(CASE WHEN len(y) = 0 THEN [NULL] ELSE y END) AS symbol FROM r)
SELECT event_id, raw_mentions, symbol, CASE WHEN symbol IS NULL THEN '' ELSE symbol || 'USDT,' || symbol || 'USD,KRW-' || symbol END AS venue_symbols,
  CASE WHEN n = 0 THEN 'no_resolved_symbol' WHEN n > 1 THEN 'multiple_candidate_symbols' END AS ambiguity FROM x"""


def short(prefix: str, *parts: str) -> str:
    return f"'{prefix}_' || substring(sha256({' || '.join(f'{p} || chr(0)' for p in parts)}), 1, 24)"


_TIME = lambda ms, f: f"strftime(make_timestamp(({ms}) * 1000), '{f}')"
_SEGMENT = lambda x: f"CASE WHEN regexp_replace({x}, '[^A-Za-z0-9._-]', '_', 'g') IN ('', '.', '..') THEN '_' ELSE regexp_replace({x}, '[^A-Za-z0-9._-]', '_', 'g') END"
_KEY_ERROR = lambda k: rf"CASE WHEN {k} IS NULL OR {k} = '' THEN 'empty' WHEN regexp_matches({k}, '^\s|\s$') THEN 'edge_space' WHEN strlen({k}) > 1024 THEN 'too_long' WHEN {k} LIKE '/%' OR {k} LIKE 's3://%' THEN 'absolute' WHEN regexp_matches({k}, '[?#\\\x00-\x20\x7f]') THEN 'bad_character' WHEN regexp_matches({k}, '(^|/)(\.\.?)?(/|$)') THEN 'bad_segment' END"
_BLANK = lambda x: f"({x} IS NULL OR {trim(x)} = '')"
_TERMS = r"(^|[^A-Za-z0-9_])(" + "|".join(SQL_FORBIDDEN) + r")($|[^A-Za-z0-9_])"
_BAD = lambda c: f"coalesce(regexp_matches({c}, '(?i){_TERMS}'), false)"
#: Two passes, as neighbouring terms share the character between them.
_REDACT = lambda c: f"regexp_replace(regexp_replace({c}, '(?i){_TERMS}', '\\1[blocked_output_term]\\3', 'g'), '(?i){_TERMS}', '\\1[blocked_output_term]\\3', 'g')"
#: Publication time in milliseconds whatever its unit; null where it is null or 0.
_PUBLISHED = """CASE WHEN published_at_ms = 0 THEN NULL WHEN abs(published_at_ms) < 100000000000 THEN published_at_ms * 1000 WHEN abs(published_at_ms) < 100000000000000 THEN published_at_ms
  WHEN abs(published_at_ms) < 100000000000000000 THEN published_at_ms // 1000 ELSE published_at_ms // 1000000 END"""
_PLACED = f"""
WITH {_E}, b AS (
  SELECT event_id, coalesce({_PUBLISHED}, fetched_at_ms) AS basis_ms, {_SYMBOLS} AS symbols
  FROM e WHERE event_id IS NOT NULL AND fetched_at_ms IS NOT NULL
), p AS (SELECT event_id, basis_ms, symbols FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY basis_ms, symbols) AS k FROM b) WHERE k = 1),
w AS (SELECT DISTINCT indexed_window_start_ms AS s FROM l1_index WHERE status = 'success' AND indexed_window_start_ms IS NOT NULL),
g AS (SELECT event_id, basis_ms - basis_ms % {GRID} AS base_ms FROM p)"""
_CONTEXT = _PLACED + f""", x AS (SELECT DISTINCT window_start_ms AS s FROM market_symbol_summaries),
h AS (SELECT event_id, basis_ms - basis_ms % {SLICE} AS base_ms, symbols FROM p),
c AS (
  SELECT h.event_id, base_ms, s FROM h JOIN x ON s IN (base_ms - {SLICE}, base_ms, base_ms + {SLICE})
  UNION SELECT h.event_id, base_ms, s FROM h ASOF JOIN x ON h.base_ms >= x.s WHERE s >= base_ms - 21600000
), m AS (SELECT DISTINCT window_start_ms AS s, symbol, venue, unnest([upper(symbol), upper(symbol) || 'USDT']) AS wanted FROM market_symbol_summaries),
n AS (SELECT c.event_id, c.s, count(DISTINCT m.symbol || ':' || m.venue) AS n FROM c JOIN (SELECT event_id, unnest(symbols) AS y FROM p) q ON c.event_id = q.event_id JOIN m ON m.s = c.s AND m.wanted = q.y GROUP BY ALL),
t AS (SELECT c.*, coalesce(n.n, 0) AS n FROM c LEFT JOIN n ON c.event_id = n.event_id AND c.s = n.s),
z AS (SELECT *, CASE WHEN n = 0 THEN 6 WHEN s = base_ms THEN 1 WHEN base_ms - s > 900000 THEN 4 ELSE 2 END AS r FROM t),
best AS (SELECT event_id, min(r) AS r, count(*) AS n_windows, min(s) AS first_window_ms, CAST(sum(n) AS BIGINT) AS n_slices FROM z GROUP BY event_id)
SELECT p.event_id, coalesce([{', '.join(f"'{r}'" for r in SQL_RANKS)}][r], 'pending') AS status, coalesce(n_windows, 0) AS n_windows, first_window_ms, coalesce(n_slices, 0) AS n_slices
FROM p LEFT JOIN best ON p.event_id = best.event_id"""
_SIG = f"list_filter(string_split_regex({low(txt('title'))}, '[^a-z0-9]+'), lambda w: strlen(w) >= 4 AND w NOT IN ({', '.join(f"'{w}'" for w in SQL_STOPWORDS)}))"
_HINT = short(
    "story_hint", f"coalesce({_TIME(f'coalesce({_PUBLISHED}, fetched_at_ms)', '%Y-%m-%d')}, '')", "event_type",
    "CASE WHEN len(symbols) > 0 THEN array_to_string(symbols, ',') ELSE 'general' END",
    f"CASE WHEN len(symbols) > 0 THEN event_type WHEN len({_SIG}) > 0 THEN array_to_string(list_slice({_SIG}, 1, 8), '_') ELSE 'untitled' END",
)
_STORY = f"""WITH {_A}, s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY story_hint_key, event_id ORDER BY observed_at_ms NULLS LAST, source_id NULLS FIRST, trust_tier NULLS FIRST) AS first
  FROM (SELECT *, {_HINT} AS story_hint_key FROM a)) WHERE first = 1)"""
_MERGED = _STORY + f""", g AS (
  SELECT story_hint_key, count(*) AS event_count, count(DISTINCT source_id) AS source_count, list_sort(list(DISTINCT event_type)) AS types,
    list_distinct(list_concat(flatten(list(flags)), CASE WHEN count(DISTINCT event_type) > 1 THEN ['source_claim_conflict'] ELSE CAST([] AS VARCHAR[]) END)) AS f,
    max(observed_at_ms) AS last_updated_ms, min({_PUBLISHED}) AS first_published_ms, max(novelty_score) AS novelty_score FROM s GROUP BY story_hint_key
), t AS (
  SELECT story_hint_key, string_agg(coalesce(trust_tier, 'unknown') || '=' || n, ',' ORDER BY trust_tier NULLS FIRST) AS trust_mix
  FROM (SELECT story_hint_key, trust_tier, count(*) AS n FROM s GROUP BY ALL) GROUP BY story_hint_key
), o AS (SELECT *, list_filter([{', '.join(f"'{x}'" for x in SQL_FLAGS)}], lambda x: list_contains(f, x)) AS fl FROM g)
SELECT o.story_hint_key, {short('story', 'o.story_hint_key', "'v1'")} AS cluster_id, event_count, source_count,
  CASE WHEN len(types) = 1 THEN types[1] ELSE 'mixed_topic_conflict' END AS primary_topic, array_to_string(types, ',') AS topics, array_to_string(fl, ',') AS flags,
  CASE WHEN list_contains(fl, 'source_claim_conflict') OR list_contains(fl, 'rumor_vs_official') THEN 'high' WHEN len(fl) > 0 THEN 'medium' WHEN source_count > 1 THEN 'low' ELSE 'none' END AS conflict_level,
  trust_mix, last_updated_ms, first_published_ms, novelty_score FROM o JOIN t ON o.story_hint_key = t.story_hint_key"""
_ADMITTED = f"""
SELECT DISTINCT i.index_key, i.canonical_manifest_key, i.l1_run_id, i.finished_at_ms, i.indexed_window_start_ms FROM l1_index i
JOIN l1_manifest m ON i.canonical_manifest_key = m.manifest_key JOIN l1_report r ON m.report_key = r.report_key
WHERE i.status = 'success' AND i.schema_version = 'l1_index_pointer_v1' AND i.schema_version_emitted = '{SQL_EMITTED}'
  AND (i.indexed_window_start_ms IS NULL OR (i.indexed_window_start_ms >= i.input_time_range_start_ms AND i.indexed_window_end_ms <= i.input_time_range_end_ms))
  AND m.schema_version = 'l1_manifest_v1' AND m.status = 'success' AND m.l1_run_id = i.l1_run_id AND m.schema_version_emitted = '{SQL_EMITTED}'
  AND m.input_time_range_start_ms <= i.input_time_range_start_ms AND m.input_time_range_end_ms >= i.input_time_range_end_ms
  AND len(m.output_object_keys) > 0 AND m.output_record_count = m.slice_count_total
  AND r.schema_version = 'normalization_report_v1' AND r.status = 'success' AND r.l1_run_id = i.l1_run_id
  AND r.input_time_range_start_ms = m.input_time_range_start_ms AND r.input_time_range_end_ms = m.input_time_range_end_ms
  AND r.schema_version_emitted = '{SQL_EMITTED}' AND r.manifest_key = i.canonical_manifest_key
  AND {' AND '.join(f'r.{c} IS NOT DISTINCT FROM m.{c}' for c in ('output_object_keys', *SQL_PROJECTIONS))}"""


_DIRECT = f"""len(evidence) = 0 AND coalesce(len(symbol_candidates), 0) = 1 AND {_SCOPE} = 'direct_asset' AND coalesce(direct_asset_count, 0) = 1
  AND {_CQ} NOT IN ('title_only', 'metadata_fallback', 'unknown') AND coalesce(content_quality_score >= 45, true)
  AND len(string_split({trim(f"regexp_replace({txt('body')}, '{_WS}+', ' ', 'g')")}, ' ')) >= 8"""
_STAND_IN = _PACK.replace(f"WITH {_E},", f"WITH {_A}, z AS (SELECT * FROM a WHERE {_DIRECT}),").replace(" FROM e\n), s AS", " FROM z\n), s AS").replace(
    "SELECT event_id, 'E' || pos AS rank, substring(excerpt, 1, 420) AS excerpt, CAST(score AS INTEGER) AS score FROM o WHERE pos <= 10",
    f"""SELECT event_id, CAST(pos - 1 AS INTEGER) AS position, 'source_excerpt' AS kind, substring(excerpt, 1, 360) AS sentence FROM o WHERE pos <= 2
UNION ALL SELECT event_id, CAST(generate_subscripts(ev, 1) - 1 AS INTEGER), 'source_sentence', unnest(ev) FROM (SELECT event_id, list_filter(evidence, lambda s: {trim('s')} <> '') AS ev FROM a)""",
)


def oracle_sql() -> dict[str, str]:
    widths = " ".join(f"WHEN '{k}' THEN {w}" for k, w in SQL_WIDTHS.items())
    decay = f"CASE WHEN {_KIND('incident', 'regulatory')} THEN 'multi_day' WHEN event_type = 'macro_event' THEN 'day' ELSE 'hours' END"
    lost = "list_filter(source_event_ids, lambda s: " + trim("s") + " <> '')[1]"
    named = lambda c: f"CASE WHEN NOT {_BLANK(c)} THEN {c} END"
    waits = "CASE WHEN market_context_status IN ('pending', 'unavailable') THEN decision_available_at_ms + {} END"
    more = {
        "packet_times": f"""WITH {_A} SELECT event_id, greatest({_PUBLISHED}, fetched_at_ms, observed_at_ms) AS decision_available_at_ms, coalesce({_PUBLISHED}, fetched_at_ms) AS relevant_from_ms,
  coalesce({_PUBLISHED}, fetched_at_ms) + CASE {decay} {widths} END AS relevant_to_ms, {txt('trust_tier')} || ' source ' || {txt('source_id')} || ' freshness_ms=' || (observed_at_ms - fetched_at_ms)
  || ' content_quality=' || {_CQ} || ' score=' || coalesce(CAST(content_quality_score AS VARCHAR), 'unknown') || ' source_quality=' || {_SQ} || ' relevance_scope=' || coalesce(source_relevance_scope, 'unknown') AS source_quality_summary FROM a""",
        "text_evidence": _STAND_IN,
        "evidence_supported": f"""WITH {_A}, s AS (SELECT event_type, evidence, {low(f"{txt('title')} || chr(10) || chr(10) || substring({txt('body')}, 1, 50000)")} AS src FROM a)
  SELECT event_type, count(*) AS n_events, count(CASE WHEN len(list_filter(evidence, lambda x: NOT contains(src, {low('x')}))) = 0 THEN 1 END) AS n_supported, CAST(sum(len(evidence)) AS BIGINT) AS n_sentences FROM s GROUP BY event_type""",
        "packet_families": f"SELECT packet_id, coalesce({named('packet_family_id')}, {named('raw_event_id')}, {lost}, packet_id) AS family_id, revision FROM (SELECT DISTINCT * FROM structured_packets)",
        "retry_schedule": f"SELECT packet_id, {waits.format(300000)} AS retry_after_ms, {waits.format(21600000)} AS expire_at_ms FROM (SELECT DISTINCT * FROM structured_packets)",
        "stories_applied": f"""WITH m AS ({_MERGED}), k AS (WITH {_A} SELECT DISTINCT event_id, {_HINT} AS story_hint_key FROM a)
  SELECT event_id, cluster_id, event_count, conflict_level, CASE WHEN conflict_level = 'high' THEN 'degraded' ELSE 'healthy' END AS health FROM k JOIN m ON k.story_hint_key = m.story_hint_key""",
        "output_manifest": "SELECT record_kind, object_key, count(*) AS record_count, CAST(sum(strlen(payload) + 1) AS BIGINT) AS byte_count FROM (SELECT DISTINCT record_kind, object_key, line_number, payload FROM raw_object_lines WHERE payload IS NOT NULL) GROUP BY ALL",
    }
    pick = lambda c: f"array_to_string({c}, '|') AS {c}"
    return more | {
        "rule_assessment": f"WITH {_A} SELECT event_id, event_type, {pick('symbols')}, symbol_band, {pick('evidence')}, {pick('flags')}, confidence, confidence_band, decision FROM a",
        "decision_matrix": f"WITH {_A} SELECT event_type, decision, count(*) AS n_events, avg(confidence) AS mean_confidence FROM a GROUP BY ALL",
        "rule_hints": f"""WITH {_A} SELECT event_id, CASE WHEN {_KIND('macro_event', 'regulatory')} THEN 'risk_off' WHEN event_type = 'social_hype' THEN 'social_mania' WHEN event_type = 'other' THEN 'uncertain' ELSE 'event_driven' END AS regime_hint,
  CASE WHEN {_KIND('incident', 'regulatory', 'delisting')} THEN 'structural_break_possible' WHEN event_type = 'other' THEN 'noise_only' ELSE 'watch_only' END AS scenario_hint,
  CASE WHEN {_KIND('incident', 'regulatory')} THEN 'multi_day' WHEN event_type = 'macro_event' THEN 'day' ELSE 'hours' END AS decay_hint, novelty_score FROM a""",
        "symbols_normalized": f"WITH {_E}, s AS (SELECT event_id, unnest({_SYMBOLS}) AS symbol FROM e) SELECT symbol, count(*) AS n_events, count(DISTINCT event_id) AS n_ids FROM s GROUP BY symbol",
        "evidence_pack": _PACK,
        "quality_gates": _QUALITY,
        "metric_evidence": _METRICS,
        "symbol_trace": _TRACE,
        "deterministic_ids": f"""WITH {_E} SELECT event_id, {short('intel_pkt_family', 'event_id', "'structured_intel_packet_v1'", f"'{POLICY}'")} AS family_id,
  {short('intel_pkt', 'event_id', "'structured_intel_packet_v1'", f"'{POLICY}'")} AS packet_id, 'sha256:' || sha256({txt('body')}) AS body_sha,
  'intel-l1-' || {short('policy', f"'{POLICY}'")} || '-' || {_TIME('observed_at_ms', '%Y%m%dT%H%M%S%gZ')} AS run_id FROM e WHERE event_id IS NOT NULL""",
        "object_keys": f"""WITH k AS (SELECT DISTINCT * FROM structured_packets), o AS (SELECT packet_id, 'structured-intel-packet/schema=structured_intel_packet_v1/dt=' || {_TIME('structured_at_ms', '%Y-%m-%d')}
  || '/hour=' || {_TIME('structured_at_ms', '%H')} || '/raw_event_id=' || {_SEGMENT("coalesce(raw_event_id, 'unknown')")} || '/packet_id=' || {_SEGMENT('packet_id')} || '/part-000001.jsonl' AS object_key FROM k)
  SELECT packet_id, object_key, {_KEY_ERROR('object_key')} AS key_error FROM o""",
        "key_errors": f"SELECT * FROM (SELECT DISTINCT index_key, canonical_manifest_key, {_KEY_ERROR('canonical_manifest_key')} AS error FROM (SELECT DISTINCT * FROM l1_index)) WHERE error IS NOT NULL",
        "hash_sample": f"WITH {_E} SELECT event_id, CAST(('0x' || substring(sha256(event_id), 1, 8))::UBIGINT AS DOUBLE) / 4294967295::DOUBLE < 0.15::DOUBLE AS in_sample FROM e WHERE event_id IS NOT NULL",
        "pointer_errors": f"""SELECT delivery_id, CASE WHEN schema_version IS DISTINCT FROM 'raw_intel_event_created_v2' THEN 'schema_version' WHEN {_BLANK('event_id')} THEN 'event_id'
  WHEN storage_ref.kind IS DISTINCT FROM 'aws_s3_jsonl_record' THEN 'kind' WHEN {_BLANK('storage_ref.bucket')} OR {_BLANK('storage_ref.key')} THEN 'location'
  WHEN coalesce(storage_ref.byte_length <= 0, true) THEN 'byte_length' WHEN NOT coalesce(starts_with(storage_ref.content_sha256, 'sha256:'), false) THEN 'content_sha256' END AS error FROM raw_event_pointers""",
        "forbidden_terms": f"WITH {_E} SELECT event_id, {_REDACT('title')} AS title FROM e WHERE {_BAD('title')} OR {_BAD('body')}",
        "document_terms": f"SELECT lang, count(*) AS n_docs, count(CASE WHEN {_BAD('text')} THEN 1 END) AS n_with_term FROM documents GROUP BY lang",
        "unprocessed_events": "SELECT DISTINCT event_id FROM raw_events WHERE event_id IS NOT NULL AND event_id NOT IN (SELECT raw_event_id FROM structured_packets WHERE raw_event_id IS NOT NULL)",
        "jsonl_locators": """WITH l AS (SELECT DISTINCT object_key, line_number, payload FROM raw_object_lines WHERE payload IS NOT NULL)
  SELECT object_key, CAST(row_number() OVER w AS INTEGER) AS line_no, CAST(coalesce(sum(strlen(payload) + 1) OVER (PARTITION BY object_key ORDER BY line_number, payload ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS byte_offset,
  strlen(payload) AS byte_length, 'sha256:' || sha256(payload) AS content_sha256 FROM l WINDOW w AS (PARTITION BY object_key ORDER BY line_number, payload)""",
        "index_admission": _ADMITTED,
        "window_radius_join": _PLACED + f" SELECT event_id, base_ms, CAST((s - base_ms) // {GRID} AS INTEGER) AS k, s AS window_start_ms FROM g JOIN w ON s IN (base_ms - {GRID}, base_ms, base_ms + {GRID})",
        "asof_window": _PLACED + " SELECT event_id, base_ms, s AS asof_window_ms FROM g ASOF JOIN w ON g.base_ms >= w.s WHERE s >= base_ms - 21600000",
        "first_slices": "SELECT window_start_ms, symbol, venue, slice_id, CASE WHEN NOT isnan(mid_price) THEN mid_price END AS mid_price FROM (SELECT *, row_number() OVER (PARTITION BY window_start_ms, symbol, venue ORDER BY slice_id) AS k FROM (SELECT DISTINCT window_start_ms, symbol, venue, slice_id, mid_price FROM market_symbol_summaries)) WHERE k = 1",
        "context_status": _CONTEXT,
        "story_clusters": _MERGED,
        "story_running": _STORY
        + """, n AS (SELECT *, CAST(row_number() OVER (PARTITION BY story_hint_key, source_id ORDER BY observed_at_ms, event_id) = 1 AS INTEGER) AS new FROM s)
  SELECT event_id, story_hint_key, row_number() OVER w AS events_so_far, CAST(sum(new) OVER w AS BIGINT) AS sources_so_far, max(observed_at_ms) OVER w AS last_updated_ms
  FROM n WINDOW w AS (PARTITION BY story_hint_key ORDER BY observed_at_ms, event_id ROWS UNBOUNDED PRECEDING)""",
        "latest_revisions": "SELECT packet_family_id, revision, packet_id, market_context_status, n_revisions FROM (SELECT *, row_number() OVER (PARTITION BY packet_family_id ORDER BY revision DESC, packet_id DESC, market_context_status DESC) AS k, count(DISTINCT packet_id) OVER (PARTITION BY packet_family_id) AS n_revisions FROM structured_packets) WHERE k = 1",
        "health_by_tier": """SELECT model_tier_used, count(*) AS n_packets, count(CASE WHEN market_context_status IN ('pending', 'unavailable') THEN 1 END) AS n_waiting,
  count(CASE WHEN list_contains(contradiction_flags, 'rumor_vs_official') THEN 1 END) AS n_rumors, count(CASE WHEN revision > 0 THEN 1 END) AS n_revised, avg(novelty_score) AS mean_novelty FROM (SELECT DISTINCT * FROM structured_packets) GROUP BY model_tier_used""",
        "event_grid": "SELECT epoch_ms(ts) - epoch_ms(ts) % 86400000 AS day_ms, event_type, count(*) AS n, count(DISTINCT user_id) AS n_users, max(value) AS max_value FROM events GROUP BY ALL",
        "last_per_subject": "SELECT source_id, max(delivery_id) AS last_delivery_id, min(delivery_id) AS first_delivery_id, count(*) AS n FROM (SELECT DISTINCT * FROM raw_event_pointers) GROUP BY source_id",
        "keys_by_prefix": "SELECT index_key, prefix, CAST(pos AS INTEGER) AS pos FROM (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY index_key) AS pos FROM (SELECT DISTINCT index_key, array_to_string(list_slice(string_split(index_key, '/'), 1, 2), '/') AS prefix FROM l1_index WHERE index_key IS NOT NULL)) WHERE pos <= 20",
    }
