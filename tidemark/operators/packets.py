"""Packets built from assessed events: times, evidence, identifiers, stories, responses of a provider."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import any_of, ascii_lower, blank, published_ms, squeeze
from tidemark.operators.rules import excerpts, text

MINUTE = 60_000
# How long an event stays relevant, by decay hint.
WIDTHS = {"minutes": 30 * MINUTE, "hours": 360 * MINUTE, "day": 1440 * MINUTE, "multi_day": 3 * 1440 * MINUTE, "structural": 14 * 1440 * MINUTE}


def times(hinted: DataFrame, structured: str = "observed_at_ms") -> DataFrame:
    """When a decision could use the event, from when to when it is relevant, and where it came from.

    Publication times count in whatever unit they were written; null or 0 is none.
    """
    start = published_ms(F.col("published_at_ms"), F.col("fetched_at_ms"))
    width = F.coalesce(*[F.when(F.col("decay_hint") == k, F.lit(w).cast("long")) for k, w in WIDTHS.items()])
    unknown = lambda c: F.coalesce(F.col(c), F.lit("unknown"))
    summary = F.concat(
        text("trust_tier"), F.lit(" source "), text("source_id"), F.lit(" freshness_ms="), (F.col(structured) - F.col("fetched_at_ms")).cast("string"),
        F.lit(" content_quality="), unknown("content_quality"), F.lit(" score="), F.coalesce(F.col("content_quality_score").cast("string"), F.lit("unknown")),
        F.lit(" source_quality="), unknown("source_quality"), F.lit(" relevance_scope="), unknown("source_relevance_scope"),
    )
    return hinted.withColumns({
        "decision_available_at_ms": F.greatest(start, "fetched_at_ms", "observed_at_ms", structured),
        "relevant_from_ms": start, "relevant_to_ms": start + width, "source_quality_summary": summary,
    })


def retry_times(status: Column, available: Column, retry_ms: int = 5 * MINUTE, expire_ms: int = 360 * MINUTE) -> tuple[Column, Column]:
    """When a packet that waits for market context is looked at again, and when it gives up; else nulls."""
    waits = status.isin("pending", "unavailable")
    return F.when(waits, available + F.lit(max(retry_ms, 1))), F.when(waits, available + F.lit(max(expire_ms, 1)))


def text_evidence(assessed: DataFrame) -> DataFrame:
    """(event_id, position, kind, sentence): an event's evidence sentences, or its two best excerpts.

    Excerpts stand in only for one candidate symbol that the text is directly about, in
    a body of eight words or more that is neither a bare title nor poor.
    """
    own = assessed.select("event_id", F.posexplode(F.filter("evidence", lambda s: ~blank(s))).alias("position", "sentence")).withColumn("kind", F.lit("source_sentence"))
    quality = F.coalesce("content_quality", F.lit("unknown"))
    direct = (
        (F.size("evidence") == 0) & (F.coalesce(F.size("symbol_candidates"), F.lit(0)) == 1) & (text("source_relevance_scope") == "direct_asset")
        & (F.coalesce("direct_asset_count", F.lit(0)) == 1) & ~quality.isin("title_only", "metadata_fallback", "unknown")
        & F.coalesce(F.col("content_quality_score") >= 45, F.lit(True)) & (F.size(F.split(squeeze(text("body")), " ")) >= 8)
    )
    stand_in = excerpts(assessed.where(direct), 2, 360).select("event_id", (F.substring("rank", 2, 3).cast("int") - 1).alias("position"), F.col("excerpt").alias("sentence"), F.lit("source_excerpt").alias("kind"))
    return own.unionByName(stand_in).select("event_id", "position", "kind", "sentence")


def supported(sentences: Column, title: Column, body: Column, chars: int = 50_000) -> Column:
    """True if every sentence stands in the source text, but for ASCII case."""
    source = ascii_lower(F.concat(title, F.lit("\n\n"), F.substring(body, 1, chars)))
    return F.forall(sentences, lambda s: F.contains(source, ascii_lower(s)))


def cited(ids: Column, pack: DataFrame) -> DataFrame:
    """pack(event_id, ids array<string>, rank → excerpt map) with the excerpts cited, in order; null if an id is unknown."""
    found = F.transform(ids, lambda i: F.try_element_at("excerpts", i))
    return pack.withColumn("cited", F.when(~F.exists(found, lambda x: x.isNull()), found))


def family_id(packets: DataFrame) -> Column:
    """The family, else the raw event, else the first source event, else the packet itself."""
    first = F.try_element_at(F.filter("source_event_ids", lambda s: ~blank(s)), F.lit(1))
    name = lambda c: F.when(~blank(F.col(c)), F.col(c))
    return F.coalesce(name("packet_family_id"), name("raw_event_id"), first, packets["packet_id"])


def apply_stories(events: DataFrame, stories: DataFrame, key: str = "story_hint_key") -> DataFrame:
    """Each event with its story's cluster, size and conflict level, and the health that follows."""
    joined = events.join(stories.select(key, "cluster_id", "event_count", "conflict_level"), key)
    return joined.withColumn("health", F.when(F.col("conflict_level") == "high", "degraded").otherwise("healthy"))


def output_manifest(rows: DataFrame, key: str, family: str, payload: str) -> DataFrame:
    """Per written object: its family, how many records and how many bytes (a newline each)."""
    return rows.groupBy(family, key).agg(F.count("*").alias("record_count"), F.sum(F.octet_length(payload).cast("long") + 1).alias("byte_count"))


def json_object(c: Column) -> Column:
    """The text from the first { to the last }; null if there is none."""
    return F.nullif(F.regexp_extract(c, r"(?s)\{.*\}", 0), F.lit(""))


# The shape of a provider's response.
RESPONSE = (
    "normalized_symbols array<string>, symbol_confidence_band string, event_type string, topic_summary string, stance_summary string, risk_summary string, regime_hint string, scenario_hint string,"
    " contradiction_flags array<string>, evidence_ids array<string>, confidence_score double, confidence_band string, novelty_score double, terminal_decision string"
)
BANDS, SYMBOL_BANDS = ["low", "medium", "high"], ["weak", "moderate", "strong"]
TEXTS, MOST_CHARS, MOST_SYMBOL = ["topic_summary", "stance_summary", "risk_summary", "regime_hint", "scenario_hint"], 512, 16
NEED_EVIDENCE, NEVER = ["high_confidence_structured", "conflicted"], "quarantine_only"


def response_error(raw: Column, known_ids: Column) -> Column:
    """The first thing wrong with a response that was asked for with the given evidence ids; null if nothing is."""
    body = json_object(raw)
    r = F.from_json(body, RESPONSE)
    ids = F.coalesce(r["evidence_ids"], F.array().cast("array<string>"))
    none, score = F.size(ids) == 0, lambda c: ~F.coalesce(r[c].between(0.0, 1.0), F.lit(False))
    symbols = F.transform(F.coalesce(r["normalized_symbols"], F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")))
    error = (
        F.when(body.isNull() | F.try_parse_json(body).isNull(), "not_json")
        .when(F.exists(ids, lambda i: ~F.coalesce(F.array_contains(known_ids, i), F.lit(False))), "unknown_evidence")
        .when(~F.coalesce(r["symbol_confidence_band"].isin(SYMBOL_BANDS), F.lit(False)), "symbol_band").when(~F.coalesce(r["confidence_band"].isin(BANDS), F.lit(False)), "confidence_band")
        .when((r["confidence_band"] == "high") & none, "high_without_evidence").when(r["terminal_decision"].isin(NEED_EVIDENCE) & none, "decision_without_evidence")
        .when(r["terminal_decision"] == NEVER, "decision").when(score("confidence_score"), "confidence_score").when(score("novelty_score"), "novelty_score")
    )
    for t in TEXTS:
        error = error.when(blank(r[t]), "text_empty").when(F.length(r[t]) > MOST_CHARS, "text_too_long")
    bare = lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")
    return error.when(F.exists(symbols, lambda x: ~bare(x).rlike(f"^[A-Z0-9]{{1,{MOST_SYMBOL}}}$")), "symbol")


def pointers(packets: DataFrame, payload: Column, key: Column, bucket: str, schema: str, manifest: Column) -> DataFrame:
    """What is published of each stored packet: its identity, decision and where its bytes lie."""
    ref = F.struct(F.lit(bucket).alias("bucket"), key.alias("key"), F.concat(F.lit("sha256:"), F.sha2(payload, 256)).alias("content_sha256"), F.lit(schema).alias("schema_version"))
    return packets.select("packet_id", "raw_event_id", "terminal_decision", ref.alias("storage_ref"), manifest.alias("manifest_key"), F.col("structured_at_ms").alias("created_at_ms"))


def with_responses(events: DataFrame, responses: DataFrame, stage: str) -> DataFrame:
    """events with the provider's valid response of one stage, or null.

    A provider is a table responses(event_id, stage, raw): filter events first, so that
    only those that need a response are joined (or sent to a model). A response is
    valid if it holds a JSON object with a score from 0 to 1 and a known band.
    """
    body = json_object(F.col("raw"))
    score = F.get_json_object(body, "$.confidence").try_cast("double")
    band = F.get_json_object(body, "$.confidence_band")
    good = body.isNotNull() & score.between(0.0, 1.0) & any_of(F.concat(F.lit("|"), band, F.lit("|")), ["|low|", "|medium|", "|high|"])
    mine = responses.where((F.col("stage") == stage) & F.coalesce(good, F.lit(False))).groupBy("event_id").agg(F.min(F.struct(body.alias("response"), score.alias("score"), band.alias("band"))).alias("m"))
    return events.join(mine.select("event_id", "m.*"), "event_id", "left")
