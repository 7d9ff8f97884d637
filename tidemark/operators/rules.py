"""Text rules over raw events: classification, symbols, sentences, flags, scores.

Everything is built-in column expressions, so a rule set of any size stays one pass
over the events without a shuffle. Null titles, bodies and categories count as empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import any_of, ascii_lower, ascii_upper, blank, squeeze, utrim

# Event types in the order they are tried, with the substrings that decide.
TYPES = [
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
# Words that make a sentence evidence, and words that raise an excerpt's rank.
EVIDENCE = ["list", "delist", "deposit", "withdraw", "hack", "exploit", "regulat", "proposal", "unlock", "funding", "partnership"]
RANKED = [
    "listing", "delisting", "remove", "suspend", "withdrawal", "deposit", "hack", "exploit", "incident", "security",
    "regulatory", "sec", "unlock", "governance", "proposal", "partnership", "funding", "open interest",
]
HIGH_RISK = ["delisting", "incident", "regulatory", "deposit_withdrawal"]


def text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def event_type(lowered: Column) -> Column:
    return F.coalesce(*[F.when(any_of(lowered, words), name) for name, words in TYPES], F.lit("other"))


def normalized_symbols(candidates: Column) -> Column:
    """Trimmed upper-case candidates of 1 to 12 ASCII letters and digits, distinct, in byte order."""
    up = F.transform(F.coalesce(candidates, F.array().cast("array<string>")), lambda s: ascii_upper(utrim(s)))
    return F.array_sort(F.array_distinct(F.filter(up, lambda s: s.rlike("^[A-Z0-9]{1,12}$"))))


def evidence_sentences(title: Column, body: Column) -> Column:
    """The first three sentences, in their own spelling, that hold a word of EVIDENCE."""
    source = F.when(blank(body), title).otherwise(body)
    parts = F.transform(F.split(source, "[.\n]"), utrim)
    return F.slice(F.filter(parts, lambda s: (F.octet_length(s) >= 12) & any_of(ascii_lower(s), EVIDENCE)), 1, 3)


def assess(events: DataFrame) -> DataFrame:
    """events with event_type, symbols, symbol_band, evidence, flags, confidence, confidence_band, decision."""
    rows = events.withColumn("_t", ascii_lower(F.concat(text("title"), F.lit(" "), text("body"))))
    rows = rows.withColumns({
        "event_type": event_type(F.col("_t")),
        "symbols": normalized_symbols(F.col("symbol_candidates")),
        "evidence": evidence_sentences(text("title"), text("body")),
    })
    strong = F.contains(text("source_category"), F.lit("project"))
    kind, none, proof = F.col("event_type"), F.size("symbols") == 0, F.size("evidence") > 0
    rumor = F.contains(ascii_lower(text("title")), F.lit("rumor")) | F.contains(F.col("_t"), F.lit("unconfirmed"))
    flags = F.array_compact(F.array(
        F.when(rumor, "rumor_vs_official"), F.when(F.size("symbols") > 3, "symbol_ambiguity"), F.when(~proof & (kind != "other"), "evidence_weak"),
    ))
    rows = rows.withColumns({"symbol_band": F.when(none, "weak").when(strong, "strong").otherwise("moderate"), "flags": flags})
    base = F.when(kind == "other", 0.35).when(kind.isin("listing", "delisting", "deposit_withdrawal"), 0.72).when(kind.isin("incident", "regulatory"), 0.62).otherwise(0.55)
    flagged = F.size("flags") > 0
    raised = base + F.when(proof, 0.12).otherwise(0.0) + F.when(F.col("symbol_band") == "strong", 0.08).otherwise(0.0)
    score = F.greatest(F.least(raised - F.when(flagged, 0.2).otherwise(0.0), F.lit(1.0)), F.lit(0.0))
    rows = rows.withColumn("confidence", score)
    c = F.col("confidence")
    decision = (
        F.when(flagged, "conflicted").when(c >= 0.8, "high_confidence_structured").when(none & (c >= 0.45), "general_market_context")
        .when(c >= 0.55, "low_confidence_structured").when(kind.isin(HIGH_RISK), "unsupported_or_weak").otherwise("irrelevant_or_noise")
    )
    return rows.withColumns({"confidence_band": F.when(c >= 0.8, "high").when(c >= 0.55, "medium").otherwise("low"), "decision": decision}).drop("_t")


def hints(assessed: DataFrame) -> DataFrame:
    """regime, scenario, decay and novelty of assessed events."""
    kind, cat = F.col("event_type"), text("source_category")
    return assessed.withColumns({
        "regime_hint": F.when(kind.isin("macro_event", "regulatory"), "risk_off").when(kind == "social_hype", "social_mania").when(kind == "other", "uncertain").otherwise("event_driven"),
        "scenario_hint": F.when(kind.isin("incident", "regulatory", "delisting"), "structural_break_possible").when(kind == "other", "noise_only").otherwise("watch_only"),
        "decay_hint": F.when(kind.isin("incident", "regulatory"), "multi_day").when(kind == "macro_event", "day").otherwise("hours"),
        "novelty_score": F.when(F.contains(cat, F.lit("official")) | F.contains(cat, F.lit("project")), 0.72).when(kind == "other", 0.35).otherwise(0.58),
    })


def excerpts(events: DataFrame, most: int = 10, chars: int = 420) -> DataFrame:
    """One row per ranked excerpt of each event: (event_id, rank, excerpt, score).

    The title and every sentence of every line, white space squeezed, 12 characters at
    least; of equal ones (but for ASCII case) the first counts. Best score first, then
    order of appearance. Ranking runs on arrays within the row: no shuffle.
    """
    lines = F.transform(F.split(text("body"), "\n"), utrim)
    sentences = F.flatten(F.transform(lines, lambda x: F.regexp_extract_all(x, F.lit(r"[^.!?。]*[.!?。]|[^.!?。]+$"), 0)))
    all_ = F.transform(F.concat(F.array(text("title")), sentences), lambda s, i: F.struct(squeeze(s).alias("text"), i.alias("ord")))
    kept = F.filter(all_, lambda s: F.length(s["text"]) >= 12)
    symbols = F.filter(F.transform(F.coalesce("symbol_candidates", F.array().cast("array<string>")), lambda s: ascii_upper(utrim(s))), lambda s: s != "")
    bonus = F.when(any_of(text("source_category"), ["notice", "exchange"]), 2).otherwise(0) + F.when(text("trust_tier") == "T1", 1).otherwise(0)
    rows = events.select("event_id", kept.alias("k"), symbols.alias("sy"), bonus.alias("b"))
    rows = rows.withColumn("keys", F.transform("k", lambda s: ascii_lower(s["text"])))

    def score(s: Column) -> Column:
        low, up = ascii_lower(s["text"]), ascii_upper(s["text"])
        words = reduce(Column.__add__, [F.when(F.contains(low, F.lit(w)), 4).otherwise(0) for w in RANKED])
        return words + F.size(F.filter("sy", lambda y: F.contains(up, y))) * 3 + F.col("b") + F.when(s["ord"] == 0, 10).otherwise(0)

    first = F.filter("k", lambda s, i: F.array_position("keys", ascii_lower(s["text"])) == (i + 1).cast("long"))
    ranked = F.slice(F.array_sort(F.transform(first, lambda s: F.struct((-score(s)).alias("minus"), s["ord"].alias("ord"), s["text"].alias("text")))), 1, most)
    out = rows.select("event_id", F.posexplode(ranked).alias("i", "e"))
    return out.select("event_id", F.concat(F.lit("E"), (F.col("i") + 1).cast("string")).alias("rank"), F.substring(F.col("e.text"), 1, chars).alias("excerpt"), (-F.col("e.minus")).alias("score"))


# How sources and contents are named that the predicates below look for.
TITLE_ONLY = ["title_only", "metadata_fallback"]
BROAD = ["global_symbol_scan", "metadata_fallback"]
TRUSTED_SOURCE, TRUSTED_CATEGORY = ["official", "exchange"], ["official", "exchange", "project"]
TRUSTED_QUALITY = ["official_source", "official_notice", "exchange_notice", "project_notice", "trusted_symbol_match"]
COPIED = ["syndicated", "duplicate"]
OFFICIAL = ["official", "exchange", "binance", "upbit", "bithumb", "project", "notice"]
DERIVATIVES = ["funding", "open_interest", "open-interest", "liquidation"]
MODEL_QUALITY = ["community_reaction", "market_snapshot"]


def quality(events: DataFrame) -> DataFrame:
    """Predicates on how an event was collected, and the set of evidence-quality reasons in fixed order."""
    sq, cq, scope = F.coalesce("source_quality", F.lit("unknown")), F.coalesce("content_quality", F.lit("unknown")), text("source_relevance_scope")
    source, cat, kind = text("source_id"), text("source_category"), ascii_lower(F.coalesce("content_kind", F.lit("unknown")))
    numeric = (sq == "market_snapshot") | (cq == "numeric_observation")
    title_only = cq.isin(TITLE_ONLY)
    trusted = (
        (text("trust_tier") == "T0") | any_of(source, TRUSTED_SOURCE) | any_of(cat, TRUSTED_CATEGORY)
        | sq.isin(TRUSTED_QUALITY)
    )
    symbols = normalized_symbols(F.col("symbol_candidates"))
    copied = any_of(sq, COPIED)
    many = (F.size(symbols) > 1) | (F.coalesce(F.size("symbol_candidates"), F.lit(0)) > 1)
    reasons = F.array_compact(F.array(
        F.when(numeric, "baseline_missing"), F.when(numeric, "single_numeric_snapshot"), F.lit("single_source_only"),
        F.when(cq == "title_only", "title_only"), F.when(many, "symbol_ambiguous"), F.when(copied, "duplicate_or_syndicated_source"),
    ))
    official = any_of(ascii_lower(F.concat_ws(" ", source, cat, sq)), OFFICIAL)
    return events.withColumns({
        "is_numeric": numeric,
        "is_derivatives": any_of(ascii_lower(source), DERIVATIVES) | F.contains(kind, F.lit("derivatives")),
        "is_broad_scan": title_only | sq.isin(BROAD) | (scope == "global_symbol_scan"),
        "is_trusted": trusted,
        "needs_model": sq.isin(MODEL_QUALITY) | title_only,
        "needs_escalation": F.coalesce(F.col("content_quality_score") < 45, F.lit(False)) | (scope == "global_symbol_scan"),
        "is_official": official,
        "reasons": reasons,
    })


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# JSON keys that hold the value of each kind of metric.
METRIC_KEYS = [
    (["open_interest", "open interest"], ["open_interest", "open-interest"], ["open_interest", "openInterest", "value"]),
    (["funding"], ["funding"], ["last_funding_rate", "funding_rate", "lastFundingRate", "fundingRate", "value"]),
    (["liquidation"], ["liquidation"], ["liquidation", "liquidations", "liquidation_value", "notional", "value"]),
]
OTHER_METRIC = ["metric_value", "value"]


def metrics(events: DataFrame) -> DataFrame:
    """One row per symbol (or one without) of every numeric observation: name, venue, value.

    The value is the first of the metric's keys at the top level of a JSON body that
    holds a finite number or numeric string. A body that isn't one JSON object has none.
    """
    rows = quality(events).where("is_numeric").withColumn("symbols", normalized_symbols(F.col("symbol_candidates")))
    name = F.coalesce("event_category_hint", "content_kind", F.lit("unknown"))
    low, source = ascii_lower(name), ascii_lower(text("source_id"))
    body = F.when(text("body").rlike(r"^\s*\{(?s:.*)\}\s*$"), F.col("body"))

    def first_of(keys: list[str]) -> Column:
        values = [F.get_json_object(body, f"$.{k}") for k in keys]
        numbers = [F.when(v.rlike(NUMBER), v.try_cast("double")) for v in values]
        return F.coalesce(*[F.when(F.abs(n) < float("inf"), n) for n in numbers])

    value = first_of(OTHER_METRIC)
    for in_name, in_source, keys in reversed(METRIC_KEYS):
        value = F.when(any_of(low, in_name) | any_of(source, in_source), first_of(keys)).otherwise(value)
    return rows.select("event_id", name.alias("metric_name"), F.col("source_id").alias("venue"), value.alias("value"), F.explode_outer("symbols").alias("symbol"))


def symbol_trace(events: DataFrame) -> DataFrame:
    """One row per resolved symbol of an event, or one row that none was resolved."""
    raw = F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce("symbol_candidates", F.array().cast("array<string>")), lambda s: ascii_upper(utrim(s))), lambda s: s != "")))
    symbols = normalized_symbols(F.col("symbol_candidates"))
    rows = events.select("event_id", F.array_join(raw, ",").alias("raw_mentions"), F.size(symbols).alias("n"), F.explode_outer(symbols).alias("symbol"))
    s = F.col("symbol")
    venues = F.when(s.isNull(), "").otherwise(F.concat(s, F.lit("USDT,"), s, F.lit("USD,KRW-"), s))
    why = F.when(F.col("n") == 0, "no_resolved_symbol").when(F.col("n") > 1, "multiple_candidate_symbols")
    return rows.select("event_id", "raw_mentions", "symbol", venues.alias("venue_symbols"), why.alias("ambiguity"))
