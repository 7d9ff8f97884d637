import hashlib

from pyspark.sql import functions as F

from tidemark.functions import ids
from tidemark.operators import gates, market, packets, rules, stories

EVENT = (
    "event_id string, title string, body string, source_id string, source_category string, trust_tier string, symbol_candidates array<string>, published_at_ms long, fetched_at_ms long,"
    " observed_at_ms long, content_quality string, content_quality_score int, source_quality string, source_relevance_scope string, content_kind string, event_category_hint string"
)


def event(i="e", title="", body="", category="news", symbols=(), **more):
    row = dict(
        event_id=i, title=title, body=body, source_id="s", source_category=category, trust_tier="T1", symbol_candidates=None if symbols is None else list(symbols), published_at_ms=1000, fetched_at_ms=2000,
        observed_at_ms=3000, content_quality="full_text", content_quality_score=80, source_quality=None, source_relevance_scope=None, content_kind="news", event_category_hint=None,
    )
    return tuple({**row, **more}.values())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), EVENT)


def test_rules_and_the_double_under_the_threshold(spark):
    df = frame(
        spark,
        event("high", "Exchange will delist ABC spot trading pair", "x", symbols=["abc"]),
        event("edge", "Update", "The funding round closes now", "project_notice", ["ABC"]),
        event("rumor", "Rumor: ABC listing unconfirmed now", "", symbols=["A", "B", "C", "D", "too-long!"]),
        event("none", None, None, None, None, trust_tier=None),
    )
    got = {r.event_id: r for r in rules.hints(rules.assess(df)).collect()}
    assert (got["high"].event_type, got["high"].decision) == ("delisting", "conflicted")  # the body has no evidence
    assert (got["edge"].event_type, got["edge"].confidence, got["edge"].decision) == ("other", 0.5499999999999999, "irrelevant_or_noise")
    assert got["rumor"].flags == ["rumor_vs_official", "symbol_ambiguity"] and got["rumor"].symbols == ["A", "B", "C", "D"]
    assert (got["none"].event_type, got["none"].symbol_band, got["none"].symbols) == ("other", "weak", [])


def test_excerpts_rank_dedupe_and_cut(spark):
    body = "A deposit of ABC is open. a  deposit of ABC is open.\nShort. " + "long words " * 60
    got = rules.excerpts(frame(spark, event("e", "ABC listing notice today", body, "exchange_notice", [" abc "]), event("n", None, None, None, None)), 10, 50).orderBy("rank").collect()
    assert [(r.rank, r.score) for r in got] == [("E1", 10 + 4 + 3 + 2 + 1), ("E2", 4 + 3 + 2 + 1), ("E3", 3)] and len(got[2].excerpt) == 50


def test_metrics_and_quality(spark):
    num = dict(content_quality="numeric_observation", event_category_hint="open_interest_snapshot")
    df = frame(
        spark, event("a", "", '{"symbol":"X","open_interest":"1042","value":1}', symbols=["X", "Y"], **num), event("b", "", '{"openInterest": "1d", "value": 7.5}', **num),
        event("c", "", "not json", **num), event("d", "", '{"open_interest": 1}'),
    )
    assert {(r.event_id, r.symbol, r.value) for r in rules.metrics(df).collect()} == {("a", "X", 1042.0), ("a", "Y", 1042.0), ("b", None, 7.5), ("c", None, None)}
    q = {r.event_id: r for r in rules.quality(df).collect()}
    assert q["a"].reasons == ["baseline_missing", "single_numeric_snapshot", "single_source_only", "symbol_ambiguous"] and q["d"].reasons == ["single_source_only"]


def test_ids_and_keys(spark):
    row = spark.range(1).select(
        ids.short_id("p", F.lit("a"), F.lit("b")).alias("s"), ids.run_id(F.lit("x"), F.lit(1_700_000_000_123)).alias("r"), ids.path_segment(F.lit("a/b c")).alias("seg"), ids.path_segment(F.lit("..")).alias("dots"),
        ids.sampled(F.lit("e1"), 0.0).alias("no"), ids.sampled(F.lit("e1"), 1.0).alias("yes"),
    ).first()
    assert row.s == "p_" + hashlib.sha256(b"a\0b\0").hexdigest()[:24] and row.r.endswith("-20231114T221320123Z") and (row.seg, row.dots, row.no, row.yes) == ("a_b_c", "_", False, True)


def test_gates(spark):
    texts = [("Buy now", True), ("buyer longing", False), ("a\nLONG b", True), ("x_short", False), (None, False), ("sell,sell", True)]
    df = spark.createDataFrame(texts, "t string, want boolean")
    assert all(r.got == r.want for r in df.select("want", gates.forbidden(F.col("t")).alias("got")).collect())
    assert [r[0] for r in df.where("want").select(gates.redacted(F.col("t"))).collect()][2] == "[blocked_output_term],[blocked_output_term]"
    keys = [("a/b", None), ("", "empty"), (" a", "edge_space"), ("a" * 1025, "too_long"), ("/a", "absolute"), ("s3://x", "absolute"), ("a?b", "bad_character"), ("a//b", "bad_segment"), ("a/../b", "bad_segment"), ("a/", "bad_segment")]
    got = spark.createDataFrame(keys, "k string, want string").select("want", gates.key_error(F.col("k")).alias("got")).collect()
    assert all(r.got == r.want for r in got)


def test_ranges_are_read_and_verified(spark):
    sha = "sha256:" + hashlib.sha256(b"bcd").hexdigest()
    objects = spark.createDataFrame([("o", bytearray(b"abcdef"))], "object_key string, content binary")
    rows = [("ok", "o", 1, 3, sha), ("sum", "o", 0, 3, sha), ("far", "o", 4, 3, sha), ("none", "p", 0, 1, sha), ("zero", "o", 0, 0, sha)]
    got = {r.event_id: r for r in gates.read_ranges(spark.createDataFrame(rows, "event_id string, object_key string, byte_offset long, byte_length long, content_sha256 string"), objects).collect()}
    assert {k: r.error for k, r in got.items()} == {"ok": None, "sum": "checksum", "far": "out_of_range", "none": "missing_object", "zero": "out_of_range"} and bytes(got["ok"].record) == b"bcd"


def test_as_of_and_grid_joins_against_brute_force(spark):
    import random

    rnd = random.Random(2)
    starts = sorted({rnd.randrange(0, 400) * 180_000 for _ in range(40)})
    events = [(f"e{k}", rnd.randrange(0, 80_000_000)) for k in range(80)]
    w, e = spark.createDataFrame([(s,) for s in starts], "window_start_ms long"), spark.createDataFrame(events, "event_id string, basis_ms long")
    got = {r.event_id: r.asof_window_ms for r in market.as_of(e, w, 180_000).collect()}
    want = {}
    for i, t in events:
        base = t - t % 180_000
        best = max((s for s in starts if s <= base), default=None)
        if best is not None and best >= base - 6 * market.HOUR:
            want[i] = best
    assert got == want
    near = {(r.event_id, r.window_start_ms) for r in market.around(e, w, 180_000).collect()}
    assert near == {(i, s) for i, t in events for s in starts if abs(s - (t - t % 180_000)) <= 180_000}
    assert market.as_of(e, w.limit(0), 180_000).count() == 0


def test_stories_merge_conflicts_and_running_counts(spark):
    df = frame(
        spark, event("a", "ABC exploit confirmed by the team", symbols=["ABC"], source_id="s1", observed_at_ms=1), event("b", "ABC exploit confirmed by the team", symbols=["ABC"], source_id="s2", observed_at_ms=2, trust_tier=None),
        event("b", "ABC exploit confirmed by the team", symbols=["ABC"], source_id="s2", observed_at_ms=2, trust_tier=None), event("c", "Nothing", published_at_ms=None, observed_at_ms=3),
    )
    made = rules.hints(rules.assess(df))
    story = {r.event_count: r for r in stories.merge(made).collect()}
    assert (story[2].source_count, story[2].conflict_level, story[2].trust_mix) == (2, "low", "unknown=1,T1=1") and story[1].conflict_level == "none"
    assert {(r.event_id, r.events_so_far, r.sources_so_far) for r in stories.running(made).collect()} == {("a", 1, 1), ("b", 2, 2), ("c", 1, 1)}


def test_responses_citations_and_families(spark):
    events = spark.createDataFrame([("a",), ("b",), ("c",)], "event_id string")
    raw = [
        ("a", "primary", 'text {"confidence": 0.7, "confidence_band": "high"} tail'), ("a", "primary", 'text {"confidence": 0.7, "confidence_band": "high"} tail'),
        ("b", "primary", '{"confidence": 7, "confidence_band": "high"}'), ("b", "primary", None), ("c", "escalation", '{"confidence": 1, "confidence_band": "low"}'), ("a", "primary", "no object"),
    ]
    responses = spark.createDataFrame(raw, "event_id string, stage string, raw string")
    assert {(r.event_id, r.band, r.score) for r in packets.with_responses(events, responses, "primary").collect()} == {("a", "high", 0.7), ("b", None, None), ("c", None, None)}
    pack = spark.createDataFrame([("a", ["E2", "E1"], {"E1": "x", "E2": "y"}), ("b", ["E9"], {"E1": "x"}), ("c", [], {})], "event_id string, ids array<string>, excerpts map<string,string>")
    assert {r.event_id: r.cited for r in packets.cited(F.col("ids"), pack).collect()} == {"a": ["y", "x"], "b": None, "c": []}
    rows = [("p", " ", None, ["", "s"]), ("q", "f", "r", []), ("r", None, "raw", None), ("t", None, " ", [])]
    df = spark.createDataFrame(rows, "packet_id string, packet_family_id string, raw_event_id string, source_event_ids array<string>")
    assert [r[0] for r in df.select(packets.family_id(df)).collect()] == ["s", "f", "raw", "t"]


def test_supported_sentences_and_retry_times(spark):
    df = spark.createDataFrame([(["A List"], "t", "x a LIST"), (["gone"], "t", "x"), ([], None, None)], "s array<string>, t string, b string")
    got = [r[0] for r in df.select(packets.supported(F.col("s"), rules.text("t"), rules.text("b"))).collect()]
    assert got == [True, False, True]
    df = spark.createDataFrame([("pending", 5), ("available", 5), (None, 5)], "st string, at long")
    assert [tuple(r) for r in df.select(*packets.retry_times(F.col("st"), F.col("at"), 0, 10)).collect()] == [(6, 15), (None, None), (None, None)]
