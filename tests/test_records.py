import hashlib
import json

from pyspark.sql import functions as F

from tidemark.operators import gates, market, packets
from tidemark.sources import slices
from tidemark.sources.buckets import Buckets, Markers

POINTER = "event_id string, object_key string, byte_offset long, byte_length long, content_sha256 string, h string"


def sha(text):
    return "sha256:" + hashlib.sha256(text.encode()).hexdigest()


def test_ranges_and_what_is_wrong_with_records(spark):
    good = json.dumps({"schema_version": "v1", "id": "é1", "hash": "x"}, ensure_ascii=False)
    other, old, text = json.dumps({"schema_version": "v1", "id": "b"}), json.dumps({"schema_version": "v0", "id": "c"}), "no json"
    body = "\n".join([good, other, old, text]) + "\n"
    objects = spark.createDataFrame([("o", bytearray(body.encode())), ("empty", bytearray())], "object_key string, content binary")
    at = lambda s: body.encode().index(s.encode())
    size = lambda s: len(s.encode())
    rows = [
        ("é1", "o", 0, size(good), sha(good), "x"), ("é1", "o", 0, size(good), sha(good), "y"), ("a", "o", at(other), size(other), sha(other), None), ("c", "o", at(old), size(old), sha(old), None),
        ("d", "o", at(text), size(text), sha(text), None), ("e", "gone", 0, 1, "s", None), ("f", "o", 3_000_000_000, 5, "s", None), ("g", "o", 0, 5, "s", None), ("h", "o", None, 5, "s", None),
        ("i", "empty", 0, 1, "s", None), ("j", "o", -1, 5, "s", None),
    ]
    read = gates.verified(gates.read_ranges(spark.createDataFrame(rows, POINTER), objects), "v1", "id", hash="h")
    got = {(r.event_id, r.h): r.error for r in read.collect()}
    assert got == {
        ("é1", "x"): None, ("é1", "y"): "hash", ("a", None): "identity", ("c", None): "schema_version", ("d", None): "not_json", ("e", None): "missing_object", ("f", None): "out_of_range",
        ("g", None): "checksum", ("h", None): "out_of_range", ("i", None): "out_of_range", ("j", None): "out_of_range",
    }


def test_lines_by_number_and_the_writer(spark):
    lines = spark.createDataFrame([("f", 2, "b"), ("f", 1, "a"), ("f", 3, ""), ("g", 1, None)], "file string, n int, payload string")
    objects = gates.jsonl_objects(lines, "file", "n", "payload")
    assert [(r.object_key, bytes(r.content)) for r in objects.collect()] == [("f", b"a\nb\n\n")]
    more = objects.unionByName(spark.createDataFrame([("h", bytearray(b"x\ny")), ("e", bytearray())], "object_key string, content binary"))
    wanted = spark.createDataFrame([("f", 2), ("f", 3), ("f", 4), ("h", 2), ("e", 1), ("z", 1), ("f", 0)], "object_key string, line_no int")
    got = {(r.object_key, r.line_no): r.line for r in gates.lines_of(more, wanted).collect()}
    assert got == {("f", 2): "b", ("f", 3): "", ("f", 4): None, ("h", 2): "y", ("e", 1): None, ("z", 1): None, ("f", 0): None}


def test_outcomes_and_positions(spark):
    rows = spark.createDataFrame([(1, "a", "h", None), (2, "b", "h", None), (3, "c", "h", None), (4, "d", "x", None), (5, "a", "h", "bad"), (6, None, "h", None)], "delivery_id long, event_id string, content_hash string, error string")
    done = spark.createDataFrame([("a",), ("a",)], "event_id string")
    stored = spark.createDataFrame([("b", "h"), ("b", "h"), ("d", "h"), (None, "h")], "event_id string, content_hash string")
    got = {r.delivery_id: (r.outcome, r.quarantined) for r in gates.outcomes(rows, F.col("error"), done, stored).collect()}
    assert got == {1: ("duplicate", False), 2: ("processed", False), 3: ("retry", False), 4: ("permanent_input_failure", True), 5: ("invalid_pointer", True), 6: ("retry", False)}
    starts = {(r.policy, r.subject): r.start for r in gates.start_positions(rows, "event_id", "delivery_id").collect()}
    assert starts["all", None] == 1 and starts["new", None] == 7 and starts["last", None] == 6 and starts["last_per_subject", "a"] == 5
    assert gates.start_positions(rows.limit(0), "event_id", "delivery_id").count() == 0


def response(**more):
    base = dict(
        normalized_symbols=["BTC"], symbol_confidence_band="weak", event_type="x", topic_summary="t", stance_summary="s", risk_summary="r", regime_hint="h", scenario_hint="h", contradiction_flags=[],
        evidence_ids=["E1"], confidence_score=0.5, confidence_band="high", novelty_score=1.0, terminal_decision="conflicted",
    )
    return json.dumps({**base, **more})


def test_response_checks(spark):
    cases = {
        "fine": response(), "words around": f"Sure: {response()} done", "none": "no object", "broken": "{oops}", "ids": response(evidence_ids=["E9"]), "sband": response(symbol_confidence_band="high"),
        "band": response(confidence_band="strong"), "high": response(evidence_ids=[]), "decided": response(evidence_ids=[], confidence_band="low"), "never": response(terminal_decision="quarantine_only"),
        "score": response(confidence_score=1.01), "novel": response(novelty_score=None), "empty": response(risk_summary=" "), "long": response(topic_summary="x" * 513), "symbol": response(normalized_symbols=["btc"]),
    }
    df = spark.createDataFrame(list(cases.items()), "name string, raw string")
    got = {r.name: r.e for r in df.select("name", packets.response_error(F.col("raw"), F.array(F.lit("E1"))).alias("e")).collect()}
    assert got == {
        "fine": None, "words around": None, "none": "not_json", "broken": "not_json", "ids": "unknown_evidence", "sband": "symbol_band", "band": "confidence_band", "high": "high_without_evidence",
        "decided": "decision_without_evidence", "never": "decision", "score": "confidence_score", "novel": "novelty_score", "empty": "text_empty", "long": "text_too_long", "symbol": "symbol",
    }


def test_snapshots_merge_into_the_first(spark):
    rows = [("s", 2, "pending", None, "k2", ["b"], None), ("s", 1, "stale_but_usable", None, None, ["a"], 5), ("s", 3, "odd", 7, "k3", None, 6), ("t", 9, None, 1, None, None, None)]
    df = spark.createDataFrame(rows, "symbol string, id long, status string, at long, key string, objects array<string>, n long")
    got = {r.symbol: tuple(r)[1:] for r in market.merged_snapshots(df, ["symbol"], ["id"], ["id", "at"], ["key", "n"], "objects").collect()}
    assert got == {"s": (1, None, "stale_but_usable", "k2", 5, ["a", "b"], 3), "t": (9, 1, None, None, None, [], 1)}


def test_prefixes(spark):
    assert slices.recent_prefixes(["x/dt=1970-01-01/hour=00/"], 3_600_000, 3, "x") == [f"x/dt={d}/hour={h}/" for d, h in (("1970-01-01", "00"), ("1970-01-01", "01"), ("1969-12-31", "23"))]
    keys = spark.createDataFrame([("a/1",), ("a/2",), ("b/1",), ("c",)], "k string")
    assert sorted(r.k for r in slices.under_prefixes(keys, "k", ["a/", "b/", "a"], 1).collect()) == ["a/1", "b/1"]
    assert slices.under_prefixes(keys, "k", [], 5).count() == 0


def test_first_slices_with_several_and_no_number(spark):
    rows = [(1, "a", "v", 2, 9.0), (1, "a", "v", 1, float("nan")), (1, "a", "v", 3, 1.0), (2, "a", "v", 5, 4.0), (2, "a", "v", 4, None)]
    got = {(r.window_start_ms, r.slice_id, r.mid_price) for r in market.first_slices(spark.createDataFrame(rows, "window_start_ms long, symbol string, venue string, slice_id long, mid_price double"), "slice_id").collect()}
    assert got == {(1, 1, None), (2, 4, None)}


def test_buckets_keep_batches_apart(spark, tmp_path):
    t = Buckets(spark, str(tmp_path / "t"), "k string, v long", "k", 4)
    t.put(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long"), 1)
    t.put(spark.createDataFrame([("c", 3)], "k string, v long"), 2)
    t.put(spark.createDataFrame([("c", 4)], "k string, v long"), 2)
    again = Buckets(spark, str(tmp_path / "t"), "k string, v long", "k", 99)
    assert again.buckets == 4 and sorted(map(tuple, again.rows([1, 2]).collect())) == [("a", 1), ("b", 2), ("c", 4)] and again.rows([]).count() == 0
    m = Markers(spark, str(tmp_path / "t"))
    for n, kind in ((1, "committed"), (2, "committed"), (3, "compacted"), (4, "committed")):
        m.commit(n, kind)
    assert m.batches() == [3, 4]
