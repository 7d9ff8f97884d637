import json
import random

from tidemark.operators.ordered import neighbours
from tidemark.sources import drift

SCHEMA = "stream_id string, record_kind string, object_key string, written_at_ms long, line_number int, payload string, names string"
IDS = {"p": "id"}


def lines(*files):
    """files: lists of records (or raw text), each file of stream s after the other."""
    return [("s", "p", f"f{n}", 1000 * n, k, r if isinstance(r, (str, type(None))) else json.dumps(r), "x") for n, file in enumerate(files) for k, r in enumerate(file)]


def changes(spark, rows):
    target = {"id": "bigint", "x": "string", "o.k": "bigint", "n": "bigint"}
    got = drift.changes(drift.described(drift.ingest(drift.parse(spark.createDataFrame(rows, SCHEMA), IDS), target), target)).collect()
    assert len(set(got)) == len(got)
    return {tuple(r)[1:] for r in got}


def test_added_removed_renamed_type_changed(spark):
    a = [{"id": 1, "x": "q", "gone": 1, "n": 1, "o": {"k": 5}}, {"id": 2, "x": "r", "n": 2, "o": {"k": 6}}]
    b = [{"id": 1, "X": "q", "n": 1.5, "o": {"j": 5}}, {"id": 2, "X": "r", "new": None, "n": 2.5, "o": {"j": 6}}]
    assert changes(spark, lines(a, b, b)) == {
        ("f1", "renamed", "X", "x"), ("f1", "removed", "gone", ""), ("f1", "added", "new", ""), ("f1", "type_changed", "n", ""), ("f1", "renamed", "o.j", "o.k"),
    }


def test_different_values_are_no_rename_and_nulls_dont_speak(spark):
    a = [{"id": 1, "x": "q", "y": 1}, {"id": 2, "x": None, "y": 2}]
    b = [{"id": 1, "z": "q", "w": 1}, {"id": 2, "z": "t", "w": 3}]
    assert changes(spark, lines(a, b)) == {("f1", "renamed", "z", "x"), ("f1", "removed", "y", ""), ("f1", "added", "w", "")}


def test_one_name_is_renamed_once(spark):
    assert changes(spark, lines([{"id": 1, "a": True}], [{"id": 1, "b": True, "c": True}])) == {("f1", "renamed", "b", "a"), ("f1", "added", "c", "")}


def test_broken_lines_nulls_and_odd_json(spark):
    rows = lines([{"id": 1}, '{"id":', None, "[1]", "5", '{"a": NaN}'], ['{"id": 1, "b": "\\ud800"}', "[" * 5000])
    assert changes(spark, rows + rows) == {("f1", "added", "b", "")}
    assert changes(spark, []) == set()


def test_ingest_keeps_the_whole_record_and_promotion_replays(spark):
    rows = lines([{"id": 1, "n": 7.0, "w": "2.5", "tags": ["a"], "m": {"k": "x"}, "other": None}, {"id": 2, "n": "no", "num": 9, "tags": "b", "extra": {"deep": [1]}}, '{"id": 3, "w": 1.50, "big": 12345678901234567890123, "n": null, "e": {}}'])
    target = {"id": "bigint", "n": "bigint", "w": "double", "tags": "array<string>", "m.k": "string"}
    table = drift.ingest(drift.parse(spark.createDataFrame(rows, SCHEMA), IDS), target)
    one, two, three = table.orderBy("line_number").collect()
    assert (one.id, one.n, one.w, one.tags, one.m_k, one[drift.OBJECTS]) == (1, None, None, ["a"], "x", '{"m":"{\\"k\\":\\"x\\"}"}')
    assert json.loads(one[drift.RESCUED]) == {"n": "7.0", "w": '"2.5"', "other": "null"}
    assert two.n is None and json.loads(two[drift.RESCUED]) == {"n": '"no"', "num": "9", "tags": '"b"', "extra.deep": "[1]"}
    assert json.loads(three[drift.RESCUED]) == {"w": "1.50", "big": "12345678901234567890123", "n": "null", "e": "{}"}
    table = drift.promote(table, {"n": ("bigint", ["n", "num"]), "w": ("double", ["w"])})
    one, two, three = drift.promote(table, {"extra.deep": ("array<int>", ["extra.deep"])}).orderBy("line_number").collect()
    assert (one.n, one.w, three.w) == (7, 2.5, 1.5) and json.loads(one[drift.RESCUED]) == {"other": "null"}
    assert two.n == 9 and two.extra_deep == [1] and set(json.loads(two[drift.RESCUED])) == {"n", "tags"}


def test_aliases_follow_chains(spark):
    df = spark.createDataFrame([("renamed", "b", "a"), ("renamed", "c", "b"), ("added", "z", "")], "change_kind string, field_name string, old_name string")
    assert drift.aliases(df, {"a": "string", "q": "string"}) == {"a": ["b", "c"]}


def test_neighbours_equal_a_plain_window(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("ab"), t) for t in rnd.sample(range(-500, 5000), 300)]
    got = neighbours(spark.createDataFrame(rows, "k string, t long"), ["k"], ["t"], [], 64, "p", "n").collect()
    by = {k: sorted(t for j, t in rows if j == k) for k in "ab"}
    for r in got:
        i = by[r.k].index(r.t)
        assert (r.p.t if r.p else None) == (by[r.k][i - 1] if i else None)
        assert (r.n.t if r.n else None) == (by[r.k][i + 1] if i + 1 < len(by[r.k]) else None)
