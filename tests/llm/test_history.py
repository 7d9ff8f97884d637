import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.history import History, Likeness, alike, common, key_of, settle, sign, signatures, words_of
from tidemark.llm.queries import content_hash, dedup_key

WORDS = [f"w{k}" for k in range(900)]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_common_is_the_longest_common_subsequence():
    rnd = random.Random(1)
    for _ in range(300):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(0, 90))] for _ in range(2))
        assert common(a, b) == lcs(a, b)


def test_alike_at_the_border():
    rule, base = Likeness(), [f"a{k}" for k in range(20)]
    edited = base[:16] + ["x", "y", "z", "u"]
    assert alike(" ".join(base), " ".join(edited), rule) and not alike(" ".join(base), " ".join(edited[:15] + ["v"] + edited[16:]), rule)
    assert not alike(" ".join(base[:11]), " ".join(base[:11]), rule)


def test_bands_agree_by_words_and_their_order():
    rnd, rule = random.Random(2), Likeness(bands=200, rows=3)
    a = [f"u{k}" for k in range(80)]
    b = [w if k % 8 else f"v{k}" for k, w in enumerate(a)]
    shuffled = rnd.sample(a, 80)
    bands, marks, _ = signatures([a, b, a, shuffled], rule, {})
    assert np.array_equal(bands[0], bands[2]) and (marks[0] == marks[2]).all() and (marks[0] == marks[3]).all()
    j = 70 / 90
    assert abs((bands[0] == bands[1]).mean() - j**3) < 0.1
    # the same words in any order: one of six orders agrees
    assert abs((bands[0] == bands[3]).mean() - 1 / 6) < 0.1


def test_repeated_words_are_elements_of_their_own():
    rule = Likeness(bands=300, rows=1)
    bands, _, _ = signatures([["a"] * 10 + ["b"] * 10, ["a"] * 10 + ["b"] * 5], rule, {})
    assert abs((bands[0] == bands[1]).mean() - 15 / 20) < 0.1


def test_short_texts_beside_others_change_no_signature(spark):
    long = " ".join(f"w{k}" for k in range(30))
    alone = sign(spark.createDataFrame([("a", long)], "id string, body string"), Likeness()).drop("id").collect()
    among = sign(spark.createDataFrame([("b", "too short"), ("a", long), ("c", None)], "id string, body string").coalesce(1), Likeness()).drop("id").collect()
    assert alone == among and len(alone) == 1


def sequential(records):
    """records: (id, keys, words) in order → (id, of)."""
    accepted, out = [], set()
    for i, keys, text in records:
        hit = next((j for j, k, t in accepted if set(k) & set(keys) or (text and t and alike(" ".join(text), " ".join(t), Likeness()))), None)
        if hit is None:
            accepted.append((i, keys, text))
        else:
            out.add((i, hit))
    return out


def feed(spark, path, records, batches, rule=Likeness()):
    store, out = History(spark, path, rule, 4), []
    size = -(-len(records) // batches)
    bodies = spark.createDataFrame([(i, " ".join(t)) for i, _, t in records], "id string, body string")
    for n in range(batches):
        rows = [(i, n * size + k, keys) for k, (i, keys, _) in enumerate(records[n * size : (n + 1) * size])]
        df = spark.createDataFrame(rows, "id string, at long, keys array<string>").withColumn("keys", F.transform("keys", lambda k: key_of("k", k)))
        got = store.admit(df, bodies).collect()
        assert len(set(got)) == len(got)
        out += map(tuple, got)
    return out


def made(n, seed):
    rnd, out = random.Random(seed), []
    for k in range(n):
        text = [rnd.choice(WORDS) for _ in range(rnd.randint(25, 60))]
        keys = [f"k{k}"]
        if out and rnd.random() < 0.4:
            _, other, base = rnd.choice(out)
            what = rnd.random()
            if what < 0.3:
                keys = [*other]
            elif base:
                text = [*base]
                for _ in range(rnd.randint(0, 2)):
                    text[rnd.randrange(len(text))] = rnd.choice(WORDS)
        if rnd.random() < 0.1:
            text = text[: rnd.randint(0, 11)]
        out.append((f"e{k:04}", keys, text))
    return out


def test_any_batching_equals_one_record_after_the_other(spark, tmp_path):
    records = made(160, 7)
    want = sequential(records)
    assert len(want) > 30
    for batches in (1, 3):
        assert set(feed(spark, str(tmp_path / f"h{batches}"), records, batches)) == want


def test_a_large_group_of_near_copies(spark, tmp_path):
    rnd = random.Random(9)
    base = [rnd.choice(WORDS) for _ in range(60)]
    records = [("e000", ["a"], base)]
    for k in range(1, 120):
        text = [*base]
        text[rnd.randrange(60)] = f"new{k}"
        records.append((f"e{k:03}", [f"k{k}"], text))
    assert set(feed(spark, str(tmp_path / "h"), records, 2)) == {(f"e{k:03}", "e000") for k in range(1, 120)}


def test_a_crowded_bucket_of_copies_that_differ_at_the_end(spark, tmp_path):
    rnd = random.Random(11)
    base, other = ([rnd.choice(WORDS) for _ in range(60)] for _ in range(2))
    records = [(f"e{k:03}", [f"k{k}"], [*(other if k % 5 == 3 else base), f"last{k}"]) for k in range(150)]
    want = {(f"e{k:03}", "e003" if k % 5 == 3 else "e000") for k in range(150)} - {("e000", "e000"), ("e003", "e003")}
    assert set(feed(spark, str(tmp_path / "h1"), records, 1)) == want and set(feed(spark, str(tmp_path / "h2"), records, 2)) == want


def templated(n, rnd, words, own, tag):
    """n texts of one template: the same words but for `own` at the end, so no two are alike."""
    base = [rnd.choice(WORDS) for _ in range(words - own)]
    return [(f"{tag}{k:05}", [f"{tag}{k}"], base + [f"{tag}{k}x{j}" for j in range(own)]) for k in range(n)]


def repeat_of(record, edits):
    i, _, text = record
    return (f"z{i}", [f"z{i}"], text[:-edits] + [f"z{i}x{j}" for j in range(edits)])


def test_later_accepted_texts_of_a_crowded_bucket_have_repeats(spark, tmp_path):
    rule = Likeness(bands=3, rows=1, bucket=8, near=-1.0)
    texts = templated(400, random.Random(5), 40, 9, "t")
    records = texts + [repeat_of(r, 3) for r in texts[300:]]
    same = lambda r: signatures([r[2]], rule, {})[0].tolist()
    buckets = Counter(str(same(r)) for r in texts)
    crowded, size = buckets.most_common(1)[0]
    assert size >= 200
    want = {(f"z{r[0]}", r[0]) for r in texts[300:] if str(same(r)) == str(same(repeat_of(r, 3))) == crowded}
    assert len(want) > 20
    got = set(feed(spark, str(tmp_path / "h"), records, 1, rule))
    assert want <= got and all(i == "z" + of for i, of in got)


@pytest.mark.parametrize("batches", [1, 2])
def test_pairs_that_share_a_band_are_found_inside_a_template(spark, tmp_path, batches):
    rule = Likeness(bucket=8)
    texts = templated(150, random.Random(8), 40, 12, "t")
    repeats = [repeat_of(r, 8) for r in texts[::3]]
    band = lambda r: signatures([r[2]], rule, {})[0]
    want = {(b[0], a[0]) for a, b in zip(texts[::3], repeats) if (band(a) == band(b)).any()}
    assert len(want) > 30
    pause = [(f"y{k}", [f"y{k}"], []) for k in range(len(texts) - len(repeats))] if batches == 2 else []
    assert set(feed(spark, str(tmp_path / "h"), texts + pause + repeats, batches, rule)) == want


def test_recall_of_scattered_edits_against_all_pairs(spark, tmp_path):
    rnd, first, second, cell = random.Random(4), [], [], {}
    word = lambda: f"w{rnd.randrange(5000)}"
    for size in (20, 60, 200):
        for share in (0.05, 0.1, 0.15, 0.2):
            for k in range(60):
                a = [word() for _ in range(size)]
                b, name = [*a], f"{size}-{share}-{k}"
                for i in rnd.sample(range(size), int(size * share)):
                    b[i] = word()
                assert alike(" ".join(a), " ".join(b), Likeness())
                first.append((f"a{name}", [], a))
                second.append((f"b{name}", [], b))
                cell[f"b{name}"] = (size, share)
    rnd.shuffle(second)
    got = {i for i, of in feed(spark, str(tmp_path / "h"), first + second, 2) if i[1:] == of[1:]}
    found = Counter(cell[i] for i in got)
    assert all(found[c] >= 0.95 * 60 for c in set(cell.values())), found


def stored(store):
    return {n: store.table(n).count() for n in ("seen", "keys", "bands", "texts")}


def test_only_accepted_records_are_stored_and_compaction_changes_nothing(spark, tmp_path):
    rnd, path = random.Random(3), str(tmp_path / "h")
    base = [rnd.choice(WORDS) for _ in range(60)]
    records = [("e00", ["a"], base)] + [(f"e{k:02}", [f"k{k}"], [*base[:k], f"new{k}", *base[k + 1 :]]) for k in range(1, 60)]
    assert len(feed(spark, path, records, 3)) == 59
    store = History(spark, path)
    assert stored(store) == {"seen": 60, "keys": 2, "bands": 48, "texts": 1}
    before = {n: sorted(map(str, store.table(n).collect())) for n in ("keys", "bands", "texts")}
    store.compact()
    assert before == {n: sorted(map(str, store.table(n).collect())) for n in ("keys", "bands", "texts")} and len(store.markers.batches()) == 1
    again = [("f1", ["z"], [*base[:9], "other", *base[10:]])]
    assert feed(spark, path, again, 1) == [("f1", "e00")]


def test_stored_rows_are_probed_where_they_lie(spark, tmp_path):
    records = made(40, 3)
    feed(spark, str(tmp_path / "h"), records, 2)
    store = History(spark, str(tmp_path / "h"))
    old, new = store.tables["bands"].rows([1]), store.tables["bands"].rows([2])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = old.join(new.select("band"), "band", "left_semi")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_a_batch_without_its_marker_leaves_no_trace(spark, tmp_path, monkeypatch):
    path, records = str(tmp_path / "h"), made(60, 5)
    want = set(feed(spark, path, records[:30], 1))
    monkeypatch.setattr("tidemark.sources.buckets.Markers.commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        feed(spark, path, records[30:], 1)
    monkeypatch.undo()
    assert History(spark, path).markers.batches() == [1]
    assert want | set(feed(spark, path, records[30:], 1)) == sequential(records)


def test_settle_takes_chains_in_order(spark):
    held = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "b"), (4, "c"), (5, "d")], "rank long, key string")
    near = spark.createDataFrame([("c", "d"), ("d", "c")], "key string, other string")
    accepted, repeats = settle(held, near)
    assert {r[0] for r in accepted.collect()} == {1, 3, 4} and {tuple(r) for r in repeats.collect()} == {(2, 1), (5, 4)}


def test_seen_ids_nulls_and_empty(spark, tmp_path):
    store = History(spark, str(tmp_path / "h"))
    bodies = spark.createDataFrame([("a", None), ("b", ""), (None, "x")], "id string, body string")
    df = spark.createDataFrame([("a", 1, ["k"]), ("a", 2, ["l"]), ("b", None, ["k", None]), (None, 1, ["k"]), ("c", 5, None)], "id string, at long, keys array<string>")
    df = df.withColumn("keys", F.transform("keys", lambda k: key_of("k", k)))
    assert [tuple(r) for r in store.admit(df, bodies).collect()] == [("b", "a")]
    assert store.admit(df, bodies).count() == 0
    assert store.admit(df.limit(0), bodies).count() == 0


def test_words_and_keys(spark):
    assert words_of("A,b  C_d\n é1") == ["a", "b", "c", "d", "é1"] and words_of(None) == []
    ways = ["News:https://f.x/A/b/?utm_source=q&id=1&trk=2#top", " news:f.x/a/b?id=1 ", "NEWS:http://f.x/a/b/?id=1&ref=z", "news:f.x/a/b?ref=3", "news:f.x/a/b/", " N/A ", "000", None, "utm"]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in ways], "k string").select(dedup_key(F.col("k"))).collect()]
    assert got == ["news:f.x/a/b?id=1"] * 3 + ["news:f.x/a/b"] * 2 + [None] * 3 + ["utm"]
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    got = [r[0] for r in spark.createDataFrame([(w,) for w in ("SHA256:AB", "ab", "sha256:" + empty, "sha256:00", "-")], "k string").select(content_hash(F.col("k"))).collect()]
    assert got == ["ab", "ab", None, None, None]
