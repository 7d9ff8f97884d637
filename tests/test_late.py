import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import epoch_ms, record_key
from tidemark.operators.late import HOUR, Lateness, PartialStore, packet_records, pointer_records
from tidemark.sources.tables import table

SCHEMA = "record_kind string, record_id string, event_ms long, arrival_ms long, batch_id long"


def brute(rows):
    out = {}
    for kind, ident, event, arrival in {r[:4] for r in rows if None not in r[:4]}:
        start = event - event % HOUR
        late = "on_time" if arrival < start + HOUR else "late" if arrival < start + 7 * HOUR else "too_late"
        out.setdefault((kind, start), []).append((late, arrival - event))
    return {
        k: (sum(v != "too_late" for v, _ in g), *(sum(v == w for v, _ in g) for w in ("on_time", "late", "too_late")), sum(d for v, d in g if v != "too_late") if any(v != "too_late" for v, _ in g) else None)
        for k, g in out.items()
    }


def figures(store):
    return {(r.record_kind, r.period_start_ms): (r.n_records, r.n_on_time, r.n_late, r.n_refused, r.sum_delay_ms) for r in store.figures().collect()}


ROWS = [
    ("p", "a", 10, 20, 1), ("p", "a", 10, 20, 1), ("p", "b", 10, HOUR, 1), ("p", "c", 10, 7 * HOUR - 1, 2), ("p", "d", 10, 7 * HOUR, 2), ("p", "e", -5, 3, 1),
    ("q", "a", 10, 9 * HOUR, 3), ("p", None, 10, 20, 1), ("p", "f", None, 20, 1), ("p", "g", 10, None, 1), ("p", "b", 10, HOUR, 3), ("p", "d", 10, 7 * HOUR, 3), ("p", "h", 10, 30, None),
]


def test_figures_and_corrections_equal_one_pass(spark, tmp_path):
    store = PartialStore(spark, str(tmp_path / "s"))
    store.add(spark.createDataFrame(ROWS, SCHEMA))
    assert figures(store) == brute(ROWS)
    got = sorted(map(tuple, store.corrections().collect()))
    assert got == [("p", "b", 0, "late"), ("p", "c", 0, "late"), ("p", "d", 0, "too_late"), ("p", "e", -HOUR, "late"), ("q", "a", 0, "too_late")]


def test_batches_in_any_order_one_twice(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    store = PartialStore(spark, str(tmp_path / "s"))
    for batch in (3, 1, 1, 2):
        store.add(df.where(F.coalesce("batch_id", F.lit(1)) == batch))
    assert figures(store) == brute(ROWS) and store.corrections().count() == 5


def test_real_batches_with_repeats_across_them(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    rows = pointer_records(table(spark, d, "raw_event_pointers")).unionByName(packet_records(table(spark, d, "structured_packets"))).cache()
    want = brute([tuple(r) for r in rows.collect()])
    ids = sorted(r[0] for r in rows.select((F.col("batch_id") % 5).alias("b")).distinct().collect() if r[0] is not None)
    store = PartialStore(spark, str(tmp_path / "s"))
    for b in [*reversed(ids), ids[0]]:
        store.add(rows.where(F.col("batch_id") % 5 == b))
    assert figures(store) == want


def test_closed_periods_refuse(spark, tmp_path):
    store = PartialStore(spark, str(tmp_path / "s"))
    first, df = ROWS[:4], lambda rows: spark.createDataFrame(rows, SCHEMA)
    store.add(df(first))
    store.add(df([("p", "n", HOUR, HOUR + 1, 2)]))
    before = figures(store)
    store.close(7 * HOUR)
    assert figures(store) == before and store.tables["keys"].rows(store.markers.batches()).count() == 1
    store.add(df([("p", "z", 10, 30, 4), ("p", "y", HOUR, HOUR + 2, 4), ("p", "n", HOUR, HOUR + 1, 4)]))
    now = figures(store)
    assert now["p", 0] == (*before["p", 0][:3], 1, before["p", 0][4]) and now["p", HOUR][0] == 2
    assert ("p", "z", 0, "too_late") in set(map(tuple, store.corrections().collect()))


def test_a_feed_without_its_marker_leaves_no_trace(spark, tmp_path, monkeypatch):
    store, df = PartialStore(spark, str(tmp_path / "s")), spark.createDataFrame(ROWS, SCHEMA)
    store.add(df.where("batch_id = 1"))
    before = figures(store)
    monkeypatch.setattr("tidemark.sources.buckets.Markers.commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.add(df)
    monkeypatch.undo()
    assert figures(store) == before
    store.add(df)
    assert figures(store) == brute(ROWS)


def test_verdicts_at_the_borders(spark):
    rows = [("p", f"e{k}", 10, t) for k, t in enumerate([0, HOUR - 1, HOUR, 7 * HOUR - 1, 7 * HOUR])]
    got = {r.record_id: r.verdict for r in Lateness().classify(spark.createDataFrame(rows, SCHEMA[: SCHEMA.rindex(",")])).collect()}
    assert [got[f"e{k}"] for k in range(5)] == ["on_time", "on_time", "late", "late", "too_late"]


def test_extra_columns(spark):
    df = spark.createDataFrame([("x", None, 0, 5 * 10**12, 1, 2)], "event_id string, verdict string, published_at_ms long, fetched_at_ms long, event_ms int, batch_id int")
    assert pointer_records(df).first().event_ms == 5 * 10**12
    assert Lateness().classify(pointer_records(df)).count() == 1


def test_units_and_ids(spark):
    ms = 1_704_067_200_123
    df = spark.createDataFrame([(1_704_067_200, 1), (ms, 2), (ms * 1000 + 7, 3), (ms * 10**6 + 7, 4), (None, 5)], "v long, k int")
    assert [r[0] for r in df.orderBy("k").select(epoch_ms(F.col("v"))).collect()] == [1_704_067_200_000, ms, ms, ms, None]
    ids = spark.createDataFrame([("\tAb ",), (" ",), (None,)], "i string").select(record_key(F.col("i"))).collect()
    assert [r[0] for r in ids] == ["ab", None, None]


def test_empty_and_rule(spark, tmp_path):
    store = PartialStore(spark, str(tmp_path / "s"))
    assert store.figures().count() == 0
    store.add(spark.createDataFrame([], SCHEMA))
    assert store.figures().count() == store.corrections().count() == 0
    with pytest.raises(ValueError):
        Lateness(HOUR, HOUR // 2)
