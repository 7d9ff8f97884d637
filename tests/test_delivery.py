from tidemark.operators.delivery import SeenIds, admitted, surplus

SCHEMA = "delivery_id long, id string, at_ms long"
ROWS = [(1, "a", 5), (2, "a", 3), (3, "a", 3), (4, "b", None), (5, "b", 9), (6, None, 1), (7, None, 1), (8, "c", 4)]


def ids(df):
    return sorted(r.delivery_id for r in df.collect())


def test_earliest_stays_ties_by_delivery_nulls_last_and_never_surplus(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for slices in (1, 2, 5):
        assert ids(surplus(df, admitted(df, SeenIds(spark, str(tmp_path / f"s{slices}"), 3), slices))) == [1, 3, 4]


def test_ids_stay_seen_over_batches_and_codes_stay_dense(spark, tmp_path):
    state = SeenIds(spark, str(tmp_path / "seen"), 4)
    first = spark.createDataFrame([(k, f"id{k % 300}", k) for k in range(600)], SCHEMA)
    assert len(ids(state.admit(first))) == 300
    again = spark.createDataFrame([(1000 + k, f"id{k}", k) for k in range(250, 400)], SCHEMA)
    assert ids(state.admit(again)) == list(range(1300, 1400))
    codes = {}
    for r in state.dictionary().collect():
        codes.setdefault(r.shard, []).append(r.code)
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in codes.values()) and sum(map(len, codes.values())) == 400
    assert ids(state.admit(again)) == []


def test_an_uncommitted_generation_counts_for_nothing(spark, tmp_path):
    state = SeenIds(spark, str(tmp_path / "seen"), 2)
    df = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    state.admit(df)
    (tmp_path / "seen" / "committed-1").unlink()
    assert ids(state.admit(df)) == [1]


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    assert ids(surplus(df, admitted(df, SeenIds(spark, str(tmp_path / "e"), 4)))) == []


def test_shards_may_grow_and_compaction_changes_nothing(spark, tmp_path):
    df = spark.createDataFrame([(k, f"id{k}", k) for k in range(200)], SCHEMA)
    SeenIds(spark, str(tmp_path / "seen"), 2).admit(df.where("delivery_id < 100"))
    state = SeenIds(spark, str(tmp_path / "seen"), 5)
    assert ids(state.admit(df)) == list(range(100, 200))
    state.compact()
    codes = [(r.shard, r.code) for r in state.dictionary().collect()]
    assert len(set(codes)) == len(codes) == 200 and state.markers.batches() == [3]
    more = df.unionByName(spark.createDataFrame([(900, "new", 1)], SCHEMA))
    assert ids(state.admit(more)) == [900]
