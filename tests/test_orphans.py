from tidemark.operators.orphans import orphan_counts, orphans, references

P = "s3://store/"
OBJECTS = "from_table string, object_key string, stored_at_ms long, deleted_at_ms long"


def run(spark, rows, stored):
    table = spark.createDataFrame(rows, "record string, key string, at long, reason string")
    refs = references(table, "t", "record", "key", "at", P)
    return refs, orphans(refs, spark.createDataFrame([("t", *s) for s in stored], OBJECTS), P)


def test_reasons_and_ways_of_writing_keys(spark):
    stored = [("a", 10, None), ("b", 10, 20), ("b", 30, None), ("c/d", 10, 20), ("e", None, None)]
    rows = [
        ("live", " s3://store/a/ ", 10, ""), ("late", "/a", 9, ""), ("gap", "b", 25, ""), ("back", "b", 30, ""), ("last", "b", 19, ""), ("gone", "c/d", 20, ""),
        ("case", "A", 50, ""), ("blank", " / ", 5, ""), ("null", None, 5, ""), ("untimed", "zz", None, ""), ("untimed2", "a", None, ""), ("late", "/a", 9, ""), ("odd", "e", 5, ""),
    ]
    refs, bad = run(spark, rows, stored)
    got = {(r.record_key, r.reason) for r in bad.collect()}
    assert got == {("late", "late"), ("gap", "deleted"), ("gone", "deleted"), ("case", "missing"), ("untimed", "missing"), ("odd", "late")}
    assert bad.count() == 6


def test_counts_and_empty_tables(spark):
    refs, bad = run(spark, [("x", "k", 0, ""), ("y", "k", 0, ""), ("z", "l", 86_400_000, "")], [("l", 0, None)])
    got = {(r.day_utc, r.n_references, r.n_missing) for r in orphan_counts(refs, bad).collect()}
    assert got == {("1970-01-01", 2, 2), ("1970-01-02", 1, 0)}
    assert run(spark, [], [("a", 1, None)])[1].count() == 0
    assert [r.reason for r in run(spark, [("x", "k", 1, "")], [])[1].collect()] == ["missing"]


def test_a_hot_key_with_many_times_is_dealt_to_many_tasks(spark):
    refs = spark.range(100_000).selectExpr("'t' as from_table", "cast(id as string) as record_key", "'hot' as ref_key", "id as ref_ms")
    stored = spark.createDataFrame([("t", "hot", 10, 40_000), ("t", "hot", 60_000, None)], OBJECTS)
    got = {r.reason: r["count"] for r in orphans(refs, stored, P).groupBy("reason").count().collect()}
    assert got == {"late": 10, "deleted": 20_000}
    bad = orphans(refs, stored.where("stored_at_ms < 0"), P)
    assert bad.where("reason = 'missing'").count() == 100_000


def test_the_same_key_in_another_table_is_no_target(spark):
    refs = spark.createDataFrame([("u", "r", "a", 5)], "from_table string, record_key string, ref_key string, ref_ms long")
    assert [r.reason for r in orphans(refs, spark.createDataFrame([("t", "a", 1, None)], OBJECTS), P).collect()] == ["missing"]
