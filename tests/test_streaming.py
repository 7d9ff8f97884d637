from pyspark.sql import functions as F

from tidemark.streaming.jobs import KeyedSink, checked, distinct_messages, file_stream, hourly, run

SCHEMA = "k string, v long, error string"


def write(spark, path, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/{name}")


def go(spark, tmp, checkpoint):
    sink = KeyedSink(spark, str(tmp / "good"), "k")
    stream = file_stream(spark, str(tmp / "in/*"), SCHEMA)
    checked(stream, "error", sink, str(tmp / "bad"), str(tmp / "done"), str(tmp / checkpoint)).awaitTermination()
    return sink


def test_replay_stores_once_conflicts_and_errors_are_kept_apart(spark, tmp_path):
    write(spark, tmp_path / "in", "a", [("x", 1, None), ("x", 1, None), ("y", 2, None), ("z", 3, "bad key"), (None, 4, None)])
    sink = go(spark, tmp_path, "c1")
    assert sorted(map(tuple, sink.rows().collect())) == [("x", 1), ("y", 2)]
    write(spark, tmp_path / "in", "b", [("x", 9, None), ("w", 5, None)])
    sink = go(spark, tmp_path, "c1")
    want = [("w", 5), ("x", 1), ("y", 2)]
    assert sorted(map(tuple, sink.rows().collect())) == want
    assert {(r.k, r.v) for r in sink.conflicts().collect()} == {(None, 4), ("x", 9)}
    assert sorted(map(tuple, go(spark, tmp_path, "c2").rows().collect())) == want  # checkpoint lost
    assert spark.read.parquet(str(tmp_path / "bad")).select("error").distinct().collect()[0][0] == "bad key"
    assert spark.read.parquet(str(tmp_path / "done")).count() >= 1


def test_messages_once_and_hourly_counts(spark, tmp_path):
    rows = [(f"m{k % 5}", k % 5, None) for k in range(10)]
    write(spark, tmp_path / "in", "a", rows)
    stream = file_stream(spark, str(tmp_path / "in/*"), SCHEMA).withColumn("t", F.timestamp_seconds(F.col("v") * 1800 + 31536000))
    got = []
    run(distinct_messages(stream, "k", "t"), str(tmp_path / "c1"), lambda df, n: got.extend(r.k for r in df.collect())).awaitTermination()
    assert sorted(got) == [f"m{k}" for k in range(5)]
    query = hourly(stream, "t", "error").writeStream.outputMode("complete").format("memory").queryName("hours").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.n for r in spark.table("hours").collect()) == [2, 4, 4]
