"""Structured Streaming: file stream in, checked and idempotent tables out.

At-least-once delivery plus sinks that refuse what they have already gives an
exactly-once effect: a micro-batch that runs again overwrites its own folder, and a key
that another batch stored is stored no second time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.late import HOUR, Lateness
from tidemark.session import scratch, written
from tidemark.sources.buckets import Buckets


class KeyedSink:
    """Rows under unique keys, in hash buckets of the key, one sub-folder per batch.

    A key is stored once. A later row with the same key and content is ignored; one with
    other content goes to `conflicts` and changes nothing. Within a batch the row with
    the smallest content hash counts. Null keys are refused as conflicts. A batch meets
    stored rows in its keys' buckets, where they lie; all rows have the columns of the
    first batch.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 16):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    def _table(self, schema: StructType) -> Buckets:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        return Buckets(self.spark, f"{self.path}/stored", ddl, self.key, self.buckets)

    def put(self, rows: DataFrame, batch: str) -> None:
        """batch: a name that only this batch and its repetitions have."""
        number = zlib.crc32(batch.encode()) & 0x7FFFFFFF
        cols = [c for c in rows.columns if c != self.key]
        sha = F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
        with scratch(self.spark):
            rows = written(rows.withColumn("_sha", sha), "rows")
            one = written(rows.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.min(F.struct("_sha", *cols)).alias("m")).select(self.key, "m.*"), "one")
            table = self._table(one.schema)
            old = self.spark.table(table.name).where(F.col("batch") != number).select(self.key, "_sha")
            old = written(old.join(one.select(self.key), self.key, "left_semi").select(self.key, F.col("_sha").alias("_old")), "old")
            new = one.join(old, self.key, "left_anti")
            known = old.unionByName(new.select(self.key, F.col("_sha").alias("_old")))
            clash = rows.join(known, self.key, "left").where(F.col("_old").isNull() | (F.col("_old") != F.col("_sha"))).drop("_old").distinct()
            clash.write.mode("overwrite").parquet(f"{self.path}/conflicts/batch={batch}")
            table.put(new, number)

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/stored/rows").drop("batch", "_sha")

    def conflicts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/conflicts").drop("batch", "_sha")


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], **trigger) -> StreamingQuery:
    """Starts a stream that hands every micro-batch to `each`; by default until nothing is left."""
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def checked(stream: DataFrame, error: str, good: KeyedSink, bad_path: str, done_path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Good rows into the keyed sink, rows with an error into quarantine, then the batch into the success index.

    The success index is written last: a batch without it is taken as not done.
    """

    run_name = hashlib.sha256(checkpoint.encode()).hexdigest()[:8]  # another checkpoint counts its batches anew

    def each(df: DataFrame, batch_id: int) -> None:
        batch = f"b{run_name}_{batch_id}"
        bad = df.where(F.col(error).isNotNull())
        bad.select(F.to_json(F.struct(*[c for c in df.columns if c != error])).alias("record"), error).write.mode("overwrite").parquet(f"{bad_path}/batch={batch}")
        good.put(df.where(F.col(error).isNull()).drop(error), batch)
        df.sparkSession.range(1).select(F.lit(batch_id).cast("long").alias("batch_id")).write.mode("overwrite").parquet(f"{done_path}/batch={batch}")

    return run(stream, checkpoint, each, **trigger)


def distinct_messages(stream: DataFrame, message_id: str, event_time: str, window: str = "24 hours") -> DataFrame:
    """Each message once, as long as its repeats come within the window."""
    return stream.withWatermark(event_time, window).dropDuplicatesWithinWatermark([message_id])


def hourly(stream: DataFrame, event_time: str, group: str, rule: Lateness = Lateness()) -> DataFrame:
    """Counts per period of event time, open for late rows until the cut-off and then dropped from state."""
    return stream.withWatermark(event_time, f"{rule.cutoff_ms // HOUR} hours").groupBy(F.window(event_time, f"{rule.period_ms // HOUR} hours").alias("w"), group).agg(F.count("*").alias("n"))
