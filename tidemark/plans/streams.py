"""Queries that run a stream to its end, and the SQL for what it must have stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import gates
from tidemark.session import fresh_dir
from tidemark.sources.tables import table
from tidemark.streaming import jobs


def stream_replay(spark: SparkSession, d: str) -> DataFrame:
    """All valid deliveries through the checked stream twice, as after a lost checkpoint: stored once."""
    at = fresh_dir(spark, "stream")
    schema = table(spark, d, "raw_event_pointers").schema
    sink = jobs.KeyedSink(spark, f"{at}/good", "delivery_id")
    for n in (1, 2):
        stream = jobs.file_stream(spark, f"{d.rstrip('/')}/raw_event_pointers.parque[t]", schema)
        stream = stream.select("delivery_id", "event_id", "source_id", "fetched_at_ms", "storage_ref", "schema_version")
        stream = stream.withColumn("error", gates.pointer_error(stream, "raw_intel_event_created_v2", "aws_s3_jsonl_record"))
        jobs.checked(stream, "error", sink, f"{at}/bad", f"{at}/done", f"{at}/checkpoint-{n}").awaitTermination()
    return sink.rows().select("delivery_id", "event_id", "source_id", F.col("storage_ref.key").alias("key"))


def queries() -> dict:
    return {"stream_replay": stream_replay}


def oracle_sql() -> dict[str, str]:
    return {
        "stream_replay": r"""SELECT DISTINCT delivery_id, event_id, source_id, storage_ref.key AS key FROM raw_event_pointers
  WHERE schema_version = 'raw_intel_event_created_v2' AND coalesce(regexp_replace(event_id, '^\s+|\s+$', '', 'g'), '') <> '' AND storage_ref.kind = 'aws_s3_jsonl_record'
    AND coalesce(trim(storage_ref.bucket), '') <> '' AND coalesce(trim(storage_ref.key), '') <> '' AND storage_ref.byte_length > 0 AND starts_with(storage_ref.content_sha256, 'sha256:')"""
    }
