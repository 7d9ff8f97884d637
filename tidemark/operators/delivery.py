"""Exactly one delivery of every identifier, over any number of batches.

Identifiers get exact dense codes from a dictionary that only grows, numbered shard by
shard.  What has been seen is a set of 4 KiB bitmaps per shard (32,768 codes each;
Parquet compresses them).  A batch takes its earliest arrival of every identifier whose
bit is not set; new codes, the shards' highest codes and the bits set are appended and
committed together by one marker, and bitmaps are united when they are read.  The
dictionary lies in hash buckets of the identifier, so probing it shuffles the batch only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.text import record_key
from tidemark.session import scratch, written
from tidemark.sources.buckets import Buckets, Markers

#: Tables of the state, and the column whose hash buckets their rows lie in.
TABLES = {
    "dictionary": ("id string, shard int, code bigint", "id"),
    "tops": ("shard int, top bigint", "shard"),
    "bitmaps": ("shard int, bucket bigint, bits binary", "shard"),
}


def bit_of(bits: Column, code: Column) -> Column:
    """True if the code's bit is set in the bitmap of its bucket."""
    at = F.bitmap_bit_position(code)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


class SeenIds:
    """State under `path`. shards: parts that new identifiers are numbered in; about one per
    million new ones keeps every numbering in one small task. It may differ from batch to
    batch: codes are looked up by identifier, and a shard goes on from its highest code."""

    def __init__(self, spark: SparkSession, path: str, shards: int = 64):
        self.spark, self.path, self.shards = spark, path.rstrip("/"), shards
        self.tables = {n: Buckets(spark, f"{self.path}/{n}", *spec, min(max(shards, 8), 4096)) for n, spec in TABLES.items()}
        self.markers = Markers(spark, self.path)

    def dictionary(self) -> DataFrame:
        return self.tables["dictionary"].rows(self.markers.batches())

    def bitmaps(self) -> DataFrame:
        """The bitmap of every shard and bucket, united over all batches."""
        return self.tables["bitmaps"].rows(self.markers.batches()).groupBy("shard", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))

    def admit(self, deliveries: DataFrame) -> DataFrame:
        """deliveries(delivery_id, id, at_ms) → the admitted (delivery_id, id), one per unseen id.

        Of several arrivals of an id the one with the smallest at_ms (null last), then
        delivery_id, is taken.  Null ids are no identifiers and don't come out.
        """
        with scratch(self.spark):
            return self._admit(deliveries)

    def _admit(self, deliveries: DataFrame) -> DataFrame:
        done = self.markers.batches()
        batch = max(done, default=0) + 1
        first = deliveries.where("id is not null").groupBy("id").agg(F.min(F.struct(F.col("at_ms").isNull().alias("none"), "at_ms", "delivery_id")).alias("first"))
        first = first.select("id", F.col("first.delivery_id").alias("delivery_id"))
        # an id may be in the dictionary without its bit, if it was coded but never admitted
        known = written(first.join(self.dictionary(), "id", "left"), "known")
        own = F.pmod(F.xxhash64("id"), F.lit(self.shards)).cast("int")
        new = known.where("code is null").select("id", "delivery_id", own.alias("shard")).withColumn("code", F.row_number().over(Window.partitionBy("shard").orderBy("id")).cast("long"))
        if done:
            # one row per shard
            tops = self.tables["tops"].rows(done).groupBy("shard").agg(F.max("top").alias("top"))
            new = new.join(F.broadcast(tops), "shard", "left").withColumn("code", F.col("code") + F.coalesce("top", F.lit(0).cast("long"))).drop("top")
        new = written(new.select("id", "delivery_id", "shard", "code"), "coded")
        unseen = new
        if done:
            probed = known.where("code is not null").withColumn("bucket", F.bitmap_bucket_number("code")).join(self.bitmaps(), ["shard", "bucket"], "left")
            unseen = unseen.unionByName(probed.where(F.col("bits").isNull() | ~bit_of(F.col("bits"), F.col("code"))).select("id", "delivery_id", "shard", "code"))
        fresh = unseen.groupBy("shard", F.bitmap_bucket_number("code").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits"))
        self.tables["dictionary"].put(new, batch)
        self.tables["tops"].put(new.groupBy("shard").agg(F.max("code").alias("top")), batch)
        self.tables["bitmaps"].put(fresh, batch)
        out = written(unseen.select("delivery_id", "id"), "admitted", keep=True)
        self.markers.commit(batch)
        return out

    def compact(self) -> None:
        """All batches so far as one: one file a bucket, one bitmap per shard and bucket."""
        done = self.markers.batches()
        if len(done) < 2:
            return
        batch, t = done[-1] + 1, self.tables
        t["dictionary"].put(self.dictionary(), batch, placed=True)
        t["tops"].put(t["tops"].rows(done).groupBy("shard").agg(F.max("top").alias("top")), batch)
        t["bitmaps"].put(self.bitmaps(), batch)
        self.markers.commit(batch, "compacted")
        for table in t.values():
            for old in done:
                table.remove(old)


def admitted(deliveries: DataFrame, state: SeenIds, slices: int = 2) -> DataFrame:
    """(delivery_id, id) of the one delivery of each id.

    The deliveries are admitted in `slices` steps of rising at_ms, so that an arrival of
    an earlier step always wins; null times come last.
    """
    rows = deliveries.where("id is not null")
    low, high = rows.agg(F.min("at_ms"), F.max("at_ms")).first()
    if low is None:
        steps = [F.lit(True)]
    else:
        width = (high - low) // slices + 1
        number = F.coalesce(F.least(F.floor((F.col("at_ms") - F.lit(low)) / width), F.lit(slices - 1)), F.lit(slices - 1))
        steps = [number == k for k in range(slices)]
    return reduce(DataFrame.unionByName, [state.admit(rows.where(step)) for step in steps])


def surplus(deliveries: DataFrame, kept: DataFrame) -> DataFrame:
    """All deliveries with an id but the admitted ones.

    The anti-join is on the unique delivery_id: a hot identifier cannot skew it.
    """
    return deliveries.where("id is not null").join(kept, "delivery_id", "left_anti")


def pointer_deliveries(pointers: DataFrame) -> DataFrame:
    return pointers.select("delivery_id", record_key(F.col("event_id")).alias("id"), F.col("created_at_ms").alias("at_ms"))
