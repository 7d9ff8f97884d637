"""Figures per event-time period that stay right when records arrive late.

Records are reduced to mergeable partial aggregates per (kind, period, arrival slot,
batch).  A slot is as wide as a period and lies on the same grid, so whether a partial
is on time, late or refused depends only on its key.  Figures are the merge of the
partials of every slot up to the cut-off; what comes after the cut-off is refused:
counted and logged, but never merged.

A store keeps the partials, a log of every correction (records merged late, records
refused) and the keys of the records of open periods, so that a record which comes in
several batches counts once.  `close` ends periods for good: their keys go.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.text import floor_to, published_ms, record_key
from tidemark.session import hadoop_fs, scratch, written
from tidemark.sources.buckets import Buckets, Markers

HOUR = 3_600_000


@dataclass(frozen=True)
class Lateness:
    """period_ms: width of a period. cutoff_ms: how long after its end it stays open."""

    period_ms: int = HOUR
    cutoff_ms: int = 6 * HOUR

    def __post_init__(self):
        if self.period_ms <= 0 or self.cutoff_ms < 0 or self.cutoff_ms % self.period_ms:
            raise ValueError("the cut-off must be a whole number of periods")

    def verdict(self, period_start: Column, arrival: Column) -> Column:
        """on_time, late or too_late; null if either time is."""
        end = period_start + F.lit(self.period_ms)
        return (
            F.when(arrival < end, "on_time")
            .when(arrival < end + F.lit(self.cutoff_ms), "late")
            .when(arrival.isNotNull() & end.isNotNull(), "too_late")
        )

    def classify(self, records: DataFrame) -> DataFrame:
        """records(record_kind, record_id, event_ms, arrival_ms) with period_start_ms and verdict.

        Rows without id, event time or arrival are left out; repeated rows count once.
        """
        return self.placed(records.select("record_kind", "record_id", "event_ms", "arrival_ms").dropna().distinct())

    def placed(self, rows: DataFrame) -> DataFrame:
        """rows with period_start_ms and verdict."""
        start = floor_to(F.col("event_ms"), self.period_ms)
        return rows.withColumn("period_start_ms", start).withColumn("verdict", self.verdict(F.col("period_start_ms"), F.col("arrival_ms")))

    def partials(self, classified: DataFrame, *more: str) -> DataFrame:
        """Mergeable state per (record_kind, period_start_ms, arrival_slot_ms, verdict) and further columns."""
        delay = F.col("arrival_ms") - F.col("event_ms")
        slot = floor_to(F.col("arrival_ms"), self.period_ms).alias("arrival_slot_ms")
        return classified.groupBy("record_kind", "period_start_ms", slot, "verdict", *more).agg(
            F.count("*").alias("n"), F.sum(delay).alias("sum_delay_ms"), F.max(delay).alias("max_delay_ms")
        )

    def combine(self, partials: DataFrame) -> DataFrame:
        """The figures of each period: partials merged, refused ones only counted."""
        kept = F.col("verdict") != "too_late"
        n_of = lambda v: F.coalesce(F.sum(F.when(F.col("verdict") == v, F.col("n"))), F.lit(0).cast("long"))
        return partials.groupBy("record_kind", "period_start_ms").agg(
            F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0).cast("long")).alias("n_records"),
            n_of("on_time").alias("n_on_time"),
            n_of("late").alias("n_late"),
            n_of("too_late").alias("n_refused"),
            F.sum(F.when(kept, F.col("sum_delay_ms"))).alias("sum_delay_ms"),
            F.max(F.when(kept, F.col("max_delay_ms"))).alias("max_delay_ms"),
        )


#: Tables of the store, and the column whose hash buckets their rows lie in.
TABLES = {
    "keys": ("key binary, period_start_ms bigint", "key"),
    "partials": ("record_kind string, period_start_ms bigint, arrival_slot_ms bigint, verdict string, batch_id bigint, n bigint, sum_delay_ms bigint, max_delay_ms bigint", "period_start_ms"),
    "log": ("record_kind string, record_id string, period_start_ms bigint, verdict string", "record_id"),
}


class PartialStore:
    """Partials, log and open keys under `path`, in `buckets` hash buckets (about one for 200,000 records of open periods).

    A record is one (kind, id, event time, arrival). It counts in the first feed that
    brings it, under the smallest of the feed's batches that hold it; a batch given
    again, whole or in part, changes nothing, whatever the order of batches. A feed
    that failed before its marker leaves no trace.
    """

    def __init__(self, spark: SparkSession, path: str, rule: Lateness = Lateness(), buckets: int = 8):
        self.spark, self.path, self.rule = spark, path.rstrip("/"), rule
        self.tables = {n: Buckets(spark, f"{self.path}/{n}", *spec, buckets) for n, spec in TABLES.items()}
        self.markers = Markers(spark, self.path)

    def closed_before(self) -> int | None:
        """Periods that start before this time are closed; None if none is."""
        fs, at = hadoop_fs(self.spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return max((int(n.removeprefix("closed-")) for n in names if n.startswith("closed-")), default=None)

    def add(self, records: DataFrame) -> None:
        """Merges records(record_kind, record_id, event_ms, arrival_ms, batch_id), of one or more batches.

        A null batch_id counts as batch -1. Records of closed periods are refused, new or not.
        """
        done, rule = self.markers.batches(), self.rule
        feed = max(done, default=0) + 1
        what = ["record_kind", "record_id", "event_ms", "arrival_ms"]
        rows = records.dropna(subset=what).groupBy(*what).agg(F.min(F.coalesce(F.col("batch_id").cast("long"), F.lit(-1))).alias("batch_id"))
        rows = rule.placed(rows).withColumn("key", F.unhex(F.md5(F.concat_ws("|", "event_ms", "arrival_ms", "record_kind", "record_id"))))
        until = self.closed_before()
        if until is not None:
            rows = rows.withColumn("verdict", F.when(F.col("period_start_ms") < until, "too_late").otherwise(F.col("verdict")))
        if done:
            rows = rows.join(self.tables["keys"].rows(done), "key", "left_anti")
        with scratch(self.spark):
            rows = written(rows, "fed")
            is_open = F.lit(True) if until is None else F.col("period_start_ms") >= until
            self.tables["keys"].put(rows.where(is_open), feed)
            self.tables["partials"].put(rule.partials(rows, "batch_id"), feed)
            self.tables["log"].put(rows.where("verdict <> 'on_time'"), feed)
            self.markers.commit(feed)

    def close(self, now_ms: int) -> None:
        """Closes the periods whose cut-off lies at or before now_ms, and makes one feed of all so far.

        Keys of closed periods are dropped, and partials of the same key merged.
        """
        done = self.markers.batches()
        until = now_ms - self.rule.cutoff_ms - self.rule.period_ms
        until = max(until - until % self.rule.period_ms + self.rule.period_ms, self.closed_before() or 0)
        fs, at = hadoop_fs(self.spark, f"{self.path}/closed-{until}")
        fs.create(at, True).close()
        if not done:
            return
        feed, t = done[-1] + 1, self.tables
        t["keys"].put(t["keys"].rows(done).where(F.col("period_start_ms") >= until), feed, placed=True)
        merged = t["partials"].rows(done).groupBy("record_kind", "period_start_ms", "arrival_slot_ms", "verdict", "batch_id")
        t["partials"].put(merged.agg(F.sum("n").alias("n"), F.sum("sum_delay_ms").alias("sum_delay_ms"), F.max("max_delay_ms").alias("max_delay_ms")), feed)
        t["log"].put(t["log"].rows(done), feed, placed=True)
        self.markers.commit(feed, "compacted")
        for table in t.values():
            for old in done:
                table.remove(old)

    def figures(self) -> DataFrame:
        """Figures of each period, merged from all partials so far."""
        return self.rule.combine(self.tables["partials"].rows(self.markers.batches()))

    def corrections(self) -> DataFrame:
        """(record_kind, record_id, period_start_ms, verdict): what was merged late and what was refused."""
        return self.tables["log"].rows(self.markers.batches())


def pointer_records(pointers: DataFrame) -> DataFrame:
    """Deliveries as records: publication time in any unit, or fetch time where it is null or 0."""
    return pointers.select(
        F.lit("pointer").alias("record_kind"),
        record_key(F.col("event_id")).alias("record_id"),
        published_ms(F.col("published_at_ms"), F.col("fetched_at_ms")).alias("event_ms"),
        F.col("fetched_at_ms").alias("arrival_ms"),
        F.col("batch_id").cast("long").alias("batch_id"),
    )


def packet_records(packets: DataFrame, batch_ms: int = 3 * HOUR) -> DataFrame:
    """Packets as records; an event time of 0 stands for none. A batch holds what came within batch_ms."""
    return packets.select(
        F.lit("packet").alias("record_kind"),
        F.col("packet_id").alias("record_id"),
        F.nullif(F.col("event_timestamp_ms"), F.lit(0).cast("long")).alias("event_ms"),
        F.col("decision_available_at_ms").alias("arrival_ms"),
        F.call_function("div", F.col("decision_available_at_ms"), F.lit(batch_ms).cast("long")).alias("batch_id"),
    )
