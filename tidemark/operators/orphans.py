"""References to records that do not exist.

The distinct keys referred to are anti-joined against the keys ever stored: what is left
is missing.  Missing keys and the storage intervals of the others are joined back to the
referring rows, which are dealt to SALTS parts per key: a key that a third of all rows
share is one row in the anti-join and lies in as many tasks as there are parts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import utrim
from tidemark.session import written

#: Parts that the references to one key are dealt to; objects are copied to all of them.
SALTS = 16


def object_key(c: Column, prefix: str) -> Column:
    """A key without store prefix, surrounding blanks and slashes; null if nothing is left."""
    bare = F.regexp_replace(utrim(c), "^" + prefix.replace(".", r"\."), "")
    return F.nullif(F.regexp_replace(bare, r"(?U)^[\s/]+|[\s/]+$", ""), F.lit(""))


def day_utc(ms: Column) -> Column:
    """yyyy-MM-dd of epoch milliseconds, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(ms / F.lit(86_400_000)).cast("int")).cast("string")


def references(rows: DataFrame, table: str, record: str, key: str, at_ms: str, prefix: str) -> DataFrame:
    """(from_table, record_key, ref_key, ref_ms) of every non-blank reference."""
    return rows.select(
        F.lit(table).alias("from_table"),
        F.col(record).cast("string").alias("record_key"),
        object_key(F.col(key), prefix).alias("ref_key"),
        F.col(at_ms).alias("ref_ms"),
    ).where("ref_key is not null").distinct()


def gathered(parts: list[DataFrame]) -> DataFrame:
    """References of several tables as one table that is computed once."""
    return written(reduce(DataFrame.unionByName, parts), "references")


def orphans(refs: DataFrame, stored: DataFrame, prefix: str) -> DataFrame:
    """refs without a live object, with day_utc and reason.

    stored(from_table, object_key, stored_at_ms, deleted_at_ms): the objects that the
    references of from_table must find. Live at time t: stored at or before t and not
    deleted at or before t. Reason: missing (never stored under that key), deleted (one
    was stored before and is gone), else late. A reference without time is only ever
    `missing`, under a null day.
    """
    key = ["from_table", "ref_key"]
    versions = stored.select("from_table", object_key(F.col("object_key"), prefix).alias("ref_key"), "stored_at_ms", "deleted_at_ms").where("ref_key is not null").distinct()
    missing = refs.select(*key).distinct().join(versions.select(*key).distinct(), key, "left_anti")
    here = versions.withColumn("absent", F.lit(False)).unionByName(missing.withColumn("absent", F.lit(True)), allowMissingColumns=True)
    dealt = refs.withColumn("salt", F.pmod(F.xxhash64("record_key", "ref_ms"), F.lit(SALTS)).cast("int"))
    both = dealt.join(here.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*key, "salt"])
    before = F.col("stored_at_ms") <= F.col("ref_ms")
    live = before & F.coalesce(F.col("deleted_at_ms") > F.col("ref_ms"), F.lit(True))
    most = lambda c: F.max(F.coalesce(c, F.lit(False)))
    tested = both.groupBy(*key, "salt", "record_key", "ref_ms").agg(most(F.col("absent")).alias("absent"), most(live).alias("live"), most(before).alias("before"))
    reason = F.when(F.col("absent"), "missing").when(F.col("ref_ms").isNotNull() & ~F.col("live"), F.when(F.col("before"), "deleted").otherwise("late"))
    return tested.withColumn("reason", reason).where("reason is not null").select("from_table", "record_key", day_utc(F.col("ref_ms")).alias("day_utc"), "reason", "ref_key")


def orphan_counts(refs: DataFrame, found: DataFrame) -> DataFrame:
    """Orphans of each reason beside all references, per table and day."""
    day = day_utc(F.col("ref_ms"))
    total = refs.groupBy("from_table", day.alias("day_utc")).agg(F.count("*").alias("n_references"))
    n_of = lambda r: F.count(F.when(F.col("reason") == r, 1)).alias(f"n_{r}")
    bad = found.groupBy(F.col("from_table").alias("ft"), F.col("day_utc").alias("d")).agg(n_of("missing"), n_of("deleted"), n_of("late"))
    on = (F.col("from_table") == F.col("ft")) & F.col("day_utc").eqNullSafe(F.col("d"))
    zero = F.lit(0).cast("long")
    return total.join(bad, on, "left").select("from_table", "day_utc", "n_references", *[F.coalesce(f"n_{r}", zero).alias(f"n_{r}") for r in ("missing", "deleted", "late")])
