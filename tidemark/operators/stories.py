"""Events merged into stories of one day, type and set of symbols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.ids import short_id, utc
from tidemark.functions.text import ascii_lower, epoch_ms, published_ms
from tidemark.operators.rules import text
from tidemark.session import written

# Words that a title signature leaves out, and the flags in their order.
STOPWORDS = ["about", "after", "amid", "from", "into", "over", "that", "this", "with", "will"]
FLAGS = ["time_mismatch", "symbol_ambiguity", "source_claim_conflict", "rumor_vs_official", "title_body_mismatch", "evidence_weak"]


def story_key(assessed: DataFrame) -> Column:
    """Day, type, symbols and, where there are no symbols, the first words of the title."""
    day = utc(published_ms(F.col("published_at_ms"), F.col("fetched_at_ms")), "yyyy-MM-dd")
    symbols = F.when(F.size("symbols") > 0, F.array_join("symbols", ",")).otherwise("general")
    words = F.filter(F.split(ascii_lower(text("title")), "[^a-z0-9]+"), lambda w: (F.octet_length(w) >= 4) & ~w.isin(STOPWORDS))
    title = F.when(F.size(words) > 0, F.array_join(F.slice(words, 1, 8), "_")).otherwise("untitled")
    topic = F.when(F.size("symbols") > 0, F.col("event_type")).otherwise(title)
    return short_id("story_hint", F.coalesce(day, F.lit("")), F.col("event_type"), symbols, topic)


def flag_set(flags: Column) -> Column:
    """The flags present, in their fixed order."""
    return F.filter(F.array(*map(F.lit, FLAGS)), lambda f: F.array_contains(flags, f))


def _members(assessed: DataFrame) -> DataFrame:
    """Each event once per story: of several rows of an id the first observed, then the first by its other columns."""
    cols = ["source_id", "trust_tier", "event_type", "flags", "novelty_score", "published_at_ms"]
    held = [c for c in cols if c in assessed.columns]
    rows = assessed.withColumn("story_hint_key", story_key(assessed))
    first = rows.groupBy("story_hint_key", "event_id").agg(F.min(F.struct(F.col("observed_at_ms").isNull().alias("none"), "observed_at_ms", *held)).alias("m"))
    return first.select("story_hint_key", "event_id", "m.observed_at_ms", *[f"m.{c}" for c in held])


def merge(assessed: DataFrame) -> DataFrame:
    """One row per story, over distinct events; sets come out joined and sorted.

    Events are counted by story, source, tier and type first, so a story that holds any
    share of all events is spread over its sources; what is then gathered per story is
    bounded by the number of types, flags and tiers.
    """
    rows = _members(assessed)
    published = F.when(F.col("published_at_ms") != 0, epoch_ms(F.col("published_at_ms")))
    flagged = lambda f: F.max(F.array_contains("flags", f)).alias(f)
    parts = rows.groupBy("story_hint_key", "source_id", "trust_tier", "event_type").agg(
        F.count("*").alias("n"), *map(flagged, FLAGS), F.max("observed_at_ms").alias("last"), F.min(published).alias("first"), F.max("novelty_score").alias("novelty")
    )
    own = Window.partitionBy("story_hint_key", "source_id").orderBy(F.lit(1))
    parts = parts.withColumn("new", (F.row_number().over(own) == 1).cast("int"))
    tiers = parts.groupBy("story_hint_key", "trust_tier").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("source_id").isNotNull(), F.col("new")).otherwise(0)).alias("sources"), F.collect_set("event_type").alias("types"),
        *[F.max(f).alias(f) for f in FLAGS], F.max("last").alias("last"), F.min("first").alias("first"), F.max("novelty").alias("novelty"),
    )
    mix = F.transform(F.array_sort(F.collect_list(F.struct("trust_tier", "n"))), lambda x: F.concat(F.coalesce(x["trust_tier"], F.lit("unknown")), F.lit("="), x["n"].cast("string")))
    all_ = tiers.groupBy("story_hint_key").agg(
        F.sum("n").alias("event_count"), F.sum("sources").alias("source_count"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("types")))).alias("types"),
        F.array_compact(F.array(*[F.when(F.max(f), f) for f in FLAGS])).alias("flags"), F.max("last").alias("last_updated_ms"), F.min("first").alias("first_published_ms"),
        F.max("novelty").alias("novelty_score"), F.array_join(mix, ",").alias("trust_mix"),
    )
    flags = F.when(F.size("types") > 1, F.array_union("flags", F.array(F.lit("source_claim_conflict")))).otherwise(F.col("flags"))
    out = all_.withColumn("flags", flag_set(flags))
    f, n = F.col("flags"), F.col("source_count")
    level = F.when(F.array_contains(f, "source_claim_conflict") | F.array_contains(f, "rumor_vs_official"), "high").when(F.size(f) > 0, "medium").when(n > 1, "low").otherwise("none")
    return out.select(
        "story_hint_key", short_id("story", F.col("story_hint_key"), F.lit("v1")).alias("cluster_id"), "event_count", "source_count",
        F.when(F.size("types") == 1, F.col("types")[0]).otherwise("mixed_topic_conflict").alias("primary_topic"), F.array_join("types", ",").alias("topics"),
        F.array_join("flags", ",").alias("flags"), level.alias("conflict_level"), "trust_mix", "last_updated_ms", "first_published_ms", "novelty_score",
    )


def running(assessed: DataFrame, bucket_ms: int = 3_600_000) -> DataFrame:
    """The story as each event found it: counts over the story's earlier events and its own.

    A new source is one that no earlier event of the story had, so counts are running
    sums, not sets that grow with the story. Events are sorted per story and hour only;
    one row per hour carries its sums to the later ones, so a hot story is spread over
    as many tasks as it has hours. Events without observation time come first.
    """
    rows = _members(assessed).withColumn("_b", F.floor(F.coalesce("observed_at_ms", F.lit(-1)) / F.lit(bucket_ms)))
    rows = written(rows.select("story_hint_key", "event_id", "observed_at_ms", "source_id", "_b"), "members")  # read three times
    at = F.struct(F.coalesce("observed_at_ms", F.lit(-1)).alias("t"), "event_id")
    first = rows.groupBy("story_hint_key", "source_id").agg(F.min(at).alias("m")).select("story_hint_key", F.col("m.event_id").alias("event_id"), F.lit(1).alias("new"))
    # a story's event is the first of one source at most
    rows = rows.join(first, ["story_hint_key", "event_id"], "left").withColumn("new", F.coalesce("new", F.lit(0)))
    hours = rows.groupBy("story_hint_key", "_b").agg(F.count("*").alias("n"), F.sum("new").alias("s"), F.max("observed_at_ms").alias("last"))
    before = Window.partitionBy("story_hint_key").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    hours = hours.select("story_hint_key", "_b", F.coalesce(F.sum("n").over(before), zero).alias("n"), F.coalesce(F.sum("s").over(before), zero).alias("s"), F.max("last").over(before).alias("last"))
    upto = Window.partitionBy("story_hint_key", "_b").orderBy("observed_at_ms", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    inner = rows.select("event_id", "story_hint_key", "_b", F.count("*").over(upto).alias("i"), F.sum("new").over(upto).alias("j"), F.max("observed_at_ms").over(upto).alias("k"))
    return inner.join(hours, ["story_hint_key", "_b"]).select(
        "event_id", "story_hint_key", (F.col("n") + F.col("i")).alias("events_so_far"), (F.col("s") + F.col("j")).alias("sources_so_far"), F.greatest("last", "k").alias("last_updated_ms"),
    )


def latest(packets: DataFrame, family: str = "packet_family_id", revision: str = "revision") -> DataFrame:
    """The newest revision of every family; ties go to the greater packet_id."""
    best = packets.groupBy(family).agg(F.max(F.struct(revision, "packet_id", "market_context_status")).alias("m"), F.count_distinct("packet_id").alias("n_revisions"))
    return best.select(family, "m.*", "n_revisions")
