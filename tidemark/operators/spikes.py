"""Readings that are implausible for their own source.

Tests per measured field: impossible values; spikes, that is readings outside the
expanded interquartile fences of their hours or with an implausible rate of change, which
are also far from the source's level; and stuck values, runs of zero variance.  Fences
come from quantile sketches per (source, field, block of hours), merged over neighbouring
blocks; a block holds about as many readings as a sketch needs to be no larger than they.

Rows are brought to their source once; every window, sketch and merge after that works
where the rows lie.  Only what is far by the exact windows is joined with the fences.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

HOUR = 3_600_000
FIELDS = ("mid_price", "spread_bps", "trade_volume")
SOURCE = ["symbol", "venue", "field_name"]


@dataclass(frozen=True)
class SpikeRule:
    """times: how many usual distances make a spike. longest: readings a spike may last.
    around_ms: half width of the span whose median is the level. stuck: readings in a row
    that make a stuck value. block_ms, blocks: width of a sketch's block, and neighbours
    merged on either side. fence: interquartile ranges that fences lie outside the quartiles."""

    times: float = 10.0
    longest: int = 3
    around_ms: int = 2 * HOUR
    stuck: int = 12
    block_ms: int = 4 * HOUR
    blocks: int = 1
    fence: float = 1.5


def readings(summaries: DataFrame) -> DataFrame:
    """One row per non-null reading, by source; repeated rows count once."""
    rows = summaries.select("slice_id", "symbol", "venue", "window_start_ms", "trade_count", *FIELDS).repartition("symbol", "venue").dropDuplicates()
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in FIELDS]))
    volume = F.col("trade_volume")
    quiet = F.coalesce((F.col("trade_count") == 0) & (volume == 0), F.lit(False))
    one_zero = F.coalesce((F.col("trade_count") == 0) != (volume == 0), F.lit(False))
    return (
        rows.select("slice_id", "symbol", "venue", "window_start_ms", "trade_count", quiet.alias("quiet"), one_zero.alias("one_zero"), pairs.alias("p"))
        .select("slice_id", "symbol", "venue", "window_start_ms", "trade_count", "quiet", "one_zero", "p.field_name", "p.value")
        .where("value is not null")
    )


def finite(v: Column) -> Column:
    return ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))


def impossible(v: Column) -> Column:
    name = F.col("field_name")
    return (
        ~finite(v)
        | ((name == "mid_price") & (v <= 0))
        | ((name == "spread_bps") & ((v < 0) | (v >= 10000)))
        | ((name == "trade_volume") & ((v < 0) | F.col("one_zero")))
    )


def stuck_values(r: DataFrame, rule: SpikeRule) -> DataFrame:
    """Readings in a stretch of `stuck` ones in a row with zero variance, all with trades counted.

    A source has one reading per window, so its series is bounded by the time covered.
    """
    live = F.coalesce(F.col("trade_count") > 0, F.lit(False)) & ~F.col("quiet") & finite(F.col("value"))
    order = Window.partitionBy(*SOURCE).orderBy("window_start_ms", "slice_id")
    back, ahead = order.rowsBetween(1 - rule.stuck, 0), order.rowsBetween(0, rule.stuck - 1)
    of = lambda f: f(F.when(F.col("live"), F.col("value"))).over(back)
    still = (F.count(F.when(F.col("live"), 1)).over(back) == rule.stuck) & (of(F.min) == of(F.max))
    rows = r.withColumn("live", live).withColumn("still", F.coalesce(still, F.lit(False)))
    return rows.withColumn("stuck", F.max("still").over(ahead)).where("stuck").select("slice_id", "field_name")


def fences(ok: DataFrame, rule: SpikeRule) -> DataFrame:
    """(source, block, q1, q3): quartiles of each source's block and its neighbours, from merged sketches."""
    sketches = ok.groupBy(*SOURCE, F.expr(f"window_start_ms div {rule.block_ms}").alias("block")).agg(F.kll_sketch_agg_double("value").alias("sketch"))
    near = Window.partitionBy(*SOURCE).orderBy("block").rangeBetween(-rule.blocks, rule.blocks)
    merged = sketches.withColumn("s", F.kll_merge_agg_double("sketch").over(near))
    at = lambda q: F.kll_sketch_get_quantile_double("s", F.lit(q))
    return merged.select(*SOURCE, "block", at(0.25).alias("q1"), at(0.75).alias("q3"))


def _median(values: Column) -> Column:
    """The exact median of a sorted array."""
    at = lambda i: F.element_at(values, i.cast("int"))
    n = F.size(values)
    return (at(F.floor((n + 1) / 2)) + at(F.floor(n / 2) + 1)) / 2


def spikes(r: DataFrame, rule: SpikeRule) -> DataFrame:
    """Short excursions far from the level of the hours around.

    The level is the exact median of the source's finite readings within around_ms
    either side, so a lasting change of level is its own level right up to the change;
    the usual distance is the exact median of all distances from it. What is far for
    `longest` readings at most is a spike if it also lies outside the fences, in a
    block whose readings are so wide apart that fences say nothing, or after or before
    a step of `times` usual distances.
    """
    ok = r.where(finite(F.col("value")) & ~F.col("quiet"))
    series = Window.partitionBy(*SOURCE)
    around = series.orderBy("window_start_ms").rangeBetween(-rule.around_ms, rule.around_ms)
    order = series.orderBy("window_start_ms", "slice_id")
    rows = ok.withColumn("off", F.abs(F.col("value") - _median(F.sort_array(F.collect_list("value").over(around)))))
    rows = rows.withColumn("usual", F.percentile("off", F.lit(0.5)).over(series))
    rows = rows.withColumn("far", F.col("off") > F.lit(rule.times) * F.col("usual"))
    step = lambda other: F.abs(F.col("value") - other.over(order)) > F.lit(rule.times) * F.col("usual")
    rows = rows.withColumn("jumps", F.coalesce(step(F.lag("value")), F.lit(False)) | F.coalesce(step(F.lead("value")), F.lit(False)))
    rows = rows.withColumn("starts", (F.col("far") & ~F.coalesce(F.lag("far").over(order), F.lit(False)) | ~F.col("far")).cast("int"))
    rows = rows.withColumn("run", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    short = rows.withColumn("size", F.count("*").over(Window.partitionBy(*SOURCE, "run"))).where(F.col("far") & (F.col("usual") > 0) & (F.col("size") <= rule.longest))
    short = short.withColumn("block", F.expr(f"window_start_ms div {rule.block_ms}"))
    same = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in [*SOURCE, "block"]]
    near = fences(ok, rule).withColumnsRenamed({c: f"f_{c}" for c in [*SOURCE, "block"]})
    wide = F.lit(rule.fence) * (F.col("q3") - F.col("q1"))
    outside = (F.col("value") > F.col("q3") + wide) | (F.col("value") < F.col("q1") - wide)
    unsettled = (F.col("q3") - F.col("q1")) > 4 * F.col("usual")
    return short.join(near, reduce(Column.__and__, same)).where(outside | unsettled | F.col("jumps")).select("slice_id", "field_name")


def implausible(summaries: DataFrame, rule: SpikeRule = SpikeRule()) -> DataFrame:
    """(slice_id, field_name) of every implausible reading, each once.

    Null readings are none; NaN and infinities are impossible and never part of a level;
    a source whose usual distance is 0 has no spikes. Null symbols or venues are a
    source of their own.
    """
    r = readings(summaries)
    parts = [r.where(impossible(F.col("value"))).select("slice_id", "field_name"), spikes(r, rule), stuck_values(r, rule)]
    return reduce(DataFrame.unionByName, parts).distinct()
