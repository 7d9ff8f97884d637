"""Market context: admitted windows, windows around an event, the last window before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import ascii_upper, floor_to

HOUR = 3_600_000
# Context states, best first.
RANKS = ["available_symbol_context", "nearest_available", "symbol_context_only", "stale_but_usable", "available", "available_general_context", "pending", "unavailable"]
PROJECTIONS = ["market_data_quality_summary_key", "market_feature_delta_key", "market_feature_delta_summary_key", "market_regime_context_key", "symbol_universe_snapshot_key"]
EMITTED = "normalized_market_slice_v1"


def basis(published: Column, fetched: Column) -> Column:
    return F.coalesce(published, fetched)


def admitted(index: DataFrame, manifest: DataFrame, report: DataFrame) -> DataFrame:
    """Index rows whose manifest and report agree with them and with each other.

    index ⋈ manifest on key, ⋈ report on key; any failing check drops the window.
    """
    m = manifest.select(*[F.col(c).alias(f"m_{c}") for c in manifest.columns])
    r = report.select(*[F.col(c).alias(f"r_{c}") for c in report.columns])
    i = index.where((F.col("status") == "success") & (F.col("schema_version") == "l1_index_pointer_v1") & (F.col("schema_version_emitted") == EMITTED))
    i = i.where("indexed_window_start_ms is null or (indexed_window_start_ms >= input_time_range_start_ms and indexed_window_end_ms <= input_time_range_end_ms)")
    j = i.join(m, i["canonical_manifest_key"] == m["m_manifest_key"])
    j = j.where(
        (F.col("m_schema_version") == "l1_manifest_v1") & (F.col("m_status") == "success") & (F.col("m_l1_run_id") == F.col("l1_run_id")) & (F.col("m_schema_version_emitted") == EMITTED)
        & (F.col("m_input_time_range_start_ms") <= F.col("input_time_range_start_ms")) & (F.col("m_input_time_range_end_ms") >= F.col("input_time_range_end_ms"))
        & (F.size("m_output_object_keys") > 0) & (F.col("m_output_record_count") == F.col("m_slice_count_total"))
    )
    same = [F.col(f"r_{c}").eqNullSafe(F.col(f"m_{c}")) for c in ("output_object_keys", *PROJECTIONS)]
    j = j.join(r, j["m_report_key"] == r["r_report_key"]).where(
        (F.col("r_schema_version") == "normalization_report_v1") & (F.col("r_status") == "success") & (F.col("r_l1_run_id") == F.col("l1_run_id"))
        & (F.col("r_input_time_range_start_ms") == F.col("m_input_time_range_start_ms")) & (F.col("r_input_time_range_end_ms") == F.col("m_input_time_range_end_ms"))
        & (F.col("r_schema_version_emitted") == EMITTED) & (F.col("r_manifest_key") == F.col("canonical_manifest_key"))
    )
    for s in same:
        j = j.where(s)
    return j.select(*[i[c] for c in index.columns]).distinct()


def around(events: DataFrame, windows: DataFrame, width: int, radius: int = 1) -> DataFrame:
    """events(event_id, basis_ms) × the windows within `radius` of theirs, by equi-join on the grid."""
    base = events.select("event_id", floor_to(F.col("basis_ms"), width).alias("base_ms"), F.explode(F.sequence(F.lit(-radius), F.lit(radius))).alias("k"))
    near = base.withColumn("window_start_ms", F.col("base_ms") + F.col("k") * F.lit(width).cast("long"))
    return near.join(windows.select("window_start_ms").distinct(), "window_start_ms")


def as_of(events: DataFrame, windows: DataFrame, width: int, lookback: int = 6 * HOUR) -> DataFrame:
    """The largest window start at or before the event's own window, at most `lookback` back.

    Within the event's own hour the windows themselves are joined, for earlier hours
    one row per hour, and always on an equal hour: never a range join.
    """
    base = events.select("event_id", floor_to(F.col("basis_ms"), width).alias("base_ms")).withColumn("hour", floor_to(F.col("base_ms"), HOUR))
    starts = windows.select(F.col("window_start_ms").alias("s")).distinct().withColumn("hour", floor_to(F.col("s"), HOUR))
    own = base.join(starts, "hour").where("s <= base_ms").groupBy("event_id", "base_ms").agg(F.max("s").alias("s"))
    hours = starts.groupBy("hour").agg(F.max("s").alias("s"))
    back = base.withColumn("hour", F.explode(F.transform(F.sequence(F.lit(1), F.lit(-(-lookback // HOUR))), lambda k: F.col("hour") - k * F.lit(HOUR).cast("long"))))
    earlier = back.join(hours, "hour").groupBy("event_id", "base_ms").agg(F.max("s").alias("s"))
    found = own.unionByName(earlier).groupBy("event_id", "base_ms").agg(F.max("s").alias("asof_window_ms"))
    return found.where(F.col("asof_window_ms") >= F.col("base_ms") - F.lit(lookback))


def first_slices(slices: DataFrame, order: str) -> DataFrame:
    """One slice per window, symbol and venue: the first in `order`, then by the other columns.

    NaN stands for no reading and comes out as null, as does a null; both sort first.
    """
    rest = [c for c in slices.columns if c not in ("window_start_ms", "symbol", "venue", order)]
    doubles = {f.name for f in slices.schema if f.dataType.typeName() in ("double", "float")}
    held = [F.nanvl(c, F.lit(None)).alias(c) if c in doubles else F.col(c) for c in rest]
    m = slices.groupBy("window_start_ms", "symbol", "venue").agg(F.min(F.struct(order, *held)).alias("m"))
    return m.select("window_start_ms", "symbol", "venue", f"m.{order}", *[f"m.{c}" for c in rest])


def window_status(base: Column, window: Column, symbols: Column, stale: int) -> Column:
    return (
        F.when(~symbols, "available_general_context").when(window == base, "available_symbol_context")
        .when(base - window > F.lit(stale), "stale_but_usable").otherwise("nearest_available")
    )


def context(events: DataFrame, slices: DataFrame, width: int, lookback: int = 6 * HOUR, stale: int = 900_000) -> DataFrame:
    """Per event: best status over its candidate windows, how many there are, and the slices of its symbols.

    events(event_id, basis_ms, symbols). Candidates are the windows around the event and
    the last one before; a window with slices of a wanted symbol (its name or its USDT
    pair) has symbol context. No candidate: pending.
    """
    windows = slices.select("window_start_ms").distinct()
    near = around(events, windows, width).select("event_id", "base_ms", "window_start_ms")
    last = as_of(events, windows, width, lookback).select("event_id", "base_ms", F.col("asof_window_ms").alias("window_start_ms"))
    candidates = near.unionByName(last).distinct()
    wanted = events.select("event_id", F.explode("symbols").alias("wanted")).distinct()
    kept = first_slices(slices, "slice_id").select("window_start_ms", "symbol", "venue")
    names = kept.withColumn("wanted", F.explode(F.array(ascii_upper(F.col("symbol")), F.concat(ascii_upper(F.col("symbol")), F.lit("USDT")))))
    hits = candidates.join(wanted, "event_id").join(names, ["window_start_ms", "wanted"]).select("event_id", "window_start_ms", F.concat_ws(":", "symbol", "venue").alias("s")).distinct()
    hits = hits.groupBy("event_id", "window_start_ms").agg(F.count("*").alias("n"))
    rows = candidates.join(hits, ["event_id", "window_start_ms"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    rank = F.array_position(F.array(*map(F.lit, RANKS)), window_status(F.col("base_ms"), F.col("window_start_ms"), F.col("n") > 0, stale))
    best = rows.groupBy("event_id").agg(F.min(rank).alias("r"), F.count("*").alias("n_windows"), F.min("window_start_ms").alias("first_window_ms"), F.sum("n").alias("n_slices"))
    zero = F.lit(0).cast("long")
    return events.select("event_id").distinct().join(best, "event_id", "left").select(
        "event_id", F.coalesce(F.element_at(F.array(*map(F.lit, RANKS)), F.col("r").cast("int")), F.lit("pending")).alias("status"),
        F.coalesce("n_windows", zero).alias("n_windows"), "first_window_ms", F.coalesce("n_slices", zero).alias("n_slices"),
    )


def merged_snapshots(snapshots: DataFrame, by: list[str], order: list[str], base: list[str], keys: list[str], joined: str) -> DataFrame:
    """One snapshot per group: the first's own columns, the best status, each key from the first that has it.

    by: columns of a group; order: which snapshot is first. base: columns taken from the
    first, null or not. keys: columns taken from the first snapshot where they aren't
    null. joined: an array column, concatenated in order. Unknown statuses rank last.
    """
    at = F.struct(*order)
    rank = F.array_position(F.array(*map(F.lit, RANKS)), F.col("status"))
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(at.alias("_at"), F.col(c).alias("_v"))))["_v"].alias(c)
    lists = F.array_sort(F.collect_list(F.when(F.col(joined).isNotNull(), F.struct(at.alias("_at"), F.col(joined).alias("_v")))))
    return snapshots.groupBy(*by).agg(
        F.min(F.struct(at.alias("_at"), *base)).alias("m"), F.min(F.when(rank > 0, rank)).cast("int").alias("r"), *[first(k) for k in keys],
        F.flatten(F.transform(lists, lambda x: x["_v"])).alias(joined), F.count("*").alias("n_merged"),
    ).select(*by, *[f"m.{c}" for c in base], F.when(F.col("r").isNotNull(), F.element_at(F.array(*map(F.lit, RANKS)), F.coalesce("r", F.lit(1)))).alias("status"), *keys, joined, "n_merged")
