"""Scans of partitioned Parquet: market slices with optional columns, packets of a span of hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.text import ascii_upper

# The columns of a slice file and their types.
REQUIRED = {
    "base_asset": "string", "symbol_canonical": "string", "venue": "string", "slice_completeness": "string",
    "window_start_ms": "bigint", "window_end_ms": "bigint", "trade_count": "bigint", "trade_volume": "double",
}
OPTIONAL = {"mid_price": "double", "spread_bps": "double"}


def read_slices(spark: SparkSession, *paths: str) -> DataFrame:
    """The slices of some files or folders; optional columns that a file hasn't come out null.

    The schema is given and not merged from all footers. A file with another type in a
    column fails when it is read; one without a required column is an error if no file
    under its path has it, and otherwise gives nulls there.
    """
    wrong = set()
    for path in paths:
        have = dict(spark.read.parquet(path).dtypes)  # the footer of one file
        wrong |= {c for c, t in REQUIRED.items() if have.get(c) != t} | {c for c, t in OPTIONAL.items() if have.get(c, t) != t}
    if wrong:
        raise ValueError(f"missing or of another type: {', '.join(sorted(wrong))}")
    schema = ", ".join(f"{c} {t}" for c, t in {**REQUIRED, **OPTIONAL}.items())
    return spark.read.schema(schema).parquet(*paths)


def wanted(slices: DataFrame, symbols: DataFrame) -> DataFrame:
    """slices whose asset or canonical symbol, in upper case, is among symbols(symbol); rows stay as they are.

    Two semi-joins: first by asset, then by canonical symbol for what the first left.
    """
    names = symbols.select(ascii_upper(F.col("symbol")).alias("_w")).where("_w is not null").distinct()
    asset, canonical = ascii_upper(F.col("base_asset")), ascii_upper(F.col("symbol_canonical"))
    by_asset = slices.join(names, asset == F.col("_w"), "left_semi")
    rest = slices.join(names, asset == F.col("_w"), "left_anti").join(names, canonical == F.col("_w"), "left_semi")
    return by_asset.unionByName(rest)


def within_hours(dt: str, hour: str, first_ms: int, last_ms: int) -> Column:
    """A filter on partition columns dt=yyyy-MM-dd and hour=HH for the hours from first_ms to last_ms.

    Compares whole days and, at the two ends, hours, all on partition columns: other
    folders are never listed or read.
    """
    import datetime as d

    at = lambda ms: d.datetime.fromtimestamp(ms // 1000, d.UTC)
    a, b = at(first_ms), at(last_ms)
    day, h = F.col(dt).cast("string"), F.col(hour).cast("int")
    lo, hi = str(a.date()), str(b.date())
    return (day >= lo) & (day <= hi) & ((day > lo) | (h >= a.hour)) & ((day < hi) | (h <= b.hour))


def recent_prefixes(explicit: list[str], now_ms: int, hours: int, family: str) -> list[str]:
    """The prefixes given, then those of the last `hours` hours, newest first, each once."""
    import datetime as d

    at = [d.datetime.fromtimestamp(now_ms // 1000, d.UTC) - d.timedelta(hours=k) for k in range(hours)]
    return list(dict.fromkeys([*explicit, *[f"{family}/dt={t:%Y-%m-%d}/hour={t:%H}/" for t in at]]))


def under_prefixes(keys: DataFrame, key: str, prefixes: list[str], most: int) -> DataFrame:
    """keys that begin with one of the prefixes, with the first prefix they do; at most `most` per prefix, by key.

    The limit is the operator's: a pass over a prefix takes so many and comes again.
    """
    prefix = F.coalesce(*[F.when(F.col(key).startswith(p), p) for p in prefixes]) if prefixes else F.lit(None).cast("string")
    first = Window.partitionBy("prefix").orderBy(key)
    rows = keys.withColumn("prefix", prefix).where("prefix is not null").withColumn("pos", F.row_number().over(first))
    return rows.where(F.col("pos") <= most)
