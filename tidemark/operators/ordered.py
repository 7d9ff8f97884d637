"""Row order without one long sort per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def neighbours(df: DataFrame, keys: list[str], order: list[str], values: list[str], bucket: int, previous: str = "previous", following: str | None = None) -> DataFrame:
    """df with the struct `previous` (and `following`) of the row before (after) under the same keys.

    order[0] is a whole number that is cut into buckets of the given width; rows are
    sorted per key and bucket only, and one summary row per bucket carries its ends to
    the next one, so a hot key is spread over as many tasks as it has buckets. Null at
    the ends of a key. `order` must be unique within a key for a defined result.
    """
    held = F.struct(*[F.col(c) for c in dict.fromkeys([*order, *values])])
    rows = df.withColumn("_b", F.floor(F.col(order[0]) / F.lit(bucket)))
    inner = Window.partitionBy(*keys, "_b").orderBy(*order)
    rows = rows.withColumn(previous, F.lag(held).over(inner))
    ends = [F.max(held).alias("_last")]
    if following:
        rows = rows.withColumn(following, F.lead(held).over(inner))
        ends.append(F.min(held).alias("_first"))
    outer = Window.partitionBy(*keys).orderBy("_b")
    summary = df.withColumn("_b", F.floor(F.col(order[0]) / F.lit(bucket))).groupBy(*keys, "_b").agg(*ends)
    carried = summary.withColumn("_before", F.lag("_last").over(outer))
    keep = ["_before"]
    if following:
        carried = carried.withColumn("_after", F.lead("_first").over(outer))
        keep.append("_after")
    out = rows.join(carried.select(*keys, "_b", *keep), [*keys, "_b"], "left").withColumn(previous, F.coalesce(previous, "_before"))
    if following:
        out = out.withColumn(following, F.coalesce(following, "_after"))
    return out.drop("_b", *keep)
