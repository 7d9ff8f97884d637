"""Pairs each row with the row of another table nearest in time for the same entity.

Times of the sought table are the leaves of one binary trie per entity and block of
2^height milliseconds.  Every level is a hash table from (entity, level, time >> level)
to the first and last leaf under that prefix.  A path below its topmost node with one
leaf says nothing new and isn't stored, so sparse entities have little more than a root
per block.  The lowest node stored on a query's path is found by binary search over the
levels: one equi-join per step, with rows of the step's levels only, so the table is
read once in all, and with those queries only whose node still has several leaves.  That
node's first or last leaf is the successor or predecessor; leaves are linked to both
neighbours, over block borders too.  No step sorts, collects or compares all rows of an
entity.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordered import neighbours
from tidemark.session import written


def height_for(tolerance_ms: int) -> int:
    """Levels under a block's root: the smallest power of two not under the tolerance."""
    return max(1, (max(tolerance_ms, 1) - 1).bit_length())


def _parting(other: str, height: int) -> Column:
    """The lowest level at which t and its neighbour lie under one node; height + 1 if they share no block."""
    differ = F.expr(f"t ^ {other}")
    # a number's highest bit, without floating point
    bits = F.length(F.bin(differ))
    return F.when(F.coalesce((differ >= 0) & (bits <= height), F.lit(False)), bits).otherwise(height + 1)


def trie(linked: DataFrame, height: int) -> DataFrame:
    """linked(entity, t, before, after) → (entity, level, prefix, first, last) of the nodes stored.

    Of the nodes with one leaf only the topmost of each path is stored: the one just
    under the level where the leaf meets its nearer neighbour, or the block's root.
    """
    top = F.least(_parting("before.t", height), _parting("after.t", height)) - 1
    levels = linked.select("entity", "t", F.explode(F.sequence(F.greatest(top, F.lit(0)), F.lit(height))).alias("level"))
    return levels.groupBy("entity", "level", F.expr("shiftright(t, level)").alias("prefix")).agg(F.min("t").alias("first"), F.max("t").alias("last"))


def search_steps(low: int, high: int) -> list[list[tuple[int, int, int]]]:
    """The binary search for the lowest level present, as (low, high, middle) of each step.

    Levels above `high` need no probe: the root is known to be there. Every level is
    probed in one step only.
    """
    steps, spans = [], [(low, high)]
    while spans:
        now = [(a, b, (a + b) // 2) for a, b in spans if a < b]
        if not now:
            break
        steps.append(now)
        spans = [s for a, b, m in now for s in ((a, m), (m + 1, b))]
    return steps


def nearest(queries: DataFrame, sought: DataFrame, tolerance_ms: int) -> DataFrame:
    """queries(entity, q), sought(entity, t, id) → entity, q, t, id of the nearest within the tolerance.

    Ties go to the earlier t, then the smaller id. Rows with null entity or time match
    nothing; queries without a match don't come out. Repeated rows count once.
    """
    height = height_for(tolerance_ms)
    leaves = sought.dropna(subset=["entity", "t"]).groupBy("entity", "t").agg(F.min("id").alias("id"))
    leaves = written(leaves, "leaves")
    linked = neighbours(leaves, ["entity"], ["t"], ["id"], 1 << height, "before", "after")
    linked = written(linked, "linked")
    asked = queries.dropna(subset=["entity", "q"]).select("entity", "q").distinct()
    nodes = written(trie(linked, height), "trie")

    # the root of the query's own block; without one, neighbours are at most one block away
    root = nodes.where(F.col("level") == height).select("entity", F.col("prefix").alias("p"), F.col("first").alias("_f"), F.col("last").alias("_l"))
    block = lambda by: F.expr(f"shiftright(q, {height}) + {by}L")
    found = asked.withColumn("p", block(0)).join(root, ["entity", "p"], "left").drop("p")
    inside = written(found.where("_f is not null"), "inside")
    outside = found.where("_f is null").select("entity", "q")
    left = root.select("entity", "p", F.col("_l").alias("pred"))
    right = root.select("entity", "p", F.col("_f").alias("succ"))
    outside = outside.withColumn("p", block(-1)).join(left, ["entity", "p"], "left").withColumn("p", block(1)).join(right, ["entity", "p"], "left").select("entity", "q", "pred", "succ")

    # a node with one leaf is the lowest stored on its path
    settled = [inside.where("_f = _l")]
    state = inside.where("_f < _l").withColumns({"lo": F.lit(0), "hi": F.lit(height)})
    for step in search_steps(0, height):
        middles = [m for _, _, m in step]
        level = nodes.where(F.col("level").isin(middles)).select("entity", "level", "prefix", "first", "last")
        probe = state.withColumn("level", F.expr("(lo + hi) div 2").cast("int")).withColumn("prefix", F.expr("shiftright(q, level)"))
        hit = F.col("first").isNotNull()
        state = probe.join(level, ["entity", "level", "prefix"], "left").select(
            "entity", "q",
            F.when(hit, F.col("first")).otherwise(F.col("_f")).alias("_f"),
            F.when(hit, F.col("last")).otherwise(F.col("_l")).alias("_l"),
            F.when(hit, F.col("lo")).otherwise(F.col("level") + 1).alias("lo"),
            F.when(hit, F.col("level")).otherwise(F.col("hi")).alias("hi"),
        )
        state = written(state, "step")
        settled.append(state.where("_f = _l or lo >= hi").drop("lo", "hi"))
        state = state.where("_f < _l and lo < hi")
    state = reduce(DataFrame.unionByName, settled)
    # under the lowest node the query's side has no leaf: all its leaves lie on the other side
    node = state.select("entity", "q", F.when(F.col("_f") >= F.col("q"), F.col("_f")).otherwise(F.col("_l")).alias("t"))
    ends = linked.select("entity", "t", "id", "before", "after")
    close = node.join(ends, ["entity", "t"])
    this = F.struct("t", "id")
    candidates = close.select("entity", "q", F.array(F.when(F.col("t") <= F.col("q"), this).otherwise(F.col("before")), F.when(F.col("t") >= F.col("q"), this).otherwise(F.col("after"))).alias("c"))
    ids = linked.select("entity", "t", "id")
    out = (
        outside.join(ids.select("entity", F.col("t").alias("pred"), F.col("id").alias("pi")), ["entity", "pred"], "left")
        .join(ids.select("entity", F.col("t").alias("succ"), F.col("id").alias("si")), ["entity", "succ"], "left")
        .select("entity", "q", F.array(F.when(F.col("pred").isNotNull(), F.struct(F.col("pred").alias("t"), F.col("pi").alias("id"))), F.when(F.col("succ").isNotNull(), F.struct(F.col("succ").alias("t"), F.col("si").alias("id")))).alias("c"))
    )
    best = F.array_min(F.transform(F.filter("c", lambda x: x.isNotNull()), lambda x: F.struct(F.abs(x["t"] - F.col("q")).alias("d"), x["t"].alias("t"), x["id"].alias("id"))))
    return candidates.unionByName(out).withColumn("b", best).where(F.col("b.d") <= tolerance_ms).select("entity", "q", "b.t", "b.id")


def canonical_symbol(c: Column) -> Column:
    return F.nullif(F.upper(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), F.lit(""))
