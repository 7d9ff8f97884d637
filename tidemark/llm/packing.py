"""Documents packed into containers of a fixed number of tokens.

Documents are dealt by hash into cells of some thousands, whose number follows the
number of documents; each cell is packed by itself with Karmarkar-Karp multiway
differencing, so no task ever sees more than a cell.  The unused space is what
near-equal loads leave, plus at most one container's worth per cell.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

CAPACITY = 8192
CELL = 2048
#: Tasks that cells are packed in; more cells share them evenly.
MOST_TASKS = 4096


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """The items (by position) of each non-empty window, loads as equal as differencing makes them.

    Every item starts as a partition of its own. The two partitions with the widest
    spread are merged so that the heaviest window of one meets the lightest of the
    other, until one is left. Only non-empty windows are kept.
    """
    heap = [(-size, i) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    parts = {i: (np.array([size]), [[i]]) for i, size in enumerate(sizes)}
    tag = len(sizes)
    while len(heap) > 1:
        (big, at), (small, to) = (parts.pop(heapq.heappop(heap)[1]) for _ in range(2))
        if len(big) < len(small):
            (big, at), (small, to) = (small, to), (big, at)
        alone = min(windows - len(big), len(small))
        loads, items = np.concatenate([big, small[:alone]]), at + to[:alone]
        for k in range(alone, len(small)):
            meets = len(big) - 1 - (k - alone)
            loads[meets] += small[k]
            items[meets] = items[meets] + to[k]
        order = np.argsort(-loads, kind="stable")
        loads, items = loads[order], [items[k] for k in order]
        lightest = loads[-1] if len(loads) == windows else 0
        heapq.heappush(heap, (int(lightest - loads[0]), tag))
        parts[tag] = loads, items
        tag += 1
    return parts[heap[0][1]][1] if heap else []


def packed(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows none of which holds more than capacity; no single size may exceed it.

    Begins with as few windows as the total needs; the count rises by what the heaviest
    window is over, one at least, whenever it is over.
    """
    total = sum(sizes)
    windows = max(1, -(-total // capacity))
    while True:
        out = differencing(sizes, windows)
        over = max((sum(sizes[i] for i in w) for w in out), default=0) - capacity
        if over <= 0:
            return out
        windows += max(1, windows * over // (4 * capacity))


def pack(sizes: DataFrame, rows: int, capacity: int = CAPACITY, cell: int = CELL) -> DataFrame:
    """sizes(doc_id, n_tokens) → doc_id, part_no, n_tokens, container_id.

    A document over capacity is split into parts that fill a container each, and a rest
    that is packed like any other; no other document is split. Documents of size 0 or
    null go into the first container of their cell with 0 tokens. Rows that repeat a
    doc_id count once (the largest size). `rows` is the number of rows expected; it only
    sets how many cells there are.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    cells = max(1, -(-rows // cell))
    # packing is work and not bytes, so cells get tasks of their own instead of being merged by size
    tasks = min(cells, MOST_TASKS)
    one = sizes.groupBy("doc_id").agg(F.coalesce(F.max("n_tokens").cast("long"), F.lit(0).cast("long")).alias("n"))
    full = F.call_function("div", F.col("n"), F.lit(capacity).cast("long"))
    whole = one.where(F.col("n") >= capacity).select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), full - 1)).alias("part_no"))
    filled = whole.select("doc_id", "part_no", F.lit(capacity).cast("long").alias("n_tokens"), F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit("-"), F.col("part_no").cast("string")).alias("container_id"))
    rest = one.select("doc_id", full.alias("part_no"), F.pmod("n", F.lit(capacity).cast("long")).alias("n_tokens"), F.pmod(F.xxhash64("doc_id"), F.lit(cells)).alias("cell"))
    rest = rest.where((F.col("part_no") == 0) | (F.col("n_tokens") > 0))

    def of_cell(key: tuple, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["n_tokens", "doc_id", "part_no"], ascending=[False, True, True], ignore_index=True)
        sizes = [int(n) for n in items["n_tokens"] if n > 0]
        where = np.zeros(len(items), dtype=np.int64)
        for w, members in enumerate(packed(sizes, capacity)):
            where[members] = w
        items["container_id"] = [f"c{key[0]}-{w}" for w in where]
        return items[["doc_id", "part_no", "n_tokens", "container_id"]]

    kind = sizes.schema["doc_id"].dataType.simpleString()
    return filled.unionByName(rest.repartition(tasks, "cell").groupBy("cell").applyInPandas(of_cell, f"doc_id {kind}, part_no bigint, n_tokens bigint, container_id string"))


def profile(assigned: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, the fewest that could do, tokens, parts, the fullest container and mean fill."""
    loads = assigned.groupBy("container_id").agg(F.sum("n_tokens").alias("load"), F.count("*").alias("n"))
    cap = F.lit(capacity).cast("long")
    return loads.agg(F.count("*").alias("n_containers"), F.sum("load").alias("n_tokens"), F.sum("n").alias("n_parts"), F.max("load").alias("max_load")).select(
        "n_containers", F.call_function("div", F.col("n_tokens") + cap - 1, cap).alias("fewest"), "n_tokens", "n_parts", "max_load", (F.col("n_tokens") / (F.col("n_containers") * cap)).alias("fill")
    )
