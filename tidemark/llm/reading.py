"""Reading level of each document from a latent difficulty model.

Rasch's multiplicative Poisson model links documents and words: word w is expected in a
document of length n and level t at the rate n * exp(a_w * t - b_w) / Z(t).  Words of a
high slope a_w mark demanding texts, words of a low one easy texts, and what appears at
every level has a slope near 0 and counts for nothing.  Levels and word parameters are
estimated in turn: word parameters from the judged documents, levels of all documents
from those, word parameters again from all documents (judged ones weigh more), then the
final levels.

Each turn is one pass over word bags that were made once; turns go on until the spread of
words over levels settles.  Words share a number of slots by hash, a parameter, so the
model, the sums that a task emits and what is broadcast have a fixed size whatever the
corpus; with more slots than words it is the model by word but for few collisions.
Judged documents are never measured with word parameters that their own half of the
judgements went into; the straight line from latent level to judged scale is fitted on
those honest levels.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.tokens import small_batches
from tidemark.session import written

#: Slots that words share, and slots solved at once, which bounds the memory of a fit.
SLOTS, CHUNK = 1 << 16, 1 << 14
GRID = np.linspace(-1.0, 7.0, 81)
#: Groups of sums: documents without judgement, and the two halves of the judged ones.
FREE, HALVES = 0, (1, 2)
WORD = re.compile(r"[^\W\d_]+")
MOST_JUDGED = 200_000
#: Turns at most, and the share of all words that may still change level when they end.
MOST_TURNS, SETTLED = 12, 0.01
JUDGED_WEIGHT = 50.0


def bag(text: str | None, known: dict[str, int], slots_of: int = SLOTS) -> tuple[list[int], list[float]]:
    """Slots of a text's words and the square roots of their counts (repeats say less)."""
    counts = Counter(WORD.findall(text.lower())) if text else {}
    slots = []
    for word in counts:
        slot = known.get(word)
        if slot is None:
            if len(known) > 500_000:
                known.clear()
            slot = known[word] = zlib.crc32(word.encode("utf-8", "replace")) % slots_of
        slots.append(slot)
    return slots, [n**0.5 for n in counts.values()]


def bags(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """documents(doc_id, text) → doc_id, slots, weights; one row per row."""

    @F.pandas_udf("slots array<int>, weights array<float>")
    def make(text: pd.Series) -> pd.DataFrame:
        known: dict[str, int] = {}
        return pd.DataFrame([bag(t, known, slots) for t in text], columns=["slots", "weights"])

    return small_batches(documents).select("doc_id", make("text").alias("b")).select("doc_id", "b.slots", "b.weights")


class Model:
    """Slopes of all slots and log Z on the grid; levels are relative to `centre`."""

    def __init__(self, stats: dict[int, np.ndarray], groups: list[int], spread: float = 1.0, steps: int = 8):
        words = sum(stats[g][: -len(GRID)] for g in groups)
        exposure = sum(stats[g][-len(GRID) :, 0] for g in groups)
        total = max(exposure.sum(), 1e-9)
        self.centre = float((exposure * GRID).sum() / total)
        at = GRID - self.centre
        self.slope = np.zeros(len(words))
        sums = np.zeros(len(at))
        seen = np.flatnonzero(words[:, 0] > 0)
        for low in range(0, len(seen), CHUNK):
            mine = seen[low : low + CHUNK]
            count, lean = words[mine, 0], words[mine, 1] - self.centre * words[mine, 0]
            slope = np.zeros(len(count))
            for _ in range(steps):
                e = exposure * np.exp(np.clip(slope[:, None] * at, -30, 30))
                z = np.maximum(e.sum(1), 1e-12)
                mean = (e * at).sum(1) / z
                var = np.maximum((e * at * at).sum(1) / z - mean * mean, 0)
                slope = np.clip(slope + (lean - count * mean - slope / spread) / (count * var + 1 / spread), -3, 3)
            z = np.maximum((exposure * np.exp(np.clip(slope[:, None] * at, -30, 30))).sum(1), 1e-12)
            sums += np.exp(slope[:, None] * at + np.log(count / z)[:, None]).sum(0)
            self.slope[mine] = slope
        self.log_z = np.log(sums) if (sums > 0).all() else np.zeros(len(at))

    def level(self, lean: np.ndarray, size: np.ndarray, mean: float, sd: float) -> np.ndarray:
        """Posterior mean level of documents with the given summed slopes and sizes."""
        log = lean[:, None] * (GRID - self.centre) - size[:, None] * self.log_z - (GRID - mean) ** 2 / (2 * sd * sd)
        p = np.exp(log - log.max(1, keepdims=True))
        return (p * GRID).sum(1) / p.sum(1)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Of a batch of bags: flat slots and weights, the row of each, and the size of each row."""
    slots = batch.column("slots")
    lengths = np.diff(slots.offsets.to_numpy())
    row = np.repeat(np.arange(len(lengths)), lengths)
    flat, weight = slots.flatten().to_numpy(), batch.column("weights").flatten().to_numpy().astype(float)
    return flat, weight, row, np.bincount(row, weight, len(lengths))


def _levels(batch: pa.RecordBatch, models: list[Model], prior: tuple[float, float]) -> tuple[np.ndarray, ...]:
    """Each row's level by the model of its group, with what _flat gives."""
    flat, weight, row, size = _flat(batch)
    group = batch.column("part").to_numpy()
    out = np.full(len(size), np.nan)
    for g in np.unique(group):
        m, mine = models[g], group == g
        out[mine] = m.level(np.bincount(row, weight * m.slope[flat], len(size))[mine], size[mine], *prior)
    out[size == 0] = np.nan
    return out, flat, weight, row, size, group


def sums(rows: DataFrame, models: list[Model] | None, prior: tuple[float, float], slots: int = SLOTS) -> dict[int, np.ndarray]:
    """One turn's sums per group: of each slot, weight and weighted level; exposure of each grid point.

    rows(slots, weights, part, judged). Without models only judged documents count. A
    task emits one row per slot it met, so what is shuffled and fetched depends on the
    model's size and not on the corpus.
    """
    size_of = slots + len(GRID)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, size_of, 2))
        for batch in batches:
            judged = batch.column("judged").to_numpy(zero_copy_only=False)
            if models:
                level, flat, weight, row, size, group = _levels(batch, models, prior)
                level = np.where(np.isnan(judged), level, judged)
            else:
                (flat, weight, row, size), level, group = _flat(batch), judged, batch.column("part").to_numpy()
            use = ~np.isnan(level) & (size > 0)
            share = np.where(np.isnan(judged), 1.0, JUDGED_WEIGHT) * use
            level = np.where(use, level, 0.0)
            point = np.clip(np.rint((level - GRID[0]) / (GRID[1] - GRID[0])).astype(int), 0, len(GRID) - 1)
            for g in range(3):
                w = share * (group == g)
                total[g, :slots, 0] += np.bincount(flat, weight * w[row], slots)
                total[g, :slots, 1] += np.bincount(flat, weight * (w * level)[row], slots)
                total[g, slots:, 0] += np.bincount(point, size * w, len(GRID))
        g, slot = np.nonzero(total[:, :, 0])
        yield pa.RecordBatch.from_arrays([pa.array(g.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(total[g, slot, 0]), pa.array(total[g, slot, 1])], ["part", "slot", "n", "s"])

    made = rows.select("slots", "weights", "part", "judged").mapInArrow(turn, "part int, slot int, n double, s double")
    got = made.groupBy("part", "slot").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toArrow()
    out = {g: np.zeros((size_of, 2)) for g in range(3)}
    part, slot = got.column("part").to_numpy(), got.column("slot").to_numpy()
    for g in range(3):
        mine = part == g
        out[g][slot[mine], 0] = got.column("n").to_numpy()[mine]
        out[g][slot[mine], 1] = got.column("s").to_numpy()[mine]
    return out


def reading_levels(documents: DataFrame, labels: DataFrame, most_turns: int = MOST_TURNS, most_judged: int = MOST_JUDGED, slots: int = SLOTS) -> DataFrame:
    """documents(doc_id, text), labels(doc_id, reading_level) → doc_id, reading_level, judged.

    reading_level lies on the scale of the labels, clipped to their range; it is null for
    texts without words, and for all if there are no labels. Several judgements of a
    document count as their mean; labels of unknown documents don't count. At most
    `most_judged` judged documents, picked by hash, take part in fitting (a bound that
    lets them be broadcast); the levels, sums and passes cover all documents. Turns end
    once at most SETTLED of all words lie at another level than a turn before, and after
    `most_turns`.
    """
    means = labels.dropna(subset=["doc_id", "reading_level"]).groupBy("doc_id").agg(F.avg("reading_level").alias("judged"))
    means = means.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_judged)
    rows = bags(documents, slots).join(F.broadcast(means), "doc_id", "left")
    part = F.when(F.col("judged").isNull(), FREE).otherwise(F.pmod(F.xxhash64("doc_id"), F.lit(2)) + HALVES[0]).cast("int")
    rows = written(rows.select("doc_id", "slots", "weights", F.coalesce("judged", F.lit(float("nan"))).alias("judged"), part.alias("part")), "bags")
    judged = rows.where("not isnan(judged)")
    low, high, mean, sd = judged.agg(F.min("judged"), F.max("judged"), F.avg("judged"), F.stddev_pop("judged")).first()
    if mean is None:
        return rows.select("doc_id", F.lit(None).cast("double").alias("reading_level"), F.lit(None).cast("double").alias("judged"))
    prior = (mean, max(sd, 0.1))
    one = Model(sums(judged, None, prior, slots), [*HALVES])
    models, before = [one] * 3, None
    for _ in range(most_turns):
        got = sums(rows, models, prior, slots)
        with ThreadPoolExecutor(3) as pool:
            models = list(pool.map(lambda groups: Model(got, groups), ([FREE, *HALVES], [FREE, HALVES[1]], [FREE, HALVES[0]])))
        exposure = sum(got[g][-len(GRID) :, 0] for g in got)
        exposure = exposure / max(exposure.sum(), 1e-9)
        if before is not None and np.abs(exposure - before).sum() / 2 <= SETTLED:
            break
        before = exposure

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_levels(batch, models, prior)[0]), batch.column("judged")], ["doc_id", "latent", "judged"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    latent = written(rows.mapInArrow(final, f"doc_id {kind}, latent double, judged double"), "latent")
    slope, offset = latent.where("not isnan(judged) and not isnan(latent)").agg(F.regr_slope("judged", "latent"), F.regr_intercept("judged", "latent")).first()
    if slope is None or slope <= 0:
        slope, offset = 1.0, 0.0
    scaled = F.greatest(F.least(F.col("latent") * slope + offset, F.lit(float(high))), F.lit(float(low)))
    return latent.select("doc_id", F.when(~F.isnan("latent"), scaled).alias("reading_level"), F.when(~F.isnan("judged"), F.col("judged")).alias("judged"))
