"""New batches checked for repeats against everything accepted so far.

A record repeats an accepted one if they share an exact key or if their texts are the
same words in the same order but for small edits.  A store keeps exact keys, minwise
band keys (in hash buckets), signatures and words of accepted records, and only of
those.  A batch brings its keys and bands into the same buckets, meets the stored rows
there, compares the texts of matching buckets, settles what is left within itself, and
appends what it accepts.  Stored rows are read where they lie, never shuffled, signed
or grouped again; only those that share a band with the batch are counted.

Minima are taken over a text's words, the k-th occurrence of a word being an element of
its own: texts of which four fifths of the longer one's words are common then resemble
each other by two thirds at least, wherever the edits lie.  A band's key also holds the
order in which its words stand in the text, which alike texts share and unrelated texts
that use the same words mostly don't.  Every band row carries a mark, some bits of
the signature and the text's length class, so most other pairs end where they meet.

Records are taken in order; one that repeats an accepted record is paired with the
earliest such and not accepted.  Within a batch that is settled in rounds: whatever has
no undecided earlier repeat is accepted, what repeats an accepted one is out.  Records
with equal keys or equal texts meet in their key, never in pairs, so a group of copies
of any size costs one row per record and round.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.session import give_back, removed, scratch, written
from tidemark.sources.buckets import Buckets, Markers

WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Likeness:
    """least_words: shorter texts are not compared. share: of the longer text's words that
    must be common, in order. bands, rows: minwise bands, and minima in a band. bucket:
    members up to which all of a bucket are compared at once; larger ones are compared
    with their accepted texts, in blocks. near: least estimated resemblance of pairs
    worth the exact comparison (pairs at the border have two thirds)."""

    least_words: int = 12
    share: float = 0.8
    bands: int = 48
    rows: int = 6
    bucket: int = 1024
    near: float = 0.5
    seed: int = 20240101


#: Bits of a mark that come from the signature, and the step between its length classes.
MARK_BITS, CLASS = 120, 1.03
MARK = ["mark", "more"]


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, 64 and more words to a machine operation."""
    place: dict[str, int] = {}
    for i, w in enumerate(a):
        place[w] = place.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for w in b:
        hit = free & place.get(w, 0)
        free = (free + hit | free - hit) & full
    return len(a) - free.bit_count()


def alike(a: str, b: str, rule: Likeness) -> bool:
    x, y = a.split(" "), b.split(" ")
    longer = max(len(x), len(y))
    need = rule.share * longer - 1e-9
    return min(len(x), len(y)) >= max(need, rule.least_words) and common(x, y) >= need


def _elements(words: list[str], known: dict[str, int]) -> list[int]:
    """A hash of every word; its second, third … occurrence has another one."""
    out, times = [], {}
    for w in words:
        h = known.get(w)
        if h is None:
            if len(known) > 500_000:
                known.clear()
            h = known[w] = xxhash.xxh3_64_intdigest(w)
        k = times[w] = times.get(w, -1) + 1
        out.append(h if k == 0 else (h + k * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    return out


def signatures(texts: list[list[str]], rule: Likeness, known: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Band keys, marks and one bit per minimum of every text (none of them empty)."""
    rng = np.random.default_rng(rule.seed)
    n = rule.bands * rule.rows
    factor = rng.integers(1, 2**63, n, dtype=np.uint64) | np.uint64(1)
    shift = rng.integers(0, 2**63, n, dtype=np.uint64)
    word = np.array([h for words in texts for h in _elements(words, known)], dtype=np.uint64)
    sizes = np.array([len(words) for words in texts])
    starts = np.cumsum(sizes) - sizes
    # a minimum over 40 bits of hash brings its place in the text along in the other 24
    place = (np.arange(len(word)) - np.repeat(starts, sizes)).astype(np.uint64) & np.uint64(0xFFFFFF)
    low = np.empty((len(texts), n), dtype=np.uint64)
    for k in range(n):
        low[:, k] = np.minimum.reduceat((word * factor[k] + shift[k]) & np.uint64(0xFFFFFFFFFF000000) | place, starts)
    at, low = low & np.uint64(0xFFFFFF), low >> np.uint64(24)
    band = np.zeros((len(texts), rule.bands), dtype=np.uint64)
    mix = lambda band, x: (band ^ (band >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + x + np.uint64(1)
    for r in range(rule.rows):
        band = mix(band, low[:, r :: rule.rows])
        band = mix(band, sum((at[:, r :: rule.rows] > at[:, q :: rule.rows]).astype(np.uint64) for q in range(rule.rows)))
    band = (band ^ np.arange(rule.bands, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    bits = np.zeros((len(texts), -(-n // 64) * 64), dtype=np.uint8)
    bits[:, :n] = (low ^ (low >> np.uint64(7)) ^ (low >> np.uint64(17))) & np.uint64(1)
    mark = np.zeros((len(texts), 128), dtype=np.uint8)
    mark[:, 8 : 8 + min(n, MARK_BITS)] = bits[:, : min(n, MARK_BITS)]
    mark = np.packbits(mark, axis=1)
    mark[:, 0] = np.minimum(np.log(sizes) / math.log(CLASS), 255).astype(np.uint8)
    return band.view(np.int64), mark.view(np.int64), np.packbits(bits, axis=1).view(np.int64)


def sign(texts: DataFrame, rule: Likeness) -> DataFrame:
    """texts(id, body) → id, text_key, words, bands, mark, more, bits of every text long enough to compare.

    text_key is the same for texts of the same words.
    """

    @F.pandas_udf("text_key long, words string, bands array<long>, mark long, more long, bits array<long>")
    def make(body: pd.Series) -> pd.DataFrame:
        known: dict[str, int] = {}
        rows: list[tuple] = [(None,) * 6] * len(body)
        lists = [words_of(b) for b in body]
        todo = [i for i, w in enumerate(lists) if len(w) >= rule.least_words]
        for low in range(0, len(todo), 500):
            part = todo[low : low + 500]
            bands, marks, bits = signatures([lists[i] for i in part], rule, known)
            for k, i in enumerate(part):
                joined = " ".join(lists[i])
                rows[i] = (np.uint64(xxhash.xxh3_64_intdigest(joined)).astype(np.int64), joined, bands[k], *marks[k], bits[k])
        # as objects: beside a null, pandas would make whole numbers of 64 bits floating ones
        return pd.DataFrame(rows, columns=["text_key", "words", "bands", *MARK, "bits"], dtype=object)

    # were it deterministic, the filter would be pushed below a join of texts, and all of them signed there once more
    made = texts.select("id", make.asNondeterministic()("body").alias("s"))
    return made.where("s.text_key is not null").select("id", "s.*")


#: Keys that may be broadcast to filter rows, some 16 MB; beyond that a shuffle join does it.
MOST_BROADCAST = 1_000_000
#: Texts of a crowded bucket that the others are compared with in the first, second and each
#: further turn, and parts that the others are dealt to, so no task gets a whole bucket.
BLOCKS = [1, 64, 1024]
SALTS = 16


def narrowed(rows: DataFrame, keys: DataFrame, *on: str, how: str = "left_semi") -> DataFrame:
    """rows whose key is among the (materialised) keys, or isn't; broadcast only after counting them."""
    keys = keys.select(*on)
    return rows.join(F.broadcast(keys) if keys.count() <= MOST_BROADCAST else keys.distinct(), [*on], how)


def _close(rule: Likeness) -> Column:
    """Whether the marks of a and b leave it open that their texts are alike: lengths, then bits.

    The first byte of a mark (the last eight bits of its first word) is the length class.
    """
    classes = math.ceil(math.log(1 / rule.share) / math.log(CLASS))
    either = lambda c: F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))
    differ = F.bit_count(F.shiftrightunsigned(either("mark"), 8)) + F.bit_count(either("more"))
    size = lambda s: F.col(f"mark_{s}").bitwiseAND(F.lit(255))
    most = int(min(rule.bands * rule.rows, MARK_BITS) * (1.08 - rule.near) / 2)
    return (F.abs(size("a") - size("b")) <= classes) & (differ <= most)


def _side(rows: DataFrame, s: str, *more: str) -> DataFrame:
    return rows.select("band", F.col("text_key").alias(s), *[F.col(m).alias(f"{m}_{s}") for m in MARK], *more)


def _met(a: DataFrame, b: DataFrame, on: list[str], rule: Likeness) -> DataFrame:
    """Pairs (a, b) of different texts that meet in a bucket and whose marks are close.

    Marks are compared where the pairs arise, so other pairs are never shuffled.
    """
    return a.join(b, on).where((F.col("a") != F.col("b")) & _close(rule)).select("a", "b")


def _across(mine: DataFrame, theirs: DataFrame, rule: Likeness) -> DataFrame:
    """The same for large buckets: one side is dealt to SALTS parts, the other copied to all of them."""
    a = _side(mine, "a", F.pmod("text_key", F.lit(SALTS)).cast("int").alias("salt"))
    b = _side(theirs, "b", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return _met(a, b, ["band", "salt"], rule)


def _verified(pairs: DataFrame, texts: DataFrame, other: DataFrame, rule: Likeness) -> DataFrame:
    """The pairs (a of texts, b of other), each once, that are alike: first by all bits, then exactly.

    Words are looked up of the texts only that are left by then.
    """

    def side(source: DataFrame, key: str, what: str) -> DataFrame:
        return source.select(F.col("text_key").alias(key), F.col(what).alias(f"{what}_{key}"))

    @F.pandas_udf("boolean")
    def same(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([alike(p, q, rule) for p, q in zip(x, y)])

    differ = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda s, x: s + x)
    both = pairs.repartition("a").dropDuplicates().join(side(texts, "a", "bits"), "a").join(side(other, "b", "bits"), "b")
    close = written(both.where(differ <= int(rule.bands * rule.rows * (1 - rule.near) / 2)).select("a", "b"), "close")
    words = lambda source, key: narrowed(side(source, key, "words"), close, key)
    return close.join(words(texts, "a"), "a").join(words(other, "b"), "b").where(same("words_a", "words_b")).select("a", "b")


def settle(held: DataFrame, near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Who is accepted when records are taken in order; every round decides the earliest open record at least.

    held(rank, key): rank orders records and identifies them; near(key, other): keys
    whose holders repeat each other, both ways round. → accepted(rank), repeats(rank, of).
    """
    held = written(held.distinct(), "held")
    near = written(near.distinct(), "near")
    total = held
    taken: list[DataFrame] = []
    while not held.isEmpty():
        first = held.groupBy("key").agg(F.min("rank").alias("first"))
        around = near.join(first, near["other"] == first["key"]).select(near["key"], "first")
        lead = first.unionByName(around).groupBy("key").agg(F.min("first").alias("first"))
        wins = held.join(lead, "key").groupBy("rank").agg(F.min((F.col("rank") == F.col("first"))).alias("wins")).where("wins").select("rank")
        wins = written(wins, "wins")
        taken.append(wins)
        keys = held.join(wins, "rank", "left_semi").select("key").distinct()
        closed = keys.unionByName(near.join(keys.withColumnRenamed("key", "other"), "other", "left_semi").select("key")).distinct()
        out = held.join(closed, "key", "left_semi").select("rank").distinct()
        held = written(held.join(out, "rank", "left_anti"), "open")
    accepted = reduce(DataFrame.unionByName, taken) if taken else total.select("rank").limit(0)
    mine = total.join(accepted, "rank", "left_semi").select("key", F.col("rank").alias("of"))
    reach = mine.unionByName(near.join(mine.withColumnRenamed("key", "other"), "other").select("key", "of")).groupBy("key").agg(F.min("of").alias("of"))
    lost = total.join(accepted, "rank", "left_anti")
    repeats = lost.join(reach, "key").where("of < rank").groupBy("rank").agg(F.min("of").alias("of"))
    return accepted, repeats


RANK = "struct<at: bigint, id: string>"
#: Tables of the store, and the column whose hash buckets their rows lie in.
TABLES = {
    "seen": ("id string", "id"),
    "keys": (f"key binary, of {RANK}", "key"),
    "bands": ("band bigint, text_key bigint, mark bigint, more bigint", "band"),
    "texts": ("text_key bigint, words string, bits array<bigint>", "text_key"),
}
PENDING = {"pending": TABLES["bands"]}


def text_id(c: Column) -> Column:
    """The exact key that stands for a text."""
    return key_of("text", c.cast("string"))


def key_of(kind: str, c: Column) -> Column:
    """An exact key as 16 bytes; null stays null."""
    return F.unhex(F.md5(F.concat(F.lit(kind + ":"), c)))


class History:
    """The store under `path`, in hash buckets: `buckets` of them, about one for ten thousand texts expected.

    The number is fixed by the first batch; `compact` can change it.
    """

    def __init__(self, spark: SparkSession, path: str, rule: Likeness = Likeness(), buckets: int = 16):
        self.spark, self.path, self.rule = spark, path.rstrip("/"), rule
        # hashes don't shrink by compression
        kind = lambda n: "none" if n in ("bands", "pending") else "zstd"
        self.tables = {n: Buckets(spark, f"{self.path}/{n}", *spec, buckets, kind(n)) for n, spec in (TABLES | PENDING).items()}
        self.markers = Markers(spark, self.path)

    def table(self, name: str) -> DataFrame:
        return self.tables[name].rows(self.markers.batches())

    def compact(self) -> None:
        """All batches so far as one, so that a bucket is one file again."""
        done = self.markers.batches()
        if len(done) < 2:
            return
        batch = done[-1] + 1
        for n in TABLES:
            self.tables[n].put(self.tables[n].rows(done), batch, placed=True)
        self.markers.commit(batch, "compacted")
        for n in TABLES:
            for b in done:
                self.tables[n].remove(b)

    def admit(self, records: DataFrame, bodies: DataFrame) -> DataFrame:
        """records(id, at, keys), bodies(id, body) → (id, of_id) of repeats.

        Records of ids seen before are left out, and bodies of other ids. keys: array of
        exact keys, nulls ignored. Of several rows of an id the one with the smallest (at,
        keys) counts; a null time comes last. Of several bodies of an id one counts, always
        the same. Committed by one marker at the end: a batch that failed half-way leaves
        no trace and can be given again.
        """
        with scratch(self.spark):
            return self._admit(records, bodies)

    def _admit(self, records: DataFrame, bodies: DataFrame) -> DataFrame:
        done = self.markers.batches()
        batch = max(done, default=0) + 1
        put = lambda name, rows, placed=False: self.tables[name].put(rows, batch, placed)
        past = {n: self.tables[n].rows(done) for n in TABLES} if done else None
        fresh = records.where("id is not null").groupBy("id").agg(F.min(F.struct(F.coalesce("at", F.lit(2**62)).alias("at"), "keys")).alias("m")).select("id", "m.at", "m.keys")
        if past:
            fresh = fresh.join(past["seen"], "id", "left_anti")
        fresh = written(fresh, "ids")
        signed = written(sign(narrowed(bodies, fresh, "id"), self.rule), "banded")
        text = signed.select("id", "text_key").groupBy("id").agg(F.min("text_key").alias("text_key"))
        fresh = fresh.join(text, "id", "left").select(
            "id", "text_key", F.struct("at", "id").alias("rank"), F.array_compact(F.array_union(F.coalesce("keys", F.array().cast("array<binary>")), F.array(text_id(F.col("text_key"))))).alias("keys")
        )
        fresh = written(fresh, "fresh")
        held = fresh.select("id", "rank", F.explode("keys").alias("key"))
        # one record stands for each text, so copies are not banded again and again
        stand = written(fresh.where("text_key is not null").groupBy("text_key").agg(F.min("id").alias("id")), "stand")
        texts = narrowed(signed, stand, "id", "text_key")
        put("pending", texts.select(F.explode("bands").alias("band"), "text_key", *MARK))
        new = self.tables["pending"].rows([batch])
        # from here on a batch's bands are needed in their buckets only
        texts = written(texts.select("text_key", "words", "bits"), "texts")
        removed(self.spark, signed)
        give_back(self.spark)

        gone = None
        if past:
            hits = held.join(past["keys"], "key").select("id", "of")
            pairs = self._old_pairs(new, past["bands"])
            old = _verified(pairs, texts, past["texts"], self.rule)
            old = old.select(text_id(F.col("a")).alias("mine"), text_id(F.col("b")).alias("key")).join(past["keys"], "key")
            hits = hits.unionByName(held.join(old.select(F.col("mine").alias("key"), "of"), "key").select("id", "of"))
            gone = written(hits.groupBy("id").agg(F.min("of").alias("of")), "gone", keep=True)
            held = held.join(gone, "id", "left_anti")
        repeats = self._settled(held, texts, new, fresh)

        lost = repeats.select("rank.id")
        if gone is not None:
            lost = lost.unionByName(gone.select("id"))
        kept = written(fresh.join(lost, "id", "left_anti"), "kept")
        out = written(stand.select("text_key").join(kept.select("text_key").distinct(), "text_key", "left_anti"), "out")
        put("seen", fresh.select("id"))
        put("keys", kept.select(F.explode("keys").alias("key"), F.col("rank").alias("of")))
        put("texts", narrowed(texts, out, "text_key", how="left_anti").dropDuplicates(["text_key"]))
        put("bands", narrowed(new, out, "text_key", how="left_anti"), placed=True)
        self.markers.commit(batch)
        for n in PENDING:
            self.tables[n].remove(batch)
        found = repeats.select("rank.id", F.col("of.id").alias("of_id"))
        return found if gone is None else found.unionByName(gone.select("id", F.col("of.id").alias("of_id")))

    def _shared(self, new: DataFrame) -> DataFrame:
        """Band rows of buckets with other members in the batch, and n, how many there are. Most rows have none."""
        sizes = new.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
        return written(new.join(sizes.hint("shuffle_hash"), "band"), "shared")

    def _old_pairs(self, new: DataFrame, old: DataFrame) -> DataFrame:
        """Pairs (a new, b old) that share a bucket and are close by their marks.

        Rows without a partner on the other side fall away inside their bucket, before
        anything is counted, sorted or shuffled.
        """
        most, members = self.rule.bucket, Window.partitionBy("band")
        theirs = written(old.join(new.select("band").hint("shuffle_hash"), "band", "left_semi").withColumn("m", F.count("*").over(members)), "theirs")
        mine = written(narrowed(new, theirs, "band").withColumn("n", F.count("*").over(members)), "mine")
        some = _met(_side(mine.where(F.col("n") <= most), "a"), _side(theirs.where(F.col("m") <= most), "b"), ["band"], self.rule)
        large = mine.where(F.col("n") > most).select("band").unionByName(theirs.where(F.col("m") > most).select("band"))
        hot = written(large.distinct(), "hot")
        if not hot.isEmpty():
            some = some.unionByName(_across(narrowed(mine, hot, "band"), narrowed(theirs, hot, "band"), self.rule))
        return some

    def _settled(self, held: DataFrame, texts: DataFrame, new: DataFrame, fresh: DataFrame) -> DataFrame:
        """(rank, of) of the batch's records that repeat one accepted in the batch.

        All pairs of a crowded bucket would be too many, and most of its texts may repeat
        its earliest. So all are compared with that one, the batch is settled, and then all
        are compared with block after block of the bucket's accepted texts, settling again
        whenever that finds a pair, until every accepted text has been compared with its
        whole bucket. Then no two accepted texts are alike, and every other has an accepted
        one it repeats, which only the one-by-one result has. Each turn compares at least
        one text more of every bucket that isn't done, so it ends.
        """

        def both(pairs: DataFrame) -> DataFrame:
            ids = pairs.select(text_id(F.col("a")).alias("key"), text_id(F.col("b")).alias("other"))
            return ids.unionByName(ids.select(F.col("other").alias("key"), F.col("key").alias("other")))

        def resolve(near: DataFrame) -> DataFrame:
            # most records share nothing with any other and are accepted at once
            shared = held.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key").unionByName(near.select("key")).distinct()
            ids = held.join(shared, "key", "left_semi").select("id").distinct()
            contested = written(held.join(ids, "id", "left_semi").select("rank", "key"), "contested")
            return written(settle(contested, near)[1], "repeats", keep=True)

        shared = self._shared(new)
        some = shared.where(F.col("n") <= self.rule.bucket)
        pairs = _met(_side(some, "a"), _side(some, "b"), ["band"], self.rule).where("a < b")
        near = written(both(_verified(pairs, texts, texts, self.rule)), "near")
        crowded = written(shared.where(F.col("n") > self.rule.bucket).select("band", "text_key", *MARK), "crowded")
        if crowded.isEmpty():
            return resolve(near)
        holders = written(fresh.join(held.select("id").distinct(), "id", "left_semi").where("text_key is not null").select("text_key", "rank"), "holders")
        # rest: a bucket's members that were not yet compared with all the others
        rest = crowded.join(holders.groupBy("text_key").agg(F.min("rank").alias("rank")), "text_key")
        rest, repeats, turn = written(rest, "crowded"), None, 0
        while True:
            taken = rest
            if turn:
                # a text is accepted if any of its holders is, though the first may repeat another by a key
                accepted = holders.join(repeats.select("rank"), "rank", "left_anti").groupBy("text_key").agg(F.min("rank").alias("rank"))
                taken = rest.drop("rank").join(accepted, "text_key")
            order = Window.partitionBy("band").orderBy("rank", "text_key")
            leaders = taken.withColumn("k", F.row_number().over(order)).where(F.col("k") <= BLOCKS[min(turn, len(BLOCKS) - 1)])
            leaders = written(leaders.select("band", "text_key", *MARK), "leaders")
            if leaders.isEmpty():
                return resolve(near) if repeats is None else repeats
            close = _across(rest, leaders, self.rule).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            found = written(both(_verified(close, texts, texts, self.rule)).join(near, ["key", "other"], "left_anti").distinct(), "found")
            more = not found.isEmpty()
            if more:
                near = written(near.unionByName(found), "near")
            if more or repeats is None:
                repeats = resolve(near)
            rest = written(rest.join(leaders, ["band", "text_key"], "left_anti"), "crowded")
            turn += 1
