"""Token ids of whole texts with a public byte-level BPE tokenizer.

Short texts are encoded where they lie.  A text longer than `piece_chars` is halved, the
halves again, until every piece is short enough; pieces are encoded as rows of their
own, spread over the cluster.  A cut before white space never lies inside a token.
Where an unsplit stretch leaves no such place, the cut is in the middle, and the join
re-encodes a growing window around it until the tokens at both of its ends are those
that the sides have already: from there on both sides agree with the whole text.
"""

from __future__ import annotations

import base64
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how texts are split before byte pairs are merged, part of the tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECE_CHARS = 16_384
#: Tokens that must agree at either end of a window, and its first half width.
AGREE, FIRST = 2, 8


@cache
def encoder(vocabulary: str):
    """The tokenizer, loaded once per Python worker."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def cut_at(text: str, low: int, high: int) -> tuple[int, bool]:
    """Where to halve text[low:high], and whether the cut is sure to lie between tokens.

    Every token ends before white space that follows other characters, so the nearest
    such place to the middle, within a quarter of the span, is sure.
    """
    middle, reach = (low + high) // 2, (high - low) // 4
    for off in range(reach):
        for at in (middle - off, middle + off):
            if low < at < high and text[at] in " \n\t\r" and not text[at - 1].isspace():
                return at, True
    return middle, False


def pieces(text: str, most: int) -> list[tuple[str, bool]]:
    """The pieces of a text in order, each with whether the cut after it is sure."""
    out, todo = [], [(0, len(text), True)]
    while todo:
        low, high, sure = todo.pop()
        if high - low <= max(most, 2):
            out.append((text[low:high], sure))
        else:
            at, fine = cut_at(text, low, high)
            todo += [(at, high, sure), (low, at, fine)]
    return out


def joined(left: list[int], right: list[int], enc) -> list[int]:
    """Ids of the joined text, from the ids of its two sides."""
    wide = FIRST
    while True:
        a, b = left[max(0, len(left) - wide):], right[:wide]
        whole_left, whole_right = len(a) == len(left), len(b) == len(right)
        try:
            text = enc.decode_bytes(a + b).decode()
        except UnicodeDecodeError:  # the window begins or ends inside a character
            wide += 1
            continue
        mid = enc.encode_ordinary(text)
        if (whole_left or mid[:AGREE] == a[:AGREE]) and (whole_right or mid[-AGREE:] == b[-AGREE:]):
            return left[: len(left) - len(a)] + mid + right[len(b):]
        wide *= 2


def tree(parts: list[tuple[list[int], bool]], enc) -> list[int]:
    """Ids of the whole text: halves of the pieces joined, then halves of those."""
    if len(parts) == 1:
        return parts[0][0]
    half = len(parts) // 2
    left, right = tree(parts[:half], enc), tree(parts[half:], enc)
    return left + right if parts[half - 1][1] or not left or not right else joined(left, right, enc)


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Keeps Arrow batches of long texts to some megabytes."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > rows:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df


def encode(documents: DataFrame, vocabulary: str = VOCABULARY, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """documents(doc_id, text) → doc_id, ids: the ids of the whole text, without special tokens.

    Null and empty texts have the empty list. Strings that spell a special token are
    ordinary text. Repeated rows come out as often as they went in. `vocabulary` must
    be readable at the same path by all executors.
    """
    docs = small_batches(documents.select("doc_id", "text"))

    @F.pandas_udf("array<int>")
    def ids_of(text: pd.Series) -> pd.Series:
        enc = encoder(vocabulary)
        return pd.Series([enc.encode_ordinary(t) if t else [] for t in text])

    @F.pandas_udf("array<struct<piece string, sure boolean>>")
    def halves(text: pd.Series) -> pd.Series:
        return pd.Series([[{"piece": p, "sure": s} for p, s in pieces(t, piece_chars)] for t in text])

    @F.pandas_udf("array<int>")
    def whole(parts: pd.Series) -> pd.Series:
        enc = encoder(vocabulary)
        return pd.Series([tree([(list(map(int, p["ids"])), bool(p["sure"])) for p in ps], enc) for ps in parts])

    is_long = F.coalesce(F.length("text") > piece_chars, F.lit(False))
    short = docs.where(~is_long).select("doc_id", ids_of("text").alias("ids"))
    cut = docs.where(is_long).select("doc_id", F.xxhash64("text").alias("row"), halves("text").alias("h"))
    rows = cut.select("doc_id", "row", F.posexplode("h").alias("k", "h")).select("doc_id", "row", "k", "h.sure", "h.piece").repartition("doc_id", "row", "k")
    coded = rows.select("doc_id", "row", "k", "sure", ids_of("piece").alias("ids"))
    parts = coded.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set(F.struct("k", "sure", "ids"))).alias("parts"), F.count("*").alias("n"))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.call_function("div", F.col("n"), F.size("parts").cast("long"))))
    long = parts.select("doc_id", whole("parts").alias("ids"), copies.alias("copy")).drop("copy")
    return short.unionByName(long)
