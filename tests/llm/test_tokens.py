import random

import pytest

from tidemark.llm import tokens as t

SCHEMA = "doc_id long, text string, ids int"


def whole(text):
    return t.encoder(t.VOCABULARY).encode_ordinary(text) if text else []


ALPHABET = ["a", "the ", "  ", "\n", "'s", "'", "=", "==", "9", "é", "한국", "🙂", "\t", "don't ", "x" * 9, " " * 9, "_", " ", "\x1f", "<|endoftext|>"]


def test_joined_pieces_equal_the_whole_text():
    rnd, enc = random.Random(3), t.encoder(t.VOCABULARY)
    for _ in range(1500):
        text = "".join(rnd.choice(ALPHABET[: rnd.choice([2, 6, 20])]) * rnd.choice([1, 1, 3]) for _ in range(rnd.choice([1, 5, 40])))
        for most in (2, 5, 17):
            parts = t.pieces(text, most)
            assert "".join(p for p, _ in parts) == text
            assert t.tree([(whole(p), s) for p, s in parts], enc) == whole(text)


@pytest.mark.parametrize("text", ["a" * 5000, "=" * 5000, " " * 5000, "ab1'" * 1200, "字" * 3000, "é🙂" * 900])
def test_stretches_without_a_sure_cut(text):
    parts = t.pieces(text, 64)
    assert t.tree([(whole(p), s) for p, s in parts], t.encoder(t.VOCABULARY)) == whole(text)


def test_rows_nulls_long_texts_and_repeats(spark):
    long = "a b'c " * 400 + "z" * 900
    rows = [(1, None, 0), (2, "", 0), (3, "short <|endoftext|>", 0), (4, long, 0), (4, long, 0), (5, long + "!", 0), (None, "x", 0)]
    got = sorted(((r.doc_id or 0, list(r.ids)) for r in t.encode(spark.createDataFrame(rows, SCHEMA), piece_chars=100).collect()))
    assert got == sorted((d or 0, whole(x)) for d, x, _ in rows)
    assert t.encode(spark.createDataFrame([], SCHEMA)).count() == 0
