import random

import numpy as np

from tidemark.llm.reading import reading_levels

TIERS = {k: [f"{'abcde'[k]}{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(5)] for k in range(5)}
DOCS, LABELS = "doc_id long, text string, reading_level string", "doc_id long, rater string, reading_level int"


def corpus(n, seed):
    rnd = random.Random(seed)
    docs, true = [], {}
    for k in range(n):
        level = rnd.randint(1, 5)
        words = [rnd.choice(TIERS[min(4, max(0, round(rnd.gauss(level - 1, 0.7))))]) for _ in range(rnd.randint(30, 120))] + [f"code{rnd.choice('xyz')}"] * 5
        docs.append((k, " ".join(words), "x"))
        true[k] = level
    return docs, true


def test_held_out_levels(spark):
    docs, true = corpus(400, 1)
    labels = [(k, "r", true[k]) for k in range(0, 400, 4)]
    got = {r.doc_id: r.reading_level for r in reading_levels(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    rest = [k for k in true if k % 4]
    p, y = np.array([got[k] for k in rest]), np.array([true[k] for k in rest])
    assert len(got) == 400 and np.corrcoef(p, y)[0, 1] > 0.9 and np.abs(p - y).mean() < 0.5 and p.min() >= 1 and p.max() <= 5


def test_no_words_no_labels_unknown_documents(spark):
    docs = spark.createDataFrame([(1, None, ""), (2, "", ""), (3, "12 34 _", ""), (4, "plain words here", ""), (5, "plain words here", "")], DOCS)
    labels = spark.createDataFrame([(4, "r", 2), (4, "q", 3), (99, "r", 5), (None, "r", 1), (5, "r", None)], LABELS)
    got = {r.doc_id: r.reading_level for r in reading_levels(docs, labels).collect()}
    assert [got[k] for k in (1, 2, 3)] == [None] * 3 and got[4] == 2.5 and got[5] == 2.5
    none = reading_levels(docs, labels.limit(0)).collect()
    assert len(none) == 5 and all(r.reading_level is None for r in none)
    assert reading_levels(docs.limit(0), labels).count() == 0
