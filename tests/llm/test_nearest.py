import random

from tidemark.llm.nearest import nearest, search_steps

Q, S = "entity string, q long, id string", "entity string, t long, id long, q string"


def brute(queries, sought, tolerance):
    out = set()
    for e, q in {(e, q) for e, q, _ in queries if e is not None and q is not None}:
        best = min(((abs(t - q), t, i) for f, t, i, _ in sought if f == e and t is not None), default=None)
        if best and best[0] <= tolerance:
            out.add((e, q, best[1], best[2]))
    return out


def run(spark, queries, sought, tolerance):
    got = nearest(spark.createDataFrame(queries, Q), spark.createDataFrame(sought, S), tolerance).collect()
    assert len(set(got)) == len(got)
    return set(map(tuple, got))


def test_every_level_is_probed_in_one_step():
    seen = [m for step in search_steps(0, 21) for _, _, m in step]
    assert len(seen) == len(set(seen)) == 21 and len(search_steps(0, 21)) <= 5


def test_against_brute_force(spark):
    rnd = random.Random(4)
    for span, tolerance in ((300, 7), (5000, 100), (10**6, 600)):
        sought = [(rnd.choice("ab"), rnd.randint(-span // 4, span), rnd.randint(0, 50), "x") for _ in range(150)] + [("h", t, t, "x") for t in range(0, 400, 2)]
        queries = [(rnd.choice("abhc"), rnd.randint(-span // 4, span), "y") for _ in range(200)]
        assert run(spark, queries, sought, tolerance) == brute(queries, sought, tolerance)


def test_ties_nulls_repeats_and_empty_tables(spark):
    sought = [("a", 90, 5, ""), ("a", 110, 1, ""), ("a", 110, 1, ""), ("a", 90, 4, ""), (None, 100, 1, ""), ("b", None, 1, "")]
    queries = [("a", 100, ""), ("a", 100, ""), (None, 100, ""), ("b", 1, ""), ("a", None, ""), ("a", 200, "")]
    assert run(spark, queries, sought, 10) == {("a", 100, 90, 4)}
    assert run(spark, queries, sought, 9) == set()
    assert run(spark, [], sought, 10) == set() and run(spark, queries, [], 10) == set()
