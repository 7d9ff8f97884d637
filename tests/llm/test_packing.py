import random
from collections import defaultdict

from tidemark.llm.packing import differencing, pack, packed, profile


def test_every_item_once_and_near_equal_loads():
    rnd = random.Random(1)
    sizes = [rnd.randint(1, 500) for _ in range(400)]
    windows = differencing(sizes, 20)
    assert sorted(i for w in windows for i in w) == list(range(400)) and len(windows) == 20
    loads = [sum(sizes[i] for i in w) for w in windows]
    assert max(loads) - min(loads) < 20


def test_capacity_is_never_exceeded_and_small_cases():
    rnd = random.Random(2)
    for n in (0, 1, 2, 3, 50, 300):
        sizes = [rnd.randint(1, 100) for _ in range(n)]
        out = packed(sizes, 100)
        assert sorted(i for w in out for i in w) == list(range(n)) and all(sum(sizes[i] for i in w) <= 100 for w in out)
    assert len(packed([100] * 7, 100)) == 7 and len(packed([50] * 8, 100)) == 4


def test_documents_split_only_over_capacity(spark):
    rnd = random.Random(3)
    rows = [(k, rnd.randint(0, 300), "x") for k in range(500)] + [(1000, 2500, "x"), (1001, 2000, "x"), (1002, None, "x"), (1003, 1000, "x"), (5, 0, "again")]
    got = pack(spark.createDataFrame(rows, "doc_id long, n_tokens int, container_id string"), len(rows), 1000, 100)
    parts, loads = defaultdict(list), defaultdict(int)
    for r in got.collect():
        parts[r.doc_id].append((r.part_no, r.n_tokens))
        loads[r.container_id] += r.n_tokens
    want = {d: n or 0 for d, n, c in rows if c == "x"}
    assert {d: sum(n for _, n in p) for d, p in parts.items()} == want
    assert all(len(p) == 1 for d, p in parts.items() if want[d] <= 1000) and max(loads.values()) <= 1000
    assert [sorted(parts[d]) for d in (1000, 1001)] == [[(0, 1000), (1, 1000), (2, 500)], [(0, 1000), (1, 1000)]]
    one = profile(got, 1000).first()
    assert one.n_tokens == sum(want.values()) and one.fill > 0.9
    assert pack(spark.createDataFrame([], "doc_id long, n_tokens int"), 0).count() == 0
