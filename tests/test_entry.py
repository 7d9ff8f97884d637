import re
from importlib import import_module
from pathlib import Path

import __spark_entry__ as entry

REPO = Path(entry.__file__).resolve().parent
SF = "/root/testdata/sf0.001"


def test_every_sql_belongs_to_a_query_and_names_are_unique():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert sum(len(m.queries()) for m in entry._plans()) == len(queries)


def test_the_library_stands_without_its_optional_part(monkeypatch):
    for path in (REPO / "tidemark").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"^\s*(from|import) tidemark\.llm", path.read_text(), re.M), path

    def without(name):
        if "llm" in name:
            raise ImportError(name)
        return import_module(name)

    monkeypatch.setattr(entry, "import_module", without)
    assert entry.queries() and not any(k.startswith(("p3_", "p4_", "p8_", "p9_", "p10_")) for k in entry.queries())


def test_flagship_and_results_are_rows_without_repeats(spark):
    if not Path(SF).exists():
        return
    assert entry.entry(spark).count() > 0
    for name in ("p1_found", "p2_found", "p5_found", "p6_found", "p7_found"):
        df = entry.queries()[name](spark, SF)
        assert df.count() == df.distinct().count()
