import sys

import __spark_entry__ as E
from corpusprep.plans.registry import QUERIES


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
    for name in QUERIES:
        assert not name.startswith("op") and "pipeline" not in name


def test_entry_works_without_the_llm_subpackage(monkeypatch):
    for gone in ("corpusprep.llm.queries", "corpus_pipeline"):
        monkeypatch.setitem(sys.modules, gone, None)
        assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].status in ("PASS", "FAIL")
    assert df.columns == ["total_records", "exact_duplicates", "near_duplicates", "leakage_ratio", "status"]
