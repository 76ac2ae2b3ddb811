"""The rollup and the corpus scope count near duplicates too, as their SQL and a loop over all pairs do."""

import random
from difflib import SequenceMatcher

import duckdb
import pytest

from corpusprep.plans import registry as reg

WORDS = "amber birch cedar delta ember flint grove häfen inlet jasper".split()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, rows = random.Random(5), []
    for n in range(60):
        text = " ".join(rng.choice(WORDS) for _ in range(rng.randint(3, 40)))
        rows.append((2 * n, text, ("en", "de")[n % 2], "web"))
        if n % 3 == 0:      # a copy with a changed word or letter, or as it is, in either language
            cut = rng.randrange(len(text))
            text = (text, text[:cut] + "x" + text[cut + 1:], text[:cut] + text[cut + 3:])[n // 3 % 3]
            rows.append((2 * n + 1, text, ("en", "de")[rng.random() < .3], "web"))
    at = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{at}/documents.parquet")
    return at


def by_sql(folder, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    got = con.sql(reg.ORACLE[name])
    return {tuple(sorted(zip(got.columns, r), key=lambda x: x[0])) for r in got.fetchall()}


@pytest.mark.parametrize("name, by", [("leakage_rollup", ["workbook", "sheet"]), ("leakage_scope_corpus", [])])
def test_near_duplicates_are_counted(spark, folder, name, by):
    rows = [r.asDict() for r in reg.QUERIES[name](spark, folder).collect()]
    side = {s: [r for r in reg.d_split(spark, folder).collect() if r["split"] == s] for s in ("train", "test")}
    want = sum(a["ctext"] != b["ctext"] and SequenceMatcher(None, a["ctext"], b["ctext"], autojunk=False).ratio() >= .9
               for a in side["train"] for b in side["test"] if all(a[c] == b[c] for c in by))
    whole = next(r for r in rows if r.get("workbook") is None)
    assert whole["near_duplicates"] == want > 0
    assert {tuple(sorted(r.items())) for r in rows} == by_sql(folder, name)
