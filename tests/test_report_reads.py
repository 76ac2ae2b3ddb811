"""What a leakage report keeps and sends: no text is cached, and texts travel once where a task can hold them."""

import hashlib
import re

from pyspark.sql import functions as F

from corpusprep.operators import leakage as lk

ROWS = "workbook string, sheet string, row_idx bigint, split string, text string"


def test_report_caches_ids_only(spark):
    rows = [("w", "s", i, "test" if i % 5 == 0 else "train", f"a text of some words, number {i % 7}") for i in range(40)]
    report = lk.sheet_report(spark.createDataFrame(rows, ROWS), "text")
    cached = re.findall(r"InMemoryRelation \[([^\]]*)\]", report._jdf.queryExecution().optimizedPlan().toString())
    assert cached and not any(re.search(r"\b(text|row_idx)#", c) for c in cached)
    row = report.first()
    assert (row.num_train, row.num_test, row.exact_duplicates) == (32, 8, 7) and row.near_duplicates > 0


def test_texts_of_some_megabytes_share_a_cell(spark):
    rows = [("w", "s", i, "test" if i % 2 else "train", i) for i in range(24)]
    df = spark.createDataFrame(rows, ROWS.replace("text string", "n bigint")) \
        .withColumn("text", F.concat(F.col("n").cast("string"), F.repeat(F.lit("x y "), 90_000)))
    train, test = lk._cells(df, "text", ["workbook", "sheet"], 0.9, 42, with_text=True)
    assert train.count() == 12 and train.select("salt").distinct().count() == 1     # 4.3 M characters a side
    assert test.groupBy("lb", "tid").count().where("count > 1").count() == 0


def test_minhash_keeps_no_shingles_and_sends_candidates_only(spark):
    words = [f"w{i}" for i in range(400)]
    base = {k: words[k * 40:k * 40 + 40] for k in range(10)}
    rows, sets = [], {}
    for i in range(60):
        own = base[i % 10] + [f"own{i}"] * (i // 10)
        part = "test" if i % 3 == 0 else "train"
        rows += [("w", None, i * 2 + j, part, " ".join(own)) for j in range(2)]        # every text twice
        sets[" ".join(own)] = {tuple(own[k:k + 3]) for k in range(len(own) - 2)}
    got = lk.minhash_pairs(spark.createDataFrame(rows, ROWS), "text", max_distance=0.5)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and plan.count("Join LeftSemi") == 2
    ids = {hashlib.md5(t.encode()).hexdigest(): s for t, s in sets.items()}
    found = got.collect()
    for r in found:
        a, b = ids[r.train_tid], ids[r.test_tid]
        assert abs(r.jaccard_distance - (1 - len(a & b) / len(a | b))) < 1e-12 and r.sheet is None
    texts = {p: {t for *_, s, t in rows if s == p} for p in ("train", "test")}
    close = {(a, b) for a in texts["train"] for b in texts["test"] if a != b and len(sets[a] & sets[b]) >= 0.9 * len(sets[a] | sets[b])}
    seen = {(r.train_tid, r.test_tid) for r in found}
    assert len(seen) == len(found)
    assert close and {(hashlib.md5(a.encode()).hexdigest(), hashlib.md5(b.encode()).hexdigest()) for a, b in close} <= seen
    assert {r.pairs for r in found} <= {4, 8, 12, 16}
