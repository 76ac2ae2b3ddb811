"""Null group keys, whole-corpus scope, groups with different columns, long near duplicates."""

import difflib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.functions import casts
from corpusprep.operators import dbscan as db
from corpusprep.operators import labels as lb
from corpusprep.operators import leakage as lk
from corpusprep.operators import split as sp

ROWS = "workbook string, sheet string, row_idx bigint, lab string, text string"


def test_rows_of_a_null_group_are_split_like_others(spark):
    rows = [("w", s, i, "ab"[i % 2], f"t{i}") for s in (None, "x") for i in range(20)]
    out = sp.stratified_split(spark.createDataFrame(rows, ROWS), "lab").collect()
    assert len(out) == 40
    for s in (None, "x"):
        for label in "ab":
            assert sum(r["sheet"] == s and r["lab"] == label and r["split"] == "train" for r in out) == 8
    shuffled = sp.seeded_shuffle(spark.createDataFrame(rows, ROWS)).collect()
    assert sorted((str(r["sheet"]), r["shuffle_pos"]) for r in shuffled) == sorted((s, i) for s in ("None", "x") for i in range(1, 21))


def test_cut_point_split_equals_row_number(spark):
    rnd = random.Random(1)
    rows = [("w", rnd.choice("xy"), i, rnd.choice("aaaabc"), "t") for i in range(3000)]
    d = spark.createDataFrame(rows, ROWS)
    got = {(r["sheet"], r["row_idx"]): r["split"] for r in sp.stratified_split(d, "lab", train=70, test=30).collect()}
    import hashlib
    groups = {}
    for _, s, i, label, _ in rows:
        groups.setdefault((s, label), []).append((hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    for (s, _), members in groups.items():
        cut = max(1, int(len(members) * 0.7))
        for n, (_, i) in enumerate(sorted(members)):
            assert got[s, i] == ("train" if n < cut else "test")


@pytest.mark.parametrize("shares", [(-1, 5), (0, 0)])
def test_shares_must_make_sense(shares):
    with pytest.raises(ValueError, match="shares"):
        sp.train_fraction(*shares)


def test_sheets_with_different_label_columns_all_stay(spark):
    a = spark.createDataFrame([("w", "a", i, f"l{i % 2}") for i in range(10)], "workbook string, sheet string, row_idx bigint, c1 string")
    b = spark.createDataFrame([("w", "b", i, f"m{i % 2}") for i in range(10)], "workbook string, sheet string, row_idx bigint, c2 string")
    both = a.unionByName(b, allowMissingColumns=True)
    out = sp.split_by_labels(both, ["c1", "c2"]).collect()
    assert len(out) == 20 and {r["sheet"] for r in out} == {"a", "b"}
    maps = lb.label_map_first_seen(both, ["c1", "c2"]).collect()
    assert {(r["sheet"], r["label_col"]) for r in maps} == {("a", "c1"), ("b", "c2")}
    first = {r["sheet"]: r["__label"] for r in sp.with_label(both, ["c2", "c1"]).where("row_idx = 0").collect()}
    assert first == {"a": "l0", "b": "m0"}


def split_rows(train, test, sheet="s"):
    return [("w", sheet, i, "x", t, "train") for i, t in enumerate(train)] + \
        [("w", sheet, 1000 + i, "x", t, "test") for i, t in enumerate(test)]


@pytest.mark.parametrize("autojunk", [False, True])
def test_near_duplicates_of_long_texts_equal_brute_force(spark, autojunk):
    rnd = random.Random(3)
    words = ["storage", "of", "the", "bucket", "is", "region", "a", "policy", "network"]
    base = [" ".join(rnd.choice(words) for _ in range(n)) for n in (40, 60, 120, 300)]
    train, test = [], []
    for t in base:
        w = t.split()
        train.append(t)
        for edits in (1, len(w) // 12, len(w) // 6):
            v = list(w)
            for _ in range(edits):
                v[rnd.randrange(len(v))] = rnd.choice(words)
            test.append(" ".join(v))
    d = spark.createDataFrame(split_rows(train, test, None), ROWS + ", split string")
    got = {(r["train_text"], r["test_text"]): r["similarity"] for r in lk.near_duplicate_pairs(d, "text", autojunk=autojunk).collect()}
    want = {}
    for a in train:
        for b in test:
            r = difflib.SequenceMatcher(None, a, b, autojunk=autojunk).ratio()
            if a != b and r >= 0.9:
                want[a, b] = r
    assert got == want and (autojunk or len(want) >= 4)


def test_corpus_scope_and_sample_multiplicity(spark):
    text = "how do I configure the storage bucket versioning rules today"
    d = spark.createDataFrame(split_rows([text] * 3, [text + "!"], "a") + split_rows(["other"], [text], "b"), ROWS + ", split string")
    report = lk.sheet_report(d, "text", by=lk.scope_cols("corpus")).collect()
    assert len(report) == 1 and report[0]["exact_duplicates"] == 1 and report[0]["near_duplicates"] == 3
    pairs = lk.near_duplicate_pairs(d, "text")
    samples = lk.sample_pairs(pairs, k=2).collect()
    assert len(samples) == 1 and len(samples[0]["sample_near_duplicates"]) == 2
    assert len(lk.sample_pairs(pairs).collect()[0]["sample_near_duplicates"]) == 3


def test_dbscan_cosine_defaults_with_zero_vectors(spark):
    rng = np.random.default_rng(0)
    vecs = [[1.0, 0.02 * i, 0.0] for i in range(6)] + [[-1.0, 0.02 * i, 0.1] for i in range(6)] + [[0.0] * 3] * 7
    vecs += rng.normal(size=(5, 3)).tolist()
    d = spark.createDataFrame([("w", None, i, v) for i, v in enumerate(vecs)], "workbook string, sheet string, row_idx bigint, v array<double>")
    got = {r["row_idx"]: r["cluster"] for r in db.dbscan(d, "v").collect()}
    norm = np.linalg.norm(vecs, axis=1, keepdims=True)
    u = np.array(vecs) / np.where(norm > 0, norm, 1)
    near = (1 - u @ u.T <= 0.5 + 1e-12) & ~np.eye(len(u), dtype=bool) & (norm > 0) & (norm > 0).T
    core = near.sum(axis=1) + 1 >= 5
    label = {}
    for i in range(len(u)):
        if core[i] and i not in label:
            stack, c = [i], len(set(label.values()))
            while stack:
                x = stack.pop()
                if x not in label:
                    label[x] = c
                    stack += [j for j in np.flatnonzero(near[x]) if core[j]]
    want = {}
    for i in range(len(u)):
        adjacent = [label[j] for j in np.flatnonzero(near[i]) if core[j]]
        want[i] = label[i] if core[i] else min(adjacent, default=-1)
    assert got == want and got[0] != got[6] and got[12] == -1


def test_json_cast_falls_back_to_the_default(spark):
    d = spark.createDataFrame([(1, '{"k": 5}'), (2, "{bad"), (3, None), (4, '{"k": 1, "z": [1]}')], "i int, s string")
    default = F.named_struct(F.lit("k"), F.lit(-1).cast("bigint"))
    got = {r["i"]: r["k"] for r in d.select("i", casts.safe_json(F.col("s"), "k bigint", default)["k"].alias("k")).collect()}
    assert got == {1: 5, 2: -1, 3: -1, 4: 1}


def test_cluster_job_goes_on_without_groups_that_lack_a_column(spark):
    from corpusprep.plans.corpus import cluster_corpus, global_cluster_summary
    a = [("w", "a", i, f"text number {i % 3}", "q") for i in range(12)] + [("w", "b", i, f"text {i}", None) for i in range(4)]
    d = spark.createDataFrame(a, "workbook string, sheet string, row_idx bigint, text string, kind string")
    rows, summary = cluster_corpus(d, ["text", "kind"], k=2)
    got = {r["sheet"]: (r["records"], r["status"]) for r in summary.collect()}
    assert got == {"a": (12, "clustered"), "b": (0, "skipped")} and {r["sheet"] for r in rows.collect()} == {"a"}
    total = global_cluster_summary(summary).first()
    assert (total["groups"], total["skipped"], total["records"]) == (1, 1, 12)
    with pytest.raises(ValueError):                 # no group can have it: the frame lacks the column
        cluster_corpus(d, ["text", "nowhere"], k=2)
