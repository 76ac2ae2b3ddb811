import random
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from corpusprep.functions import similarity as sim
from corpusprep.operators import leakage as lk
from corpusprep.plans import registry as reg


def _split_frame(spark, train, test, group=("w", "s")):
    rows = [(group[0], group[1], i, "train", t) for i, t in enumerate(train)]
    rows += [(group[0], group[1], 1000 + i, "test", t) for i, t in enumerate(test)]
    return spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, split string, text string")


def _brute(train, test, t):
    out = Counter()
    for te in test:
        for tr in train:
            if tr != te and SequenceMatcher(None, tr, te).ratio() >= t:
                out[(tr, te)] += 1
    return out


def _random_texts(rng, n, base_words):
    texts = []
    for _ in range(n):
        words = rng.sample(base_words, rng.randint(2, 8))
        s = " ".join(words)
        if rng.random() < 0.5 and texts:
            src = rng.choice(texts)
            i = rng.randrange(len(src) + 1)
            s = src[:i] + rng.choice("abcxyz ") + src[i:]        # a near copy
        texts.append(s)
    return texts


@pytest.mark.parametrize("seed,threshold", [(1, 0.9), (2, 0.8), (3, 0.6)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, seed, threshold):
    monkeypatch.setattr(lk, "SALT_ROWS", 3)       # force several salt slices per bucket
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma", "tau", "rho", "phi", "é", "ça"]
    pool = _random_texts(rng, 60, words)
    train = [rng.choice(pool) for _ in range(40)]
    test = [rng.choice(pool) for _ in range(25)]
    df = _split_frame(spark, train, test)
    got = Counter()
    for r in lk.near_duplicate_pairs(df, "text", threshold=threshold).collect():
        got[(r.train_text, r.test_text)] += r.pairs
        assert r.similarity >= threshold
    assert got == _brute(train, test, threshold)


def test_exact_duplicates_and_report(spark):
    train = ["same text", "same text", "other", "near copy of a sentence here"]
    test = ["same text", "near copy of a sentence herE", "unique"]
    df = _split_frame(spark, train, test)
    rep = lk.sheet_report(df, "text", threshold=0.9, with_samples=True).first()
    assert (rep.num_train, rep.num_test, rep.exact_duplicates) == (4, 3, 1)
    assert rep.near_duplicates == 1
    assert rep.sample_near_duplicates[0].similarity == pytest.approx(0.964, abs=1e-3)
    gate = lk.leakage_gate(lk.sheet_report(df, "text", threshold=0.9)).first()
    assert gate.total_records == 7 and gate.status == "FAIL"
    assert gate.leakage_ratio == round(2 / 7, 4)
    with pytest.raises(lk.LeakageError):
        lk.assert_no_leakage(lk.leakage_gate(lk.sheet_report(df, "text", threshold=0.9)))


def test_gate_no_data_and_pass(spark):
    empty = spark.createDataFrame([], "workbook string, sheet string, num_train bigint, num_test bigint, "
                                      "exact_duplicates bigint, near_duplicates bigint")
    g = lk.leakage_gate(empty).first()
    assert (g.total_records, g.leakage_ratio, g.status) == (0, 0.0, "NO_DATA")
    df = _split_frame(spark, ["a b c", "d e f"], ["x y z"])
    assert lk.leakage_gate(lk.sheet_report(df, "text")).first().status == "PASS"


def test_rollup_totals_equal_parts(spark):
    a = _split_frame(spark, ["t1", "t2"], ["t1"], ("w1", "s1"))
    b = _split_frame(spark, ["u1"], ["u2", "u1"], ("w1", "s2"))
    c = _split_frame(spark, ["v"], ["v"], ("w2", "s1"))
    rep = lk.sheet_report(a.unionByName(b).unionByName(c), "text", threshold=None)
    roll = {(r.workbook, r.sheet): r for r in lk.leakage_rollup(rep).collect()}
    assert roll[(None, None)].exact_duplicates == 3
    assert roll[("w1", None)].num_train == 3 and roll[("w1", None)].level == 1
    assert roll[(None, None)].level == 3


def test_similarity_helpers():
    rng = random.Random(7)
    for _ in range(200):
        a = "".join(rng.choice("abcde") for _ in range(rng.randint(0, 30)))
        b = "".join(rng.choice("abcde") for _ in range(rng.randint(0, 30)))
        lcs = sim.lcs_length(a, b)
        m = SequenceMatcher(None, a, b).ratio() * (len(a) + len(b)) / 2
        assert m <= lcs + 1e-9
        assert sim.lcs_at_least(a, b, lcs) and not sim.lcs_at_least(a, b, lcs + 1)
        overlap = int((sim.char_bins(a) if a else 0).__class__ is not None) and \
            sum(min(x, y) for x, y in zip(sim.char_bins(a), sim.char_bins(b)))
        assert overlap >= lcs
    assert sim.ratio("", "") == 1.0


def test_asymmetry_and_scope(spark):
    assert lk.scope_cols("corpus") == []
    with pytest.raises(ValueError):
        lk.scope_cols("planet")
    a = _split_frame(spark, ["shared"], [], ("w", "s1"))
    b = _split_frame(spark, [], ["shared"], ("w", "s2"))
    df = a.unionByName(b)
    assert lk.exact_duplicates(df, "text").agg(F.sum("exact_duplicates")).first()[0] == 0
    assert lk.exact_duplicates(df, "text", by=["workbook"]).first().exact_duplicates == 1


def test_minhash_finds_close_pairs_within_groups(spark):
    base = "the quick brown fox jumps over the lazy dog near the quiet river bank today"
    train = [base, "completely different words about cooking pasta with fresh tomato sauce"]
    test = [base + " again", "nothing in common here at all zebra"]
    a = _split_frame(spark, train, test, ("w", "s1"))
    b = _split_frame(spark, [base], [], ("w", "s2"))            # same text in another group
    got = lk.minhash_pairs(a.unionByName(b), "text", max_distance=0.5).collect()
    assert len(got) == 1 and got[0].sheet == "s1"
    assert got[0].jaccard_distance <= 0.5


def test_hot_text_multiplicities(spark, monkeypatch):
    monkeypatch.setattr(lk, "SALT_ROWS", 2)
    hot = "the same support question repeated very many times"
    near = "the same support question repeated very many timez"
    train = [hot] * 30 + [near] * 3 + [f"other question number {i}" for i in range(57)]
    test = [hot] * 10 + [near] * 2 + [f"different test item {i}" for i in range(18)]
    df = _split_frame(spark, train, test)
    got = Counter()
    for r in lk.near_duplicate_pairs(df, "text").collect():
        got[(r.train_text, r.test_text)] += r.pairs
    assert got == _brute(train, test, 0.9)
    assert got[(hot, near)] == 30 * 2 and got[(near, hot)] == 3 * 10
    rep = lk.sheet_report(df, "text").first()
    assert rep.exact_duplicates == 2 and rep.near_duplicates == sum(got.values())


def test_corpus_scope_query_equals_brute_force_across_sheets(spark, tmp_path):
    rng = random.Random(11)
    pool = _random_texts(rng, 40, ["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma", "tau"])
    docs = [(i, rng.choice(["en", "de", "fr"]), rng.choice("ab"), rng.choice(pool)) for i in range(120)]
    spark.createDataFrame(docs, "doc_id bigint, lang string, source string, text string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    rows = reg.d_split(spark, str(tmp_path)).select("sheet", "split", "ctext").collect()
    train, test = ([(r.ctext, r.sheet) for r in rows if r.split == p] for p in ("train", "test"))
    want = sum(_brute([t for t, _ in train], [t for t, _ in test], lk.SIMILARITY_THRESHOLD).values())
    inside = sum(sum(_brute([t for t, s in train if s == g], [t for t, s in test if s == g], lk.SIMILARITY_THRESHOLD).values())
                 for g in ("en", "de", "fr"))
    got = reg.QUERIES["leakage_scope_corpus_near"](spark, str(tmp_path)).collect()
    assert want > inside > 0 and len(got) == 1
    assert (got[0].num_train, got[0].num_test, got[0].near_duplicates) == (len(train), len(test), want)
    assert got[0].exact_duplicates == len({t for t, _ in train} & {t for t, _ in test})
