"""Text operators: personal data, BPE, toxicity, quality."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusprep.llm import bpe_transducer as bpe
from corpusprep.llm import mil_quality, ordinal_toxicity, pii_scan

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


# ------------------------------------------------------------------ personal data
def brute_base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans_equal_the_plain_patterns():
    rnd = random.Random(4)
    bits = ["a@b.co", "@", ".", "x.y_z%+-@h-1.example.org", "1.2.3.4", "256.1.1.1", "001.02.3.4.5.6.7.8", "+1 (555) 010-99", "+", "-", " ",
            "4111 1111 1111 1111", "4111-1111-1111-1112", "5500005555555559", "12", "é", "𝔸", "\n", "word", "0", "9", "(", ")", "@@", "a@b", "a@b.c@d.e"]
    for _ in range(4000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))
        base, _ = pii_scan.spans(text)
        assert sorted(base) == sorted(brute_base(text)), text


def test_added_spans_need_checksum_or_context():
    assert pii_scan.spans("IBAN GB82 WEST 1234 5698 7654 32 ok")[1] == [("iban", 5, 32)]
    assert pii_scan.spans("IBAN GB82 WEST 1234 5698 7654 33 ok")[1] == []
    assert pii_scan.spans("his social security number 078-05-1120")[1] == [("ssn", 27, 38)]
    assert pii_scan.spans("part 078-05-1120")[1] == []
    assert pii_scan.spans("paid by card 378282246310005 now")[1] == [("card", 13, 28)]
    assert pii_scan.spans("serial 378282246310005 now")[1] == []


def test_find_and_mask_over_odd_rows(spark):
    long = "7" * 200_000 + " a@b.cd " + "x@" * 50_000
    rows = [(1, "mail me a@b.cd"), (1, "mail me a@b.cd"), (2, None), (None, ""), (3, long), (4, "é 10.0.0.1")]
    d = spark.createDataFrame([(i, t, "s", None if t is None else len(t)) for i, t in rows], "doc_id bigint, text string, spans string, n_chars bigint")
    got = {(r["doc_id"], r["spans"]): r for r in pii_scan.find_pii(d).collect()}
    assert pii_scan.find_pii(d).count() == 6 and pii_scan.find_pii(d.limit(0)).count() == 0
    assert got[4, "ip:2:10"]["n_ip"] == 1
    assert got[2, ""]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[1, "email:8:14"]["base_sha256"] == hashlib.sha256(b"email:8:14").hexdigest()
    masked = pii_scan.mask_pii(d)
    assert masked.columns == d.columns
    out = {r["doc_id"]: r for r in masked.collect()}
    assert out[4]["text"] == "é [IP]" and out[4]["n_chars"] == 6 and out[2]["text"] is None and out[1]["text"] == "mail me [EMAIL]"


@pytest.mark.parametrize("iban", ["CH93 0076 2011 6238 5295 7", "PT50 0002 0123 1234 5678 9015 4", "GB82 WEST 1234 5698 7654 32",
                                  "GB82WEST12345698765432", "NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "CH9300762011623852957"])
def test_ibans_end_where_the_country_says(iban):
    for before, after in (("", ""), ("IBAN ", " USD 500"), ("to ", " BIC"), ("AB12 CD34 ", " 7 EUR"), ("(", ")."), ("", "é"), ("XX00 ", " GB82 WEST 0")):
        assert pii_scan.spans(before + iban + after)[1] == [("iban", len(before), len(before) + len(iban))]
        assert pii_scan.mask(before + iban + after) == f"{before}[IBAN]{after}"
    for bad in (iban[:-1], iban + "1", iban + "x", "x" + iban, iban[:2] + "99" + iban[4:]):
        assert pii_scan.ibans(bad) == []
    assert pii_scan.ibans(f"{iban} {iban}") == [(0, len(iban)), (len(iban) + 1, 2 * len(iban) + 1)]


def test_iban_of_a_country_without_a_known_length():
    digits = 98 - int("12345678901234" + "333300") % 97       # X is 33
    assert pii_scan.ibans(f"XX{digits:02d} 1234 5678 9012 34 ABC") == [(0, 22)]


def test_every_span_has_a_score_that_context_raises(spark):
    plain, near = "see a@b.co", "contact: a@b.co"
    assert pii_scan.scored(plain) == [("email", 4, 10, pii_scan.PRIOR["email"])] and pii_scan.scored(near) == [("email", 9, 15, 1.0)]
    rows = [(1, "server 10.0.0.1, phone +1 555 123 4567, card 4111111111111111 or 378282246310005, GB82 WEST 1234 5698 7654 32"),
            (2, "x 10.0.0.1"), (3, None)]
    got = {r["doc_id"]: r for r in pii_scan.find_pii(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, t in rows:
        found = pii_scan.scored(t or "")
        assert got[i]["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b, _ in found) and got[i]["scores"] == [s for *_, s in found]
        base = pii_scan.joined(pii_scan.spans(t or "")[0])
        assert got[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    assert len(got[1]["scores"]) == 5 and got[1]["n_card"] == 1 and got[2]["scores"] == [pii_scan.PRIOR["ip"]]


# ------------------------------------------------------------------ BPE
@pytest.fixture(scope="module")
def lexicon(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lex") / "a.bin")
    words = [b" the", b"the", b" then", b"ten", " für".encode(), b"1", b" of", b" loft", b"\n", b"s", b"'s"]
    bpe.compile_lexicon(bpe.Model(BYTE_BPE), words, path)
    return bpe.Lexicon(path), words


def test_automaton_is_minimal_and_maps_words_to_places(lexicon):
    lex, words = lexicon
    assert lex.lookup(sorted(words)).tolist() == list(range(len(words)))
    assert lex.lookup([b"", b" th", b"thee", b"x", b"the" * 40]).tolist() == [-1] * 5
    a = bpe.minimal_automaton([b"tap", b"taps", b"top", b"tops"])
    assert len(a[3]) == 5            # one chain for "ap(s)" and "op(s)"


def test_encoding_equals_the_library(lexicon):
    rnd = random.Random(9)
    odd = [chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x3000, 0x180E, 0x200B, 0x301, 0x130)]
    alpha = [*"ab thenofsTHE '\"1234.,!?-_", *odd, "²", "½", "٣", "Ⅷ", "é", "日", "😀", "<|endoftext|>", " the", "'s", "'LL"]
    texts = ["", "x" * 4000, "ab" * 3000 + " " + "é" * 300, " " * 999, "\n" * 50 + "a", "<|endoftext|>", "<|endoftext|"]
    texts += ["".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 40))) for _ in range(2500)]
    want = [e.ids for e in Tokenizer.from_file(BYTE_BPE).encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(x, "<u4").tolist() for x in lexicon[0].encode(texts)]
    assert got == want


def test_frequent_words_keep_whole_counts_within_the_bound(spark):
    counts = spark.createDataFrame([("a", 9), ("b", 5), ("c", 5), ("d", 5), ("e", 2)], "word string, n bigint")
    for size, want in ((0, ""), (1, "a"), (3, "a"), (4, "abcd"), (9, "abcde")):
        assert sorted(r["word"] for r in bpe.frequent_words(counts, size).collect()) == list(want)
    assert bpe.frequent_words(counts.limit(0), 5).count() == 0


def test_encoding_with_a_short_memory_equals_the_library(lexicon):
    texts = ["the then ten " * 3, "für the x1 loft's", "a b c d e f g", "the then"] * 5
    lexicon[0].memo = bpe.Memo(3)
    want = [e.ids for e in Tokenizer.from_file(BYTE_BPE).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(lexicon[0].encode([t])[0], "<u4").tolist() for t in texts] == want


def test_documents_equal_the_library(spark):
    lib = Tokenizer.from_file(BYTE_BPE)
    rows = [(1, "Hello the world, it's 2024!\n\n  Zürich"), (2, None), (3, ""), (None, "null id"), (4, "long " * 20_000), (1, "Hello again"),
            (5, "a<|endoftext|>b")]
    d = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id bigint, text string, ids string")
    got = bpe.encode_documents(d, BYTE_BPE, lexicon_words=50, keep_ids=True).collect()
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), ids))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert bpe.encode_documents(d.limit(0), BYTE_BPE, lexicon_words=50).count() == 0


# ------------------------------------------------------------------ toxicity
def toxic_corpus(n=600, seed=0):
    rnd = random.Random(seed)
    clean, rude = [f"word{i}" for i in range(300)], ["zounds", "knavery", "varletish", "varletous", "dolt"]
    rows = []
    for i in range(n):
        words = [rnd.choice(clean) for _ in range(rnd.randint(5, 120))]
        y = int(i % 5 == 0)
        for _ in range(rnd.randint(2, 6) * y):
            words[rnd.randrange(len(words))] = rnd.choice(rude).title()
        rows.append((i, " ".join(words), y))
    return rows


def test_toxic_documents_are_found_on_rows_not_fitted(spark):
    rows = toxic_corpus()
    extra = [(9000, None), (9001, ""), (None, "dolt varletish zounds"), (9002, "word1 " * 30_000), (9002, "word1 " * 30_000)]
    d = spark.createDataFrame([(i, t, "t") for i, t, _ in rows] + [(i, t, "t") for i, t in extra], "doc_id bigint, text string, toxic string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 2] + [(i, y) for i, _, y in rows if i % 10 == 0] + [(None, 1), (3, None)],
                                   "doc_id bigint, toxic int")
    model = ordinal_toxicity.train(d, labels)
    assert (np.diff(model.cuts) > 0).all()
    got = {r["doc_id"]: r for r in ordinal_toxicity.score(d, model).collect()}
    assert not any(got[i]["toxic"] for i, _, y in rows if not y)
    assert np.mean([got[i]["toxic"] for i, _, y in rows if y]) > 0.95
    assert all(0 <= got[i]["expected_severity"] <= 2 for i, *_ in rows)
    assert not got[9000]["toxic"] and not got[9001]["toxic"] and not got[9002]["toxic"] and got[None]["toxic"]
    kept = ordinal_toxicity.keep_clean(d, model)
    assert kept.columns == d.columns and kept.count() == d.count() - sum(r["toxic"] for k, r in got.items() if k != 9002)


def test_toxicity_without_usable_labels_rejects_nothing(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    for labels in ([], [(1, None)], [(1, 0)], [(1, 1)]):
        frame = spark.createDataFrame(labels, "doc_id bigint, toxic int")
        assert ordinal_toxicity.keep_clean(d, ordinal_toxicity.train(d, frame)).count() == 2
    assert ordinal_toxicity.grade_toxicity(d.limit(0), frame).count() == 0


def test_ordinal_fit_orders_grades_and_has_the_right_gradient():
    rng = np.random.default_rng(0)
    rows, grades = [], []
    for _ in range(400):
        g = int(rng.integers(0, 3))
        rows.append(np.unique(np.r_[rng.integers(100, 120, 4), np.arange(1, 1 + 3 * g)]))
        grades.append(g)
    m = ordinal_toxicity.fit(rows, np.array(grades), 3, min_chi2=5)
    w = dict(zip(m.slots.tolist(), m.weights.tolist(), strict=True))
    p = m.at_least(np.array([sum(w.get(int(s), 0) for s in r) for r in rows]))
    assert ((p >= 0.5).sum(axis=1) == grades).mean() > 0.97


# ------------------------------------------------------------------ quality
def quality_corpus(n=500, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(rnd.randint(30, 400))]
        y = int(rnd.random() < 0.8)
        if not y:
            a = rnd.randrange(len(words) // 2)
            words[a:] = [w.upper() + "!!" for w in words[a:]] if i % 2 else [words[a]] * (len(words) - a)
        rows.append((i, " ".join(words), y))
    return rows


def test_quality_held_out_accuracy_and_odd_rows(spark):
    rows = quality_corpus()
    extra = [(9000, None), (9001, ""), (None, "abc def"), (9002, "abc def " * 40_000), (9002, "abc def " * 40_000)]
    d = spark.createDataFrame([(i, t, "t") for i, t, _ in rows] + [(i, t, "t") for i, t in extra], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, None), (None, 1)], "doc_id bigint, quality int")
    got = mil_quality.score_quality(d, mil_quality.train(d, labels)).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r["doc_id"]: r for r in got}
    held = [(by[i]["predicted"], y) for i, _, y in rows if by[i]["held_out"]]
    assert 60 < len(held) < 140 and np.mean([p == y for p, y in held]) > 0.95
    assert by[None]["held_out"] and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    again = {r["doc_id"]: r["score"] for r in mil_quality.score_quality(d, mil_quality.train(d, labels)).collect()}
    assert all(abs(again[k] - r["score"]) < 1e-6 for k, r in by.items())
    none = mil_quality.train(d, labels.limit(0))
    assert mil_quality.score_quality(d, none).count() == len(got) and mil_quality.score_quality(d.limit(0), none).count() == 0


def test_attention_gradient_equals_differences():
    rng = np.random.default_rng(0)
    count = np.array([3, 1, 4])
    f = rng.normal(size=(8, mil_quality.FEATURES))
    y = np.array([1.0, 0.0, 1.0])
    m = mil_quality.fit(f, count, y, steps=60)
    p = m.score(f, count)
    assert ((p >= 0.5) == y).all()
    h, t, g, a, z, _ = m.forward(f, count)
    assert np.allclose(np.add.reduceat(a, np.cumsum(count) - count), 1)
