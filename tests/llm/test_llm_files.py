"""Archives, token files, mixing and the pipeline."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from corpusprep.llm import ordinal_toxicity, pii_scan, rans_tokens, simhash_gray, source_mix, warc_sharded
from corpusprep.llm.common import hash_sample, open_store

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# ------------------------------------------------------------------ WARC
def pages():
    rnd = random.Random(2)
    body = ["<p>" + "".join(rnd.choice("abc é") for _ in range(rnd.randint(90, 400))) + "</p>" for _ in range(20)]
    rows = [(i, f"http://h/{i}", body[i % 20] if i % 3 else body[0]) for i in range(5, 300)]
    rows += [(1, None, "short"), (2, "u\r\nX: y", "short"), (3, "u", None), (4, "", ""), (None, "n", body[0]), (None, "n", "lonely " * 30),
             (None, "n", "lonely " * 30), (700, "d", body[1]), (700, "d", body[1]), (701, "z", "z" * 99), (702, "z", "z" * 99), (800, "big", "q" * 400_000)]
    return rows


def want_pages(rows):
    data = [((h or "").encode(), i) for i, _, h in rows]
    first = {}
    for b, i in data:
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for b, i in data:
        f = first.get(b)
        revisit = f is not None and f != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(map(str, out))


def test_a_shard_rolls_by_compressed_size_at_production_parameters(spark):
    rnd = random.Random(6)
    rows = [(i, f"http://e/{i}", rnd.randbytes(50_000).hex()) for i in range(70)]       # 7 MB, about 3.5 MB compressed
    d = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    uri, manifest = warc_sharded.write_archives(d)
    files = sorted(manifest.collect(), key=lambda r: r["file"])
    assert {r["shard"] for r in files} == {files[0]["shard"]} and len(files) > 2
    assert all(warc_sharded.ROLL_BYTES <= r["bytes"] < warc_sharded.ROLL_BYTES + 100_000 for r in files[:-1])
    assert warc_sharded.read_archives(uri, manifest).count() == 70


def test_archives_round_trip_roll_and_rerun(spark):
    rows = pages()
    d = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, payload_digest string")
    uri, manifest = warc_sharded.write_archives(d, shard_bytes=20_000, roll_bytes=4_000)
    m = {r["file"]: r for r in manifest.collect()}
    assert len(m) > len({r["shard"] for r in m.values()}) > 2           # shards, rolled into files
    got = warc_sharded.read_archives(uri, manifest)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(str(tuple(r[c] for c in cols)) for r in got.collect()) == want_pages(rows)
    texts = {r["payload_digest"]: r["payload"] for r in got.collect() if r["record_type"] == "response"}
    assert all(hashlib.sha256(b).hexdigest() == k for k, b in texts.items())
    uri2, manifest2 = warc_sharded.write_archives(d.repartition(7), shard_bytes=20_000, roll_bytes=4_000)
    assert {r["file"]: r["crc32"] for r in manifest2.collect()} == {k: r["crc32"] for k, r in m.items()}
    fs, root = open_store(uri)
    names = {i.base_name for i in fs.get_file_info(__import__("pyarrow").fs.FileSelector(root))}
    assert names == set(m)                                              # no temporary names are left
    some = sorted(m)[0]
    with fs.open_input_stream(f"{root}/{some}") as f:
        data = f.read()
    with fs.open_output_stream(f"{root}/{some}") as f:
        f.write(data[:-30])
    with pytest.raises(Exception, match="truncated|not the file|[Cc]ompressed"):
        warc_sharded.read_archives(uri, manifest).collect()


def test_archives_of_an_empty_table(spark):
    d = spark.createDataFrame([], "page_id bigint, url string, html string")
    uri, manifest = warc_sharded.write_archives(d)
    assert manifest.count() == 0 and warc_sharded.read_archives(uri, manifest).count() == 0


# ------------------------------------------------------------------ rANS
@pytest.mark.parametrize("seed", range(4))
def test_coder_round_trip_and_random_access(seed):
    rng = np.random.default_rng(seed)
    docs = [rng.zipf(1.2 + seed / 4, int(n)).clip(0, 70_000) for n in rng.integers(1, 9000, 30)] + [np.array([0]), np.arange(500)]
    r = rans_tokens.Reader(rans_tokens.pack([None, *range(31)], docs))
    flat = np.concatenate(docs)
    assert np.array_equal(r.ids(), flat) and r.doc_ids[0] is None and r.sizes.tolist() == [len(d) for d in docs]
    assert np.array_equal(r.ids(2, 3), flat[2 * rans_tokens.BLOCK:3 * rans_tokens.BLOCK])


def test_coder_is_near_the_entropy_and_notices_damage():
    rng = np.random.default_rng(1)
    ids = rng.choice(200, 200_000, p=np.arange(1, 201) / np.arange(1, 201).sum())
    data = rans_tokens.pack([1], [ids])
    p = np.bincount(ids) / len(ids)
    assert len(data) * 8 < 1.03 * len(ids) * -(p[p > 0] * np.log2(p[p > 0])).sum() + 8 * 2000
    bad = bytearray(data)
    bad[-100] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans_tokens.Reader(bytes(bad)).ids()
    for one in (np.array([7]), np.full(99_999, 3)):
        assert np.array_equal(rans_tokens.Reader(rans_tokens.pack([1], [one])).ids(), one)


def test_word_tokens_equal_the_library(monkeypatch):
    rnd = random.Random(3)
    odd = [chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, 0x2003, 0x3000, 0x180E, 0x200B, 0x301, 0x308, 0x130, 0x131,
                            0x3A3, 0x3C2, 0xAD)]
    alpha = [*"ab cAB  'sdmtrel12.,!*|<>", *odd, "½", "Ⅷ", "é", "É", "ß", "Å", "日", "😀", "<|endoftext|>", "Éeau,", "WORD."]
    texts = ["", "x" * 3000, "<|startoftext|>a", "Éeau, ÉEAU!! don't it's"] + [
        "".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    lib = Tokenizer.from_file(WORD_BPE)
    want = [np.array(e.ids, "<u4").tobytes() for e in lib.encode_batch(texts, add_special_tokens=False)]
    tokens = rans_tokens.WordTokens(WORD_BPE)
    assert tokens.encode(texts) == want
    monkeypatch.setattr(rans_tokens, "MEMO", 30)                 # forgets all the time
    assert [x for at in range(0, len(texts), 25) for x in tokens.encode(texts[at:at + 25])] == want


def test_token_files_round_trip(spark):
    rnd = random.Random(5)
    rows = [(i * 3, " ".join(rnd.choice(["Alpha", "beta,", "ünder", "the", "of"]) for _ in range(rnd.randint(0, 300)))) for i in range(200)]
    rows += [(None, "no id"), (1, None), (2, ""), (3, "again"), (4, "long " * 30_000)]
    d = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id bigint, text string, start int")
    uri, manifest = rans_tokens.write_tokens(d, WORD_BPE, 1, shard_bytes=20_000, file_tokens=3_000)
    assert manifest.count() > manifest.select("shard").distinct().count() > 2
    got = rans_tokens.read_tokens(uri, manifest, keep_ids=True).collect()
    lib = Tokenizer.from_file(WORD_BPE)
    coded = [(-1 if i is None else i, [*lib.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]
    coded.sort(key=lambda r: (r[0], np.array(r[1], "<u2").tobytes()))
    start, want = 0, []
    for i, ids in coded:
        want.append((None if i < 0 else i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want
    uri, manifest = rans_tokens.write_tokens(d.limit(0), WORD_BPE, 1)
    assert rans_tokens.read_tokens(uri, manifest).count() == 0


def test_hash_sample_is_bounded_and_repeatable(spark):
    t = spark.range(5000).withColumnRenamed("id", "k")
    got = [sorted(r["k"] for r in hash_sample(t.repartition(n), "k", 300).collect()) for n in (2, 7)]
    assert got[0] == got[1] and len(got[0]) == 300
    assert hash_sample(t.limit(10), "k", 300).count() == 10 and hash_sample(t.limit(0), "k", 5).count() == 0


# ------------------------------------------------------------------ mixing
def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left, shares = total - sum(fixed.values()), sum(w[s] for s in names if s not in fixed)
        over = [s for s in names if s not in fixed and left * w[s] / shares >= 3 * sizes[s]] if shares else []
        if not over:
            return {s: float(fixed[s]) if s in fixed else left * w[s] / shares for s in names}
        fixed |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("digits", [3, 1])
def test_mix_equals_brute_force(spark, monkeypatch, digits):
    monkeypatch.setattr(source_mix, "RANGE_DIGITS", digits)
    rnd = random.Random(digits)
    rows = [(i, " ".join("w" for _ in range(rnd.randint(0, 40))), rnd.choice(["a"] * 30 + ["b", "ä", "Z", "c", None])) for i in range(400)]
    rows += [(1000, None, "b"), (1001, " \t\n lead and trail \r", "tiny"), (None, "no id here", "a"), (5, "dup dup", "a"), (5, "dup dup", "a"),
             (1002, "", "empty"), (1003, "big " * 20_000, "huge")]
    d = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, source string, taken int")
    got = source_mix.mix(d).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = brute_targets(sizes)
    assert sorted(str((r["doc_id"], r["size"])) for r in got) == sorted(str((i, size(t))) for i, t, _ in rows)
    by_target = {}
    of = {}
    for i, t, s in rows:
        of.setdefault((i, size(t)), set()).add(s)
    for r in got:
        s = of[r["doc_id"], r["size"]]
        assert r["source_size"] in {sizes[x] for x in s} and any(abs(r["target"] - want[x]) < 1e-6 for x in s)
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_target[r["source_size"], round(r["target"], 6)] = by_target.get((r["source_size"], round(r["target"], 6)), 0) + r["taken"]
    assert all(abs(taken - target) < 1 for (_, target), taken in by_target.items())
    again = source_mix.mix(d.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert source_mix.mix(d.limit(0)).count() == 0


def test_mixed_documents_hold_the_words_taken(spark):
    rows = [(i, f"w{i} " * (i % 17), ["a", "b", "c"][i % 3], 0) for i in range(90)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint")
    taken = {r["doc_id"]: r["taken"] for r in source_mix.mix(d).collect()}
    out = source_mix.mixed_documents(d)
    assert out.columns == d.columns
    words = {}
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    assert words == {i: n for i, n in taken.items() if n}
    assert source_mix.mixed_documents(d.limit(0)).count() == 0


@pytest.mark.parametrize("digits", [3, 1])
def test_mixed_documents_keep_every_budget_with_shared_repeated_and_null_ids(spark, monkeypatch, digits):
    monkeypatch.setattr(source_mix, "RANGE_DIGITS", digits)
    rnd = random.Random(9)
    words = lambda n: " ".join(rnd.choice("abcdefgh") + str(rnd.randrange(99)) for _ in range(n))
    rows = [(i, words(8), "s1") for i in range(200)] + [(i, words(8), "s2") for i in range(800)]      # ids shared, sizes equal
    rows += [(None, words(5), s) for s in ("s1", "s2", None) for _ in range(60)]                       # null ids of one size
    rows += [(7, rows[7][1], "s1")] * 20 + [(None, "same text here", "s2")] * 90 + [(3, words(rnd.randrange(9)), None) for _ in range(50)]
    d = spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], "doc_id bigint, text string, source string, __size string, size int")
    size = lambda t: len(t.split())
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    targets = brute_targets(sizes)
    # a loop over each source in the order of the keys: how many words each (id, size) gives in all
    want, given = {}, {}
    key = lambda r: (hashlib.md5(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0] or 0, size(r[1]))
    for s, target in targets.items():
        passes, rest = divmod(math.floor(target), sizes[s])
        for i, t, _ in sorted((r for r in rows if r[2] == s), key=key):
            last = min(size(t), rest)
            rest -= last
            want[s, i, size(t)] = want.get((s, i, size(t)), 0) + passes * size(t) + last
    taken = sum(r["taken"] for r in source_mix.mix(d).collect())
    texts = {(s, i): set() for i, _, s in rows}
    for i, t, s in rows:
        texts[s, i].add(t)
    out = source_mix.mixed_documents(d)
    assert out.columns == d.columns
    for r in out.collect():
        given[r["source"]] = given.get(r["source"], 0) + size(r["text"])
        assert any(t == r["text"] or " ".join(t.split()).startswith(r["text"] + " ") for t in texts[r["source"], r["doc_id"]])
    assert given == {s: math.floor(t) for s, t in targets.items()}
    assert sum(given.values()) == taken == sum(want.values())
    got = {}
    for r in out.collect():
        if r["doc_id"] is not None and r["doc_id"] > 100:            # ids that are not repeated within a source
            got[r["source"], r["doc_id"]] = got.get((r["source"], r["doc_id"]), 0) + size(r["text"])
    assert got == {(s, i): n for (s, i, _), n in want.items() if i is not None and i > 100 and n}


# ------------------------------------------------------------------ pipeline
def test_pipeline_equals_its_stages_by_hand(spark, tmp_path):
    rnd = random.Random(6)
    rows = []
    for i in range(160):
        words = [f"word{rnd.randrange(500)}" for _ in range(rnd.randint(20, 90))]
        y = int(i % 4 == 0)
        for _ in range(3 * y):
            words[rnd.randrange(len(words))] = rnd.choice(["varletish", "doltish"])
        if i % 10 == 1:
            words.append("a@b.org")
        rows.append((i, " ".join(words), "en", f"s{i % 3}", y))
    rows += [(300 + i, rows[i][1], "en", "s0", rows[i][4]) for i in range(1, 20, 2)]
    rows += [(400, None, None, None, 0), (401, "", "en", "s1", 0)]
    docs = spark.createDataFrame([(i, t, la, s, None if t is None else len(t)) for i, t, la, s, _ in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], r[4]) for r in rows], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    left = [r for r in rows if not r[4]]
    fps = [simhash_gray.fingerprint(r[1]) for r in left]
    kept = []
    for r, f in zip(left, fps, strict=True):
        if not any((f ^ g).bit_count() <= 3 and q[0] < r[0] for q, g in zip(left, fps, strict=True)):
            kept.append(r)
    frame = spark.createDataFrame([(i, None if t is None else pii_scan.mask(t), la, s, 0) for i, t, la, s, _ in kept], docs.schema)
    mixed = source_mix.mixed_documents(frame).collect()
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((r["doc_id"], lib.encode(r["text"], add_special_tokens=False).ids) for r in mixed)
    assert sorted((r["doc_id"], list(r["ids"])) for r in got) == want
    assert len(corpus_pipeline.STAGES) == 5 and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "pii", "mixing", "bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert ordinal_toxicity.REJECT == 0.5
