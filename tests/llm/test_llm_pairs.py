"""Near-duplicate operators against brute force: SimHash, syncmers, embeddings."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from corpusprep.llm import ego_join, simhash_gray, syncmers
from corpusprep.llm.common import connected_components, forest, prefix_sums, shard_bounds

DOCS = "doc_id bigint, text string, fingerprint string, component_id string, key string"


def docs_of(spark, rows):
    """Rows ``(id, text)`` with extra columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOCS)


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def labels_of(ids, links):
    root = {i: i for i in range(len(ids))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        root[find(a)] = find(b)
    out = []
    for i in range(len(ids)):
        known = [ids[j] for j in range(len(ids)) if find(j) == find(i) and ids[j] is not None]
        out.append(min(known) if known else None)
    return out


def test_simhash_components_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(400)] + ["Ünï", "ÀB", "Ab"]
    rows = []
    for i in range(120):
        words = list(rng.choice(vocab, 120))
        rows.append((i, " ".join(words)))
        if i % 3 == 0:
            words[60] = "Changed"
            rows.append((1000 + i, "\t".join(words)))
            rows.append((2000 + i, "\n".join(words).upper()))
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (None, ""), (5003, "one"), (5004, "one two"), (5003, "one"),
             (5005, "x\x1cy z\x85 a"), (7000, "a b c " * 9000)]
    got = simhash_gray.simhash_components(docs_of(spark, rows)).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    want = labels_of([i for i, _ in rows], [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3])
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got)) == sorted(key((i, f"{f:016x}", c)) for (i, _), f, c in zip(rows, fps, want, strict=True))


@pytest.mark.parametrize("shard_rows", [4096, 20])
def test_simhash_links_survive_splitting_of_hot_shards(spark, shard_rows):
    rng = np.random.default_rng(5)
    center = int(rng.integers(0, 1 << 62))
    values = {center}
    for _ in range(300):                       # a ball of near values shares every block
        v = center
        for b in rng.choice(64, rng.integers(1, 7), replace=False):
            v ^= 1 << int(b)
        values.add(v)
    values |= {int(x) for x in rng.integers(0, 1 << 63, 300)}
    u = np.array(sorted(values), dtype=np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= 3
    want = forest(len(u), *np.nonzero(near))
    frame = spark.createDataFrame([(int(x),) for x in u.view(np.int64)], "fp bigint")
    comp = {r["node"]: r["root"] for r in connected_components(simhash_gray.near_links(frame, 3, shard_rows)).collect()}
    signed = u.view(np.int64).tolist()
    got = [comp.get(v, v) for v in signed]
    assert len(set(zip(want.tolist(), got, strict=True))) == len(set(want.tolist())) == len(set(got))


def test_gray_index_finds_exactly_the_near_pairs():
    rng = np.random.default_rng(1)
    u = rng.integers(0, 1 << 20, 700, dtype=np.uint64) * np.uint64(0x10001)
    u = np.unique(u)
    shard = np.sort(rng.integers(0, 3, len(u)))
    order = np.lexsort((simhash_gray.gray_rank(u), shard))
    s, v = shard[order], u[order]
    got = {(min(i, j), max(i, j)) for a, b in simhash_gray.GrayIndex(s, v).links(3) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    i, j = np.nonzero((np.bitwise_count(v[:, None] ^ v[None, :]) <= 3) & (s[:, None] == s[None, :]))
    assert got == {(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True) if a < b}


def test_gray_neighbours_differ_in_one_bit():
    g = np.arange(4096, dtype=np.uint64)
    code = g ^ (g >> np.uint64(1))
    assert np.array_equal(simhash_gray.gray_rank(code), g)


def test_simhash_empty_table_and_keep_one(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash_gray.simhash_components(empty).count() == 0
    assert simhash_gray.keep_one(empty).count() == 0
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(4, long), (2, long), (2, long), (9, "other text " * 30), (None, "only without id " * 20), (None, long)]
    kept = simhash_gray.keep_one(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, rows).columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, [
        (2, long), (9, "other text " * 30), (None, "only without id " * 20)]))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 500), (600, 601)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert {i: 0 for i in range(1, 301)} | {601: 600} == {k: v for k, v in got.items() if k != v}


def test_prefix_sums_and_shards(spark):
    rows = [(i, (i * 7) % 13) for i in range(500)]
    t = prefix_sums(spark.createDataFrame(rows, "key bigint, n bigint"), ["key"], "n")
    got = {r["key"]: r["start"] for r in t.collect()}
    total, want = 0, {}
    for k, n in rows:
        want[k] = total
        total += n
    assert got == want
    bounds = shard_bounds(t, "key", 500, 1000)
    assert [b[0] for b in bounds] == sorted(b[0] for b in bounds) and bounds[0] == (0, 0)
    assert len(shard_bounds(t, "key", 1, 4)) <= 5


# ------------------------------------------------------------------ syncmers
def test_syncmer_query_equals_brute_force_edit(spark):
    rows = [(3, "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 12), (1, "für Straße " * 50), (2, None), (4, ""),
            (7, "x" * 3000), (8, "x" * 3000), (9, "word"), (20, "α𝔸β " * 33), (8, "twin id")]
    got = {(r["doc_id"], r["n_chars"]): r for r in syncmers.edited_likeness(docs_of(spark, rows)).collect()}
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0], r[1].encode()))
    assert len(got) == len(rows)
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        r = got[i, len(t)]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert got[7, 3000]["fingerprint"] == got[8, 3000]["fingerprint"] and got[7, 3000]["near_next"] == 0.0
    assert got[2, 0]["fingerprint"] == "" == got[4, 0]["fingerprint"]
    assert syncmers.edited_likeness(spark.createDataFrame([], DOCS)).count() == 0
    one = syncmers.edited_likeness(docs_of(spark, [(None, "a b c d e f g h")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_syncmers_are_context_free_and_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    words = [f"w{rng.integers(0, 5000)}" for _ in range(600)]
    rows = [(1, " ".join(words)), (2, "other start " + " ".join(words[100:300]) + " other end"), (3, " ".join(words))]
    got = {r["doc_id"]: r for r in syncmers.fingerprints(docs_of(spark, rows)).collect()}
    assert got[1]["fingerprint"] == got[3]["fingerprint"]
    h = lambda b: xxhash.xxh64_intdigest(b, 42)
    units = [w[i:i + syncmers.UNIT] for w in rows[1][1].split() for i in range(0, len(w), syncmers.UNIT)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    # Spark hashes a long with the previous hash as its seed
    chain = lambda vs: _fold(vs)

    def long_hash(v, seed):
        return xxhash.xxh64_intdigest((v & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "little"), seed & 0xFFFFFFFFFFFFFFFF)

    def _fold(vs):
        seed = 42
        for v in vs:
            seed = long_hash(v, seed)
        return signed(seed)
    uh = [signed(h(u.encode())) for u in units]
    s = [chain(uh[i:i + 2]) for i in range(len(uh) - 1)]
    inner = syncmers.K - syncmers.S + 1
    anchors = set()
    for i in range(len(units) - syncmers.K + 1):
        of = s[i:i + inner]
        if min(of) in (of[0], of[-1]):
            anchors.add(_fold(of) & 0xFFFFFFFF)
    assert got[2]["anchors"] == sorted(anchors)[:syncmers.SIZE]


def test_syncmer_fingerprint_holds_all_anchors_in_order_with_positions(spark):
    rng = np.random.default_rng(3)
    words = [f"w{rng.integers(0, 900)}" for _ in range(9000)]
    shared = " ".join(f"s{rng.integers(0, 10 ** 3)}" for _ in range(400))
    rows = [(1, " ".join(words[:4000]) + " " + shared), (2, shared + " " + " ".join(f"z{w}" for w in words)), (3, "a b c d " * 50), (4, "a b c d " * 20)]
    got = {r["doc_id"]: r for r in syncmers.fingerprints(docs_of(spark, rows)).collect()}
    marks = {i: [r["fingerprint"][a:a + 8] for a in range(0, len(r["fingerprint"]), 8)] for i, r in got.items()}
    for i, r in got.items():
        assert len(marks[i]) == len(r["positions"]) and r["positions"] == sorted(set(r["positions"]))
    assert len(marks[1]) > 2000 and set(got[1]["anchors"]) < {int(m, 16) for m in marks[1]}
    own = " ".join(words[:4000]).split(" ")                    # words have at most UNIT code points
    inside = {(p - len(own), m) for p, m in zip(got[1]["positions"], marks[1], strict=True) if p >= len(own)}
    assert inside and inside == {(p, m) for p, m in zip(got[2]["positions"], marks[2], strict=True) if p <= 400 - syncmers.K}
    assert len(marks[3]) > len(set(marks[3]))                  # repeats stay
    next_of = {r["doc_id"]: r["near_next"] for r in syncmers.edited_likeness(docs_of(spark, rows)).collect()}
    for i, j in ((1, 2), (2, 3), (3, 4), (4, 1)):
        a, b = Counter(marks[i]), Counter(marks[j])
        assert next_of[i] == pytest.approx(2 * (a & b).total() / (a.total() + b.total()), abs=1e-12)
    assert next_of[1] > 0 and 0 < next_of[3] < 1


def test_syncmers_find_a_shared_passage_at_any_offset_without_spaces(spark):
    rng = np.random.default_rng(4)
    run = lambda n: "".join(chr(int(c)) for c in np.where(rng.random(n) < 0.1, rng.integers(0x20000, 0x2A000, n), rng.integers(0x4E00, 0x9000, n)))
    passage = run(300)
    rows = [(0, passage)] + [(o, run(37 + o) + passage + run(20)) for o in range(1, 9)] + [(9, passage[:150] + run(1) + passage[150:])]
    got = {r["doc_id"]: r for r in syncmers.fingerprints(docs_of(spark, rows)).collect()}
    marks = {i: [(p, r["fingerprint"][8 * k:8 * k + 8]) for k, p in enumerate(r["positions"])] for i, r in got.items()}
    assert len(marks[0]) > 150
    for o in range(1, 9):                                      # a unit at each code point: positions are shifted by as many
        assert {(p + 37 + o, m) for p, m in marks[0]} <= set(marks[o])
    kept = {m for _, m in marks[0]} & {m for _, m in marks[9]}
    assert len(kept) >= len({m for _, m in marks[0]}) - syncmers.UNIT - syncmers.K


def test_syncmer_units_of_short_and_long_words(spark):
    words = ["a", "𝔸bcd", "abcde", "ab𝔸defgh", "abcdefghi", "𝔸𝔸𝔸𝔸𝔸𝔸𝔸𝔸𝔸𝔸x", "", "x" * 30]
    def units(w):
        n = syncmers.UNIT
        return [w[i:i + n] for i in (range(0, len(w), n) if len(w) <= 2 * n else range(len(w) - n + 1))]
    text = " \t".join(words) + "\n"
    got = spark.createDataFrame([(text,)], "t string").selectExpr(f"regexp_extract_all(t, r'{syncmers.UNITS}', 1) AS u").first()["u"]
    assert got == [u for w in words for u in units(w)]


# ------------------------------------------------------------------ embeddings
def brute_vectors(rows, cosine):
    ok = [v is not None and None not in v and np.isfinite(v).all() and any(v) for _, v in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[i][1], float) for i in (a, b))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    links.append((a, b))
    n = np.bincount(np.array(links, int).ravel(), minlength=len(rows)) if links else np.zeros(len(rows), int)
    comp = labels_of([i for i, _ in rows], links)
    comp = [c if o else i for c, o, (i, _) in zip(comp, ok, rows, strict=True)]
    return sorted(((i, int(k), c, i == c) for (i, _), k, c in zip(rows, n, comp, strict=True)), key=str)


@pytest.mark.parametrize("block_rows", [2048, 16])
def test_embeddings_equal_brute_force(spark, block_rows):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(60, 12))
    near = np.repeat(base[:20], 5, axis=0) + rng.normal(scale=0.2, size=(100, 12))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.r_[base, near])]
    rows += [(900 + i, rows[3][1]) for i in range(40)]                       # many copies of one vector
    rows += [(950, None), (951, [0.0] * 12), (952, [float("nan")] + [1.0] * 11), (953, [float("inf")] + [1.0] * 11), (954, [1.0, 2.0]),
             (955, [2.0, 4.0]), (None, rows[5][1]), (956, []), (957, [None] * 12), (3, rows[3][1]), (958, [1e-3 * x for x in rows[4][1]])]
    frame = spark.createDataFrame([(i, v, "a", 1) for i, v in rows], "vec_id bigint, embedding array<double>, kept string, n_links int")
    got = ego_join.near_vectors(frame, block_rows=block_rows).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got), key=str) == brute_vectors(rows, 0.9)


def test_embeddings_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert ego_join.near_vectors(frame).count() == 0
