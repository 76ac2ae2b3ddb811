"""Conversation repair, line dedup and hard negatives against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import conversation_repair, lemp_negatives, line_runs

SPACE = " \t\n\x0b\x0c\r"


# ------------------------------------------------------------------ conversations
def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        n = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if n == 0:
            continue
        if n == 1:
            text = ""
        if n == 2:
            text = "".join(c for c in text if c not in ".!?")
        if n == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if n == 3 else 1)
    return out


def brute_repair(rows):
    """Rows ``(turn, role, text)`` of one conversation: the report, by a plain search from the back over (cost, letters)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        core = text.rstrip(SPACE)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated")
        seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(maxsize=None)
    def best(i, last, inserted):
        """Cheapest ``(cost, letters, turns)`` from row i on, after a turn with initial ``last``."""
        found = [(0, "", ())] if i == len(rows) and last in ("", "a") else []

        def go(cost, letter, turn, *to):
            rest = best(*to)
            if rest:
                found.append((cost + rest[0], letter + rest[1], (() if turn is None else (turn,)) + rest[2]))
        if inserted < 4:
            for r in ("user", "assistant"):
                if (last, r[0]) in step:
                    go(3, "I", f"{r}:", i, r[0], inserted + 1)
        if i < len(rows):
            _, role, text = rows[i]
            go(4, "D", None, i + 1, last, 0)
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                if (last, role[:1]) in step:
                    go(more, "K", f"{role}:{text}", i + 1, role[:1], 0)
                for r in ("user", "assistant"):
                    if (last, r[0]) in step:
                        go(3 + more, "R", f"{r}:{text}", i + 1, r[0], 0)
        return min(found, key=lambda f: f[:2]) if found else None
    cost, audit, turns = best(0, "", 0)
    numbers = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest())


CONV = "conv_id bigint, turn bigint, role string, text string, audit string, pattern int, cost string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], CONV)


def random_rows(rng, convs, longest):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "Ux", None, "s", "ux"]
    texts = ["Fine.", "Why?", "cut off", "", " \t\n", None, "a!\n ", "é.", "x\x1c", "Fine.", "More here.", "."]
    rows = []
    for c in convs:
        for t in range(rng.randrange(longest)):
            rows.append((c, rng.choice([t, t, t, t, None, 2, t + 3, -t]), rng.choice(roles[:5]) if rng.random() < .8 else rng.choice(roles),
                         rng.choice(texts) if rng.random() < .5 else f"{rng.random()}."))
    return rows


def expected(rows, ids):
    by = defaultdict(list)
    for conv, *r in rows:
        by[conv].append(tuple(r))
    return {c: brute_repair(by[c]) for c in ids}


@pytest.mark.parametrize("segment_rows", [4096, 2])
def test_repair_equals_plain_search(spark, segment_rows):
    rng = random.Random(segment_rows)
    convs = [None, *range(-2, 60)]
    rows = random_rows(rng, convs, 9)
    rows += rows[:7]                                        # repeated rows
    rows += [(99, t, r, f"{t}.") for t, r in enumerate(["s", "user", "assistant"] * 12)]
    got = conversation_repair.repair_report(conversation_repair.damage(frame(spark, rows)), frame(spark, rows), segment_rows).collect()
    want = expected(brute_damage(rows), {r[0] for r in rows})
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == want
    assert len(got) == len(want)


def test_repaired_turns_are_legal_and_hold_whole_texts(spark):
    long = "word " * 200_000 + "end."
    rows = [(1, 0, "assistant", long), (1, 1, "assistant", "b."), (1, 2, "assistant", "b."), (2, 5, "system", "s."), (3, None, None, None)]
    got = conversation_repair.repaired_turns(frame(spark, rows)).orderBy("conv_id", "place").collect()
    turns = [tuple(r) for r in got]
    assert [(c, p, e, r) for c, p, e, r, _ in turns] == [(1, 1, "I", "user"), (1, 2, "K", "assistant"), (1, 3, "I", "user"), (1, 4, "K", "assistant")] \
        or [(c, p, e, r) for c, p, e, r, _ in turns] == [(1, 1, "R", "user"), (1, 2, "K", "assistant")]
    assert long in [t for *_, t in turns]


def test_repair_of_an_empty_table_and_of_conversations_that_lost_all_rows(spark):
    empty = frame(spark, [])
    assert conversation_repair.repair_report(empty).count() == 0
    assert conversation_repair.repaired_turns(empty).count() == 0
    got = conversation_repair.repair_report(empty, frame(spark, [(4, 1, "user", "x"), (None, 1, "user", "x")])).collect()
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert {tuple(r) for r in got} == {(4, *nothing), (None, *nothing)}


def test_weights_order_as_cost_then_letters():
    rng = random.Random(1)
    for _ in range(300):
        pattern = "".join(rng.choice("BPSUAXsuax") for _ in range(rng.randrange(12)))
        cut = rng.randrange(len(pattern) + 1)
        whole, parts = conversation_repair.Path(), conversation_repair.Path()
        whole.extend(len(pattern), conversation_repair.transfer(pattern))
        for p in (pattern[:cut], pattern[cut:]):
            parts.extend(len(p), conversation_repair.transfer(p))
        assert whole.result() == parts.result()


# ------------------------------------------------------------------ lines
def brute_lines(rows, min_docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(SPACE).translate(lower)
    n = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} - {""})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if n[key(x)] < min_docs]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


DOCS = "doc_id bigint, text string, n_lines string, hashes int, key string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "k") for i, t in rows], DOCS)


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (5, 2), (7, 3)])
def test_line_dedup_equals_brute_force(spark, batches, fanout):
    rng = random.Random(batches)
    lines = [f"line {i}" for i in range(40)] + ["Common", " common\t", "", "  ", "É", "é", "COMMON\r", "\x1c", "x\x85"]
    rows = [(i if rng.random() < .9 else None, "\n".join(rng.choice(lines) for _ in range(rng.randrange(9)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "\n\n"), (903, "Common\n" * 4000 + "own line " * 5000), *rows[:40], *[(1000, "copied\ntext")] * 12]
    got = line_runs.drop_frequent_lines(docs_of(spark, rows), batches=batches, fanout=fanout).collect()
    assert sorted(map(tuple, got), key=str) == brute_lines(rows, 10)


def test_line_dedup_of_an_empty_table(spark):
    assert line_runs.drop_frequent_lines(docs_of(spark, [])).count() == 0
    runs = line_runs.LineRuns(spark)
    assert runs.frequent().count() == 0


def test_runs_are_levelled_and_settled_hashes_are_not_added_again(spark):
    runs = line_runs.LineRuns(spark, min_docs=3, fanout=2, buckets=4)
    batch = lambda *hashes: spark.createDataFrame([([h.encode() for h in hashes], 3), ([b"rare"], 1)], "hashes array<binary>, docs bigint")
    sizes = []
    for names in (["a", "b"], ["a", "c"], ["a", "d"], ["a", "e"], ["a", "b"]):
        runs.add(batch(*names))
        sizes.append([[spark.table(t).count() for t in level] for level in runs.levels])
    # "a" is settled by the first batch: the second adds c and rare only, merged to a, b, c, rare
    assert sizes == [[[3]], [[], [4]], [[2], [4]], [[], [], [6]], [[0], [], [6]]]
    assert {bytes(r["hash"]) for r in runs.frequent().collect()} == {b"a", b"b", b"c", b"d", b"e", b"rare"}
    plan = runs._merged(runs._tables())._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "Exchange" not in plan                     # runs meet bucket by bucket
    runs.close()


# ------------------------------------------------------------------ hard negatives
def brute_negatives(rows):
    v = []
    for at, (i, e, label) in enumerate(rows):
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        if i is not None and i % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        v.append((at, i, label, [math.floor(256 * float(np.float32(x))) for x in e]))
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for a in v:
        if a[1] is None or a[1] % 100:
            continue
        score = lambda b: sum(x * y for x, y in zip(a[3], b[3], strict=True))  # noqa: B023, E731
        peers = [(score(b), b[1], b[2] == a[2]) for b in v if b[0] != a[0] and len(b[3]) == len(a[3])]
        for p, pid, _ in sorted((x for x in peers if x[2] and x[1] != a[1]), key=order)[:5]:
            for rank, (n, nid, _) in enumerate(sorted((x for x in peers if not x[2] and 30 * p <= 100 * x[0] <= 90 * p), key=order)[:10], 1):
                out.append((a[1], pid, rank, nid, p, n))
    return sorted(out, key=str)


VECS = "vec_id bigint, embedding array<float>, label int, length string, codes int, rank string"


def vecs_of(spark, rows):
    return spark.createDataFrame([(i, e, label, "x", 1, "y") for i, e, label in rows], VECS)


@pytest.mark.parametrize(("bucket_rows", "group_anchors", "stripes"), [(2048, 1024, 32), (16, 3, 4)])
def test_hard_negatives_equal_brute_force(spark, bucket_rows, group_anchors, stripes):
    rng = np.random.default_rng(bucket_rows)
    rows = []
    centers = rng.normal(size=(6, 12))
    for i in range(0, 2400, 5):
        label = int(rng.integers(0, 6))
        v = centers[label] * .6 + centers[(label + 1) % 6] * .4 + rng.normal(size=12) * .4
        rows.append((i, [float(np.float32(x)) for x in np.round(v * (1 + (i % 4)) / 3, 2)], label))
    rows += rows[:30]                                                         # repeated rows and equal scores
    rows += [(5000, rows[3][1], -7), (5100, [0.0] * 12, 1), (5200, None, 1), (5300, [None] * 12, 1), (5400, [float("nan")] * 12, 1),
             (5500, [float("inf")] * 12, 1), (5600, rows[5][1], None), (None, rows[5][1], 2), (None, rows[5][1], 3), (6000, [1.0, 2.0], 1),
             (6100, [1.0, 2.0], 1), (6101, [0.5, 1.0], 2), (7000, [], 1), (7100, [], 1), (7101, [], 2)]
    got = lemp_negatives.hard_negatives(vecs_of(spark, rows), bucket_rows=bucket_rows, group_anchors=group_anchors, stripes=stripes).collect()
    assert sorted(map(tuple, got), key=str) == brute_negatives(rows)
    assert len(got) > 200


def test_hard_negatives_of_empty_tables(spark):
    assert lemp_negatives.hard_negatives(vecs_of(spark, [])).count() == 0
    assert lemp_negatives.hard_negatives(vecs_of(spark, [(1, [1.0], 1), (3, [1.0], 2)])).count() == 0     # no anchors


def test_feasible_ranges_lose_no_vector_and_prune(spark):
    rng = np.random.default_rng(2)
    codes = np.floor(256 * rng.normal(size=(500, 8))).astype(np.int64)
    codes = codes[np.argsort(-np.linalg.norm(codes, axis=1))]
    units = lemp_negatives._units(codes)
    row = {"top": float(np.linalg.norm(codes, axis=1)[0]), "ids": np.arange(500).tobytes(), "labels": np.zeros(500, np.int64).tobytes(),
           "codes": codes.tobytes(), "orders": np.argsort(units, axis=0, kind="stable").T.astype("<u4").tobytes()}
    b = lemp_negatives._Bucket(row, 8, np.dtype(np.float64))
    seen = 0
    for a in rng.integers(0, 500, 40):
        for t in (-.9, 0.0, .3, .8, .95, 1.0):
            focus = np.argsort(-np.abs(units[a]))[:5]
            got = b.feasible(units[a], focus, t - 1e-9)
            got = set(range(500)) if got is None else set(got.tolist())
            assert got >= set(np.flatnonzero(units @ units[a] >= t).tolist())
            seen += len(got)
    assert seen < 40 * 6 * 500 * .6


def test_large_components_are_multiplied_exactly(spark):
    big = [8.0e6, -1.0e3]
    rows = [(0, big, 1), (1, big, 1), (2, [5.0e6, -1.5e3], 2), (3, [4.0e6, 3.0], 3)]
    got = lemp_negatives.hard_negatives(vecs_of(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute_negatives(rows)
    assert got


def test_queries_of_the_three_read_whole_tables(spark):
    from corpusprep.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    convs = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in convs.select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op11_conversations"](spark, sf).collect()}
    assert got == expected(brute_damage(rows), {r[0] for r in rows})
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted(((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in brute_lines(docs, 10)), key=str)
    assert sorted(map(tuple, QUERIES["op12_line_dedup"](spark, sf).collect()), key=str) == want
    vecs = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", F.col("label")).collect()]
    assert sorted(map(tuple, QUERIES["op13_hard_negatives"](spark, sf).collect()), key=str) == brute_negatives(vecs)
