"""Linear classifiers of all groups in one run, and Ward clustering, against plain versions."""

import random

import numpy as np

from corpusprep.operators import agglomerative as ag
from corpusprep.operators import classify as cl
from corpusprep.operators import linear as li
from corpusprep.operators import split as sp


def brute_ward(x, k):
    """One merge at a time: the two clusters of least Ward distance, until k are left."""
    names = list(range(len(x)))
    size, center = {i: 1 for i in names}, {i: x[i].astype(float) for i in names}
    of, heights = {i: i for i in names}, []
    while len(names) > k:
        c = np.array([center[i] for i in names])
        n = np.array([size[i] for i in names], float)
        d = ((c[:, None] - c[None]) ** 2).sum(-1) * 2 * n[:, None] * n[None] / (n[:, None] + n[None])
        d[np.tril_indices(len(names))] = np.inf
        i, j = np.unravel_index(d.argmin(), d.shape)
        a, b = names[i], names[j]
        heights.append(d[i, j] ** .5)
        center[a] = (center[a] * size[a] + center[b] * size[b]) / (size[a] + size[b])
        size[a] += size[b]
        names.pop(j)
        of = {r: a if c == b else c for r, c in of.items()}
    first = sorted({min(r for r in of if of[r] == c) for c in set(of.values())})
    return [first.index(min(r for r in of if of[r] == of[i])) for i in range(len(x))], heights


def test_ward_cuts_as_one_merge_at_a_time(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(rng.normal(size=6) * 3, 1, size=(50, 6)) for _ in range(10)])
    df = spark.createDataFrame([("w", None, i, [float(v) for v in r]) for i, r in enumerate(x)]
                               + [("w", "few", i, [float(i // 2)]) for i in range(4)] + [("w", "few", 9, None), ("w", "few", 10, [float("nan")])],
                               "workbook string, sheet string, row_idx bigint, v array<double>")
    got = {(r["sheet"], r["row_idx"]): r["cluster"] for r in ag.ward(df, "v", 12, block=128).collect()}
    want, heights = brute_ward(x, 12)
    assert [got[None, i] for i in range(500)] == want
    assert [got["few", i] for i in (0, 1, 2, 3, 9, 10)] == [0, 0, 1, 1, -1, -1]       # equal vectors stay together
    merges = ag.ward_merges(df.where("sheet is null"), "v", block=128).collect()
    assert len(merges) == 499
    assert np.allclose(sorted(m["height"] for m in merges)[:len(heights)], heights)
    assert max(m["round"] for m in merges) < 40


def corpus(spark, groups, rows, noise):
    rng = random.Random(3)
    words = {c: [f"{c}{i}" for i in range(30)] for c in ("alpha", "beta", "gamma")}
    out = []
    for g in range(groups):
        for i in range(rows):
            label = rng.choice(sorted(words)[:2 + g % 2])
            text = " ".join(rng.choice(words[label if rng.random() > noise else rng.choice(sorted(words))]) for _ in range(12))
            out.append(("w", f"s{g}", i, text, label))
    df = spark.createDataFrame(out, "workbook string, sheet string, row_idx bigint, text string, label string")
    return sp.stratified_split(df, "label").cache()


def test_one_run_is_as_accurate_as_a_fit_for_each_group(spark):
    df = corpus(spark, 3, 260, .25)
    got = {r["sheet"]: r["accuracy"] for r in cl.accuracy(cl.lr_evaluate(df, "text", "label")).collect()}
    for s in ("s0", "s1", "s2"):
        model, lmap = cl.lr_fit(df, "text", "label", ("w", s))
        test = df.where(f"sheet = '{s}' and split = 'test'")
        ids = {r["label"]: r["label_id"] for r in lmap.collect()}
        rows = model.transform(test).select("label", "prediction").collect()
        want = sum(ids[r["label"]] == r["prediction"] for r in rows) / len(rows)
        assert got[s] >= want - 1e-3


def test_mixing_of_blocks_and_one_sided_groups(spark):
    df = corpus(spark, 2, 300, .1)
    one = df.where("sheet = 's0' and label = 'alpha'").replace({"s0": "single"}, subset=["sheet"])
    models, lmap = li.softmax_fit(df.unionByName(one), "text", "label", block_rows=40)      # several blocks a group
    got = {r["sheet"]: r for r in models.collect()}
    assert {s: r["labels"] for s, r in got.items()} == {"s0": 2, "s1": 3, "single": 1}
    assert got["single"]["rounds"] < li.ROUNDS                                              # settled at once, the others go on
    pred = li.softmax_evaluate(df.unionByName(one), "text", "label", block_rows=40)
    acc = {r["sheet"]: r["accuracy"] for r in cl.accuracy(pred).collect()}
    assert min(acc.values()) > .95
    again = {r["sheet"]: r["weights"] for r in li.softmax_fit(df.repartition(7).unionByName(one), "text", "label", block_rows=40)[0].collect()}
    assert all(np.allclose(again[s], got[s]["weights"]) for s in got)                       # reruns agree


def test_jobs_do_not_grow_with_the_groups(spark, monkeypatch):
    written = []
    monkeypatch.setattr(li, "scratch_path", lambda s, name, real=li.scratch_path: written.append(name) or real(s, name))
    counts = []
    for groups in (1, 6):
        written.clear()
        li.softmax_fit(corpus(spark, groups, 40, .1), "text", "label", dims=64)
        counts.append(len(written))
    assert max(counts) <= 1 + li.ROUNDS
