import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.operators import classify as cl
from corpusprep.operators import cluster as cu
from corpusprep.operators import vectors as vc


def test_metrics_hand_computed(spark):
    # actual / predicted over classes 0,1,2; class 2 is never predicted
    pairs = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 0), (2, 1), (2, 0)]
    rows = [("w", "s", i, a, p) for i, (a, p) in enumerate(pairs)]
    pred = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, label_id int, pred_id int")
    assert cl.accuracy(pred).first().accuracy == pytest.approx(3 / 7)
    rep = {r.class_id: r for r in cl.class_report(pred).collect()}
    assert rep[0].precision == pytest.approx(2 / 4) and rep[0].recall == pytest.approx(2 / 3)
    assert rep[1].precision == pytest.approx(1 / 3) and rep[1].recall == pytest.approx(1 / 2)
    assert rep[2].precision == 0.0 and rep[2].f1 == 0.0 and rep[2].support == 2
    f0 = 2 * (0.5 * 2 / 3) / (0.5 + 2 / 3)
    f1 = 2 * (1 / 3 * 0.5) / (1 / 3 + 0.5)
    w = cl.weighted_f1(pred).first().f1
    assert w == pytest.approx((f0 * 3 + f1 * 2) / 7)
    assert 0.0 <= w <= 1.0


def _py_nb(train, test):
    vocab = {w for _, t in train for w in t.split()}
    labels = sorted({l for l, _ in train})
    counts = {l: Counter() for l in labels}
    docs = Counter(l for l, _ in train)
    for l, t in train:
        counts[l].update(t.split())
    out = []
    for t in test:
        best = None
        for i, l in enumerate(labels):
            tot = sum(counts[l].values())
            s = math.log(docs[l] / len(train))
            for w in t.split():
                if w in vocab:
                    s += math.log((counts[l][w] + 1) / (tot + len(vocab)))
            if best is None or s > best[0] + 1e-12:
                best = (s, l)
        out.append(best[1])
    return out


def test_naive_bayes_matches_python(spark):
    train = [("spam", "buy cheap pills now"), ("spam", "cheap offer now"), ("ham", "meeting at noon"),
             ("ham", "lunch at noon with team"), ("ham", "team meeting notes")]
    test = ["cheap lunch now", "team offer", "unknown words only"]
    rows = [("w", "s", i, "train", l, t) for i, (l, t) in enumerate(train)]
    rows += [("w", "s", 100 + i, "test", "ham", t) for i, t in enumerate(test)]
    df = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, split string, label string, "
                                     "text string")
    got = [r.pred_label for r in cl.nb_evaluate(df, "text", "label").orderBy("row_idx").collect()]
    assert got == _py_nb(train, test)
    conf = [r.confidence for r in cl.nb_evaluate(df, "text", "label").collect()]
    assert all(0.5 <= c <= 1.0 for c in conf)


def _blobs(spark, n_per=20, seed=0):
    rng = np.random.default_rng(seed)
    centers = np.array([[0, 0], [10, 10], [-10, 10]], dtype=float)
    rows = []
    i = 0
    for c in centers:
        for p in c + rng.normal(0, 0.5, size=(n_per, 2)):
            rows.append(("w", "s", i, [float(x) for x in p]))
            i += 1
    rows.append(("w", "s", i, [40.0, -40.0]))   # an outlier
    return spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, v array<double>")


def test_kmeans_fixed_point_and_partition_invariance(spark):
    df = _blobs(spark)
    rows, cents = cu.kmeans(df, "v", k=4, max_iter=50)
    got = rows.collect()
    a = {r.row_idx: r.cluster for r in got}
    c = {r.cluster: np.array(r.centroid) for r in cents.collect()}
    pts = {r.row_idx: np.array(r.v) for r in got}
    for i, p in pts.items():          # every row sits at its nearest centroid
        d = {k: float(((p - v) ** 2).sum()) for k, v in c.items()}
        assert d[a[i]] <= min(d.values()) + 1e-9
    for k, v in c.items():            # centroids are the means of their rows
        members = [pts[i] for i in pts if a[i] == k]
        assert np.allclose(np.mean(members, axis=0), v)
    rows3, _ = cu.kmeans(df.repartition(3), "v", k=4, max_iter=50)
    assert {r.row_idx: r.cluster for r in rows3.collect()} == a
    s = cu.cluster_summary(rows, algorithm="kmeans", columns_used=["v"]).first()
    assert (s.records, s.clusters, s.algorithm) == (61, 4, "kmeans")


def test_lloyd_cost_never_rises(spark):
    df = _blobs(spark, seed=3)
    cents = cu.seed_centroids(df, "v", 3)
    last = float("inf")
    for _ in range(4):
        a = cu.assign(df, "v", cents)
        cost = a.agg(F.sum("dist2")).first()[0]
        assert cost <= last + 1e-9
        last = cost
        cents = cu.update(a, "v").select("workbook", "sheet", "cluster", "centroid")


def test_unknown_algorithm():
    with pytest.raises(ValueError):
        cu.check_algorithm("spectral")


def test_summary_excludes_noise(spark):
    df = spark.createDataFrame([("w", "s", 0, -1), ("w", "s", 1, 0), ("w", "s", 2, 0), ("w", "s", 3, 2)],
                               "workbook string, sheet string, row_idx bigint, cluster int")
    s = cu.cluster_summary(df).first()
    assert (s.records, s.clusters) == (4, 2)


def test_tfidf_normalised(spark):
    df = spark.createDataFrame([("w", "s", 0, "a a b"), ("w", "s", 1, "b c")],
                               "workbook string, sheet string, row_idx bigint, t string")
    t = vc.tfidf(df, "t")
    for r in t.groupBy("row_idx").agg(F.sum(F.col("weight") ** 2).alias("n2")).collect():
        assert r.n2 == pytest.approx(1.0)
    h = vc.hashed_embedding(df, "t", dims=16).first().embedding
    assert len(h) == 16 and sum(x * x for x in h) == pytest.approx(1.0)


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(40, 5)) @ np.diag([5, 2, 1, 0.5, 0.1])
    rows = [("w", "g1" if i < 20 else "g2", i, [float(x) for x in p]) for i, p in enumerate(base)]
    df = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, v array<double>")
    got = {r.row_idx: (r.pc1, r.pc2) for r in vc.pca_2d(df, "v").collect()}
    for g, idx in (("g1", range(0, 20)), ("g2", range(20, 40))):
        x = base[list(idx)]
        xc = x - x.mean(0)
        w, vecs = np.linalg.eigh(np.cov(xc.T))
        top = vecs[:, np.argsort(-w)[:2]]
        for j in range(2):
            if top[np.argmax(np.abs(top[:, j])), j] < 0:
                top[:, j] *= -1
        exp = xc @ top
        for n, i in enumerate(idx):
            assert got[i] == pytest.approx(tuple(exp[n]), abs=1e-6)


def test_embed_hook(spark):
    df = spark.createDataFrame([("ab",), ("abcd",)], "t string")
    out = vc.embed_with(df, "t", lambda: (lambda texts: [[len(t), 1.0] for t in texts])).collect()
    assert [list(r.embedding) for r in out] == [[2.0, 1.0], [4.0, 1.0]]


def test_model_save_and_load(spark, tmp_path):
    from corpusprep.operators import report as rp
    rows = [("w", "s", i, "train" if i < 6 else "test", "a" if i % 2 else "b", f"word{i % 2} common")
            for i in range(8)]
    df = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, split string, label string, "
                                     "text string")
    m = cl.nb_fit(df, "text", "label")
    rp.save_nb_model(m, str(tmp_path / "nb"))
    m2 = rp.load_nb_model(spark, str(tmp_path / "nb"))
    test = df.where("split = 'test'")
    a = sorted(map(tuple, cl.nb_predict(m, test, "text").select("row_idx", "pred_label").collect()))
    b = sorted(map(tuple, cl.nb_predict(m2, test, "text").select("row_idx", "pred_label").collect()))
    assert a == b


def test_bisecting_grouped(spark):
    df = _blobs(spark, n_per=12, seed=4)
    df = df.unionByName(df.withColumn("sheet", F.lit("t")))
    out = cu.bisecting(df, "v", k=3)
    rows = out.collect()
    assert len(rows) == 2 * 37
    for sheet in ("s", "t"):
        a = {r.row_idx: r.cluster for r in rows if r.sheet == sheet}
        assert set(a.values()) <= {0, 1, 2} and len(set(a.values())) == 3
        # the two sheets hold the same points, so they get the same clusters
    s_ = {r.row_idx: r.cluster for r in rows if r.sheet == "s"}
    t_ = {r.row_idx: r.cluster for r in rows if r.sheet == "t"}
    assert s_ == t_


def test_custom_metric_callback(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)]
    rows = [("w", "s", i, a, p) for i, (a, p) in enumerate(pairs)]
    pred = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, label_id int, pred_id int")

    def balanced_accuracy(conf):
        per = []
        for cls, g in conf.groupby("label_id"):
            per.append(g.loc[g.pred_id == cls, "n"].sum() / g["n"].sum())
        return {"balanced_accuracy": float(sum(per) / len(per)), "rows": int(conf["n"].sum())}

    r = cl.custom_metrics(pred, balanced_accuracy, "balanced_accuracy double, rows long").first()
    assert r.rows == 5 and r.balanced_accuracy == pytest.approx((0.5 + 1.0 + 0.0) / 3)


def test_lr_model_save_and_load(spark, tmp_path):
    from pyspark.ml import PipelineModel
    rows = [("w", "s", i, "train" if i < 16 else "test", "a" if i % 2 else "b", f"word{i % 2} filler text")
            for i in range(20)]
    df = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, split string, label string, "
                                     "text string")
    model, lmap = cl.lr_fit(df, "text", "label", ("w", "s"))
    model.write().overwrite().save(str(tmp_path / "lr"))
    back = PipelineModel.load(str(tmp_path / "lr"))
    test = df.where("split = 'test'")
    a = [r.prediction for r in model.transform(test).orderBy("row_idx").collect()]
    b = [r.prediction for r in back.transform(test).orderBy("row_idx").collect()]
    assert a == b
    ev = {r.row_idx: (r.label_id, r.pred_id) for r in cl.lr_evaluate(df, "text", "label").collect()}
    assert all(lab == pred for lab, pred in ev.values())


def test_plus_plus_seeds_distinct_and_invariant(spark):
    df = _blobs(spark, n_per=15, seed=9)
    a = {r.cluster: tuple(r.centroid) for r in cu.plus_plus_seeds(df, "v", 4).collect()}
    b = {r.cluster: tuple(r.centroid) for r in cu.plus_plus_seeds(df.repartition(5), "v", 4).collect()}
    assert a == b and len(set(a.values())) == 4
    dup = df.unionByName(df)                       # duplicate points never become a second seed
    c = {r.cluster: tuple(r.centroid) for r in cu.plus_plus_seeds(dup, "v", 4).collect()}
    assert len(set(c.values())) == 4
    with pytest.raises(ValueError):
        cu.kmeans(df, "v", 2, init="random")


@pytest.mark.parametrize("block_rows", [2048, 40])
def test_knn_ties_beyond_any_margin_go_to_the_smaller_row(spark, block_rows):
    rng = np.random.default_rng(12)
    copies, others = rng.normal(size=6), rng.normal(size=(30, 6))
    ids = [int(i) for i in rng.permutation(150)]
    vecs = {i: copies if n < 120 else others[n - 120] for n, i in enumerate(ids)}
    frame = spark.createDataFrame([("w", "s", i, [float(x) for x in v]) for i, v in vecs.items()],
                                  "workbook string, sheet string, row_idx bigint, v array<double>")
    got = vc.knn_graph(frame, "v", k=5, block_rows=block_rows).orderBy("src", "rank").collect()
    want = [(i, j) for i in sorted(vecs) for _, j in sorted(
        (float(np.sqrt(((vecs[i] - vecs[j]) ** 2).sum())), j) for j in vecs if j != i)[:5]]
    assert [(r.src, r.dst) for r in got] == want
