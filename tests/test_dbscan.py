import numpy as np

from corpusprep.operators import dbscan as db


def _py_dbscan(pts, r, min_samples):
    n = len(pts)
    nb = [[j for j in range(n) if np.linalg.norm(pts[i] - pts[j]) <= r + 1e-12] for i in range(n)]
    core = [len(x) >= min_samples for x in nb]
    comp = list(range(n))

    def find(x):
        while comp[x] != x:
            comp[x] = comp[comp[x]]
            x = comp[x]
        return x
    for i in range(n):
        if core[i]:
            for j in nb[i]:
                if core[j]:
                    a, b = find(i), find(j)
                    comp[max(a, b)] = min(a, b)
    lab = {}
    for i in range(n):
        if core[i]:
            lab[i] = min(k for k in range(n) if core[k] and find(k) == find(i))
    out = []
    for i in range(n):
        if core[i]:
            out.append(lab[i])
        else:
            adj = [lab[j] for j in nb[i] if core[j]]
            out.append(min(adj) if adj else -1)
    return out


def _canon(labels):
    m, out = {}, []
    for x in labels:
        if x == -1:
            out.append(-1)
        else:
            out.append(m.setdefault(x, len(m)))
    return out


def test_dbscan_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    pts = np.vstack([rng.normal(c, 0.3, size=(15, 3)) for c in ([0, 0, 0], [3, 3, 0], [0, 3, 3])]
                    + [rng.uniform(-4, 6, size=(8, 3))])
    rows = [("w", "s", i, [float(x) for x in p]) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, v array<double>")
    got = {r.row_idx: r.cluster for r in db.dbscan(df, "v", eps=0.6, min_samples=4, metric="euclidean").collect()}
    exp = _py_dbscan(pts, 0.6, 4)
    assert _canon([got[i] for i in range(len(pts))]) == _canon(exp)
    core = {r.row_idx: r.is_core for r in db.core_points(df, "v", eps=0.6, min_samples=4, metric="euclidean")
            .collect()}
    assert sum(core.values()) > 10


def test_small_packs_chains_copies_and_null_groups(spark, monkeypatch):
    """Cells, packs and blocks of a few points: every step meets more than one of them."""
    monkeypatch.setattr(db, "PACK", 8)
    monkeypatch.setattr(db, "BLOCK", 16)
    rng = np.random.default_rng(7)
    parts = [rng.normal(c, 0.3, size=(25, 3)) for c in ([0, 0, 0], [3, 3, 0], [1.6, 1.6, 0])]
    chain = np.linspace([5, 0, 0], [5, 9, 0], 40)                 # one long cluster, far ends apart
    copies = np.repeat([[1.0, 1.0, 1.0], [-4.0, -4.0, 0.0]], [20, 5], axis=0)
    pts = np.vstack([*parts, chain, copies, rng.uniform(-4, 6, size=(20, 3))])
    odd = [("w", None, len(pts), [float("nan"), 0.0, 0.0]), ("w", None, len(pts) + 1, None)]
    rows = [("w", g, i, [float(x) for x in p]) for g in (None, "s") for i, p in enumerate(pts)] + odd
    df = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, v array<double>")
    got = db.dbscan(df, "v", eps=0.6, min_samples=5, metric="euclidean").collect()
    exp = _canon(_py_dbscan(pts, 0.6, 5))
    for g in (None, "s"):
        of = {r.row_idx: r.cluster for r in got if r.sheet == g}
        assert _canon([of[i] for i in range(len(pts))]) == exp
        assert g == "s" or of[len(pts)] == of[len(pts) + 1] == -1
    n = {(r.sheet, r.row_idx): r.n_neighbors for r in db.core_points(df, "v", eps=0.6, metric="euclidean").collect()}
    near = (np.linalg.norm(pts[:, None] - pts[None], axis=2) <= 0.6 + 1e-12).sum(axis=1)
    assert all(n[g, i] == near[i] for g in (None, "s") for i in range(len(pts)))
    assert n[None, len(pts) + 1] == 1 and (None, len(pts)) not in n


def test_pairs_at_the_radius_are_within():
    x = np.array([[0.0, 0.0], [3.0, 4.0], [1e6, 1e6]])
    y = np.array([[0.0, 5.0], [0.0, 5.0000001], [1e6 + 3, 1e6 + 4]])
    assert db.within(x, y, 5.0).tolist() == [[True, False, False], [True, True, False], [False, False, True]]


def test_packs_meet_a_lot_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(db, "PACK", 4)
    monkeypatch.setattr(db, "LOT", 2, raising=False)
    points = [(None, i, [float(i % 13), float(i // 13) / 9]) for i in range(60)]
    df = spark.createDataFrame(points, "sheet string, row_idx bigint, v array<double>")
    found = db.core_points(df, "v", eps=1.0, min_samples=5, metric="euclidean", by=["sheet"])
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().optimizedPlan().toString()
    want = {i: sum((a - c) ** 2 + (b - d) ** 2 <= 1.0 + 1e-12 for _, _, (c, d) in points) for _, i, (a, b) in points}
    assert {r.row_idx: r.n_neighbors for r in found.collect()} == want


def test_a_pack_travels_once_for_each_lot(spark, monkeypatch):
    from pyspark.sql.group import GroupedData
    points = [(None, i, str(i % 64), [float(i % 16) / 40, float(i // 16) / 40], 1) for i in range(256)]      # all near each other
    df = spark.createDataFrame(points, "sheet string, id bigint, pack string, v array<double>, n bigint")
    packs, sides = db._packs(df, ["sheet"], "all", ["id", "n", "v"]), []
    monkeypatch.setattr(GroupedData, "cogroup", lambda self, other, real=GroupedData.cogroup: sides.append((self._df, other._df)) or real(self, other))
    near = db._compare(packs, packs, ["sheet"], 1.0, db._count, ["id", "v"], ["n", "v"], ["id", "n"]).collect()
    assert [x.count() for x in sides[0]] == [64 * 4, 64 * 4]             # 64 * 64 pairs of packs
    assert {r["id"] for r in near} == set(range(256))
    assert sum(r["n"] for r in near) == sum((a - c) ** 2 + (b - d) ** 2 <= 1 for *_, (a, b), _ in points for *_, (c, d), _ in points)
