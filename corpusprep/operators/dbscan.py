"""DBSCAN per group over a graph of cells; no list of near pairs is ever written.

For cosine distance vectors are L2-normalised and ``cos_dist <= eps`` becomes
``|x - y| <= r`` with ``r = sqrt(2 * eps)``.

1. Equal vectors are one weighted point.
2. **Cells.** A net is laid over the points in rounds: inside a block a point
   farther than the round's radius from all centres so far becomes a centre,
   and the centres go on to the next round. The rounds' radii add up to less
   than r / 2, so all points of a cell are within r of each other. (Grid
   cells of that size would need as many axes as the vectors have.)
3. **Packs.** Nets of growing radius over the cell centres make a tree; it
   deals the points into packs of about ``PACK`` near ones, each inside a
   ball. Two packs are compared only if their balls allow a distance of r.
   That is found from the balls alone, and a comparison is one matrix product.
4. **Core points.** A cell that weighs ``min_samples`` holds core points only,
   unchecked. For the others neighbours are counted.
5. **Clusters.** All core points of a cell are one node. Nodes whose centres
   are near are linked first; then only points of different components are
   compared, and a comparison returns the links of a spanning forest. A
   cluster is named by its smallest core ``row_idx``.
6. A point that is not core takes the smallest cluster with a core point
   within r; others are noise (-1). Clusters are numbered per group by name.

Work follows the number of cells and of points near another cluster. Vectors
without any structure at the radius (each its own cell, all balls touching)
leave all pairs of packs: then the work is the square of the group, as matrix
products, while what is written stays linear.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.operators.cluster import NOISE
from corpusprep.operators.joins import bounded_broadcast, join_by, null_safe_groups
from corpusprep.schema import ROW_IDX, group_cols
from corpusprep.session import scratch_path

# Library defaults of the reference's DBSCAN call.
EPS = 0.5
MIN_SAMPLES = 5
METRIC = "cosine"

#: Points of a pack, about.
PACK = 1024
#: Points, centres or balls of a block that one task goes through.
BLOCK = 2048
#: Packs, about, of a lot, and the lots that few packs make.
LOT, FEW_LOTS = 32, 4
#: Shares of the radius that the rounds of the cell net use up: less than a half together.
CELL_SHARES = (1 / 4, 1 / 8, 1 / 16)
#: Multiples of the radius of the nets over cells.
TREE_RADII = (1, 4, 16)
#: Slack of the distance comparison.
TIE = 1e-12


def _kept(rows: DataFrame, name: str) -> DataFrame:
    spark = rows.sparkSession
    path = scratch_path(spark, f"dbscan-{name}")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _prepare(df: DataFrame, vec: str, metric: str, by: list[str]) -> DataFrame:
    v = F.col(vec).cast("array<double>")
    if metric == "cosine":
        norm = F.sqrt(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), lambda a, x: a + x))
        # under cosine a zero vector is at distance 1 of all others: far for any radius below 1
        v = F.when(norm > 0, F.transform(v, lambda x: x / norm))
    elif metric != "euclidean":
        raise ValueError(f"unsupported metric {metric!r}")
    return df.select(*by, ROW_IDX, F.transform(v, lambda x: x + F.lit(0.0)).alias("v"))      # -0.0 is 0.0


def radius(eps: float, metric: str) -> float:
    return math.sqrt(2.0 * eps) if metric == "cosine" else eps


# --------------------------------------------------------------------------
# numpy inside tasks
# --------------------------------------------------------------------------
def _matrix(rows) -> np.ndarray:
    return np.stack([np.asarray(r, dtype=float) for r in rows])


def within(x: np.ndarray, y: np.ndarray, r: float) -> np.ndarray:
    """Which rows of ``x`` and ``y`` are at most ``r`` apart. Pairs that the
    rounding of the product leaves open are measured by their differences."""
    x2, y2 = (x * x).sum(axis=1), (y * y).sum(axis=1)
    d2 = x2[:, None] + y2[None, :] - 2 * (x @ y.T)
    slack = 16 * (x.shape[1] + 4) * np.finfo(float).eps * (x2.max() + y2.max())
    near = d2 <= r * r - slack
    i, j = np.nonzero(~near & (d2 <= (r + TIE) ** 2 + slack))
    for at in range(0, len(i), BLOCK):
        a, b = i[at:at + BLOCK], j[at:at + BLOCK]
        near[a, b] = np.sqrt(((x[a] - y[b]) ** 2).sum(axis=1)) <= r + TIE
    return near


def _net_udf(r: float):
    @F.pandas_udf("array<struct<id:bigint,to:bigint>>")
    def run(ids: pd.Series, vecs: pd.Series) -> pd.Series:
        """The centre of each point of a block: the smallest ids, each farther than ``r`` from those before it."""
        out = []
        for i, v in zip(ids, vecs):
            order = np.argsort(np.asarray(i))
            i, x = np.asarray(i)[order], _matrix(v)[order]
            to, left = np.empty_like(i), np.arange(len(i))
            while len(left):
                taken = ((x[left] - x[left[0]]) ** 2).sum(axis=1) <= r * r
                taken[0] = True
                to[left[taken]] = i[left[0]]
                left = left[~taken]
            out.append([{"id": int(a), "to": int(b)} for a, b in zip(i, to)])
        return pd.Series(out)
    return run


@F.pandas_udf(T.StructType([T.StructField("centre", T.ArrayType(T.DoubleType())), T.StructField("radius", T.DoubleType())]))
def _ball(vecs: pd.Series) -> pd.DataFrame:
    """A ball around the mean that holds all vectors of a pack."""
    out = []
    for v in vecs:
        x = _matrix(v)
        c = x.mean(axis=0)
        out.append({"centre": c.tolist(), "radius": float(np.sqrt(((x - c) ** 2).sum(axis=1)).max())})
    return pd.DataFrame(out, columns=["centre", "radius"])


def _near_udf(r: float, once: bool):
    @F.pandas_udf("array<struct<a:string,b:string>>")
    def run(a: pd.Series, ca: pd.Series, ra: pd.Series, la: pd.Series,
            b: pd.Series, cb: pd.Series, rb: pd.Series, lb: pd.Series) -> pd.Series:
        """Packs of two blocks whose balls allow a distance of ``r``; those of one label are left out."""
        out = []
        for i, x, rx, lx, j, y, ry, ly in zip(a, ca, ra, la, b, cb, rb, lb):
            x, y = _matrix(x), _matrix(y)
            rx, ry, i, j = np.asarray(rx, float), np.asarray(ry, float), np.asarray(i), np.asarray(j)
            x2, y2 = (x * x).sum(axis=1), (y * y).sum(axis=1)
            reach = (r + rx[:, None] + ry[None, :]) * (1 + 1e-9) + TIE
            slack = 16 * (x.shape[1] + 4) * np.finfo(float).eps * (x2.max() + y2.max())
            near = x2[:, None] + y2[None, :] - 2 * (x @ y.T) <= reach * reach + slack
            near &= np.asarray(lx)[:, None] != np.asarray(ly)[None, :]
            p, q = np.nonzero(near)
            out.append([{"a": s, "b": t} for s, t in zip(i[p], j[q]) if not once or s <= t])
        return pd.Series(out)
    return run


def _count(r: float, ids: np.ndarray, x: np.ndarray, weights: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = within(x, y, r) @ weights
    return ids[n > 0], n[n > 0]


def _link(r: float, p: np.ndarray, x: np.ndarray, q: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each label of two packs with the smallest one that it reaches through their near pairs."""
    near = within(x, y, r)
    top = np.iinfo(np.int64).max
    low_p, low_q = p.copy(), q.copy()
    while True:
        to_q = np.minimum(low_q, np.where(near, low_p[:, None], top).min(axis=0))
        to_p = np.minimum(low_p, np.where(near, to_q[None, :], top).min(axis=1))
        if (to_p == low_p).all() and (to_q == low_q).all():
            break
        low_p, low_q = to_p, to_q
    a, low = np.concatenate([p, q]), np.concatenate([low_p, low_q])
    links = np.unique(np.stack([a, low], axis=1)[a != low], axis=0)
    return links[:, 0], links[:, 1]


def _lowest(r: float, ids: np.ndarray, x: np.ndarray, labels: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    near = within(x, y, r)
    any_ = near.any(axis=1)
    return ids[any_], np.where(near, labels[None, :], np.iinfo(np.int64).max).min(axis=1)[any_]


def _columns(pack: pa.StructArray, names: Sequence[str]) -> list[np.ndarray]:
    """Fields of a pack's points; vectors as the rows of a matrix."""
    out = []
    for name in names:
        c = pc.struct_field(pack, name)
        if name == "v":
            widths = pc.unique(pc.list_value_length(c))
            if len(widths) != 1:
                raise ValueError("vectors of one group have different lengths")
            out.append(c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), widths[0].as_py()))
        else:
            out.append(c.to_numpy(zero_copy_only=False))
    return out


# --------------------------------------------------------------------------
# cells, packs, pairs of packs
# --------------------------------------------------------------------------
def _blocks(rows: DataFrame, by: list[str], key: str, size: int) -> DataFrame:
    """``rows`` with ``__blocks`` of the group and ``__b``, the block of the row."""
    n, small = bounded_broadcast(rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("__blocks")))
    return join_by(rows, n, by, broadcast=small).withColumn("__b", F.pmod(F.xxhash64(key), "__blocks").cast("int"))


def _net(centres: DataFrame, by: list[str], r: float) -> DataFrame:
    """``by, id, to``: each centre's centre in the next net, within ``r``."""
    blocks = _blocks(centres, by, "id", BLOCK).groupBy(*by, "__b").agg(F.collect_list(F.struct("id", "v")).alias("__r"))
    return _kept(blocks.select(*by, F.explode(_net_udf(r)(F.col("__r.id"), F.col("__r.v"))).alias("x")).select(*by, "x.*"), "net")


def _cells(points: DataFrame, by: list[str], r: float) -> tuple[DataFrame, DataFrame, list[str]]:
    """``(by, id, cell)``, and per cell its ancestors ``a0 .. ak`` in the tree of nets."""
    cell_of = points.select(*by, "id", F.col("id").alias("cell"))
    centres = points.select(*by, "id", "v")
    before = None

    def climb(share):
        nonlocal centres, before
        hop = _net(centres, by, share * r)
        n = hop.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") == F.col("to")).alias("kept")).first()
        centres = join_by(centres, hop.where("id = to").select(*by, "id"), [*by, "id"], "left_semi")
        before = n["n"]
        return hop, n["kept"]

    for share in CELL_SHARES:
        hop, kept = climb(share)
        up = hop.select(*by, F.col("id").alias("cell"), "to")
        cell_of = join_by(cell_of, up, [*by, "cell"]).select(*by, "id", F.col("to").alias("cell"))
        if kept <= BLOCK or kept > 0.9 * before:        # one block a group, or no more to gain
            break
    cell_of = _kept(cell_of, "cells")
    tree = cell_of.where("id = cell").select(*by, "cell", F.col("cell").alias("a0"))
    names = ["a0"]
    for share in TREE_RADII:
        hop, kept = climb(share)
        last, name = names[-1], f"a{len(names)}"
        tree = join_by(tree, hop.select(*by, F.col("id").alias(last), F.col("to").alias(name)), [*by, last])
        names.append(name)
        if kept <= 1:
            break
    return cell_of, _kept(tree, "tree"), names


def _pack_rules(cells: DataFrame, by: list[str], names: list[str], sizes: dict[str, str]) -> DataFrame:
    """Per cell and size column a place (struct) for its points: the smallest
    subtree of ``PACK`` points, into how many bins it is dealt, and by what:
    by its children where these are smaller than a pack, else by point (null)."""
    out = cells
    for level in [*names, None]:
        keys = [*by, level] if level else by
        total = cells.groupBy(*keys).agg(*[F.sum(c).alias(f"__{c}_{level}") for c in sizes])
        out = join_by(out, total, keys)
    for c, name in sizes.items():
        rule = F
        for level, child in zip([*names, None], [None, *names]):
            held = F.col(f"__{c}_{level}")
            place = F.struct((F.concat(F.lit(f"{level}:"), F.col(level).cast("string")) if level else F.lit("all")).alias("under"),
                             F.ceil(held / PACK).cast("int").alias("bins"), (F.col(child) if child else F.lit(None)).cast("bigint").alias("child"))
            rule = rule.when(held >= PACK, place) if level else rule.otherwise(place)
        out = out.withColumn(name, rule)
    return out.select(*by, "cell", "weight", *sizes.values())


def _pack_name(rule: str):
    return F.concat_ws("/", f"{rule}.under", F.pmod(F.xxhash64(F.coalesce(f"{rule}.child", "id")), f"{rule}.bins").cast("string"))


def _packs(points: DataFrame, by: list[str], name: str, fields: Sequence[str], label=None) -> DataFrame:
    """Points gathered into packs ``by, pack, label, rows, ball``; with a label a pack holds one label only."""
    key = F.col("pack") if label is None else F.concat_ws("/", F.col(label).cast("string"), "pack")
    g = points.select(*by, key.alias("pack"), (F.lit(None) if label is None else F.col(label)).cast("bigint").alias("label"),
                      F.struct(*fields).alias("__x"))
    rows = g.groupBy(*by, "pack", "label").agg(F.collect_list("__x").alias("rows"))
    return _kept(rows.withColumn("ball", _ball(F.col("rows.v"))), name)


def _compare(a: DataFrame, b: DataFrame, by: list[str], r: float, fn: Callable, left: Sequence[str], right: Sequence[str],
             out: Sequence[str], once: bool = False, labelled: bool = False) -> DataFrame:
    """Rows ``by, out`` that ``fn`` finds for each two packs whose balls allow a distance of ``r``.

    ``once``: ``a`` and ``b`` are the same packs, two of them meet once.
    ``labelled``: packs of equal labels are not compared."""
    def balls(p, side, skip):
        lab = F.col("label") if labelled else F.lit(skip).cast("bigint")
        rows = _blocks(p.select(*by, "pack", "ball", lab.alias("label")), by, "pack", BLOCK)
        return rows.groupBy(*by, "__b", "__blocks").agg(F.collect_list(F.struct("pack", "ball.centre", "ball.radius", "label")).alias(side))
    x, y = balls(a, "__x", 0), balls(b, "__y", 1)
    n = y.groupBy(*by).agg(F.max("__blocks").alias("__n"))
    x = join_by(x, n, by).select(*by, "__x", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("__b"))
    met = join_by(x, y.select(*by, "__b", "__y"), [*by, "__b"])
    parts = [F.col(f"{s}.{f}") for s in ("__x", "__y") for f in ("pack", "centre", "radius", "label")]
    pairs = _kept(met.select(*by, F.explode(_near_udf(r, once)(*parts)).alias("p")).select(*by, "p.*"), "pairs")
    # packs are dealt into lots, and two lots meet in a task: there a pack comes once, with the names of those it is compared with
    sizes = [F.count_distinct(c) for c in ("a", "b")]
    lots = pairs.groupBy(*by).agg(*[F.greatest(F.ceil(n / LOT), F.least(F.lit(FEW_LOTS), n)).cast("int").alias(c) for n, c in zip(sizes, ("__na", "__nb"))])
    pairs = join_by(pairs, lots, by).select(
        *by, "a", "b", F.pmod(F.xxhash64("a"), "__na").cast("int").alias("__la"), F.pmod(F.xxhash64("b"), "__nb").cast("int").alias("__lb"))
    meets = pairs.groupBy(*by, "__la", "__lb", "a").agg(F.collect_list("b").alias("__with"))
    x = join_by(meets, a.select(*by, F.col("pack").alias("a"), F.col("rows").alias("__x")), [*by, "a"]).drop("a")
    y = join_by(pairs.select(*by, "__la", "__lb", "b").distinct(), b.select(*by, F.col("pack").alias("b"), F.col("rows").alias("__y")), [*by, "b"])
    y = y.select(*[F.col(c).alias(c if c == "__y" else f"__y_{c}") for c in y.columns])
    schema = T.StructType([*[pairs.schema[c] for c in by], *[T.StructField(c, T.LongType()) for c in out]])

    def run(some: pa.Table, others: pa.Table) -> pa.Table:
        to = {name: _columns(pack.values, right) for name, pack in zip(others.column("__y_b").to_pylist(), others.column("__y"))}
        found = []
        for pack, names in zip(some.column("__x"), some.column("__with").to_pylist()):
            own = _columns(pack.values, left)
            found += [fn(r, *own, *to[name]) for name in names]
        cols = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)]
        at = pa.array(np.zeros(len(cols[0]), np.int64))
        return pa.table([*[some.column(c).take(at) for c in by], *cols], names=schema.names)
    keys = [*by, "__la", "__lb"]
    return x.groupBy(*keys).cogroup(y.groupBy(*[f"__y_{c}" for c in keys])).applyInArrow(run, schema)


def _components(nodes: DataFrame, links: DataFrame, by: list[str]) -> DataFrame:
    """``by, node, label``: the smallest node that links lead to (propagation with pointer jumping)."""
    links = _kept(links.union(links.select(*by, "b", "a")).distinct(), "links")
    labels = _kept(nodes.select(*by, "node", F.col("node").alias("label")), "labels")
    if not links.limit(1).count():
        return labels
    while True:
        via = join_by(links, labels.select(*by, F.col("node").alias("b"), F.col("label").alias("nl")), [*by, "b"]) \
            .groupBy(*by, F.col("a").alias("node")).agg(F.min("nl").alias("nl"))
        step = join_by(labels, via, [*by, "node"], "left") \
            .select(*by, "node", F.col("label").alias("old"), F.least("label", F.coalesce("nl", "label")).alias("label"))
        # pointer jumping: take the label of the label
        ahead = step.select(*by, F.col("node").alias("label"), F.col("label").alias("ll"))
        labels = _kept(join_by(step, ahead, [*by, "label"], "left").select(*by, "node", "old", F.least("label", "ll").alias("label")), "labels")
        if not labels.where("label != old").limit(1).count():
            return labels.drop("old")
        labels = labels.drop("old")


# --------------------------------------------------------------------------
# operators
# --------------------------------------------------------------------------
def _weighted_points(df: DataFrame, vec: str, eps: float, metric: str, by: list[str]):
    """Rows with finite vectors, rows without a direction, and the distinct
    vectors ``by, id, n, v, cell, weight, pack, cpack`` (``id`` = smallest row)."""
    r = radius(eps, metric)
    every = _prepare(df, vec, metric, by)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = _kept(every.where(F.col("v").isNotNull() & finite), "rows")
    alone = every.where(F.col("v").isNull()).select(*by, ROW_IDX)
    points = _kept(rows.groupBy(*by, "v").agg(F.min(ROW_IDX).alias("id"), F.count(F.lit(1)).alias("n")), "points")
    cell_of, tree, names = _cells(points, by, r)
    held = join_by(cell_of, points.select(*by, "id", "n"), [*by, "id"]).groupBy(*by, "cell").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"), F.lit(1).alias("one"))
    rules = _pack_rules(_kept(join_by(tree, held, [*by, "cell"]), "sizes"), by, names, {"size": "rule", "one": "crule"})
    placed = join_by(join_by(points, cell_of, [*by, "id"]), rules, [*by, "cell"])
    return rows, alone, _kept(placed.select(*by, "id", "n", "v", "cell", "weight", _pack_name("rule").alias("pack"),
                                            _pack_name("crule").alias("cpack")), "placed"), r


def _copies(rows: DataFrame, points: DataFrame, by: list[str]) -> DataFrame:
    """``by, row_idx, id``: the point of each row."""
    return join_by(rows, points.select(*by, "v", "id"), [*by, "v"]).select(*by, ROW_IDX, "id")


def _degrees(open_: DataFrame, points: DataFrame, by: list[str], r: float) -> DataFrame:
    """``by, id, n``: rows within ``r`` of each point of ``open_``, itself included."""
    a = _packs(open_, by, "open", ["id", "v"])
    b = _packs(points, by, "all", ["n", "v"])
    return _compare(a, b, by, r, _count, ["id", "v"], ["n", "v"], ["id", "n"]).groupBy(*by, "id").agg(F.sum("n").alias("n"))


@null_safe_groups
def core_points(df: DataFrame, vec: str, eps: float = EPS, min_samples: int = MIN_SAMPLES,
                metric: str = METRIC, by: Sequence[str] | None = None) -> DataFrame:
    """``by, row_idx, n_neighbors, is_core`` for every row, itself counted.

    Rows without a direction (zero under cosine) and null vectors are alone;
    rows with a non-finite number are left out."""
    by = group_cols(by)
    rows, alone, points, r = _weighted_points(df, vec, eps, metric, by)
    counted = join_by(_copies(rows, points, by), _degrees(points, points, by, r), [*by, "id"]) \
        .select(*by, ROW_IDX, F.col("n").cast("bigint").alias("n_neighbors"))
    every = counted.unionByName(alone.withColumn("n_neighbors", F.lit(1).cast("bigint")))
    return every.withColumn("is_core", F.col("n_neighbors") >= min_samples)


@null_safe_groups
def dbscan(df: DataFrame, vec: str, eps: float = EPS, min_samples: int = MIN_SAMPLES, metric: str = METRIC,
           by: Sequence[str] | None = None, out: str = "cluster") -> DataFrame:
    """Rows of ``df`` with ``out`` = cluster id per group, -1 for noise.

    Rows without a direction and null vectors are alone, rows with a
    non-finite number are noise; ``row_idx`` is unique in its group."""
    by = group_cols(by)
    rows, alone, points, r = _weighted_points(df, vec, eps, metric, by)
    open_ = points.where(F.col("weight") < min_samples)
    degrees = _kept(_degrees(open_, points, by, r).where(F.col("n") >= min_samples).select(*by, "id"), "degrees")
    core = join_by(open_, degrees, [*by, "id"], "left_semi").unionByName(points.where(F.col("weight") >= min_samples))
    node = core.groupBy(*by, "cell").agg(F.min("id").alias("node"))
    core = _kept(join_by(core, node, [*by, "cell"]), "core")

    # nodes by their centres first, then what is left between components
    centres = _packs(core.where("id = cell").drop("pack").withColumnRenamed("cpack", "pack"), by, "centres", ["node", "v"])
    links = _compare(centres, centres, by, r, _link, ["node", "v"], ["node", "v"], ["a", "b"], once=True)
    first = _components(core.select(*by, "node").distinct(), links, by)
    parted = join_by(core, first, [*by, "node"])
    sides = _packs(parted, by, "sides", ["label", "v"], label="label")
    links = _compare(sides, sides, by, r, _link, ["label", "v"], ["label", "v"], ["a", "b"], once=True, labelled=True)
    whole = _components(first.select(*by, F.col("label").alias("node")).distinct(), links, by)
    named = join_by(parted.drop("node").withColumnRenamed("label", "node"), whole, [*by, "node"])
    named = _kept(named.select(*by, "id", "v", "pack", "label"), "named")

    border = join_by(open_, degrees, [*by, "id"], "left_anti")
    near = _compare(_packs(border, by, "border", ["id", "v"]), _packs(named, by, "clusters", ["label", "v"], label="label"),
                    by, r, _lowest, ["id", "v"], ["label", "v"], ["id", "label"]).groupBy(*by, "id").agg(F.min("label").alias("comp"))
    comp = named.select(*by, "id", F.col("label").alias("comp")).unionByName(near)
    comp = join_by(_copies(rows, points, by), comp, [*by, "id"]).select(*by, ROW_IDX, "comp")
    if min_samples <= 1:
        comp = comp.unionByName(alone.withColumn("comp", F.col(ROW_IDX)))
    comp = _kept(comp, "comp")
    ids = comp.select(*by, "comp").distinct().withColumn(
        "cid", (F.dense_rank().over(Window.partitionBy(*by).orderBy("comp")) - 1).cast("int"))
    assigned = join_by(comp, ids, [*by, "comp"]).select(*by, ROW_IDX, "cid")
    return join_by(df, assigned, [*by, ROW_IDX], "left").withColumn(
        out, F.coalesce(F.col("cid"), F.lit(NOISE)).cast("int")).drop("cid")
