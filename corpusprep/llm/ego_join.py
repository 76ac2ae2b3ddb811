"""Embedding near-duplicates: epsilon grid order join.

Unit vectors at cosine >= c are at Euclidean distance <= eps = sqrt(2 - 2c).
Vectors are turned to their principal axes (second moments of all vectors),
put on a grid of cells of width eps over the leading axes and sorted by cell
(then by position), so near vectors stand in near parts of the sequence. The
sorted sequence is cut into blocks with the box that each one fills; pairs of
blocks meet through the cells of the first axis and are dropped if their
boxes are more than eps apart. Inside a pair the two sequences are joined
recursively: halves whose boxes are too far apart are skipped, and small
ones compared by one matrix product in double precision.

Equal vectors are one class with a count, so copies are never paired. A pair
of blocks returns sums of links for each class and spanning links, not the
pairs; components over these are found by alternating stars.

Defined results: a vector that is null, zero, or holds a null or non-finite
component links with nothing; vectors of different lengths do not link; a
null id is nobody's smallest; rows that share an id each get their row; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import connected_components, forest, map_text, written

MIN_COSINE = 0.9
#: Vectors of a block, and of the pieces compared by one product.
BLOCK_ROWS = 2048
LEAF_ROWS = 512
#: Leading axes that make the grid and the boxes.
AXES = 8
#: Cosines this close to the bound are computed again from the vectors themselves.
CLOSE = 1e-9


def _matrix(column: pa.ListArray) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def principal_axes(classes: DataFrame, dim: int) -> np.ndarray:
    """Eigenvectors of the second moments of all unit vectors, strongest first; the sums are added in Spark."""
    def run(batches):
        m, n = np.zeros((dim, dim)), 0
        for b in batches:
            u = unit(_matrix(b.column(0)))
            m += u.T @ u
            n += len(u)
        if n:
            i, j = np.indices(m.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(m.ravel())], names=["i", "j", "v"])
    sums = map_text(classes.select("embedding"), run, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    m = np.zeros((dim, dim))
    for r in sums.collect():                       # dim * dim numbers
        m[r["i"], r["j"]] = r["v"]
    return np.linalg.eigh((m + m.T) / 2)[1][:, ::-1]


def _blocks(classes: DataFrame, axes: np.ndarray, eps: float, block_rows: int, type_: np.dtype) -> DataFrame:
    """Blocks of the sorted sequence: ``block, n, ids, vectors, counts, cell_lo, cell_hi, lo, hi``."""
    k = min(AXES, axes.shape[1])
    at = {n: i for i, n in enumerate(("embedding", "class", "copies"))}

    def place(batches):
        for b in batches:
            p = unit(_matrix(b.column(at["embedding"]))) @ axes[:, :k]
            cells = np.floor(p / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.FixedSizeListArray.from_arrays(pa.array(cells.ravel()), k).cast(pa.list_(pa.int32())),
                 pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), k).cast(pa.list_(pa.float64()))],
                names=[*b.schema.names, "cells", "pos"])
    kind = classes.schema["embedding"].dataType.simpleString()
    placed = map_text(classes.select("embedding", "class", "copies"), place,
                      f"embedding {kind}, class bigint, copies bigint, cells array<int>, pos array<double>")
    parts = -(-classes.count() // block_rows) or 1           # few large blocks: their pairs are what costs
    ordered = placed.repartitionByRange(parts, "cells", "pos").coalesce(parts).sortWithinPartitions("cells", "pos", "class") \
        .withColumn("part", F.spark_partition_id())

    def cut(batches):
        held: list[tuple] = []

        def block(nth: int, rows: list[tuple]) -> pa.RecordBatch:
            v = np.concatenate([r[0] for r in rows])
            ids, copies, pos = (np.concatenate([r[i] for r in rows]) for i in (1, 2, 3))
            c = np.floor(pos[:, 0] / eps).astype(np.int32)
            return pa.RecordBatch.from_pylist([{
                "block": part << 32 | nth, "n": len(v), "ids": ids.astype("<i8").tobytes(), "vectors": v.astype(type_).tobytes(),
                "counts": copies.astype("<i8").tobytes(), "pos": pos.astype("<f8").tobytes(), "cell_lo": int(c.min()),
                "cell_hi": int(c.max()), "lo": pos.min(axis=0).tolist(), "hi": pos.max(axis=0).tolist()}], _BLOCK)
        nth, n, part = 0, 0, 0
        for b in batches:
            part = int(b.column(5)[0].as_py())
            row = (_matrix(b.column(0)), *(b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)), _matrix(b.column(4)))
            while len(row[0]):
                take = min(block_rows - n, len(row[0]))
                held.append(tuple(x[:take] for x in row))
                row, n = tuple(x[take:] for x in row), n + take
                if n == block_rows:
                    yield block(nth, held)
                    held, nth, n = [], nth + 1, 0
        if held:
            yield block(nth, held)
    return written(map_text(ordered, cut, _BLOCK_DDL), "ego-blocks")


_BLOCK = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary()), ("counts", pa.binary()),
                    ("pos", pa.binary()), ("cell_lo", pa.int32()), ("cell_hi", pa.int32()), ("lo", pa.list_(pa.float64())),
                    ("hi", pa.list_(pa.float64()))])
_BLOCK_DDL = ("block bigint, n bigint, ids binary, vectors binary, counts binary, pos binary, cell_lo int, cell_hi int, "
              "lo array<double>, hi array<double>")


def block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """``a, b`` (a <= b) of the blocks whose boxes are at most ``eps`` apart.

    Two such blocks have first-axis cells that differ by one at most, so they
    meet in a cell; a pair is taken in the first cell in which it meets.
    """
    box = blocks.select("block", "cell_lo", "cell_hi", "lo", "hi")
    a = box.select(*[F.col(c).alias(f"a_{c}") for c in box.columns], F.explode(F.sequence("cell_lo", "cell_hi")).alias("cell"))
    b = box.select(*[F.col(c).alias(f"b_{c}") for c in box.columns],
                   F.explode(F.sequence(F.col("cell_lo") - 1, F.col("cell_hi") + 1)).alias("cell"))
    gap = F.zip_with(F.zip_with("a_lo", "b_hi", lambda x, y: x - y), F.zip_with("b_lo", "a_hi", lambda x, y: x - y),
                     lambda x, y: F.greatest(x, y, F.lit(0.0)))
    apart = F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g)
    return a.join(b, "cell").where((F.col("a_block") <= F.col("b_block"))
                                   & (F.col("cell") == F.greatest(F.col("a_cell_lo"), F.col("b_cell_lo") - 1))
                                   & (apart <= eps * eps + CLOSE)) \
        .select(F.col("a_block").alias("a"), F.col("b_block").alias("b"))


class _Side:
    def __init__(self, row: dict, side: str, type_: np.dtype):
        self.ids = np.frombuffer(row[f"{side}_ids"], "<i8")
        self.raw = np.frombuffer(row[f"{side}_vectors"], type_).astype(np.float64).reshape(len(self.ids), -1)
        self.unit = unit(self.raw)
        self.counts = np.frombuffer(row[f"{side}_counts"], "<i8")
        self.pos = np.frombuffer(row[f"{side}_pos"], "<f8").reshape(len(self.ids), -1)


def _near(a: _Side, b: _Side, same: bool, eps: float, cosine: float):
    """Recursive join of two intervals: ``(i, j)`` index arrays of the links."""
    stack = [(0, len(a.ids), 0, len(b.ids))]
    while stack:
        i, j, k, m = stack.pop()
        if same and m <= i:
            continue
        x, y = a.pos[i:j], b.pos[k:m]
        gap = np.maximum(np.maximum(x.min(axis=0) - y.max(axis=0), y.min(axis=0) - x.max(axis=0)), 0)
        if gap @ gap > eps * eps + CLOSE:
            continue
        if max(j - i, m - k) > LEAF_ROWS:
            h, g = (i + j + 1) // 2, (k + m + 1) // 2
            stack += [(p, q, r, s) for p, q in ((i, h), (h, j)) for r, s in ((k, g), (g, m)) if p < q and r < s]
            continue
        dots = a.unit[i:j] @ b.unit[k:m].T
        p, q = np.nonzero(dots >= cosine - CLOSE)
        d = dots[p, q]
        p, q = p + i, q + k
        for n in np.flatnonzero(np.abs(d - cosine) <= CLOSE):
            u, v = a.raw[p[n]], b.raw[q[n]]
            d[n] = (u @ v) / (np.sqrt(u @ u) * np.sqrt(v @ v))
        ok = d >= cosine
        if same:
            ok &= p < q
        yield p[ok], q[ok]


def class_links(blocks: DataFrame, eps: float, cosine: float, type_: np.dtype) -> DataFrame:
    """``a, b, n``: rows with ``n`` count links of class ``a``; rows with ``b`` are spanning links."""
    names = ("n", "ids", "vectors", "counts", "pos")
    side = lambda s: blocks.select(F.col("block").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in names])
    pairs = block_pairs(blocks, eps).join(side("a"), "a").join(side("b"), "b")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                x = _Side(row, "a", type_)
                same = row["a"] == row["b"]
                y = x if same else _Side(row, "b", type_)
                shift = 0 if same else len(x.ids)
                root = np.arange(len(x.ids) if same else len(x.ids) + len(y.ids))
                found = np.zeros(len(root), np.int64)
                for p, q in _near(x, y, same, eps, cosine):
                    found += np.bincount(p, weights=y.counts[q], minlength=len(root)).astype(np.int64)
                    found += np.bincount(q + shift, weights=x.counts[p], minlength=len(root)).astype(np.int64)
                    root = forest(len(root), p, q + shift, root)
                ids = x.ids if same else np.r_[x.ids, y.ids]
                hit, tied = np.flatnonzero(found), np.flatnonzero(root != np.arange(len(root)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[ids[hit], ids[tied]]), pa.array(np.r_[np.zeros(len(hit), np.int64), ids[root[tied]]],
                                                                    mask=np.r_[np.ones(len(hit), bool), np.zeros(len(tied), bool)]),
                     pa.array(np.r_[found[hit], np.zeros(len(tied), np.int64)])], names=["a", "b", "n"])
    return written(pairs.mapInArrow(run, "a bigint, b bigint, n bigint"), "ego-links")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = MIN_COSINE,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    spark = vectors.sparkSession
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.withColumn("dim", F.when(F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0), F.size("embedding")))
    good, bad = rows.where(F.col("dim").isNotNull()), rows.where(F.col("dim").isNull())
    # class numbers: dense places in the written table's order are not needed, only distinct ones
    classes = written(good.groupBy("embedding").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
                                                    F.first("dim").alias("dim"))
                      .withColumn("class", F.monotonically_increasing_id()), "ego-classes")
    links = None
    for r in classes.select("dim").distinct().collect():        # one pass for each vector length; as a rule there is one
        of = classes.where(F.col("dim") == r["dim"])
        type_ = np.dtype("<f4" if of.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8")
        blocks = _blocks(of, principal_axes(of, r["dim"]), eps, block_rows, type_)
        got = class_links(blocks, eps, cosine, type_)
        links = got if links is None else links.union(got)
    if links is None:
        links = spark.createDataFrame([], "a bigint, b bigint, n bigint")
    comp = connected_components(links.where(F.col("b").isNotNull()).select("a", "b"))
    sums = links.where(F.col("b").isNull()).groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    known = classes.join(comp, F.col("class") == F.col("node"), "left").join(sums, "class", "left") \
        .select("embedding", "first_id", F.coalesce("root", "class").alias("root"),
                (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"))
    least = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = known.join(least, "root").select("embedding", "n_links", "component_id")
    out = good.join(known, "embedding").select("vec_id", "n_links", "component_id") \
        .unionByName(bad.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
