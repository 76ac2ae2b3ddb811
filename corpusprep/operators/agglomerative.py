"""Bottom-up (Ward) clustering of every group at once, by reciprocal nearest neighbours.

Each round finds every cluster's nearest cluster of its group and merges the
pairs that are each other's nearest. Ward's distance is reducible (a merge
brings no cluster nearer to others), so these merges are those of the
one-at-a-time procedure and the heights are the same; a round merges a share
of all clusters, so rounds grow with the logarithm of the rows. A merged
cluster is its size and centroid, from which the Lance-Williams update of
Ward's distance follows in closed form:

    height^2 = 2 * n_a * n_b / (n_a + n_b) * |c_a - c_b|^2

Equal vectors are one cluster from the start. Clusters of a group are dealt
into blocks and two blocks meet in one task that returns one
neighbour for each row; the work of a round grows with the square of the
group's clusters, what travels with their number times the number of blocks.
Only clusters and merges are written between rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions.vectors import matrix
from corpusprep.operators.joins import block_pairs, join_by, null_safe_groups
from corpusprep.schema import ROW_IDX, group_cols
from corpusprep.session import scratch_path

NOISE = -1
#: Clusters of a block in the neighbour search, and of it those whose distances are held at a time.
BLOCK, ROWS = 8192, 512
MAX_ROUNDS = 10_000


def _kept(rows: DataFrame, name: str) -> DataFrame:
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _nearest(i: np.ndarray, n: np.ndarray, x: np.ndarray, j: np.ndarray, m: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """``src, dst, height``: the nearest ``y`` cluster of each ``x`` cluster by Ward's distance, itself excluded; ties go to the smaller id."""
    src, dst, height = [], [], []
    x2, y2 = (x * x).sum(axis=1), (y * y).sum(axis=1)
    for at in range(0, len(i), ROWS):
        part = slice(at, at + ROWS)
        weight = 2 * n[part, None] * m[None, :] / (n[part, None] + m[None, :])
        near = np.maximum(x2[part, None] + y2[None, :] - 2 * (x[part] @ y.T), 0) * weight
        near[i[part, None] == j[None, :]] = np.inf
        # all clusters that rounding of the product can bring first are measured again from the centroids
        slack = 16 * (x.shape[1] + 4) * np.finfo(float).eps * (x2[part] + y2.max()) * weight.max(axis=1)
        limit = near.min(axis=1) + slack
        for r in range(len(near)):
            c = np.flatnonzero(near[r] <= limit[r])
            c = c[np.isfinite(near[r, c])]
            if len(c):
                exact = np.sqrt(((x[at + r] - y[c]) ** 2).sum(axis=1) * weight[r, c])
                best = np.lexsort((j[c], exact))[0]
                src.append(i[at + r]), dst.append(j[c[best]]), height.append(exact[best])
    return [np.array(src, np.int64), np.array(dst, np.int64), np.array(height, float)]


def _nearest_of_blocks(a, b):
    sides = [(t.column("id").to_numpy(), t.column("n").to_numpy().astype(float), matrix(t.column("centroid"))) for t in (a, b) if t is not None]
    if len(sides) == 1:
        return _nearest(*sides[0], *sides[0])
    return [np.concatenate(c) for c in zip(_nearest(*sides[0], *sides[1]), _nearest(*sides[1], *sides[0]), strict=True)]


def _neighbours(clusters: DataFrame, by: list[str], block: int) -> DataFrame:
    """``by, src, dst, height``: each cluster's nearest one."""
    schema = T.StructType([T.StructField("src", T.LongType()), T.StructField("dst", T.LongType()), T.StructField("height", T.DoubleType())])
    near = block_pairs(clusters.select(*by, "id", "n", "centroid"), by, "id", block, _nearest_of_blocks, schema)
    best = near.groupBy(*by, "src").agg(F.min(F.struct("height", "dst")).alias("b"))
    return best.select(*by, "src", F.col("b.dst").alias("dst"), F.col("b.height").alias("height"))


def _merged(clusters: DataFrame, pairs: DataFrame, by: list[str]) -> DataFrame:
    """Clusters after the merges ``pairs(kept, absorbed)``: sizes added, centroids weighted."""
    renamed = pairs.select(*by, F.col("absorbed").alias("id"), F.col("kept").alias("__to"))
    moved = join_by(clusters, renamed, [*by, "id"], "left") \
        .select(*by, F.coalesce("__to", "id").alias("id"), F.col("__to").isNotNull().alias("__absorbed"), "n", "centroid")
    # two members at most: a plain pair of columns, no vector aggregate
    both = moved.groupBy(*by, "id").agg(
        F.max(F.when(~F.col("__absorbed"), F.struct("n", "centroid"))).alias("a"), F.max(F.when(F.col("__absorbed"), F.struct("n", "centroid"))).alias("b"))
    n = F.col("a.n") + F.coalesce(F.col("b.n"), F.lit(0))
    mean = F.zip_with("a.centroid", "b.centroid", lambda x, y: (x * F.col("a.n") + y * F.col("b.n")) / n)
    return both.select(*by, "id", n.alias("n"), F.when(F.col("b").isNull(), F.col("a.centroid")).otherwise(mean).alias("centroid"))


@null_safe_groups
def ward_merges(df: DataFrame, vec: str, by: Sequence[str] | None = None, block: int = BLOCK) -> DataFrame:
    """The dendrogram of each group: ``by, kept, absorbed, height, size, round``.

    A cluster is named by its smallest ``row_idx``; ``absorbed`` is the
    greater name of the two that merge. Equal vectors merge at height 0.
    Rows whose vector is null or holds a null or non-finite number take no part.
    """
    by = group_cols(by)
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col(vec).cast("array<double>")
    rows = df.select(*by, ROW_IDX, v.alias("centroid")).where(F.col("centroid").isNotNull() & F.forall("centroid", good)) \
        .withColumn("centroid", F.transform("centroid", lambda x: x + F.lit(0.0)))                # -0.0 is 0.0
    rows = _kept(rows, "ward-rows")
    clusters = _kept(rows.groupBy(*by, "centroid").agg(F.min(ROW_IDX).alias("id"), F.count(F.lit(1)).alias("n"))
                     .select(*by, "id", "n", "centroid"), "ward-clusters")
    copies = join_by(rows, clusters.select(*by, "centroid", "id", "n"), [*by, "centroid"]).where(F.col(ROW_IDX) != F.col("id"))
    merges = [_kept(copies.select(*by, F.col("id").alias("kept"), F.col(ROW_IDX).alias("absorbed"), F.lit(0.0).alias("height"),
                                  F.col("n").alias("size"), F.lit(0).alias("round")), "ward-merges")]
    for step in range(1, MAX_ROUNDS):
        near = _kept(_neighbours(clusters, by, block), "ward-near")
        back = near.select(*by, F.col("dst").alias("src"), F.col("src").alias("dst"))
        pairs = join_by(near.where("src < dst"), back, [*by, "src", "dst"], "left_semi")
        pairs = pairs.select(*by, F.col("src").alias("kept"), F.col("dst").alias("absorbed"), "height")
        pairs = _kept(pairs, "ward-pairs")
        if not pairs.limit(1).count():
            break
        clusters = _kept(_merged(clusters, pairs, by), "ward-clusters")
        merges.append(join_by(pairs, clusters.select(*by, F.col("id").alias("kept"), F.col("n").alias("size")), [*by, "kept"])
                      .select(*by, "kept", "absorbed", "height", "size", F.lit(step).alias("round")))
    out = merges[0]
    for m in merges[1:]:
        out = out.unionByName(m)
    return _kept(out, "ward-dendrogram")


@null_safe_groups
def ward(df: DataFrame, vec: str, k: int, by: Sequence[str] | None = None, block: int = BLOCK) -> DataFrame:
    """Rows of ``df`` with ``cluster``: the cut of each group's dendrogram into ``k`` clusters.

    The ``k - 1`` highest merges are undone (equal heights: later rounds,
    then greater names first). Clusters are numbered from 0 by their smallest
    ``row_idx``. Equal vectors stay together, so a group with fewer distinct
    vectors has fewer clusters; rows without a usable vector get -1.
    """
    by = group_cols(by)
    merges = ward_merges(df, vec, by, block)
    high = Window.partitionBy(*by).orderBy(F.desc("height"), F.desc("round"), F.desc("absorbed"))
    undone = merges.where("round > 0").withColumn("__r", F.row_number().over(high)).where(F.col("__r") < k)
    held = join_by(merges, undone.select(*by, "absorbed"), [*by, "absorbed"], "left_anti")
    # names follow their absorber until it is absorbed no more; the distance doubles each round
    root = _kept(held.select(*by, F.col("absorbed").alias("id"), F.col("kept").alias("root")), "ward-root")
    while True:
        up = root.select(*by, F.col("id").alias("root"), F.col("root").alias("__up"))
        nxt = _kept(join_by(root, up, [*by, "root"], "left").select(*by, "id", F.coalesce("__up", "root").alias("root"),
                                                                    F.col("__up").isNotNull().alias("__moved")), "ward-root")
        moved = nxt.where("__moved").limit(1).count()
        root = nxt.drop("__moved")
        if not moved:
            break
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col(vec).isNotNull() & F.coalesce(F.forall(F.col(vec).cast("array<double>"), good), F.lit(False))
    named = join_by(df, root.select(*by, F.col("id").alias(ROW_IDX), F.col("root").alias("__root")), [*by, ROW_IDX], "left") \
        .withColumn("__root", F.when(usable, F.coalesce("__root", ROW_IDX)))
    ids = named.where("__root is not null").select(*by, "__root").distinct() \
        .withColumn("cluster", (F.row_number().over(Window.partitionBy(*by).orderBy("__root")) - 1).cast("int"))      # k rows a group
    out = join_by(named, ids, [*by, "__root"], "left").withColumn("cluster", F.coalesce("cluster", F.lit(NOISE)))
    return out.drop("__root")

