"""Clustering per group: grouped Lloyd k-means, bisecting k-means, summary.

Grouped Lloyd runs every group in the same Spark job: centroids are a small
table keyed by ``(group, cluster)`` that travels with the tasks (or, when it is
too large, is joined to the rows); each round assigns rows to the nearest
centroid of their group and adds up partial sums. Seeds are
the ``k`` rows with the smallest ``md5('<seed>:<row_idx>')`` per group, so
the result does not depend on partitioning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusprep.functions.vectors import matrix, nearest_centroid
from corpusprep.operators.joins import bounded_broadcast, join_by
from corpusprep.operators.ranking import DEFAULT_SEED, shuffle_key
from corpusprep.schema import ROW_IDX, group_cols
from corpusprep.session import checkpoint_dir, scratch_path

# Default cluster count and the label of noise rows.
DEFAULT_K = 5
NOISE = -1
ALGORITHMS = ("kmeans", "dbscan", "agglomerative")


def check_algorithm(name: str) -> str:
    name = name.lower()
    if name not in ALGORITHMS:
        raise ValueError(f"no algorithm {name!r}; choose one of {', '.join(ALGORITHMS)}")
    return name


def _vec(c: str):
    return F.col(c).cast("array<double>")


def seed_centroids(df: DataFrame, vec: str, k: int = DEFAULT_K, by: Sequence[str] | None = None,
                   seed: int = DEFAULT_SEED) -> DataFrame:
    """``by, cluster, centroid``: the first ``k`` rows of each group in
    seeded order (a window with a group limit, so hot groups stay cheap)."""
    by = group_cols(by)
    w = Window.partitionBy(*by).orderBy(shuffle_key(ROW_IDX, seed), F.col(ROW_IDX))
    return df.select(*by, ROW_IDX, _vec(vec).alias("centroid")) \
        .withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k) \
        .select(*by, (F.col("__rn") - 1).cast("int").alias("cluster"), "centroid")


def plus_plus_seeds(df: DataFrame, vec: str, k: int = DEFAULT_K, by: Sequence[str] | None = None,
                    seed: int = DEFAULT_SEED, broadcast: bool | None = None) -> DataFrame:
    """k-means++ seeds for every group at once, deterministic.

    The first seed is the row with the smallest ``md5('<seed>:<row_idx>')``.
    Each next seed is a D^2-weighted draw: every row gets the key
    ``ln(u) / D^2`` (``u`` in (0, 1] from an md5 of seed, round and row, D the
    distance to the nearest chosen seed) and the largest key wins per group
    (weighted sampling by Efraimidis-Spirakis keys), a partial ``max_by``
    aggregate. One pass over the rows per seed; the result does not depend
    on partitioning. Groups with fewer distinct points get fewer seeds.
    """
    by = group_cols(by)
    cents = seed_centroids(df, vec, 1, by, seed).checkpoint()
    for c in range(1, k):
        a = assign(df, vec, cents, by, broadcast=broadcast).where(F.col("dist2") > 0)
        h = F.md5(F.concat(F.lit(f"{seed}:{c}:"), F.col(ROW_IDX).cast("string")))
        u = (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + F.lit(1.0)) / F.lit(float(1 << 52))
        key = F.struct((F.log(u) / F.col("dist2")).alias("k"), (-F.col(ROW_IDX)).alias("t"))
        pick = a.groupBy(*by).agg(F.max_by(_vec(vec), key).alias("centroid")) \
            .select(*by, F.lit(c).cast("int").alias("cluster"), "centroid")
        cents = cents.unionByName(pick).checkpoint()
    return cents


def _sqdist(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def assign(df: DataFrame, vec: str, centroids: DataFrame, by: Sequence[str] | None = None,
           out: str = "cluster", broadcast: bool | None = None) -> DataFrame:
    """Nearest centroid of the row's group (squared Euclidean; ties -> the
    smaller cluster id). Adds ``out`` and ``dist2``.

    Centroids are packed to one row per group. ``broadcast=None`` checks the
    packed size; True/False reuse a decision made earlier (k-means rounds).
    """
    by = group_cols(by)
    packed = centroids.groupBy(*by).agg(F.collect_list(F.struct("cluster", "centroid")).alias("__p")) \
        .select(*by, F.transform("__p", lambda x: x["cluster"]).alias("__ids"),
                F.transform("__p", lambda x: x["centroid"]).alias("__cents"))
    if broadcast is None:
        packed, broadcast = bounded_broadcast(packed)
    j = join_by(df, packed, by, broadcast=broadcast)
    gkey = F.xxhash64(*[F.col(c) for c in by]) if by else F.lit(0)
    best = nearest_centroid(gkey, _vec(vec), F.col("__ids"), F.col("__cents"))
    return j.withColumn("__best", best).withColumn(out, F.col("__best.c")) \
        .withColumn("dist2", F.col("__best.d")).drop("__ids", "__cents", "__best")


def update(assigned: DataFrame, vec: str, by: Sequence[str] | None = None, cluster: str = "cluster") -> DataFrame:
    """Mean vector and size per (group, cluster) with a partial aggregate."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    by = group_cols(by)
    s = assigned.select(*by, F.col(cluster).alias("cluster"), array_to_vector(_vec(vec)).alias("__v")) \
        .groupBy(*by, "cluster").agg(Summarizer.mean(F.col("__v")).alias("__m"),
                                     F.count(F.lit(1)).cast("bigint").alias("size"))
    return s.select(*by, "cluster", vector_to_array("__m").alias("centroid"), "size")


#: Largest centroid table (numbers) that travels with each task; beyond it centroids stay a table.
CENTROID_NUMBERS = 4_000_000


class _Rounds:
    """Passes over ``(gid, row_idx, vec)`` with the centroids of all groups in a broadcast variable.

    The centroids (groups * k * dimensions numbers, bounded by
    ``CENTROID_NUMBERS``) are the only state; each pass is one job whose
    partial results are added up in Spark, a row per (group, cluster).
    """

    def __init__(self, data: DataFrame, dim: int):
        self.data, self.dim, self.sc = data, dim, data.sparkSession.sparkContext

    def _pass(self, fn, schema: str, cents: dict) -> DataFrame:
        """``fn`` gets batches of ``(gid, row_idx, rows of vec)``, one group after the other, and the centroids."""
        sent = self.sc.broadcast(cents)

        def groups(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                gid, ids = b.column("gid").to_numpy(), b.column(ROW_IDX).to_numpy(zero_copy_only=False)
                x = matrix(pa.chunked_array([b.column("vec")]))
                for g in pd.unique(gid):
                    at = np.flatnonzero(gid == g)
                    yield int(g), ids[at], x if len(at) == len(x) else x[at]

        def run(batches):
            yield pa.RecordBatch.from_pandas(fn(groups(batches), sent.value), schema=arrow, preserve_index=False)
        arrow = to_arrow_schema(T.StructType.fromDDL(schema))
        return self.data.mapInArrow(run, schema)

    def draw(self, cents: dict, seed: int, c: int) -> dict:
        """The next seed of each group by ``ln(u) / D^2`` (see ``plus_plus_seeds``)."""
        def best(groups, cents):
            top: dict = {}
            for gid, ids, x in groups:
                d2 = np.min([((x - m) ** 2).sum(axis=1) for m in cents[gid][1]], axis=0)
                u = np.array([int(hashlib.md5(f"{seed}:{c}:{i}".encode()).hexdigest()[:13], 16) + 1.0 for i in ids.tolist()]) / float(1 << 52)
                far = np.flatnonzero(d2 > 0)
                if len(far):
                    keys = np.log(u[far]) / d2[far]
                    i = far[np.lexsort((ids[far], -keys))[0]]               # largest key, then the smaller row
                    key = (np.log(u[i]) / d2[i], -int(ids[i]))
                    if gid not in top or key > top[gid][0]:
                        top[gid] = (key, x[i])
            return pd.DataFrame([(g, k[0], k[1], v.tolist()) for g, (k, v) in top.items()], columns=["gid", "k", "t", "vec"])
        picks = self._pass(best, "gid bigint, k double, t bigint, vec array<double>", cents) \
            .groupBy("gid").agg(F.max_by("vec", F.struct("k", "t")).alias("vec")).collect()      # one row a group
        for r in picks:
            ids, m = cents[r["gid"]]
            cents[r["gid"]] = (np.append(ids, c), np.vstack([m, r["vec"]]))
        return cents

    def means(self, cents: dict) -> dict:
        """Mean vector of the rows nearest to each centroid: ``(gid, cluster) -> mean``."""
        def sums(groups, cents):
            total: dict = {}
            for gid, _, x in groups:
                if gid not in cents:
                    continue
                ids, m = cents[gid]
                near = np.argmin([((x - v) ** 2).sum(axis=1) for v in m], axis=0)
                for at in np.unique(near):
                    n, s = total.get((gid, int(ids[at])), (0, 0.0))
                    total[gid, int(ids[at])] = (n + int((near == at).sum()), s + x[near == at].sum(axis=0))
            return pd.DataFrame([(g, c, n, s.tolist()) for (g, c), (n, s) in total.items()], columns=["gid", "cluster", "n", "s"])

        def add(key, parts):
            return pd.DataFrame([(*key, (np.sum(np.stack(parts["s"].to_numpy()), axis=0) / parts["n"].sum()).tolist())],
                                columns=["gid", "cluster", "m"])
        parts = self._pass(sums, "gid bigint, cluster int, n bigint, s array<double>", cents)
        got = parts.groupBy("gid", "cluster").applyInPandas(add, "gid bigint, cluster int, m array<double>").collect()
        return {(r["gid"], r["cluster"]): np.array(r["m"]) for r in got}


def _lloyd(df: DataFrame, vec: str, k: int, by: list[str], seed: int, max_iter: int, tol: float,
           init: str) -> tuple[DataFrame, bool] | None:
    """Centroids of all groups by ``_Rounds``; None if they are too many to travel with the tasks."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    spark = df.sparkSession
    path = scratch_path(spark, "kmeans")
    df.select(*by, ROW_IDX, _vec(vec).alias("vec")).write.parquet(path)          # vectors are made once for all passes
    kept = spark.read.parquet(path)
    var = kept.select(*by, array_to_vector("vec").alias("__v"), F.size("vec").alias("__size")).groupBy(*by) \
        .agg(Summarizer.variance(F.col("__v")).alias("__var"), F.max("__size").alias("__dim"))
    groups, _ = bounded_broadcast(var.select(
        *by, F.monotonically_increasing_id().alias("gid"), "__dim",
        (F.lit(tol) * F.aggregate(vector_to_array("__var"), F.lit(0.0), lambda a, x: a + x)
         / F.greatest(F.size(vector_to_array("__var")), F.lit(1))).alias("__limit")))
    size = groups.agg(F.count(F.lit(1)).alias("n"), F.max("__dim").alias("d")).first()
    if not size["n"] or size["n"] * k * size["d"] > CENTROID_NUMBERS:
        return None
    rows = join_by(kept, groups.select(*by, "gid"), by, broadcast=True).select("gid", F.col(ROW_IDX).cast("bigint").alias(ROW_IDX), "vec")
    rounds = _Rounds(rows, size["d"])
    first = seed_centroids(rounds.data, "vec", k if init == "md5" else 1, ["gid"], seed).orderBy("gid", "cluster").collect()
    cents: dict = {}
    for r in first:                                     # at most k rows a group
        ids, m = cents.get(r["gid"], (np.zeros(0, int), np.zeros((0, size["d"]))))
        cents[r["gid"]] = (np.append(ids, r["cluster"]), np.vstack([m, r["centroid"]]))
    if init != "md5":
        for c in range(1, k):
            cents = rounds.draw(cents, seed, c)
    limit = {r["gid"]: r["__limit"] for r in groups.select("gid", "__limit").collect()}
    live = set(cents)
    for _ in range(max_iter):
        new = rounds.means({g: cents[g] for g in live})
        for g in list(live):
            ids, m = cents[g]
            moved = np.stack([new.get((g, int(c)), v) for c, v in zip(ids, m, strict=True)])
            if ((moved - m) ** 2).sum() <= limit[g]:
                live.discard(g)
            cents[g] = (ids, moved)
        if not live:
            break
    rows = [(int(g), int(c), v.tolist(), g not in live) for g, (ids, m) in cents.items() for c, v in zip(ids, m, strict=True)]
    table = spark.createDataFrame(rows, "gid bigint, cluster int, centroid array<double>, converged boolean")
    return table.join(groups, "gid").select(*by, "cluster", "centroid", "converged")


def kmeans(df: DataFrame, vec: str, k: int = DEFAULT_K, by: Sequence[str] | None = None,
           seed: int = DEFAULT_SEED, max_iter: int = 300, tol: float = 1e-4,
           init: str = "k-means++") -> tuple[DataFrame, DataFrame]:
    """Grouped Lloyd iterations; returns ``(assignments, centroids)``.

    ``init``: ``k-means++`` (default, deterministic D^2 seeding) or ``md5``
    (the ``k`` rows with the smallest seeded hash).

    A group has converged when the summed squared shift of its centroids is
    at most ``tol`` times the mean per-coordinate variance of its rows (the
    usual relative tolerance); converged groups are left out of later rounds,
    and the loop ends when every group has converged or after ``max_iter``
    rounds; ``centroids.converged`` tells for each group. While the centroids
    of all groups are at most ``CENTROID_NUMBERS`` numbers they travel with
    the tasks and a round is one job; beyond that they are a table.
    """
    by = group_cols(by)
    if init not in ("k-means++", "md5"):
        raise ValueError(f"unknown init {init!r}")
    cents = _lloyd(df, vec, k, by, seed, max_iter, tol, init)
    if cents is None:
        cents = _lloyd_table(df, vec, k, by, seed, max_iter, tol, init)
    cents, small = bounded_broadcast(cents)
    return assign(df, vec, cents, by, broadcast=small), cents


def _lloyd_table(df: DataFrame, vec: str, k: int, by: list[str], seed: int, max_iter: int, tol: float, init: str) -> DataFrame:
    """As ``_lloyd``, with the centroids as a table joined in each round and checkpointed after it."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    checkpoint_dir(df.sparkSession)
    path = scratch_path(df.sparkSession, "kmeans")
    df.select(*by, ROW_IDX, _vec(vec).alias(vec)).write.parquet(path)
    data = df.sparkSession.read.parquet(path)
    var = data.select(*by, array_to_vector(_vec(vec)).alias("__v")).groupBy(*by) \
        .agg(Summarizer.variance(F.col("__v")).alias("__var"))
    lim = var.select(*by, (F.lit(tol) * F.aggregate(vector_to_array("__var"), F.lit(0.0), lambda a, x: a + x)
                           / F.greatest(F.size(vector_to_array("__var")), F.lit(1))).alias("__limit")).checkpoint()
    cents = seed_centroids(data, vec, k, by, seed).checkpoint() if init == "md5" \
        else plus_plus_seeds(data, vec, k, by, seed, broadcast=False)
    n_groups = n_open = lim.count()
    state = None
    for _ in range(max_iter):
        if n_open < n_groups:                      # converged groups are frozen
            keys = state.where("__open").select(*by).distinct()
            rows, live = join_by(data, keys, by, "left_semi"), join_by(cents, keys, by, "left_semi")
        else:
            rows, live = data, cents
        new = update(assign(rows, vec, live, by, broadcast=False), vec, by) \
            .select(*by, "cluster", F.col("centroid").alias("__new"))
        shift = _sqdist(F.col("centroid"), F.coalesce("__new", "centroid"))
        state = join_by(join_by(cents, new, by + ["cluster"], "left"), lim, by).select(
            *by, "cluster", F.coalesce("__new", "centroid").alias("centroid"),
            (F.sum(shift).over(Window.partitionBy(*by)) > F.col("__limit")).alias("__open")).checkpoint()
        n_open = state.where("__open").select(*by).distinct().count()
        cents = state.select(*by, "cluster", "centroid")
        if n_open == 0:
            break
    return state.select(*by, "cluster", "centroid", (~F.col("__open")).alias("converged")) if state is not None \
        else cents.withColumn("converged", F.lit(False))


def bisecting(df: DataFrame, vec: str, k: int = DEFAULT_K, by: Sequence[str] | None = None,
              seed: int = DEFAULT_SEED, max_iter: int = 300) -> DataFrame:
    """Top-down hierarchical clustering for every group at once.

    Start with one cluster per group; each round picks, in every group, the
    largest cluster (ties: smaller id) that still has at least two rows and
    splits it with grouped 2-means (``kmeans`` keyed by group and cluster);
    the new half gets the next id. After ``k - 1`` rounds each group has up
    to ``k`` clusters. Each split runs at most ``max_iter`` Lloyd rounds, as
    ``kmeans`` does. Between splits only keys and cluster ids are written.
    Stands in for bottom-up agglomerative clustering.
    Adds ``cluster``.
    """
    by = group_cols(by)
    spark = df.sparkSession

    def kept(rows: DataFrame) -> DataFrame:
        path = scratch_path(spark, "bisect")
        rows.write.parquet(path)
        return spark.read.parquet(path)
    vectors = kept(df.select(*by, ROW_IDX, _vec(vec).alias("__vec")))
    cur = kept(vectors.select(*by, ROW_IDX, F.lit(0).alias("cluster")))       # keys and cluster ids only
    for step in range(1, k):
        sizes = cur.groupBy(*by, "cluster").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= 2)
        w = Window.partitionBy(*by).orderBy(F.col("__n").desc(), F.col("cluster"))
        target = sizes.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1) \
            .select(*by, F.col("cluster").alias("__parent"))
        target, small = bounded_broadcast(target)          # at most one row per group
        if not target.limit(1).count():
            break
        marked = join_by(cur, target, by, "left", broadcast=small)
        chosen = marked.where(F.col("cluster") == F.col("__parent")).select(*by, ROW_IDX, "__parent")
        rows = join_by(vectors, chosen, by + [ROW_IDX])
        halves, _ = kmeans(rows, "__vec", 2, by + ["__parent"], seed, max_iter)
        moved = halves.where(F.col("cluster") == 1).select(*by, ROW_IDX, F.lit(step).alias("__to"))
        cur = kept(join_by(cur, moved, by + [ROW_IDX], "left")
                   .select(*by, ROW_IDX, F.coalesce("__to", "cluster").alias("cluster")))
    return join_by(df, cur, by + [ROW_IDX])


def cluster_summary(assigned: DataFrame, by: Sequence[str] | None = None, cluster: str = "cluster",
                    algorithm: str = "kmeans", columns_used: Sequence[str] = ()) -> DataFrame:
    """records and clusters (noise excluded) per group."""
    by = group_cols(by)
    return assigned.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("records"),
        F.count_distinct(F.when(F.col(cluster) != NOISE, F.col(cluster))).cast("bigint").alias("clusters"),
    ).withColumn("algorithm", F.lit(algorithm)) \
     .withColumn("columns_used", F.array(*[F.lit(c) for c in columns_used]).cast("array<string>"))
