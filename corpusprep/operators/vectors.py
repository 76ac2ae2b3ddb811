"""Text vectors: TF-IDF over the vocabulary, hashed embeddings, PCA, kNN.

The reference embeds with a pretrained sentence encoder. Built-in encoders
here are TF-IDF (relational, per group) and hashed term counts; a user
encoder can be plugged in with ``embed_with`` (Arrow batches).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions.text import word_tokens
from corpusprep.functions.vectors import matrix
from corpusprep.operators.joins import block_pairs, null_safe_groups, reuse, sized_join
from corpusprep.schema import ROW_IDX, group_cols

HASH_DIMS = 256


@null_safe_groups
def tfidf(df: DataFrame, text: str, by: Sequence[str] | None = None, vocab: DataFrame | None = None) -> DataFrame:
    """Sparse TF-IDF rows ``group, row_idx, token, weight`` (L2-normalised per row).

    ``idf = ln((1 + N) / (1 + df)) + 1`` with N rows and df rows holding the
    token inside the group; ``vocab`` (``token`` column) limits the terms.
    """
    by = group_cols(by)
    keys = by + [ROW_IDX]
    # rows travel once, as texts: their tokens are then counted, and weighed against their norm, where they are
    tf = df.select(*keys, F.col(text).alias("__text")).repartition(*keys) \
        .select(*keys, F.explode(word_tokens(F.col("__text"))).alias("token")) \
        .groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("tf"))
    if vocab is not None:
        tf = sized_join(tf, vocab.select("token").distinct(), on=["token"], how="left_semi")
    tf = reuse(tf)                               # read for document frequencies and weights
    n = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    dfreq = tf.groupBy(*by, "token").agg(F.count(F.lit(1)).alias("__df"))
    idf = sized_join(dfreq, n, on=by).select(
        *by, "token", (F.log((F.col("__n") + 1) / (F.col("__df") + 1)) + 1).alias("idf"))
    w = sized_join(tf, idf, on=by + ["token"]).withColumn("__w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(Window.partitionBy(*keys)))
    return w.select(*keys, "token", (F.col("__w") / norm).alias("weight"))


def hashed_embedding(df: DataFrame, text: str, dims: int = HASH_DIMS, out: str = "embedding") -> DataFrame:
    """Dense ``array<double>`` of hashed term counts, L2-normalised (MLlib
    ``HashingTF`` and ``Normalizer`` on word tokens; JVM side)."""
    from pyspark.ml.feature import HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array
    words = df.withColumn("__words", word_tokens(F.col(text)))
    h = HashingTF(inputCol="__words", outputCol="__tf", numFeatures=dims).transform(words)
    n = Normalizer(inputCol="__tf", outputCol="__n", p=2.0).transform(h)
    return n.withColumn(out, vector_to_array("__n")).drop("__words", "__tf", "__n")


def embed_with(df: DataFrame, text: str, encoder_factory: Callable[[], Callable[[list[str]], np.ndarray]],
               out: str = "embedding") -> DataFrame:
    """User encoder hook: ``encoder_factory()`` runs once per task and maps a
    list of texts to a 2-D array; rows stay in Spark partitions."""
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _emb(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder_factory()
        for texts in batches:
            m = np.asarray(enc(texts.fillna("").tolist()), dtype=np.float32)
            yield pd.Series(list(m))
    return df.withColumn(out, _emb(F.col(text)))


def as_double_array(c: str):
    return F.col(c).cast("array<double>")


def pca_2d(df: DataFrame, vec: str, by: Sequence[str] | None = None, k: int = 2) -> DataFrame:
    """PCA of each group (null keys and an empty ``by`` included): see ``_pca``."""
    by = group_cols(by)
    # a text that names the group: to_json leaves null columns out and quotes the others
    name = F.to_json(F.struct(*by)) if by else F.lit("{}")
    rows = df.select(*by, ROW_IDX, as_double_array(vec).alias("__x"), name.alias("__group"))
    out = _pca(rows.select("__group", ROW_IDX, "__x"), "__x", ["__group"], k)
    keys = rows.select("__group", *by, ROW_IDX)
    return keys.join(out, ["__group", ROW_IDX]).select(*by, ROW_IDX, *[f"pc{i + 1}" for i in range(k)])


def _pca(df: DataFrame, vec: str, by: list[str], k: int) -> DataFrame:
    """Mean-centred PCA to ``k`` components for every group in one job.

    Per group, MLlib's ``Summarizer`` (a partial aggregate) gives the mean of
    ``x`` and of the flattened outer product ``x x^T``; the covariance of each
    group is then one small row (d*d values), eigen-decomposed with numpy in
    ``applyInPandas`` (one row per group, so no group's data is gathered).
    Components are sign-fixed so that their largest loading is positive, and
    rows are projected with a size-checked join. Returns ``by, row_idx,
    pc1..pck``.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    from corpusprep.functions.vectors import moment_partials
    v = as_double_array(vec)
    src = df.select(*by, v.alias("__v"))
    part_schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in by] + [
        T.StructField("n", T.LongType()), T.StructField("mean", T.ArrayType(T.DoubleType())),
        T.StructField("mom", T.ArrayType(T.DoubleType()))])
    partials = src.mapInPandas(lambda it: moment_partials(it, by, "__v"), part_schema)
    stats = partials.select(*by, "n", array_to_vector("mean").alias("__m"), array_to_vector("mom").alias("__mm")) \
        .groupBy(*by).agg(Summarizer.mean(F.col("__m"), F.col("n").cast("double")).alias("__m"),
                          Summarizer.mean(F.col("__mm"), F.col("n").cast("double")).alias("__mm"),
                          F.sum("n").alias("__n")) \
        .select(*by, vector_to_array("__m").alias("mean"), vector_to_array("__mm").alias("mom"), "__n")
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in by] + [
        T.StructField("mean", T.ArrayType(T.DoubleType())),
        T.StructField("axes", T.ArrayType(T.ArrayType(T.DoubleType())))])

    def _eig(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():
            mu = np.asarray(r["mean"], dtype=float)
            n = len(mu)
            cov = np.asarray(r["mom"], dtype=float).reshape(n, n) - np.outer(mu, mu)
            if r["__n"] > 1:
                cov = cov * r["__n"] / (r["__n"] - 1)
            w, vecs = np.linalg.eigh(cov)
            order = np.argsort(-w, kind="stable")[:k]
            axes = []
            for j in order:
                a = vecs[:, j]
                if a[np.argmax(np.abs(a))] < 0:
                    a = -a
                axes.append(a.tolist())
            out.append({**{c: r[c] for c in by}, "mean": mu.tolist(), "axes": axes})
        return pd.DataFrame(out, columns=[*by, "mean", "axes"])

    model = stats.groupBy(*by).applyInPandas(_eig, schema)
    from corpusprep.functions.vectors import project
    j = sized_join(df.select(*by, ROW_IDX, v.alias("__v")), model, on=by)
    p = project(F.col("__v"), F.col("mean"), F.col("axes"))
    return j.select(*by, ROW_IDX, p.alias("__p")).select(*by, ROW_IDX, *[F.col("__p")[i].alias(f"pc{i + 1}")
                                                                         for i in range(k)])


#: Rows of a block in the neighbour search, and of it those whose distances are held at a time.
KNN_BLOCK, KNN_ROWS = 8192, 512


@null_safe_groups
def knn_graph(df: DataFrame, vec: str, k: int = 10, by: Sequence[str] | None = None, block_rows: int = KNN_BLOCK) -> DataFrame:
    """Exact k-nearest-neighbour graph inside each group: ``by, src, dst, distance, rank``.

    Rows of a group are dealt into blocks; two blocks of one group meet in a
    task, which returns the ``k`` nearest of each of their rows, not the
    pairs; the nearest of all blocks then meet by ``src``. Ties, however
    many, go to the smaller ``row_idx``. The work grows with the square of the largest
    group, the rows that travel with its size times the number of blocks; a
    task's memory with neither.
    """
    by = group_cols(by)
    rows = df.select(*by, ROW_IDX, as_double_array(vec).alias("__v"))
    schema = T.StructType([T.StructField("src", T.LongType()), T.StructField("dst", T.LongType()), T.StructField("distance", T.DoubleType())])

    def compare(a, b):
        i, x = a.column(ROW_IDX).to_numpy(), matrix(a.column("__v"))
        if b is None:
            return _nearest(i, x, i, x, k)
        j, y = b.column(ROW_IDX).to_numpy(), matrix(b.column("__v"))
        return [np.concatenate(c) for c in zip(_nearest(i, x, j, y, k), _nearest(j, y, i, x, k), strict=True)]

    near = block_pairs(rows, by, ROW_IDX, block_rows, compare, schema)
    w = Window.partitionBy(*by, "src").orderBy("distance", "dst")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _nearest(i: np.ndarray, x: np.ndarray, j: np.ndarray, y: np.ndarray, k: int) -> list[np.ndarray]:
    """``src, dst, distance`` of the ``k`` nearest ``y`` rows of each ``x`` row, self excluded."""
    src, dst, distance = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    x2, y2 = (x * x).sum(axis=1), (y * y).sum(axis=1)
    # all rows that rounding of the product, or a tie, can bring among the k nearest
    margin = 16 * (x.shape[1] + 4) * np.finfo(float).eps * (x2 + y2[np.isfinite(y2)].max(initial=0.0))
    take = min(k, len(j))
    for at in range(0, len(i), KNN_ROWS):
        part = slice(at, at + KNN_ROWS)
        d = x2[part, None] + y2[None, :] - 2 * (x[part] @ y.T)
        d[(i[part, None] == j[None, :]) | ~np.isfinite(d)] = np.inf
        limit = np.partition(d, take - 1, axis=1)[:, take - 1] + margin[part]
        for r in range(len(d)):
            c = np.flatnonzero((d[r] <= limit[r]) & np.isfinite(d[r]))
            exact = np.sqrt(((x[at + r] - y[c]) ** 2).sum(axis=1))
            first = np.lexsort((j[c], exact))[:k]
            src.append(np.full(len(first), i[at + r])), dst.append(j[c][first]), distance.append(exact[first])
    return [np.concatenate(src), np.concatenate(dst), np.concatenate(distance)]
