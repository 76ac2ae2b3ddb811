"""Dense vector math for Arrow batches (numpy inside tasks).

Spark's higher-order array functions are interpreted per element; for
distances and projections over many dimensions these vectorised pandas UDFs
are much faster. Spark still partitions and shuffles the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """The vectors of an Arrow column, all of one length, as a matrix; a null component is NaN."""
    rows = column.combine_chunks()
    rows = pa.concat_arrays(rows.chunks) if isinstance(rows, pa.ChunkedArray) else rows
    flat = rows.flatten()
    if rows.null_count or flat.null_count or len(np.unique(np.diff(rows.offsets.to_numpy()))) > 1:
        return np.stack([np.asarray(v, dtype=np.float64) for v in rows.to_pylist()])
    return flat.to_numpy(zero_copy_only=False).reshape(len(rows), -1)


NEAREST_SCHEMA = T.StructType([T.StructField("c", T.IntegerType()), T.StructField("d", T.DoubleType())])


def _stack(values: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in values]) if len(values) else np.zeros((0, 0))


@F.pandas_udf(NEAREST_SCHEMA)
def nearest_centroid(gkey: pd.Series, vec: pd.Series, ids: pd.Series, cents: pd.Series) -> pd.DataFrame:
    """Nearest of the row's group centroids (squared Euclidean; ties -> the
    smaller id). ``gkey`` identifies the group; all rows of a group carry the
    same ``ids``/``cents`` arrays, so each group of the batch is one matrix
    operation."""
    n = len(vec)
    out_c = np.zeros(n, dtype=np.int32)
    out_d = np.zeros(n, dtype=np.float64)
    for _, rows in pd.Series(np.arange(n)).groupby(gkey.values, sort=False):
        rows = rows.to_numpy()
        first = rows[0]
        cid = np.asarray(ids.iat[first])
        order = np.argsort(cid, kind="stable")
        cid = cid[order]
        c = _stack(cents.iat[first])[order]
        x = _stack(vec.iloc[rows])
        d = np.empty((len(rows), len(cid)))
        for j in range(len(cid)):
            diff = x - c[j]
            d[:, j] = (diff * diff).sum(1)
        best = np.argmin(d, axis=1)
        out_c[rows] = cid[best]
        out_d[rows] = d[np.arange(len(rows)), best]
    return pd.DataFrame({"c": out_c, "d": out_d})


# evaluated once per row even when both fields are read
nearest_centroid = nearest_centroid.asNondeterministic()


@F.pandas_udf(T.DoubleType())
def euclidean(a: pd.Series, b: pd.Series) -> pd.Series:
    if len(a) == 0:
        return pd.Series([], dtype=float)
    x, y = _stack(a), _stack(b)
    return pd.Series(np.sqrt(((x - y) ** 2).sum(1)))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def project(vec: pd.Series, mean: pd.Series, axes: pd.Series) -> pd.Series:
    out = []
    for v, m, a in zip(vec, mean, axes):
        out.append(((np.asarray(v, dtype=float) - np.asarray(m, dtype=float)) @ _stack(a).T).tolist())
    return pd.Series(out)


def moment_partials(batches: Iterator[pd.DataFrame], keys: list[str], vec: str,
                    max_values: int = 8_000_000) -> Iterator[pd.DataFrame]:
    """Per task and group: row count, mean of x and mean of x x^T (flattened).
    Pre-aggregates inside each partition before any shuffle; when the open
    accumulators exceed ``max_values`` numbers they are emitted early (the
    final weighted mean combines any number of partials per group)."""
    acc: dict[tuple, list] = {}
    held = 0
    for pdf in batches:
        for k, g in pdf.groupby(keys, sort=False, dropna=False):
            k = k if isinstance(k, tuple) else (k,)
            x = _stack(g[vec])
            s = acc.get(k)
            if s is None:
                acc[k] = [len(x), x.sum(0), x.T @ x]
                held += x.shape[1] * (x.shape[1] + 1)
            else:
                s[0] += len(x)
                s[1] = s[1] + x.sum(0)
                s[2] = s[2] + x.T @ x
        if held > max_values:
            yield _emit(acc, keys)
            acc, held = {}, 0
    if acc:
        yield _emit(acc, keys)


def _emit(acc: dict, keys: list[str]) -> pd.DataFrame:
    rows = []
    for k, (n, sx, sxx) in acc.items():
        rows.append({**dict(zip(keys, k)), "n": n, "mean": (sx / n).tolist(), "mom": (sxx / n).ravel().tolist()})
    return pd.DataFrame(rows, columns=[*keys, "n", "mean", "mom"])
