"""Helpers shared by the operators: written tables, shared files, prefix sums, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusprep.session import scratch_path

#: Sort key of a null id: before all others.
NULL_KEY = -(1 << 63)
#: Rows handed to Python at once from one Arrow batch; bounds the memory of a task on wide text.
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def key_of(col: str | Column) -> Column:
    """A non-null bigint sort key of an id column."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("bigint"), F.lit(NULL_KEY))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def map_text(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with ``fn(iterator of small batches) -> iterator of batches``."""
    def run(batches):
        return fn(slices(batches))
    return df.mapInArrow(run, schema)


def hash_sample(rows: DataFrame, key: str, size: int) -> DataFrame:
    """At most ``size`` rows, spread over all by the hash of ``key``; the same rows each time.

    Larger tables are thinned by a second hash first, so that no task hands
    its own ``size`` rows to the driver.
    """
    n = rows.count()
    if n > 2 * size:
        rows = rows.where(F.pmod(F.xxhash64(key, F.lit(1)), F.lit(n)) < 2 * size)
    return rows.orderBy(F.xxhash64(key), key).limit(size)


class Memo:
    """What a worker remembers, in two generations of about ``size`` entries: often used entries stay."""

    def __init__(self, size: int):
        self.size, self.known, self.old = size, {}, {}

    def unknown(self, keys: set) -> list:
        """Keys still to be learned into ``known``; all other ``keys`` are in ``known`` afterwards."""
        if len(self.known) > self.size:
            self.old, self.known = self.known, {}
        known, old, out = self.known, self.old, []
        for k in keys.difference(known):
            v = old.get(k)
            if v is None:
                out.append(k)
            else:
                known[k] = v
        return out


# ------------------------------------------------------------------ shared files
def shared_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder URI under the shared checkpoint folder, with its scheme."""
    jvm, sc = spark._jvm, spark.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, name))
    return path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toString()


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


class CommittedFile:
    """A file written under a temporary name and renamed when complete.

    A lost or repeated task leaves at most a temporary name behind; final
    names are only ever complete files, and equal for equal input.
    """

    def __init__(self, uri: str, name: str):
        self.fs, root = open_store(uri)
        self.fs.create_dir(root, recursive=True)
        self.final = f"{root}/{name}"
        self.tmp = f"{root}/_tmp-{uuid.uuid4().hex}-{name}"
        self.out = self.fs.open_output_stream(self.tmp)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self.out.close()
        if self.fs.type_name != "local" and self.fs.get_file_info(self.final).type != pafs.FileType.NotFound:
            self.fs.delete_file(self.final)
        self.fs.move(self.tmp, self.final)


def read_file(uri: str, name: str):
    fs, root = open_store(uri)
    return fs.open_input_stream(f"{root}/{name}")


# ------------------------------------------------------------------ prefix sums
def prefix_sums(light: DataFrame, order: list[str], size: str, start: str = "start") -> DataFrame:
    """Add ``start``: the sum of ``size`` over all rows before, in ``order``.

    The narrow table is range partitioned and written; each partition's sum
    (one row a partition) gives its offset, and a window inside each
    partition does the rest. No task sees more than one range.
    """
    spark = light.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = written(light.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                .withColumn("__part", F.spark_partition_id()), "ordered")
    sums = t.groupBy("__part").agg(F.sum(size).alias("__sum"))
    offs = sums.select("__part", F.coalesce(F.sum("__sum").over(
        Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    before = F.coalesce(F.sum(size).over(
        Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # offs: at most one row for each shuffle partition
    return (t.withColumn("__before", before).join(F.broadcast(offs), "__part")
            .withColumn(start, (F.col("__before") + F.col("__off")).cast("bigint"))
            .drop("__part", "__before", "__off"))


def shard_bounds(starts: DataFrame, key: str, shard_size: int, max_shards: int) -> list[tuple[int, int]]:
    """``(first key, first start)`` of each shard of about ``shard_size``, ascending.

    At most ``max_shards`` pairs: the shard grows instead. Depends only on
    the rows, so a rerun gives the same shards.
    """
    last = starts.agg(F.max("start").alias("m")).first()["m"] or 0
    width = max(int(shard_size), last // max_shards + 1)
    rows = (starts.groupBy(F.expr(f"start div {width}").alias("s"))
            .agg(F.min(key).alias("k"), F.min("start").alias("o")).orderBy("s").collect())
    return [(r["k"], r["o"]) for r in rows]


def shard_firsts(bounds: list[tuple[int, int]]) -> np.ndarray:
    """First key of each shard; the first shard starts before all keys."""
    firsts = np.array([k for k, _ in bounds] or [NULL_KEY], dtype=np.int64)
    firsts[0] = NULL_KEY
    return firsts


def with_shard(df: DataFrame, key: str, bounds: list[tuple[int, int]]) -> DataFrame:
    """Add ``__shard``: the last shard whose first key is at most ``key``."""
    firsts = shard_firsts(bounds)
    at = df.columns.index(key)
    schema = df.select("*", F.lit(0).alias("__shard")).schema

    def run(batches):
        for b in batches:
            k = b.column(at).to_numpy(zero_copy_only=False)
            s = np.searchsorted(firsts, k, side="right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s.astype(np.int32))],
                                             names=[*b.schema.names, "__shard"])
    return df.mapInArrow(run, schema)


# ------------------------------------------------------------------ components
def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: alternating large and small stars.

    Each round is two aggregates and two joins on the node; its edges are
    written to the shared folder. Stops when the edge set no longer changes
    (every node then points at the smallest node of its component).
    """
    a, b = F.col("a"), F.col("b")
    e = written(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                .where(a != b).distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 31)).alias("h")).first()
        if (now["n"], now["h"]) == state or not now["n"]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = (now["n"], now["h"])
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        e = written(low.select("a", F.col("m").alias("b")).union(moved).where(a != b).distinct(), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def forest(n: int, i: np.ndarray, j: np.ndarray, parent: np.ndarray | None = None) -> np.ndarray:
    """Smallest reachable index of each of ``n`` items over links ``i``-``j`` (numpy min propagation)."""
    root = np.arange(n) if parent is None else parent
    while len(i):
        a, b = root[i], root[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        open_ = lo != hi
        if not open_.any():
            break
        i, j, lo, hi = i[open_], j[open_], lo[open_], hi[open_]
        np.minimum.at(root, hi, lo)
        while True:
            nxt = root[root]
            if np.array_equal(nxt, root):
                break
            root = nxt
    return root
