"""Join helpers: broadcast a side only behind a checked size bound."""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusprep.session import scratch_path

# Largest side we are willing to ship to every executor: rows, and bytes of its files.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 16 << 20


def bounded_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """Return ``(small, is_broadcast)``.

    ``small`` (an aggregate or a dictionary) is written to the shared folder
    and read again: its rows and bytes are then known, its lineage is cut, no
    cache has to be released and a lost executor loses nothing. It is
    broadcast only if it holds at most ``max_rows`` rows and ``max_bytes``
    bytes; otherwise it is left for a shuffle join (with AQE skew splitting).
    """
    spark = small.sparkSession
    path = scratch_path(spark, "small")
    small.write.parquet(path)
    small = spark.read.schema(small.schema).parquet(path)
    if small.count() > max_rows:
        return small, False
    size = int(str(small._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return (F.broadcast(small), True) if size <= max_bytes else (small, False)


def sized_join(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    side, _ = bounded_broadcast(small, max_rows)
    return big.join(side, on=on, how=how)


def join_by(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner", broadcast: bool = False) -> DataFrame:
    """Join on ``by`` with nulls equal; an empty ``by`` joins one-row aggregates."""
    by = list(by)
    other = right.select(*[F.col(c).alias(f"__r_{c}") if c in by else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for c in by:
        cond = cond & left[c].eqNullSafe(other[f"__r_{c}"])
    out = left.join(F.broadcast(other) if broadcast else other, cond, how)
    return out if how == "left_semi" else out.drop(*[f"__r_{c}" for c in by])


# Group columns packed into one struct: structs are never null and their null
# fields compare as equal, so joins on it lose no group, and an empty ``by``
# is a struct like any other.
GROUP_KEY = "__g"


def null_safe_groups(fn):
    """Let a grouped operator ``fn(..., by)`` keep null group keys and take an empty ``by``.

    Every frame among its arguments that has all group columns, also inside
    a model (a dict of frames), gets them packed into one struct; results
    get them back. A ``keys`` argument names the packed key in their place.
    """
    sig = inspect.signature(fn)

    def pack(value, by):
        if isinstance(value, dict):
            return {k: pack(v, by) for k, v in value.items()}
        if isinstance(value, DataFrame) and GROUP_KEY not in value.columns and set(by) <= set(value.columns):
            key = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
            return value.withColumn(GROUP_KEY, key).drop(*by)
        return value

    def unpack(out, by):
        if isinstance(out, tuple):
            return tuple(unpack(o, by) for o in out)
        if isinstance(out, dict):
            return {k: unpack(v, by) for k, v in out.items()}
        if isinstance(out, DataFrame) and GROUP_KEY in out.columns:
            return out.select(*[F.col(f"{GROUP_KEY}.{c}").alias(c) for c in by], *[c for c in out.columns if c != GROUP_KEY])
        return out

    @functools.wraps(fn)
    def run(*args, **kw):
        from corpusprep.schema import group_cols
        bound = sig.bind(*args, **kw)
        bound.apply_defaults()
        by = group_cols(bound.arguments["by"])
        if by == [GROUP_KEY]:
            return fn(*bound.args, **bound.kwargs)
        for name, value in bound.arguments.items():
            bound.arguments[name] = pack(value, by)
        if bound.arguments.get("keys") is not None:
            bound.arguments["keys"] = [GROUP_KEY, *[k for k in bound.arguments["keys"] if k not in by]]
        bound.arguments["by"] = [GROUP_KEY]
        return unpack(fn(*bound.args, **bound.kwargs), by)
    return run


def cpu_partitions(spark, per_slot: int = 4) -> int:
    """Partition count for CPU-heavy Python stages: several per task slot,
    at least the configured shuffle partitions."""
    slots = spark.sparkContext.defaultParallelism
    return max(slots * per_slot, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


#: Blocks that a small group is dealt into, if they keep ``FEW_ROWS`` rows, so that its pairs fill some slots.
FEW_BLOCKS, FEW_ROWS = 4, 1024


def block_pairs(rows: DataFrame, by: Sequence[str], key: str, block_rows: int, compare: Callable, schema: T.StructType) -> DataFrame:
    """Rows that ``compare(x, y)`` (two Arrow tables) yields for every two blocks of a group, beside the group.

    A group's rows are dealt by ``key`` into blocks of about ``block_rows``; two
    different blocks meet once, and ``y`` is None where a block meets itself.
    A task holds two blocks at a time; a row travels once for each block of
    its group. ``compare`` returns the columns of ``schema``.
    """
    by = list(by)
    n = F.count(F.lit(1))
    blocks = F.greatest(F.ceil(n / block_rows), F.least(F.lit(FEW_BLOCKS), F.ceil(n / FEW_ROWS)))
    sizes, small = bounded_broadcast(rows.groupBy(*by).agg(blocks.cast("int").alias("__n")))
    dealt = join_by(rows, sizes, by, broadcast=small).withColumn("__b", F.pmod(F.xxhash64(key), "__n").cast("int"))
    x = dealt.select(*rows.columns, F.col("__b").alias("__p"), F.explode(F.sequence("__b", F.col("__n") - 1)).alias("__q"))
    y = dealt.where("__b > 0").select(*[F.col(c).alias(f"__y_{c}") for c in rows.columns],
                                      F.explode(F.sequence(F.lit(0), F.col("__b") - 1)).alias("__y___p"), F.col("__b").alias("__y___q"))
    keys = [*by, "__p", "__q"]
    y_keys = [f"__y_{c}" for c in keys]
    out = T.StructType([*[rows.schema[c] for c in by], *schema.fields])

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        same = a.num_rows and a.column("__p")[0].as_py() == a.column("__q")[0].as_py()
        if not a.num_rows or not (same or b.num_rows):          # a block without rows
            return pa.table([pa.array([], to_arrow_type(f.dataType)) for f in out.fields], names=out.names)
        found = compare(a, None if same else b.rename_columns([c.removeprefix("__y_") for c in b.column_names]))
        at = pa.array([0] * len(found[0]), pa.int64())
        return pa.table([*[a.column(c).take(at) for c in by], *[pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(found, schema.fields, strict=True)]],
                        names=out.names)
    return x.groupBy(*keys).cogroup(y.groupBy(*y_keys)).applyInArrow(run, out)


def reuse(df: DataFrame) -> DataFrame:
    """Persist a frame that several branches of one plan read (memory, spill
    to disk). Blocks lost with an executor are recomputed from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
