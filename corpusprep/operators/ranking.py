"""Seeded order and skew-safe ranks inside groups.

The order of a row inside its group is ``md5('<seed>:<row_idx>')`` with
``row_idx`` as tie break. A plain window ``partitionBy(group)`` would sort a
whole group in one task; one group may hold a third of all rows, so ranks
are computed in two levels instead:

1. the first ``PREFIX_HEX`` hex digits of the hash give an ordered bucket;
   a map-side-combined histogram counts rows per ``(group, bucket)``;
2. a window over the histogram (at most 16**PREFIX_HEX rows per group) gives
   the number of rows in earlier buckets;
3. rows are ranked inside ``(group, bucket)`` only, and the offset is added.

The result equals ``row_number() over (partition by group order by hash,
row_idx)`` exactly; no task ever holds more than one bucket of one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.operators.joins import bounded_broadcast, join_by

# The default seed of every shuffle.
DEFAULT_SEED = 42
PREFIX_HEX = 5


def shuffle_key(row_idx: Column | str, seed: int = DEFAULT_SEED) -> Column:
    c = F.col(row_idx) if isinstance(row_idx, str) else row_idx
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def rank_in_group(df: DataFrame, by: Sequence[str], key: str, tie: str,
                  rank_col: str = "rank", size_col: str = "group_n") -> DataFrame:
    """Add 1-based ``rank_col`` (order ``key``, ``tie``) and group size ``size_col``.

    ``key`` must be a lower-case hex string column (an md5).
    """
    by = list(by)
    b = "__bucket"
    keyed = df.withColumn(b, F.conv(F.substring(F.col(key), 1, PREFIX_HEX), 16, 10).cast("int"))
    hist = keyed.groupBy(*by, b).agg(F.count(F.lit(1)).alias("__cnt"))
    w_run = Window.partitionBy(*by).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*by)
    offs = hist.select(
        *by, b,
        F.coalesce(F.sum("__cnt").over(w_run), F.lit(0)).alias("__before"),
        F.sum("__cnt").over(w_all).alias(size_col),
    )
    offs, small = bounded_broadcast(offs)
    joined = join_by(keyed, offs, by + [b], broadcast=small)
    w_loc = Window.partitionBy(*by, b).orderBy(F.col(key), F.col(tie))
    return joined.withColumn(rank_col, (F.col("__before") + F.row_number().over(w_loc)).cast("bigint")) \
        .drop(b, "__before")


# Buckets of the histogram that finds a cut: a label of n rows ranks n / 4096 of them.
CUT_HEX = 3


def cut_points(df: DataFrame, by: Sequence[str], key: str, tie: str, frac: float,
               within: Sequence[str] | None = None) -> DataFrame:
    """``by`` with the key and tie of the last of the first ``max(1, floor(n * frac))`` rows.

    A histogram of key prefixes tells the bucket in which that row lies; only
    the rows of this bucket are ranked, on narrow columns. One row per group.
    With ``within``, some of the columns ``by``, the groups that share these
    stand in the order of the others and what rounding leaves is carried on:
    the first ``k`` of them take ``floor(frac * their rows)`` together, and a
    group that takes none has no cut point.
    """
    by = list(by)
    narrow = df.select(*by, F.col(key).alias("__k"), F.col(tie).alias("__t"),
                       F.substring(F.col(key), 1, CUT_HEX).alias("__b"))
    hist = narrow.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
    run = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    if within is None:
        want = F.greatest(F.lit(1), F.floor(F.sum("__cnt").over(Window.partitionBy(*by)) * F.lit(frac)))
        hist = hist.withColumn("__want", want)
    else:
        sizes = hist.groupBy(*by).agg(F.sum("__cnt").alias("__n"))
        total = F.sum("__n").over(Window.partitionBy(*within).orderBy(*[c for c in by if c not in within]))
        sizes = sizes.withColumn("__total", total).withColumn(
            "__want", F.floor(F.col("__total") * F.lit(frac)) - F.floor((F.col("__total") - F.col("__n")) * F.lit(frac)))
        hist = join_by(hist, sizes.select(*by, "__want"), by)
    hist = hist.withColumn("__upto", F.sum("__cnt").over(run))
    cut = hist.where((F.col("__upto") >= F.col("__want")) & (F.col("__upto") - F.col("__cnt") < F.col("__want"))) \
        .withColumn("__left", F.col("__want") - (F.col("__upto") - F.col("__cnt"))).select(*by, "__b", "__left")
    inside = join_by(narrow, cut, by + ["__b"])
    nth = F.row_number().over(Window.partitionBy(*by).orderBy("__k", "__t"))
    return inside.withColumn("__nth", nth).where(F.col("__nth") == F.col("__left")) \
        .select(*by, F.col("__k").alias("__cut_key"), F.col("__t").alias("__cut_tie"))
