"""Group filters: skip list, empty groups, required columns, complete splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.names import NAME_PREFIXES, normalize_name, normalize_name_py
from corpusprep.operators.joins import bounded_broadcast, join_by
from corpusprep.schema import CELLS, SHEET, SPLIT, TEST, TRAIN, group_cols


def skip_groups(df: DataFrame, skip: Sequence[str] | str | None, sheet: str = SHEET,
                prefixes: Sequence[str] = NAME_PREFIXES) -> DataFrame:
    """Drop rows whose normalised sheet name is on the (normalised) skip list.

    The list is a parameter (a comma string or a list); blanks are ignored
    and an empty list keeps everything.
    """
    items = skip.split(",") if isinstance(skip, str) else list(skip or [])
    names = sorted({normalize_name_py(s, prefixes) for s in items if s.strip()})
    if not names:
        return df
    return df.where(~normalize_name(F.col(sheet), prefixes).isin(names))


def group_sizes(df: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    by = group_cols(by)
    return df.groupBy(*by).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


def nonempty_groups(catalog: DataFrame, rows: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Groups of ``catalog`` with at least one row, plus their row count.

    ``catalog`` lists every group (a reader emits empty sheets there)."""
    by = group_cols(by)
    sizes = group_sizes(rows, by)
    return catalog.select(*by).distinct().join(sizes, by, "left") \
        .withColumn("n_rows", F.coalesce("n_rows", F.lit(0)).cast("bigint")) \
        .withColumn("kept", F.col("n_rows") > 0)


def column_catalog(raw: DataFrame, by: Sequence[str] | None = None, cells: str = CELLS) -> DataFrame:
    """Columns present per group of a raw ``cells`` frame (sorted array)."""
    by = group_cols(by)
    keys = raw.select(*by, F.explode(F.map_keys(F.col(cells))).alias("column")).distinct()
    return keys.groupBy(*by).agg(F.sort_array(F.collect_list("column")).alias("columns"))


def groups_with_columns(catalog: DataFrame, required: Sequence[str]) -> DataFrame:
    """Flag groups that have all required columns (``has_all``)."""
    req = F.array(*[F.lit(c) for c in required])
    return catalog.withColumn("has_all", F.forall(req, lambda c: F.array_contains(F.col("columns"), c)))


def pick_label_column(catalog: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """First candidate label column present in each group (null if none)."""
    cand = F.array(*[F.lit(c) for c in candidates])
    return catalog.withColumn("label_col", F.element_at(
        F.filter(cand, lambda c: F.array_contains(F.col("columns"), c)), 1))


def complete_groups(split_df: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Groups with both a train and a test row (usable for training)."""
    by = group_cols(by)
    c = split_df.groupBy(*by).agg(
        F.count_if(F.col(SPLIT) == TRAIN).cast("bigint").alias("train_count"),
        F.count_if(F.col(SPLIT) == TEST).cast("bigint").alias("test_count"))
    return c.where((F.col("train_count") > 0) & (F.col("test_count") > 0))


def with_presence(df: DataFrame, cols: Sequence[str], by: Sequence[str] | None = None,
                  prefix: str = "__has_") -> tuple[DataFrame, dict]:
    """``df`` with a flag for each of ``cols`` that the row's group has, and the flags by column.

    A group has a column if any of its rows holds a value in it; a column
    that the frame does not have gets no flag. One row per group is joined.
    """
    by = group_cols(by)
    known = [c for c in cols if c in df.columns]
    flags = {c: F.col(f"{prefix}{i}") for i, c in enumerate(cols) if c in known}
    if not known:
        return df, flags
    has = df.groupBy(*by).agg(*[F.bool_or(F.col(c).isNotNull()).alias(f"{prefix}{i}") for i, c in enumerate(cols) if c in known])
    has, small = bounded_broadcast(has)
    return join_by(df, has, by, broadcast=small), flags
