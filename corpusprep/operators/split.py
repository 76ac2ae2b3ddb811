"""Seeded shuffle and stratified train/test split inside each group.

Semantics (per group and label value):
* rows are ordered by ``md5('<seed>:<row_idx>')`` then ``row_idx``;
* the first ``max(1, floor(n * frac))`` rows are train, the rest test, so a
  label with one row is train only and the parts are disjoint and complete;
* rows whose label is missing equal no label and leave both splits;
* only the ratio of the two shares counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.filters import with_presence
from corpusprep.operators.joins import bounded_broadcast, join_by
from corpusprep.operators.ranking import DEFAULT_SEED, cut_points, rank_in_group, shuffle_key
from corpusprep.schema import GROUP, ROW_IDX, SPLIT, TEST, TRAIN, group_cols

# Default train and test shares.
DEFAULT_TRAIN = 80
DEFAULT_TEST = 20


def train_fraction(train: float = DEFAULT_TRAIN, test: float = DEFAULT_TEST) -> float:
    """Train's part of both shares; only their ratio counts."""
    if min(train, test) < 0 or train + test <= 0:
        raise ValueError(f"shares must not be negative and not both zero: {train}, {test}")
    return train / (train + test)


def seeded_shuffle(df: DataFrame, by: Sequence[str] | None = None, seed: int = DEFAULT_SEED,
                   row_idx: str = ROW_IDX, pos_col: str = "shuffle_pos") -> DataFrame:
    """Add the 1-based position of each row in its group's seeded order."""
    by = group_cols(by)
    keyed = df.withColumn("__key", shuffle_key(row_idx, seed))
    return rank_in_group(keyed, by, "__key", row_idx, pos_col, "__n").drop("__key", "__n")


def stratified_split(df: DataFrame, label: str, by: Sequence[str] | None = None,
                     train: float = DEFAULT_TRAIN, test: float = DEFAULT_TEST,
                     seed: int = DEFAULT_SEED, row_idx: str = ROW_IDX) -> DataFrame:
    """Add ``split`` ('train'/'test') inside each ``(group, label)``.

    Rows are compared with the cut point of their label, one row per
    (group, label); no row of ``df`` is shuffled while these are few.
    """
    by = group_cols(by)
    frac = train_fraction(train, test)
    keyed = df.where(F.col(label).isNotNull()).withColumn("__key", shuffle_key(row_idx, seed))
    cuts, small = bounded_broadcast(cut_points(keyed, by + [label], "__key", row_idx, frac))
    at = F.struct(F.col("__key"), F.col(row_idx)) <= F.struct(F.col("__cut_key"), F.col("__cut_tie"))
    return join_by(keyed, cuts, by + [label], broadcast=small).withColumn(
        SPLIT, F.when(at, F.lit(TRAIN)).otherwise(F.lit(TEST))).drop("__key", "__cut_key", "__cut_tie")


def last_present(label_cols: Sequence[str], df: DataFrame) -> str:
    """When several label columns are given the last present one decides."""
    present = [c for c in label_cols if c in df.columns]
    if not present:
        raise ValueError(f"none of the label columns {list(label_cols)} is present")
    return present[-1]


def with_label(df: DataFrame, label_cols: Sequence[str], by: Sequence[str] | None = None, last: bool = False,
               out: str = "__label") -> DataFrame:
    """Add ``out``: the value of the first (or ``last``) label column that the row's group has.

    A group has a column if any of its rows holds a value in it, so groups
    with different columns can stand in one frame. Null where it has none.
    """
    cols = [c for c in label_cols if c in df.columns]
    if not cols:
        raise ValueError(f"none of the label columns {list(label_cols)} is present")
    marked, has = with_presence(df, cols, by)
    value = F.coalesce(*[F.when(has[c], F.struct(F.col(c).cast("string").alias("v"))) for c in (cols[::-1] if last else cols)])["v"]
    return marked.withColumn(out, value).select(*df.columns, out)


def split_by_labels(df: DataFrame, label_cols: Sequence[str], by: Sequence[str] | None = None, **kw) -> DataFrame:
    """Split each group by the last label column that it has."""
    return stratified_split(with_label(df, label_cols, by, last=True), "__label", by, **kw).drop("__label")


def split_by_combination(df: DataFrame, label_cols: Sequence[str], by: Sequence[str] | None = None,
                         train: float = DEFAULT_TRAIN, test: float = DEFAULT_TEST,
                         seed: int = DEFAULT_SEED, row_idx: str = ROW_IDX) -> DataFrame:
    """Split each group by all its label columns together; adds ``split``.

    The combinations of values stand in the order of ``label_cols``, nulls
    first, and what rounding leaves is carried from one to the next. So train
    has its share to within one row in the group, in every value of the first
    column, in every combination of the first two, and so on: combinations of
    a row or two, which ``stratified_split`` would put into train one by one,
    keep the share together. Inside a combination the seeded order decides.
    A column that a group does not have parts nothing there; a row without a
    value in a column that its group has leaves both splits, as do groups
    with none of the columns.
    """
    by = group_cols(by)
    cols = [c for c in label_cols if c in df.columns]
    if not cols:
        raise ValueError(f"none of the label columns {list(label_cols)} is present")
    marked, has = with_presence(df, cols, by)
    parts = [f"__label{i}" for i in range(len(cols))]
    labelled, whole = F.lit(False), F.lit(True)
    for c in cols:
        labelled, whole = labelled | has[c], whole & (~has[c] | F.col(c).isNotNull())
    keyed = marked.where(labelled & whole).select(
        *df.columns, *[F.when(has[c], F.col(c).cast("string")).alias(p) for c, p in zip(cols, parts, strict=True)],
        shuffle_key(row_idx, seed).alias("__key"))
    cuts, small = bounded_broadcast(cut_points(keyed, by + parts, "__key", row_idx, train_fraction(train, test), within=by))
    at = F.struct(F.col("__key"), F.col(row_idx)) <= F.struct(F.col("__cut_key"), F.col("__cut_tie"))
    out = join_by(keyed, cuts, by + parts, how="left", broadcast=small)
    return out.withColumn(SPLIT, F.when(F.col("__cut_key").isNotNull() & at, F.lit(TRAIN)).otherwise(F.lit(TEST))) \
        .select(*df.columns, SPLIT)


def split_counts(split_df: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """``train_count``, ``test_count`` per group."""
    by = group_cols(by)
    return split_df.groupBy(*by).agg(
        F.count_if(F.col(SPLIT) == TRAIN).cast("bigint").alias("train_count"),
        F.count_if(F.col(SPLIT) == TEST).cast("bigint").alias("test_count"),
    )


def split_parts(split_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_df.where(F.col(SPLIT) == TRAIN), split_df.where(F.col(SPLIT) == TEST)


def union_parts(*parts: DataFrame) -> DataFrame:
    """Union by column name; parts may miss columns or be empty."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


__all__ = ["GROUP", "seeded_shuffle", "stratified_split", "split_by_labels", "split_by_combination", "split_counts",
           "split_parts", "union_parts", "train_fraction", "last_present", "with_label"]
