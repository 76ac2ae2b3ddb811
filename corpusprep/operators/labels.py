"""Label maps (first-seen and sorted), encode and decode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.operators.joins import sized_join
from corpusprep.schema import ROW_IDX, SPLIT, TRAIN, group_cols

UNSEEN_ID = -1


def _long_labels(df: DataFrame, label_cols: Sequence[str], by: list[str]) -> DataFrame:
    """``by, label_col, label`` for every present label column (long form)."""
    present = [c for c in label_cols if c in df.columns]
    if not present:
        return df.select(*by, F.lit(None).cast("string").alias("label_col"),
                         F.lit(None).cast("string").alias("label"), ROW_IDX).where(F.lit(False))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("label_col"), F.col(c).cast("string").alias("label"))
                                for c in present]))
    return df.select(*by, ROW_IDX, pairs.alias("__p")).select(*by, ROW_IDX, "__p.label_col", "__p.label")


def label_map_first_seen(df: DataFrame, label_cols: Sequence[str], by: Sequence[str] | None = None) -> DataFrame:
    """id = order of first appearance (by ``row_idx``) of each label value;
    a missing label is a value too. A group has the label columns in which
    any of its rows holds a value. Returns ``by, label_col, label, label_id``."""
    by = group_cols(by)
    first = _long_labels(df, label_cols, by).groupBy(*by, "label_col", "label").agg(
        F.min(ROW_IDX).alias("__first"))
    # one row per distinct label: a column without any value in a group is not one of the group's
    first = first.withColumn("__has", F.max(F.col("label").isNotNull()).over(Window.partitionBy(*by, "label_col"))) \
        .where("__has").drop("__has")
    w = Window.partitionBy(*by, "label_col").orderBy("__first")
    return first.select(*by, "label_col", "label",
                        (F.row_number().over(w) - 1).cast("int").alias("label_id"))


def label_map_sorted(split_df: DataFrame, label: str, by: Sequence[str] | None = None) -> DataFrame:
    """Sorted distinct labels of the train rows; id = position. Adds
    ``num_labels`` per group."""
    by = group_cols(by)
    labels = split_df.where(F.col(SPLIT) == TRAIN).select(*by, F.col(label).cast("string").alias("label")) \
        .where(F.col("label").isNotNull()).distinct()
    w = Window.partitionBy(*by).orderBy("label")
    return labels.select(*by, "label", (F.row_number().over(w) - 1).cast("int").alias("label_id"),
                         F.count(F.lit(1)).over(Window.partitionBy(*by)).cast("int").alias("num_labels"))


def label_encode(df: DataFrame, label_map: DataFrame, label: str, by: Sequence[str] | None = None,
                 out: str = "label_id") -> DataFrame:
    """Attach ``label_id``; a label missing from the map gets -1."""
    by = group_cols(by)
    m = label_map.select(*by, F.col("label").alias("__lab"), F.col("label_id").alias(out))
    j = sized_join(df.withColumn("__lab", F.col(label).cast("string")), m, on=by + ["__lab"], how="left")
    return j.withColumn(out, F.coalesce(F.col(out), F.lit(UNSEEN_ID)).cast("int")).drop("__lab")


def label_decode(df: DataFrame, label_map: DataFrame, id_col: str = "label_id",
                 by: Sequence[str] | None = None, out: str = "label") -> DataFrame:
    by = group_cols(by)
    m = label_map.select(*by, F.col("label_id").alias(id_col), F.col("label").alias(out))
    return sized_join(df, m, on=by + [id_col], how="left")


def distinct_labels(df: DataFrame, label: str, by: Sequence[str] | None = None) -> DataFrame:
    by = group_cols(by)
    return df.select(*by, F.col(label).cast("string").alias("label")).distinct()
