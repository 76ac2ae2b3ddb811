"""Typed projection of raw ``cells`` maps and per-column type inference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.schema import CELLS, ROW_IDX, group_cols


def typed_projection(raw: DataFrame, schema: T.StructType, keys: Sequence[str] | None = None,
                     cells: str = CELLS) -> DataFrame:
    """One typed column per schema field; cells that do not parse become null."""
    keys = list(keys) if keys is not None else group_cols(None) + [ROW_IDX]
    cols = [F.col(cells).getItem(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return raw.select(*keys, *cols)


def infer_types(raw: DataFrame, by: Sequence[str] | None = None, cells: str = CELLS) -> DataFrame:
    """Narrowest of bigint, double, string per (group, column) over non-null cells."""
    by = group_cols(by)
    kv = raw.select(*by, F.explode(F.col(cells)).alias("column", "value")).where(F.col("value").isNotNull())
    agg = kv.groupBy(*by, "column").agg(
        F.bool_and(F.col("value").try_cast("bigint").isNotNull()).alias("is_int"),
        F.bool_and(F.col("value").try_cast("double").isNotNull()).alias("is_double"),
    )
    return agg.select(*by, "column", F.when(F.col("is_int"), "bigint").when(F.col("is_double"), "double")
                      .otherwise("string").alias("type"))
