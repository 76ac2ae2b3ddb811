"""Adapters that present the driver's parquet tables as grouped corpora.

Each adapter returns ``workbook, sheet, row_idx`` plus the typed columns of
its rows. Only the columns an adapter needs are selected, so the parquet
scan reads just those (``ReadSchema`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def docs_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D: documents, one sheet per language, label ``source``."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.lit("documents").alias("workbook"),
        F.col("lang").alias("sheet"),
        F.col("doc_id").alias("row_idx"),
        F.col("source"),
        F.col("text"),
    )


def docs_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q: documents joined to labels, one sheet per source."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id").select(
        F.lit("labelled").alias("workbook"),
        F.col("source").alias("sheet"),
        F.col("doc_id").alias("row_idx"),
        F.col("quality").cast("string").alias("quality"),
        F.col("toxic").cast("string").alias("toxic"),
        F.col("text"),
    )


def docs_by_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L: documents in four sheets by id, label ``lang``."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.lit("lang").alias("workbook"),
        F.concat(F.lit("b"), (F.col("doc_id") % 4).cast("string")).alias("sheet"),
        F.col("doc_id").alias("row_idx"),
        F.col("lang"),
        F.col("text"),
    )


def chat_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V: conversation turns, one sheet per role, label ``turn % 3``."""
    c = read_table(spark, sf_dir, "conversations")
    return c.select(
        F.lit("chat").alias("workbook"),
        F.col("role").alias("sheet"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("row_idx"),
        (F.col("turn") % 3).cast("string").alias("turn_class"),
        F.col("text"),
    )


def vectors_by_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E: embeddings in four sheets by id, label ``label``."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        F.lit("vec").alias("workbook"),
        F.concat(F.lit("e"), (F.col("vec_id") % 4).cast("string")).alias("sheet"),
        F.col("vec_id").alias("row_idx"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding"),
    )


def parts_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R: parts, one sheet per brand."""
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.lit("part").alias("workbook"),
        F.col("p_brand").alias("sheet"),
        F.col("p_partkey").alias("row_idx"),
        "p_name", "p_type", "p_size", "p_retailprice",
    )


def customers_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.lit("customer").alias("workbook"),
        F.col("c_mktsegment").alias("sheet"),
        F.col("c_custkey").alias("row_idx"),
        "c_name", "c_nationkey", "c_acctbal",
    )



def as_cells(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Typed corpus -> raw ``(workbook, sheet, row_idx, cells)`` form."""
    keys = ["workbook", "sheet", "row_idx"] if by is None else by
    entries = [F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
               for c in columns]
    return df.select(*keys, F.map_from_entries(F.array(*entries)).alias("cells"))
