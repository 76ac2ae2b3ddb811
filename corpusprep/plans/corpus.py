"""End-to-end corpus plans composed from the operators.

* ``leakage_report``: split -> tagged text -> per-sheet report -> gate.
* ``classify_corpus``: split -> naive Bayes per group -> metrics, status.
* ``cluster_corpus``: skip list -> non-empty groups with the required
  columns -> delimited text -> vectors -> clusters -> rows and summary.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.text import delimited_text, tagged_text
from corpusprep.operators import classify as cl
from corpusprep.operators import cluster as cu
from corpusprep.operators import filters as fl
from corpusprep.operators import labels as lb
from corpusprep.operators import leakage as lk
from corpusprep.operators import split as sp
from corpusprep.operators import vectors as vc
from corpusprep.operators.joins import join_by
from corpusprep.schema import group_cols

# Names of the derived text columns in the written reports.
CLUSTER_TEXT = "__cluster_text__"
COMBINED_TEXT = "__combined_text__"


def leakage_report(df: DataFrame, text_cols: Sequence[str], label: str, by: Sequence[str] | None = None,
                   threshold: float | None = lk.SIMILARITY_THRESHOLD, fail_threshold: float = lk.FAIL_THRESHOLD,
                   train: float = 80, test: float = 20, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Return ``(per-sheet report, gate row)``."""
    by = group_cols(by)
    marked, has = fl.with_presence(df, text_cols, by)
    texts = marked.withColumn(COMBINED_TEXT, tagged_text(text_cols, has)).select(*df.columns, COMBINED_TEXT)
    s = sp.stratified_split(texts, label, by, train, test, seed)
    rep = lk.sheet_report(s, COMBINED_TEXT, by, threshold, seed, with_samples=threshold is not None)
    return rep, lk.leakage_gate(rep, fail_threshold)


def classify_corpus(split_df: DataFrame, text: str, label_cols: Sequence[str],
                    by: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Naive Bayes per group on complete groups; returns (predictions,
    summary with ``status``): groups missing a split are reported as
    ``skipped`` and do not stop the others. Each group is fitted and scored
    on the first of ``label_cols`` that it has."""
    by = group_cols(by)
    split_df = sp.with_label(split_df, label_cols, by)
    label = "__label"
    usable = fl.complete_groups(split_df, by).select(*by)
    s = join_by(split_df, usable, by, "left_semi").where(F.col(label).isNotNull())
    pred = cl.nb_evaluate(s, text, label, by)
    summary = cl.training_summary(s, pred, lb.label_map_sorted(s, label, by), by)
    groups = split_df.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows"))
    out = join_by(groups, summary, by, "left").withColumn(
        "status", F.when(F.col("num_labels").isNotNull(), "trained").otherwise("skipped")).drop("__rows")
    return pred, out


def cluster_corpus(df: DataFrame, text_cols: Sequence[str], k: int = cu.DEFAULT_K, algorithm: str = "kmeans",
                   skip: Sequence[str] | str | None = None, by: Sequence[str] | None = None,
                   dims: int = vc.HASH_DIMS, seed: int = 42, vectors: str | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """Cluster the text of every group; returns (rows with
    ``__cluster_text__`` and ``cluster_label``, summary per group). A group
    without one of ``text_cols`` is left out of the rows and stands in the
    summary as ``skipped``; the others go on."""
    by = group_cols(by)
    algorithm = cu.check_algorithm(algorithm)
    if not text_cols:
        raise ValueError("no clustering columns are named")
    missing = [c for c in text_cols if c not in df.columns]
    if missing:
        raise ValueError(f"no group can have the columns {missing}")
    kept = fl.skip_groups(df, skip)
    marked, has = fl.with_presence(kept, text_cols, by)
    usable = functools.reduce(lambda a, b: a & b, (has[c] for c in text_cols))
    left_out = marked.where(~usable).select(*by).distinct()
    t = marked.where(usable).withColumn(CLUSTER_TEXT, delimited_text(text_cols)).select(*df.columns, CLUSTER_TEXT)
    v = t if vectors else vc.hashed_embedding(t, CLUSTER_TEXT, dims, out="__vec")
    vec = vectors or "__vec"
    if algorithm == "kmeans":
        rows, _ = cu.kmeans(v, vec, k, by, seed)
        rows = rows.drop("dist2")
    elif algorithm == "agglomerative":
        from corpusprep.operators.agglomerative import ward
        rows = ward(v, vec, k, by)
    else:
        from corpusprep.operators.dbscan import dbscan
        rows = dbscan(v, vec, by=by)
    rows = rows.withColumnRenamed("cluster", "cluster_label").drop("__vec")
    summary = cu.cluster_summary(rows, by, "cluster_label", algorithm, text_cols).withColumn("status", F.lit("clustered"))
    skipped = left_out.select(*by, F.lit(0).cast("bigint").alias("records"), F.lit(0).cast("bigint").alias("clusters"),
                              F.lit(algorithm).alias("algorithm"), F.array(*[F.lit(c) for c in text_cols]).alias("columns_used"),
                              F.lit("skipped").alias("status"))
    return rows, summary.unionByName(skipped)


def global_cluster_summary(summary: DataFrame) -> DataFrame:
    """One row over all groups: groups clustered and skipped, records, clusters."""
    return summary.agg(F.count_if(F.col("status") == "clustered").cast("bigint").alias("groups"),
                       F.count_if(F.col("status") == "skipped").cast("bigint").alias("skipped"),
                       F.coalesce(F.sum("records"), F.lit(0)).cast("bigint").alias("records"),
                       F.coalesce(F.sum("clusters"), F.lit(0)).cast("bigint").alias("clusters"))


__all__ = ["leakage_report", "classify_corpus", "cluster_corpus", "global_cluster_summary", "write_leakage_report", "write_cluster_outputs",
           "write_classification_outputs"]


# --------------------------------------------------------------------------
# writing the plans' outputs (JSON reports, CSV rows, versioned layout)
# --------------------------------------------------------------------------
def write_leakage_report(report: DataFrame, gate: DataFrame, path: str,
                         threshold: float | None = lk.SIMILARITY_THRESHOLD,
                         fail_threshold: float = lk.FAIL_THRESHOLD) -> None:
    """``workbooks/``: one JSON line per workbook with its sheets nested;
    ``summary/``: one line with totals, ratio, status and both thresholds."""
    from corpusprep.operators.report import nest, write_json_report
    base = path.rstrip("/")
    sheets = report.withColumnRenamed("sheet", "sheet_name")
    nest(sheets, ["workbook"], "sheets", order=["sheet_name"]).write.mode("overwrite").json(f"{base}/workbooks")
    write_json_report(gate.withColumn("similarity_threshold", F.lit(threshold).cast("double"))
                      .withColumn("fail_threshold", F.lit(fail_threshold)), f"{base}/summary")


def write_cluster_outputs(rows: DataFrame, summary: DataFrame, root: str, model: str = "clustering",
                          version: str | None = None, by: Sequence[str] | None = None) -> str:
    """Clustered rows as CSV and summaries as JSON under
    ``root/{rows,summary}/model=../version=../workbook=../sheet=..``."""
    from corpusprep.operators.report import versioned_write
    by = group_cols(by)
    base = root.rstrip("/")
    version = versioned_write(rows, f"{base}/rows", model, version, by, fmt="csv")
    versioned_write(summary, f"{base}/summary", model, version, by, fmt="json")
    return version


def write_classification_outputs(split_df: DataFrame, pred: DataFrame, summary: DataFrame, text: str,
                                 label: str, root: str, model: str = "nb", version: str | None = None,
                                 by: Sequence[str] | None = None) -> str:
    """Label maps, per-class metrics, inference samples and the per-group
    summary, each as JSON in the versioned layout."""
    from corpusprep.operators.report import versioned_write
    by = group_cols(by)
    base = root.rstrip("/")
    version = versioned_write(lb.label_map_sorted(split_df, label, by), f"{base}/label_mapping", model, version,
                              by, fmt="json")
    versioned_write(cl.class_report(pred, by), f"{base}/metrics", model, version, by, fmt="json")
    samples = cl.inference_samples(split_df, cl.nb_fit(split_df, text, label, by), text, by=by)
    versioned_write(samples, f"{base}/inference_samples", model,
                    version, by, fmt="json")
    versioned_write(summary, f"{base}/summary", model, version, by, fmt="json")
    return version
