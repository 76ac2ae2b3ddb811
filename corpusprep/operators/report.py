"""Reports: top rows per group, nested report assembly, sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.operators.ranking import DEFAULT_SEED, shuffle_key
from corpusprep.schema import ROW_IDX, group_cols


def first_rows(df: DataFrame, k: int, by: Sequence[str] | None = None, seed: int = DEFAULT_SEED,
               row_idx: str = ROW_IDX) -> DataFrame:
    """The first ``k`` rows of each group in seeded order, with ``rn``.

    ``row_number() <= k`` lets Spark insert a partial window group limit
    before the shuffle, so a hot group sends at most ``k`` rows per task.
    """
    by = group_cols(by)
    w = Window.partitionBy(*by).orderBy(shuffle_key(row_idx, seed), F.col(row_idx))
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def nest(df: DataFrame, outer: Sequence[str], name: str, order: Sequence[str] | None = None) -> DataFrame:
    """Collect the rows of each ``outer`` key into a sorted array of structs.

    Used for reports (sheets under workbooks); the inner rows are one per
    group, so the arrays are bounded by the number of groups of one key.
    """
    outer = list(outer)
    inner = [c for c in df.columns if c not in outer]
    order = list(order or inner)
    fields = order + [c for c in inner if c not in order]
    return df.groupBy(*outer).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))


def master_summary(summary: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """One row for each value of the first group column: its groups nested, with totals.

    ``summary`` has one row a group (``training_summary`` or the summary of
    ``classify_corpus``). Returns the first group column, ``n_groups,
    num_train_samples, num_test_samples, accuracy`` (of all its test rows:
    groups weigh by theirs; groups without accuracy are left out of it) and
    ``groups``, an array of the rows without that column, by the other group
    columns. A null group column is a value; ``by=[]`` gives one row.
    """
    by = group_cols(by)
    outer, inner = by[:1], by[1:]
    scored = F.col("accuracy").isNotNull()
    weight = F.when(scored, F.col("num_test_samples"))
    rows = [c for c in summary.columns if c not in by]
    return summary.groupBy(*outer).agg(
        F.count(F.lit(1)).cast("int").alias("n_groups"),
        F.coalesce(F.sum("num_train_samples"), F.lit(0)).cast("bigint").alias("total_train"),
        F.coalesce(F.sum("num_test_samples"), F.lit(0)).cast("bigint").alias("total_test"),
        F.try_divide(F.sum(F.col("accuracy") * weight), F.sum(weight)).alias("mean_accuracy"),
        F.sort_array(F.collect_list(F.struct(*inner, *rows))).alias("groups")) \
        .withColumnsRenamed({"total_train": "num_train_samples", "total_test": "num_test_samples", "mean_accuracy": "accuracy"})


# --------------------------------------------------------------------------
# sinks
# --------------------------------------------------------------------------
def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ("workbook", "sheet"),
              mode: str = "overwrite") -> None:
    """Clustered rows as CSV with a header, one folder per group."""
    df.write.mode(mode).partitionBy(*partition_by).option("header", True).csv(path)


def write_json_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Reports as JSON lines: one small file, gathered after the report is computed."""
    df.repartition(1).write.mode(mode).json(path)


def versioned_write(df: DataFrame, path: str, model: str, version: str | None = None,
                    partition_by: Sequence[str] = ("workbook", "sheet"), fmt: str = "parquet") -> str:
    """Write under ``model=<m>/version=<v>/workbook=<w>/sheet=<s>`` with
    dynamic partition overwrite, so rewriting one group leaves the others.
    The workbook is part of the key, so same-named sheets of two workbooks
    do not overwrite each other. The version defaults to one UTC timestamp
    taken once per write."""
    import datetime as dt
    version = version or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    w = (df.withColumn("model", F.lit(model)).withColumn("version", F.lit(version))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("model", "version", *partition_by).format(fmt))
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)
    return version


def save_nb_model(model: dict, path: str) -> None:
    """Naive Bayes tables (label map, classes, token counts) as parquet."""
    for name in ("label_map", "classes", "tokens"):
        model[name].write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def load_nb_model(spark, path: str, alpha: float = 1.0) -> dict:
    base = path.rstrip("/")
    return {name: spark.read.parquet(f"{base}/{name}") for name in ("label_map", "classes", "tokens")} | {
        "alpha": alpha}
