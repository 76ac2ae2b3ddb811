"""One classifier per group, inference and evaluation.

The reference fine-tunes a transformer per worksheet on one machine. Here
the default model is multinomial naive Bayes written as aggregations over
``(group, label, token)``, so every group trains and predicts in the same
Spark job. Label ids follow the sorted train label map.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.functions.text import word_tokens
from corpusprep.operators.joins import bounded_broadcast, null_safe_groups, reuse, sized_join
from corpusprep.operators.labels import label_encode, label_map_sorted
from corpusprep.schema import ROW_IDX, SPLIT, TEST, TRAIN, group_cols


def argmax(scores: Column) -> Column:
    """0-based position of the largest score; the first maximum wins."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


# --------------------------------------------------------------------------
# naive Bayes by aggregation
# --------------------------------------------------------------------------
@null_safe_groups
def nb_fit(split_df: DataFrame, text: str, label: str, by: Sequence[str] | None = None,
           alpha: float = 1.0) -> dict[str, DataFrame]:
    """Fit multinomial NB on the train rows of every group at once.

    Returns ``label_map`` (sorted train labels), ``classes`` (prior and
    per-class denominator) and ``tokens`` (sparse log counts for count > 0).
    """
    by = group_cols(by)
    train = split_df.where(F.col(SPLIT) == TRAIN).select(*by, F.col(label).cast("string").alias("label"), text)
    lmap = label_map_sorted(split_df, label, by)
    counts = reuse(train.select(*by, "label", F.explode(word_tokens(F.col(text))).alias("token"))
                   .groupBy(*by, "label", "token").agg(F.count(F.lit(1)).cast("bigint").alias("cnt")))
    vocab = counts.groupBy(*by).agg(F.count_distinct("token").cast("bigint").alias("vocab_size"))
    totals = counts.groupBy(*by, "label").agg(F.sum("cnt").cast("bigint").alias("total"))
    docs = train.groupBy(*by, "label").agg(F.count(F.lit(1)).cast("bigint").alias("n_docs"))
    n_all = Window.partitionBy(*by)
    classes = docs.join(totals, by + ["label"], "left").join(vocab, by, "left") \
        .fillna(0, subset=["total", "vocab_size"]) \
        .withColumn("log_prior", F.log(F.col("n_docs") / F.sum("n_docs").over(n_all))) \
        .withColumn("log_denom", F.log(F.col("total") + F.lit(alpha) * F.col("vocab_size"))) \
        .join(lmap.select(*by, "label", "label_id"), by + ["label"])
    tokens = counts.select(*by, "label", "token", "cnt",
                           (F.log(F.col("cnt") + F.lit(alpha)) - F.log(F.lit(alpha))).alias("log_gain"))
    return {"label_map": lmap, "classes": classes, "tokens": tokens, "alpha": alpha}


@null_safe_groups
def nb_scores(model: dict, df: DataFrame, text: str, keys: Sequence[str] | None = None,
              by: Sequence[str] | None = None) -> DataFrame:
    """Log score per (row, class): prior + sum over in-vocabulary words of
    ``tf * log((cnt + a) / (total + a*V))``; words outside the group's train
    vocabulary are ignored."""
    by = group_cols(by)
    keys = list(keys) if keys is not None else by + [ROW_IDX]
    alpha = model["alpha"]
    tf = df.select(*keys, F.explode(word_tokens(F.col(text))).alias("token")) \
        .groupBy(*keys, "token").agg(F.count(F.lit(1)).cast("bigint").alias("tf"))
    # one model row per (group, token) with its per-label gains: a single
    # size-checked join finds the known words and their gains together
    packed = model["tokens"].groupBy(*by, "token").agg(
        F.collect_list(F.struct("label", "log_gain")).alias("__gains"))
    known = reuse(sized_join(tf, packed, on=by + ["token"]))
    n_known = known.groupBy(*keys).agg(F.sum("tf").alias("n_known"))
    gains = known.select(*keys, "tf", F.explode("__gains").alias("__e")) \
        .groupBy(*keys, F.col("__e.label").alias("label")) \
        .agg(F.sum(F.col("tf") * F.col("__e.log_gain")).alias("gain"))
    rows = df.select(*keys).join(n_known, keys, "left").fillna(0, subset=["n_known"])
    base = sized_join(rows, model["classes"].select(*by, "label", "label_id", "log_prior", "log_denom"), on=by)
    return base.join(gains, keys + ["label"], "left").select(
        *keys, "label", "label_id",
        (F.col("log_prior") + F.coalesce("gain", F.lit(0.0))
         + F.col("n_known") * (F.log(F.lit(alpha)) - F.col("log_denom"))).alias("score"))


@null_safe_groups
def nb_predict(model: dict, df: DataFrame, text: str, keys: Sequence[str] | None = None,
               by: Sequence[str] | None = None) -> DataFrame:
    """``pred_id``, ``pred_label`` (highest score, smaller id on ties) and
    ``confidence`` (softmax probability of the predicted class)."""
    by = group_cols(by)
    keys = list(keys) if keys is not None else by + [ROW_IDX]
    s = nb_scores(model, df, text, keys, by)
    agg = s.groupBy(*keys).agg(
        F.max_by(F.struct("label_id", "label"), F.struct("score", -F.col("label_id"))).alias("__best"),
        F.max("score").alias("__max"),
        F.collect_list("score").alias("__scores"))
    denom = F.aggregate("__scores", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("__max")))
    return agg.select(*keys, F.col("__best.label_id").alias("pred_id"), F.col("__best.label").alias("pred_label"),
                      (F.lit(1.0) / denom).alias("confidence"))


@null_safe_groups
def nb_evaluate(split_df: DataFrame, text: str, label: str, by: Sequence[str] | None = None,
                alpha: float = 1.0) -> DataFrame:
    """Fit on train, predict test; rows ``group, row_idx, label_id, pred_id,
    pred_label, confidence`` (unseen test labels get id -1)."""
    by = group_cols(by)
    split_df = reuse(split_df)
    model = nb_fit(split_df, text, label, by, alpha)
    test = split_df.where(F.col(SPLIT) == TEST)
    pred = nb_predict(model, test, text, by + [ROW_IDX], by)
    actual = label_encode(test.select(*by, ROW_IDX, label), model["label_map"], label, by)
    return actual.join(pred, by + [ROW_IDX]).select(*by, ROW_IDX, F.col(label).cast("string").alias("label"),
                                                     "label_id", "pred_id", "pred_label", "confidence")


# --------------------------------------------------------------------------
# MLlib alternative for one large group
# --------------------------------------------------------------------------
def lr_pipeline(text: str, label_col: str = "label_id", num_features: int = 1 << 16, max_iter: int = 30):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"[^\p{L}\p{N}]+", toLowercase=True),
        HashingTF(inputCol="__words", outputCol="__tf", numFeatures=num_features),
        IDF(inputCol="__tf", outputCol="__features"),
        LogisticRegression(featuresCol="__features", labelCol=label_col, maxIter=max_iter),
    ])


def _group_filter(by: list[str], key: tuple):
    cond = F.lit(True)
    for c, v in zip(by, key):
        cond = cond & (F.col(c) == F.lit(v))
    return cond


def lr_fit(split_df: DataFrame, text: str, label: str, key: tuple, by: Sequence[str] | None = None):
    """Fit the MLlib pipeline on the train rows of one group; returns
    ``(PipelineModel, label map)``. Save it with
    ``model.write().overwrite().save(path)``."""
    by = group_cols(by)
    part = split_df.where(_group_filter(by, key))
    lmap = label_map_sorted(part, label, by)
    tr = label_encode(part.where(F.col(SPLIT) == TRAIN), lmap, label, by) \
        .where(F.col("label_id") >= 0).withColumn("label_id", F.col("label_id").cast("double"))
    return lr_pipeline(text).fit(tr), lmap


def lr_evaluate(split_df: DataFrame, text: str, label: str, by: Sequence[str] | None = None) -> DataFrame:
    """Softmax regression of all groups in one run (see ``operators.linear``)."""
    from corpusprep.operators.linear import softmax_evaluate
    return softmax_evaluate(split_df, text, label, by)


# --------------------------------------------------------------------------
# metrics (accuracy, weighted F1, per-class report)
# --------------------------------------------------------------------------
def accuracy(pred: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    by = group_cols(by)
    return pred.groupBy(*by).agg(F.avg((F.col("pred_id") == F.col("label_id")).cast("double")).alias("accuracy"))


def class_report(pred: DataFrame, by: Sequence[str] | None = None, times: str | None = None) -> DataFrame:
    """precision, recall, f1, support per (group, class id); a zero
    denominator gives 0. Classes are those seen as actual or predicted.
    ``times`` names a column with the number of rows that a row stands for."""
    by = group_cols(by)
    n = (F.col(times) if times else F.lit(1)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    roles = pred.select(*by, F.explode(F.array(
        F.struct(F.col("label_id").alias("cls"), n.alias("is_actual"), zero.alias("is_pred"),
                 ((F.col("label_id") == F.col("pred_id")).cast("int") * n).alias("hit")),
        F.struct(F.col("pred_id").alias("cls"), zero.alias("is_actual"), n.alias("is_pred"),
                 zero.alias("hit")),
    )).alias("r")).select(*by, "r.*")
    c = roles.groupBy(*by, "cls").agg(
        F.sum("is_actual").cast("bigint").alias("support"),
        F.sum("is_pred").cast("bigint").alias("n_pred"),
        F.sum("hit").cast("bigint").alias("tp"))
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    out = c.select(*by, F.col("cls").cast("int").alias("class_id"), prec.alias("precision"), rec.alias("recall"),
                   "support")
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return out.withColumn("f1", f1)


def report_averages(report: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """macro and weighted averages of precision, recall, f1 per group."""
    by = group_cols(by)
    tot = F.sum("support")
    return report.groupBy(*by).agg(
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("weighted_recall"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("weighted_f1"),
        tot.cast("bigint").alias("support"))


def weighted_f1(pred: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    by = group_cols(by)
    return report_averages(class_report(pred, by), by).select(*by, F.col("weighted_f1").alias("f1"))


@null_safe_groups
def training_summary(split_df: DataFrame, pred: DataFrame, label_map: DataFrame,
                     by: Sequence[str] | None = None) -> DataFrame:
    """Per group: labels, accuracy, weighted F1, train and test counts."""
    by = group_cols(by)
    counts = split_df.groupBy(*by).agg(
        F.count_if(F.col(SPLIT) == TRAIN).cast("bigint").alias("num_train_samples"),
        F.count_if(F.col(SPLIT) == TEST).cast("bigint").alias("num_test_samples"))
    nl = label_map.groupBy(*by).agg(F.count(F.lit(1)).cast("int").alias("num_labels"))
    # both figures come from the counts of each two classes, so the rows are predicted once
    conf, _ = bounded_broadcast(confusion(pred, by))
    hit = F.when(F.col("label_id").isNotNull() & F.col("pred_id").isNotNull(), (F.col("pred_id") == F.col("label_id")).cast("int"))
    acc = conf.groupBy(*by).agg((F.sum(hit * F.col("n")) / F.sum(F.when(hit.isNotNull(), F.col("n")))).alias("accuracy"))
    f1 = report_averages(class_report(conf, by, "n"), by).select(*by, F.col("weighted_f1").alias("f1"))
    return counts.join(nl, by).join(acc, by, "left").join(f1, by, "left")


@null_safe_groups
def report_record(pred: DataFrame, label_map: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """The written report of each group: ``accuracy, f1, per_class, macro_avg, weighted_avg``.

    ``per_class`` is an array of ``class_id, label, precision, recall, f1,
    support`` by class id, as long as the group has classes; labels that the
    train rows do not have are class -1 with a null name. The averages are
    structs of the same four figures. Accuracy is the recall of all classes
    weighted by support, so predictions are read once. A group without
    predictions has no record.
    """
    by = group_cols(by)
    names = label_map.select(*by, F.col("label_id").alias("class_id"), "label")
    rep = sized_join(class_report(pred, by), names, on=[*by, "class_id"], how="left")
    figures = ("precision", "recall", "f1")
    total = F.sum("support")

    def average(kind: str, of) -> Column:
        return F.struct(*[of(c).alias(c) for c in figures], total.cast("bigint").alias("support")).alias(kind)
    out = rep.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct("class_id", "label", *figures, "support"))).alias("per_class"),
        average("macro_avg", F.avg), average("weighted_avg", lambda c: F.sum(F.col(c) * F.col("support")) / total))
    return out.select(*by, F.col("weighted_avg.recall").alias("accuracy"), F.col("weighted_avg.f1").alias("f1"),
                      "per_class", "macro_avg", "weighted_avg")


@null_safe_groups
def inference_samples(split_df: DataFrame, model: dict, text: str, k: int = 5,
                      by: Sequence[str] | None = None) -> DataFrame:
    """First ``k`` test rows per group (seeded order): the first 250
    characters of their text, and the label and confidence predicted for
    these. Only the samples are scored."""
    from corpusprep.functions.text import preview
    from corpusprep.operators.report import first_rows
    by = group_cols(by)
    top = first_rows(split_df.where(F.col(SPLIT) == TEST).select(*by, ROW_IDX, text), k, by)
    shown = reuse(top.select(*by, ROW_IDX, F.col("rn").cast("int").alias("rn"), preview(F.col(text)).alias("text")))
    pred = nb_predict(model, shown, "text", by + [ROW_IDX], by)
    return shown.join(pred, by + [ROW_IDX]).select(
        *by, "rn", "text", F.col("pred_label").alias("predicted_label"), "confidence")


def confusion(pred: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """``by, label_id, pred_id, n``: confusion counts (a partial aggregate)."""
    by = group_cols(by)
    return pred.groupBy(*by, "label_id", "pred_id").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def custom_metrics(pred: DataFrame, fn, schema: str, by: Sequence[str] | None = None) -> DataFrame:
    """Apply a user metric callback per group.

    ``fn(confusion: pandas.DataFrame) -> dict`` receives the group's
    confusion counts (columns ``label_id, pred_id, n``; at most classes^2
    rows, so no group's predictions are gathered) and returns the metric
    values named in ``schema`` (a DDL string, group columns excluded).
    """
    import pandas as pd
    by = group_cols(by)
    conf = confusion(pred, by)
    key_fields = ", ".join(f"{c} {conf.schema[c].dataType.simpleString()}" for c in by)

    def _apply(pdf: pd.DataFrame) -> pd.DataFrame:
        out = dict(fn(pdf[["label_id", "pred_id", "n"]].reset_index(drop=True)))
        for c in by:
            out[c] = pdf[c].iloc[0]
        return pd.DataFrame([out])

    full = f"{key_fields}, {schema}" if by else schema
    return conf.groupBy(*by).applyInPandas(_apply, full)
