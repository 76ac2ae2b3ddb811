"""Every grouped operator keeps groups with null keys and takes an empty ``by``."""

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import agglomerative as ag
from corpusprep.operators import classify as cl
from corpusprep.operators import linear as li
from corpusprep.operators import vectors as vc
from corpusprep.plans import corpus as cp

GROUPS = [("w", "s1"), ("w", None), (None, None)]
ROWS = 20


@pytest.fixture(scope="module")
def grouped(spark):
    rows = []
    for g, (w, s) in enumerate(GROUPS):
        for i in range(ROWS):
            label = ("red", "blue")[i % 2]
            word = {"red": "crimson scarlet", "blue": "azure navy"}[label]
            rows.append((w, s, 1000 * g + i, "test" if i % 5 > 2 else "train", f"{word} item{i % 3}", label,
                         [float(i % 2 * 5 + i * .01), float(g + i * .02), 1.0]))
    return spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, split string, text string, label string, v array<double>") \
        .repartition(4).cache()


def run_all(df, by):
    keyed = lambda out: out
    pred = cl.nb_evaluate(df, "text", "label", by)
    model = cl.nb_fit(df, "text", "label", by)
    return {
        "nb_evaluate": pred,
        "nb_scores": cl.nb_scores(model, df, "text", [*by, "row_idx"], by),
        "nb_predict": cl.nb_predict(model, df.where("split = 'test'"), "text", None, by),
        "training_summary": cl.training_summary(df, pred, model["label_map"], by),
        "inference_samples": cl.inference_samples(df, model, "text", 2, by),
        "tfidf": vc.tfidf(df, "text", by),
        "pca_2d": vc.pca_2d(df, "v", by),
        "softmax": li.softmax_evaluate(df, "text", "label", by, dims=64),
        "ward": keyed(ag.ward(df, "v", 2, by)),
    }


NAMES = ["nb_evaluate", "nb_scores", "nb_predict", "training_summary", "inference_samples", "tfidf", "pca_2d", "softmax", "ward"]


@pytest.fixture(scope="module")
def results(grouped):
    return {("workbook", "sheet"): run_all(grouped, ["workbook", "sheet"]), (): run_all(grouped, [])}


@pytest.mark.parametrize("name", NAMES)
def test_null_groups_stay_and_give_what_named_groups_give(results, name):
    out = results["workbook", "sheet"][name]
    assert out.columns[:2] == ["workbook", "sheet"]
    got = {}
    for r in out.select("workbook", "sheet").collect():
        got[tuple(r)] = got.get(tuple(r), 0) + 1
    assert set(got) == set(GROUPS)
    assert len(set(got.values())) == 1               # the groups hold the same rows, so they give as many


@pytest.mark.parametrize("name", NAMES)
def test_an_empty_by_is_one_group_of_all_rows(results, name):
    out = results[()][name]
    n = {"nb_evaluate": 24, "nb_scores": 120, "nb_predict": 24, "training_summary": 1, "inference_samples": 2, "tfidf": 180, "pca_2d": 60,
         "softmax": 24, "ward": 60}[name]
    assert "workbook" not in out.columns or name == "ward"
    assert out.count() == n


def test_classify_corpus_trains_null_groups(grouped):
    pred, summary = cp.classify_corpus(grouped, "text", ["label"])
    got = {(r["workbook"], r["sheet"]): (r["status"], r["accuracy"]) for r in summary.collect()}
    assert got == {g: ("trained", 1.0) for g in GROUPS}
    assert pred.count() == 24


def test_a_group_with_a_null_key_predicts_as_its_named_twin(results):
    rows = results["workbook", "sheet"]["nb_predict"].select("workbook", "sheet", (F.col("row_idx") % 1000).alias("i"), "pred_id", F.round("confidence", 9).alias("c"))
    by = {}
    for r in rows.collect():
        by.setdefault((r["workbook"], r["sheet"]), set()).add((r["i"], r["pred_id"], r["c"]))
    assert len(by) == 3 and len({frozenset(v) for v in by.values()}) == 1
