import json
import os

import pytest
from pyspark.sql import functions as F

from corpusprep.plans import corpus as cp
from corpusprep.operators import split as sp
from corpusprep.functions import text as tx
from corpusprep.sources import tables as tb
from tests.conftest import SF_SMALL


def test_leakage_plan_and_writer(spark, sheet_df, tmp_path):
    rep, gate = cp.leakage_report(sheet_df, ["sample_question", "sample_question_type"], "category")
    g = gate.first()
    assert g.total_records == 30 and g.status in ("PASS", "FAIL")
    cp.write_leakage_report(rep, gate, str(tmp_path / "leak"))
    wb = [json.loads(line) for f in os.listdir(tmp_path / "leak" / "workbooks") if f.endswith(".json")
          for line in open(tmp_path / "leak" / "workbooks" / f)]
    assert wb[0]["workbook"] == "support" and wb[0]["sheets"][0]["sheet_name"] == "Questions"
    summ = [json.loads(line) for f in os.listdir(tmp_path / "leak" / "summary") if f.endswith(".json")
            for line in open(tmp_path / "leak" / "summary" / f)]
    assert summ[0]["similarity_threshold"] == 0.9 and summ[0]["fail_threshold"] == 0.01


def test_classify_plan_skips_incomplete_groups(spark, sheet_df, tmp_path):
    lonely = sheet_df.limit(1).withColumn("sheet", F.lit("Lonely"))     # one row: train only
    df = sheet_df.unionByName(lonely).withColumn("t", tx.tagged_text(["sample_question", "sample_question_type"]))
    s = sp.split_by_labels(df, ["category"])
    pred, summary = cp.classify_corpus(s, "t", ["category"])
    st = {r.sheet: r.status for r in summary.collect()}
    assert st == {"Questions": "trained", "Lonely": "skipped"}
    row = summary.where("sheet = 'Questions'").first()
    assert row.num_labels == 5 and row.num_train_samples == 20 and row.num_test_samples == 10
    cp.write_classification_outputs(s, pred, summary, "t", "category", str(tmp_path / "clf"), version="v1")
    back = spark.read.json(str(tmp_path / "clf" / "label_mapping"))
    assert back.where("sheet = 'Questions'").count() == 5


@pytest.mark.parametrize("algorithm", ["kmeans", "agglomerative", "dbscan"])
def test_cluster_plan_algorithms(spark, sheet_df, tmp_path, algorithm):
    rows, summary = cp.cluster_corpus(sheet_df, ["sample_question", "sample_question_type"], k=5,
                                      algorithm=algorithm, skip="other")
    r = rows.collect()
    assert len(r) == 30 and all(x["__cluster_text__"].count(" | ") == 1 for x in r)
    s = summary.first()
    assert s.records == 30 and s.algorithm == algorithm and list(s.columns_used) == ["sample_question",
                                                                                    "sample_question_type"]
    if algorithm != "dbscan":
        assert s.clusters == 5
    cp.write_cluster_outputs(rows, summary, str(tmp_path / "cl"), version="v1")
    assert spark.read.option("header", True).csv(str(tmp_path / "cl" / "rows")).count() == 30


def test_cluster_plan_rejects_bad_input(spark, sheet_df):
    with pytest.raises(ValueError):
        cp.cluster_corpus(sheet_df, ["sample_question"], algorithm="spectral")
    with pytest.raises(ValueError):
        cp.cluster_corpus(sheet_df, ["no_such_column"])
