"""The written classification record and the nested summary of all groups, against loops."""

import json

import pytest

from corpusprep.operators import classify as cl
from corpusprep.operators import report as rp

PRED = [("w", "s", 0, 0), ("w", "s", 0, 1), ("w", "s", 1, 1), ("w", "s", 1, 1), ("w", "s", 2, 0), ("w", "s", -1, 1),
        ("w", None, 0, 0), (None, None, 0, 1)]
NAMES = [("w", "s", "ant", 0), ("w", "s", "bee", 1), ("w", "s", "cow", 2), ("w", None, "ant", 0), (None, None, "ant", 0),
         (None, None, "bee", 1), ("x", "unused", "ant", 0)]


def plain(pairs, names):
    classes = sorted({c for p in pairs for c in p})
    out = []
    for c in classes:
        tp = sum(a == p == c for a, p in pairs)
        n_pred, support = sum(p == c for _, p in pairs), sum(a == c for a, _ in pairs)
        precision, recall = tp / n_pred if n_pred else 0.0, tp / support if support else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        out.append((c, names.get(c), precision, recall, f1, support))
    n = sum(r[5] for r in out)
    macro = tuple(sum(r[i] for r in out) / len(out) for i in (2, 3, 4))
    weighted = tuple(sum(r[i] * r[5] for r in out) / n for i in (2, 3, 4))
    return sum(a == p for a, p in pairs) / n, out, (*macro, n), (*weighted, n)


@pytest.fixture(scope="module")
def frames(spark):
    pred = spark.createDataFrame(PRED, "workbook string, sheet string, label_id int, pred_id int")
    names = spark.createDataFrame(NAMES, "workbook string, sheet string, label string, label_id int")
    return pred, names


def test_report_record_equals_a_loop(frames):
    got = {(r["workbook"], r["sheet"]): r for r in cl.report_record(*frames).collect()}
    assert set(got) == {("w", "s"), ("w", None), (None, None)}
    for key, r in got.items():
        names = {i: n for w, s, n, i in NAMES if (w, s) == key}
        accuracy, classes, macro, weighted = plain([(a, p) for w, s, a, p in PRED if (w, s) == key], names)
        assert r["accuracy"] == pytest.approx(accuracy) and r["f1"] == pytest.approx(weighted[2])
        assert [(c["class_id"], c["label"], c["support"]) for c in r["per_class"]] == [(c[0], c[1], c[5]) for c in classes]
        for c, want in zip(r["per_class"], classes, strict=True):
            assert tuple(c)[2:5] == pytest.approx(want[2:5])
        assert tuple(r["macro_avg"]) == pytest.approx(macro) and tuple(r["weighted_avg"]) == pytest.approx(weighted)


def test_report_record_of_nothing_is_nothing(frames):
    pred, names = frames
    assert cl.report_record(pred.where("false"), names).count() == 0


SUMMARY = [("w", "b", 10, 5, 2, 0.8, 0.7), ("w", "a", 20, 15, 3, 0.4, 0.5), ("w", None, 1, 0, None, None, None), (None, "c", 4, 2, 2, 0.5, 0.5)]
SUMMARY_DDL = ("workbook string, sheet string, num_train_samples bigint, num_test_samples bigint, num_labels int, accuracy double, "
               "f1 double")


def test_master_summary_nests_groups_and_reads_back_as_json(spark, tmp_path):
    master = rp.master_summary(spark.createDataFrame(SUMMARY, SUMMARY_DDL))
    got = {r["workbook"]: r for r in master.collect()}
    assert set(got) == {"w", None}
    w = got["w"]
    assert (w["n_groups"], w["num_train_samples"], w["num_test_samples"]) == (3, 31, 20)
    assert w["accuracy"] == pytest.approx((0.8 * 5 + 0.4 * 15) / 20)
    assert [g["sheet"] for g in w["groups"]] == [None, "a", "b"]
    assert w["groups"][1].asDict() == {"sheet": "a", "num_train_samples": 20, "num_test_samples": 15, "num_labels": 3, "accuracy": 0.4,
                                       "f1": 0.5}
    rp.write_json_report(master, str(tmp_path / "master"))
    lines = [json.loads(x) for f in (tmp_path / "master").glob("part-*.json") for x in f.read_text().splitlines()]
    assert sorted(len(x["groups"]) for x in lines) == [1, 3]


def test_master_summary_without_groups_or_accuracy(spark):
    rows = spark.createDataFrame([(None, None, 3, 0, None, None, None)], SUMMARY_DDL)
    r = rp.master_summary(rows).first()
    assert r["accuracy"] is None and r["n_groups"] == 1
    one = rp.master_summary(spark.createDataFrame(SUMMARY, SUMMARY_DDL).drop("workbook", "sheet"), []).first()
    assert one["n_groups"] == 4 and one["num_train_samples"] == 35 and len(one["groups"]) == 4
    assert rp.master_summary(rows.where("false")).count() == 0
