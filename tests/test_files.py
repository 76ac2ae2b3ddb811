import os
import tempfile

import pytest
from pyspark.sql import functions as F

from corpusprep.sources import xlsx as xl
from corpusprep.operators import filters as fl
from corpusprep.operators import report as rp


def _folder():
    return tempfile.mkdtemp(prefix="corpusprep-test-")


def test_workbook_roundtrip_and_edge_sheets(spark):
    d = _folder()
    rows = [("Billing", ["category", "sample_question", "n"], [["billing", "Where is my invoice, please?", 1],
                                                               ["billing", "Ça coûte combien?", 2.5],
                                                               [None, "no label", None]]),
            ("AWS_Storage", ["category", "category"], [["a", "b"]]),
            ("Empty", ["category"], []),
            ("NoLabel", ["question"], [["what?"]])]
    xl.write_bytes(os.path.join(d, "one.xlsx"), xl.workbook_bytes(rows))
    xl.write_bytes(os.path.join(d, "two.xlsx"), xl.workbook_bytes([("Billing", ["category"], [["x"]])]))
    xl.write_bytes(os.path.join(d, "broken.xlsx"), b"not a workbook")
    with open(os.path.join(d, "notes.txt"), "w") as fh:
        fh.write("ignored")
    raw = xl.read_workbooks(spark, d)
    assert {r.workbook for r in xl.bad_files(raw).collect()} == {"broken.xlsx"}
    good = xl.good_rows(raw)
    b = good.where("workbook = 'one.xlsx' AND sheet = 'Billing'").orderBy("row_idx").collect()
    assert [r.row_idx for r in b] == [0, 1, 2]
    assert b[0].cells == {"category": "billing", "sample_question": "Where is my invoice, please?", "n": "1"}
    assert b[1].cells["sample_question"] == "Ça coûte combien?" and b[1].cells["n"] == "2.5"
    assert b[2].cells["category"] is None
    dup = good.where("sheet = 'AWS_Storage'").first().cells
    assert dup == {"category": "a", "category.1": "b"}
    # same sheet name in two workbooks stays apart
    assert good.where("sheet = 'Billing'").select("workbook").distinct().count() == 2
    # skip list on normalised names; empty sheets appear in the sheet catalog only
    kept = xl.read_workbooks(spark, d, skip="storage")
    assert xl.good_rows(kept).where("sheet = 'AWS_Storage'").count() == 0
    cat = xl.good_rows(xl.read_workbooks(spark, d, output="sheets"))
    ne = {(r.workbook, r.sheet): r.kept for r in fl.nonempty_groups(cat, good).collect()}
    assert ne[("one.xlsx", "Empty")] is False and ne[("one.xlsx", "Billing")] is True
    cols = fl.column_catalog(good)
    has = {r.sheet: r.has_all for r in fl.groups_with_columns(cols, ["category"]).collect()
           if r.workbook == "one.xlsx"}
    assert has["NoLabel"] is False and has["Billing"] is True
    # explicit file list and failfast
    sel = xl.read_workbooks(spark, d, files=" two.xlsx , ,")
    assert [r.workbook for r in sel.select("workbook").distinct().collect()] == ["two.xlsx"]
    with pytest.raises(Exception):
        xl.read_workbooks(spark, d, files="broken.xlsx", mode="FAILFAST").collect()
    assert xl.list_workbooks(d, " all_files ", keyword_case_sensitive=False) == ["broken.xlsx", "one.xlsx",
                                                                              "two.xlsx"]
    assert xl.list_workbooks(d, "all_files") == ["all_files"]


def test_write_workbooks_from_spark(spark):
    d = _folder()
    df = spark.range(0, 30).select(
        (F.col("id") % 3).cast("string").alias("book"), F.concat(F.lit("S"), (F.col("id") % 2).cast("string"))
        .alias("sheet"), F.col("id").alias("k"), (F.col("id") * 1.5).alias("v"))
    meta = xl.write_workbooks(df, d, "book", "sheet", ["k", "v"], order_col="k").collect()
    assert sorted(m.file for m in meta) == ["0.xlsx", "1.xlsx", "2.xlsx"]
    back = xl.good_rows(xl.read_workbooks(spark, d))
    assert back.count() == 30
    vals = sorted(float(r.cells["v"]) for r in back.collect())
    assert vals == [i * 1.5 for i in range(30)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("w1", "s", 1, 0), ("w2", "s", 2, 1)],
                               "workbook string, sheet string, row_idx bigint, cluster_label int")
    rp.write_csv(df, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.count() == 2 and set(back.columns) == {"row_idx", "cluster_label", "workbook", "sheet"}
    v = rp.versioned_write(df, str(tmp_path / "out"), "m")
    rp.versioned_write(df.where("workbook = 'w1'").withColumn("cluster_label", F.lit(9)), str(tmp_path / "out"),
                       "m", v)
    got = {(r.workbook, r.cluster_label) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("w1", 9), ("w2", 1)}       # dynamic overwrite of one group only
    rp.write_json_report(df, str(tmp_path / "json"))
    assert len([f for f in os.listdir(tmp_path / "json") if f.endswith(".json")]) == 1


def test_filter_pushdown(spark):
    d = _folder()
    xl.write_bytes(os.path.join(d, "a.xlsx"), xl.workbook_bytes([("S1", ["x"], [["1"], ["2"]]), ("S2", ["x"], [["3"]])]))
    xl.write_bytes(os.path.join(d, "b.xlsx"), xl.workbook_bytes([("S1", ["x"], [["4"]])]))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        raw = xl.read_workbooks(spark, d).where((F.col("workbook") == "a.xlsx") & F.col("sheet").isin("S1", "S9"))
        got = sorted(r.cells["x"] for r in raw.collect())
        assert got == ["1", "2"]
        plan = raw._sc._jvm.PythonSQLUtils.explainString(raw._jdf.queryExecution(), "formatted")
        assert "EqualTo(workbook,a.xlsx)" in plan and "In(sheet" in plan
        xl.write_bytes(os.path.join(d, "c.xlsx"), b"broken")
        bad = xl.read_workbooks(spark, d).where(F.col("sheet") == "S1")
        assert bad.where(F.col("_error").isNotNull()).count() == 0 and bad.count() == 3
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
