import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusprep.operators import split as sp
from corpusprep.operators.ranking import rank_in_group, shuffle_key
from corpusprep.sources import tables as tb
from tests.conftest import SF_MID


def test_golden_sheet_split(sheet_df):
    s = sp.stratified_split(sheet_df, "category")
    counts = {(r["category"], r["split"]): r["n"] for r in
              s.groupBy("category", "split").agg(F.count("*").alias("n")).collect()}
    for cat in ["billing", "storage", "compute", "network", "security"]:
        assert counts[(cat, "train")] == 4 and counts[(cat, "test")] == 2
    c = sp.split_counts(s).first()
    assert (c.train_count, c.test_count) == (20, 10)


def test_split_disjoint_complete_and_min_one(spark):
    d = tb.docs_by_lang(spark, SF_MID)
    s = sp.stratified_split(d, "source")
    assert s.count() == d.where("source is not null").count()
    assert s.select("workbook", "sheet", "row_idx").distinct().count() == s.count()
    per = s.groupBy("sheet", "source").agg(F.count_if(F.col("split") == "train").alias("tr"))
    assert per.where("tr < 1").count() == 0


def test_split_partition_invariance(spark):
    d = tb.docs_by_lang(spark, SF_MID)
    ref = sorted(tuple(r) for r in sp.stratified_split(d, "source").select("row_idx", "split").collect())
    for n in (1, 3, 8):
        got = sorted(tuple(r) for r in sp.stratified_split(d.repartition(n), "source")
                     .select("row_idx", "split").collect())
        assert got == ref


def test_edge_labels(spark):
    rows = [("w", "s", 0, "a"), ("w", "s", 1, None), ("w", "s", 2, "b"), ("w", "s", 3, "b")]
    df = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, label string")
    s = {r.row_idx: r.split for r in sp.stratified_split(df, "label").collect()}
    assert 1 not in s                      # missing label leaves both splits
    assert s[0] == "train"                 # one-row label is train only
    assert sorted(v for k, v in s.items() if k in (2, 3)) == ["test", "train"]  # max(1, int(2*0.8)) = 1


def test_shares():
    assert sp.train_fraction(80, 20) == 0.8
    assert sp.train_fraction(1, 3) == pytest.approx(0.25)
    with pytest.raises(ValueError):
        sp.train_fraction(0, 0)


def test_last_label_column(sheet_df):
    assert sp.last_present(["category", "nope", "sample_question_type"], sheet_df) == "sample_question_type"
    with pytest.raises(ValueError):
        sp.last_present(["x"], sheet_df)


def test_rank_in_group_equals_window(spark):
    d = tb.docs_by_lang(spark, SF_MID).withColumn("k", shuffle_key("row_idx"))
    got = rank_in_group(d, ["sheet"], "k", "row_idx").select("row_idx", "rank", "group_n")
    w = Window.partitionBy("sheet").orderBy("k", "row_idx")
    exp = d.select("row_idx", F.row_number().over(w).cast("bigint").alias("rank"),
                   F.count("*").over(Window.partitionBy("sheet")).alias("group_n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_union_parts_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2,)], "id int")
    e = spark.createDataFrame([], "id int")
    u = sp.union_parts(a, b, e)
    assert sorted(map(tuple, u.collect())) == [(1, "x"), (2, None)]
