import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusprep.functions import casts as cs
from corpusprep.functions import names as nm
from corpusprep.functions import text as tx
from corpusprep.operators import filters as fl
from corpusprep.operators import labels as lb
from corpusprep.operators import split as sp
from corpusprep.operators import tokens as tk
from corpusprep.sources import typed as ty
from pyspark.sql import types as T


def test_tagged_and_delimited(spark):
    df = spark.createDataFrame([("a", None, 3), ("  x\t", "y", None)], "c1 string, c2 string, n int")
    out = df.select(tx.tagged_text(["c1", "c2", "n", "gone"], present=df.columns).alias("t"),
                    tx.delimited_text(["c1", "n"]).alias("d")).collect()
    assert out[0].t == "[C1] a [C2] nan [N] 3 [GONE] "
    assert out[1].t == "[C1] x [C2] y [N] nan [GONE] "
    assert out[0].d == "a | 3" and out[1].d == "  x\t | nan"


def test_names_and_skip(spark):
    assert nm.normalize_name_py("  AWS_Storage ") == "storage"
    assert nm.normalize_name_py("Amazon_storage ") == "storage"
    assert nm.normalize_name_py("xaws_y") == "xy"
    df = spark.createDataFrame([("AWS_Storage",), ("Amazon_storage ",), ("Other",)], "sheet string")
    kept = [r.sheet for r in fl.skip_groups(df, "storage, ").collect()]
    assert kept == ["Other"]
    assert fl.skip_groups(df, "").count() == 3


def test_csv_list_and_casts(spark):
    df = spark.createDataFrame([(" a, b ,,c ", "12", "yes", "1.5"), (None, "x", "N", "bad")],
                               "s string, i string, b string, f string")
    r = df.select(tx.csv_list(F.col("s")).alias("l"), tx.csv_list(F.col("s"), keep_blank=True).alias("k"),
                  cs.safe_int(F.col("i"), -1).alias("i"), cs.safe_bool(F.col("b")).alias("b"),
                  cs.safe_float(F.col("f"), 0.0).alias("f")).collect()
    assert r[0].l == ["a", "b", "c"] and r[0].k == ["a", "b", "", "c"]
    assert (r[0].i, r[0].b, r[0].f) == (12, True, 1.5)
    assert (r[1].i, r[1].b, r[1].f) == (-1, False, 0.0)


def test_word_tokens_unicode(spark):
    df = spark.createDataFrame([("Ça va? Élan-42 x_y",)], "t string")
    assert df.select(tx.word_tokens(F.col("t"))).first()[0] == ["ça", "va", "élan", "42", "x", "y"]


def test_label_maps(spark):
    rows = [("w", "s", 0, "b"), ("w", "s", 1, "a"), ("w", "s", 2, None), ("w", "s", 3, "b"), ("w", "s", 4, "c")]
    df = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, cat string")
    first = {r.label: r.label_id for r in lb.label_map_first_seen(df, ["cat", "missing"]).collect()}
    assert first == {"b": 0, "a": 1, None: 2, "c": 3}
    s = df.withColumn("split", F.when(F.col("row_idx") < 4, "train").otherwise("test"))
    m = lb.label_map_sorted(s, "cat")
    assert {r.label: (r.label_id, r.num_labels) for r in m.collect()} == {"a": (0, 2), "b": (1, 2)}
    enc = {r.row_idx: r.label_id for r in lb.label_encode(s, m, "cat").collect()}
    assert enc == {0: 1, 1: 0, 2: -1, 3: 1, 4: -1}
    dec = lb.label_decode(lb.label_encode(s, m, "cat").where("label_id >= 0"), m, out="back")
    assert all(r.cat == r.back for r in dec.collect())


def test_typed_projection_and_inference(spark):
    raw = spark.createDataFrame([("w", "s", 0, {"a": "1", "b": "1.5", "c": "x"}),
                                 ("w", "s", 1, {"a": "7", "b": "2", "c": None})],
                                "workbook string, sheet string, row_idx bigint, cells map<string,string>")
    types = {r.column: r.type for r in ty.infer_types(raw).collect()}
    assert types == {"a": "bigint", "b": "double", "c": "string"}
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.DoubleType())])
    t = ty.typed_projection(raw, schema).orderBy("row_idx").collect()
    assert (t[0].a, t[0].c) == (1, None)
    cat = fl.column_catalog(raw)
    assert fl.groups_with_columns(cat, ["a", "c"]).first().has_all
    assert fl.pick_label_column(cat, ["z", "c", "a"]).first().label_col == "c"


def test_complete_groups(spark):
    rows = [("w", "s1", 0, "train"), ("w", "s1", 1, "test"), ("w", "s2", 2, "train")]
    df = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, split string")
    assert [r.sheet for r in fl.complete_groups(df).collect()] == ["s1"]


def test_encode_shapes(spark, sheet_df):
    s = sp.stratified_split(sheet_df.withColumn("t", tx.tagged_text(["sample_question"])), "category")
    voc = tk.vocabulary(s, "t", size=10)
    assert voc.count() == 10 and voc.agg(F.min("token_id")).first()[0] == 4
    e = tk.encode(s, "t", voc, keys=["workbook", "sheet", "row_idx"], max_length=8).collect()
    for r in e:
        assert len(r.input_ids) == 8 and len(r.attention_mask) == 8
        n = sum(r.attention_mask)
        assert r.input_ids[0] == tk.CLS_ID and r.input_ids[n - 1] == tk.SEP_ID
        assert all(x == tk.PAD_ID for x in r.input_ids[n:])
    lens = {r.row_idx: sum(r.attention_mask) for r in e}
    words = {r.row_idx: len(r.w) for r in s.select("row_idx", tx.word_tokens(F.col("t")).alias("w")).collect()}
    assert all(lens[k] == min(words[k], 6) + 2 for k in lens)


def test_custom_tokenizer_hook(spark):
    df = spark.createDataFrame([("a b c",), ("",)], "t string")

    def factory():
        return lambda texts: [[101] + [len(w) for w in t.split()] + [102] for t in texts]

    out = tk.encode_with(df, "t", factory, max_length=4).collect()
    assert out[0].input_ids == [101, 1, 1, 1] and out[0].attention_mask == [1, 1, 1, 1]
    assert out[1].input_ids == [101, 102, 0, 0] and out[1].attention_mask == [1, 1, 0, 0]


def test_preview_limit():
    assert tx.PREVIEW_CHARS == 250
    assert pd.Series(["x"]).size == 1
