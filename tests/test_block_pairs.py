"""Blocks of a group meet once, two in a task; what is predicted or tokenized travels once."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.operators import classify as cl
from corpusprep.operators import linear as ln
from corpusprep.operators import vectors as vc
from corpusprep.operators.joins import block_pairs


def test_two_blocks_of_a_group_meet_once(spark):
    rows = spark.range(90).select(F.when(F.col("id") < 60, "a").alias("g"), F.col("id"))
    schema = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.LongType())])

    def compare(a, b):
        assert a.num_rows < 60
        i = a.column("id").to_numpy()
        j = i if b is None else b.column("id").to_numpy()
        p, q = (t.ravel() for t in np.meshgrid(i, j, indexing="ij"))
        return [p[p < q], q[p < q]] if b is None else [np.minimum(p, q), np.maximum(p, q)]

    packed = rows.select(F.struct("g").alias("g"), "id")
    got = block_pairs(packed, ["g"], "id", 16, compare, schema)
    assert "FlatMapCoGroupsInArrow" in got._jdf.queryExecution().optimizedPlan().toString()
    pairs = [(r.g.g, r.x, r.y) for r in got.collect()]
    want = {("a" if x < 60 else None, x, y) for x in range(90) for y in range(x + 1, 90) if (x < 60) == (y < 60)}
    assert len(pairs) == len(want) and set(pairs) == want


def test_knn_of_null_group_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(vc, "KNN_ROWS", 7)
    x = np.random.default_rng(3).integers(0, 3, (60, 4)).astype(float)
    df = spark.createDataFrame([("w", None, i, v.tolist()) for i, v in enumerate(x)], "workbook string, sheet string, row_idx bigint, v array<double>")
    got = {(r.src, r["rank"]): (r.dst, r.distance) for r in vc.knn_graph(df, "v", k=3, block_rows=13).collect()}
    for i in range(60):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        best = [j for j in np.lexsort((np.arange(60), d)) if j != i][:3]
        assert [got[i, n + 1] for n in range(3)] == [(j, d[j]) for j in best]


def test_block_rows_are_read_as_arrays():
    kind = pa.struct([("row_idx", pa.int64()), ("label_id", pa.int32()), ("bag", pa.list_(pa.int32()))])
    rows = pa.array([{"row_idx": i, "label_id": i % 2, "bag": [5, 1, 5][:i]} for i in range(4)], kind)
    assert [b.tolist() for b in ln._bags(rows.slice(1))] == [[5], [5, 1], [5, 1, 5]]
    x = ln.Features(ln._bags(rows), 8)
    row, cols, vals = x.part(np.array([3, 0, 2]))
    assert row.tolist() == [0, 0, 0, 1, 2, 2, 2] and cols.tolist() == [1, 5, 8, 8, 1, 5, 8]
    assert np.allclose(vals[:2], np.log1p([1, 2]) / np.linalg.norm(np.log1p([1, 2])))


def test_tokens_are_counted_where_their_text_is(spark):
    df = spark.createDataFrame([("w", "s", 1, "a b a"), ("w", "s", 1, "b c"), ("w", None, 2, "a")],
                               "workbook string, sheet string, row_idx bigint, text string")
    out = vc.tfidf(df, "text")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [p for p in re.findall(r"hashpartitioning\([^)]*\)", plan) if "row_idx" in p and "token" in p]
    assert sorted((r.row_idx, r.token) for r in out.collect()) == [(1, "a"), (1, "b"), (1, "c"), (2, "a")]


def test_summary_predicts_once(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = [("w", "s", i, i % 3, (i * i) % 3) for i in range(30)]

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    pred = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, label_id int, pred_id int")
    pred = pred.mapInPandas(count, pred.schema)
    split = spark.createDataFrame([("w", "s", "train"), ("w", "s", "test")], "workbook string, sheet string, split string")
    lmap = spark.createDataFrame([("w", "s", str(i), i) for i in range(3)], "workbook string, sheet string, label string, label_id int")
    out = cl.training_summary(split, pred, lmap).collect()
    hits = sum(r[3] == r[4] for r in rows)
    assert [(r.num_labels, r.accuracy, r.num_train_samples) for r in out] == [(3, hits / 30, 1)]
    assert seen.value == 30
