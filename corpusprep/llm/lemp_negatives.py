"""Hard-negative mining: LEMP-style coordinate pruning, exact verification.

Vectors are sorted by length and cut into buckets; a bucket holds, for each
coordinate, the order of its vectors by that coordinate of their unit vector.
For an anchor and the score it still needs, a bucket asks for cosine
``t = needed / (length of the anchor * greatest length in the bucket)``: over
1 the bucket is skipped; otherwise the unit value ``x`` of each focus
coordinate (the anchor's largest) leaves a feasible range for the vector's
own value, ``cos(acos x + acos t) .. cos(max(0, acos x - acos t))``, read
from the sorted list by binary search. Vectors that stand in all the ranges
are verified by their exact integer product. Needed scores rise while the
k best of a bucket stream are known, and long buckets come first.

Anchors go in groups, buckets in stripes: a task streams one stripe past one
group and returns at most k rows for each anchor and score interval, so what
leaves it does not grow with the number of vectors. Buckets too short for
every anchor of a group are not sent to it.

Defined results: rows without label, with a null vector or a null or
non-finite component take no part; vectors meet those of their own
length of array only; rows that share an id are rows of their own, but never
each other's positives; a null id is no anchor and stands after the others of its
score; components whose code is beyond a long are held at its ends, and a score
beyond a long raises; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import map_text, slices, written

#: Fixed values of the mining rule.
SCALE, SHIFT_EVERY, LABELS, ANCHOR_EVERY = 256, 7, 10, 100
POSITIVES, NEGATIVES = 5, 10
LOW_SHARE, HIGH_SHARE, OF = 30, 90, 100

BUCKET_ROWS = 2048
GROUP_ANCHORS = 1024
STRIPES = 32
FOCUS = 5
#: Ranges are widened by this much, so that rounding loses no vector.
SLACK = 1e-9
#: Stands for a null id in order; such rows come after all others of their score.
NO_ID = (1 << 63) - 1
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def prepared(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """``row, id, label, codes, length, dim`` of the rows that take part, written."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                          F.col(vector_col).alias("vector")) \
        .where(F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", finite))
    shifted = F.when(F.col("id") % SHIFT_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    coded = rows.select("id", shifted.alias("label"), F.transform("vector", lambda x: F.floor(x.cast("double") * SCALE)).alias("codes"))
    squares = F.aggregate("codes", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return written(coded.select(F.monotonically_increasing_id().alias("row"), "*", F.sqrt(squares).alias("length"),
                                F.size("codes").alias("dim")), "neg-rows")


def _product_type(largest: int, dim: int) -> np.dtype:
    """The type in which every product of two vectors is exact: doubles, longs, or Python integers."""
    reach = max(1, dim) * largest * largest
    return np.dtype(np.float64 if reach < 1 << 53 else np.int64 if reach < 1 << 62 else object)


_BUCKET = pa.schema([("bucket", pa.int64()), ("top", pa.float64()), ("ids", pa.binary()), ("labels", pa.binary()),
                     ("codes", pa.binary()), ("orders", pa.binary())])
_BUCKET_DDL = "bucket bigint, top double, ids binary, labels binary, codes binary, orders binary"


def _units(codes: np.ndarray) -> np.ndarray:
    v = codes.astype(np.float64)
    n = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.where(n > 0, n, 1)


def _buckets(rows: DataFrame, dim: int, bucket_rows: int) -> DataFrame:
    """Length buckets, longest first, with their sorted coordinate lists, written."""
    parts = -(-rows.count() // bucket_rows) or 1
    ordered = rows.select(F.col("length"), F.coalesce("id", F.lit(NO_ID)).alias("id"), "label", "codes", "row") \
        .repartitionByRange(parts, F.desc("length"), F.asc("id"), F.asc("row")).sortWithinPartitions(F.desc("length"), "id", "row") \
        .select("length", "id", "label", "codes", F.spark_partition_id().alias("part"))

    def bucket(part, nth, held):
        length, ids, labels = (np.concatenate([h[i] for h in held]) for i in range(3))
        codes = np.concatenate([h[3] for h in held])
        orders = np.argsort(_units(codes), axis=0, kind="stable").T.astype("<u4")
        return pa.RecordBatch.from_pylist([{
            "bucket": part << 32 | nth, "top": float(length[0]), "ids": ids.astype("<i8").tobytes(), "labels": labels.astype("<i8").tobytes(),
            "codes": codes.astype("<i8").tobytes(), "orders": orders.tobytes()}], _BUCKET)

    def cut(batches):
        held, n, nth, part = [], 0, 0, 0
        for b in batches:
            part = b.column(4)[0].as_py()
            row = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            row.append(b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim))
            while len(row[0]):
                take = min(bucket_rows - n, len(row[0]))
                held.append([x[:take] for x in row])
                row, n = [x[take:] for x in row], n + take
                if n == bucket_rows:
                    yield bucket(part, nth, held)
                    held, nth, n = [], nth + 1, 0
        if held:
            yield bucket(part, nth, held)
    return written(map_text(ordered, cut, _BUCKET_DDL), "neg-buckets")


class _Bucket:
    def __init__(self, r: dict, dim: int, type_: np.dtype):
        self.top = r["top"]
        self.ids, self.labels = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["labels"], "<i8")
        codes = np.frombuffer(r["codes"], "<i8").reshape(len(self.ids), dim)
        self.codes = codes.astype(type_)
        self.orders = np.frombuffer(r["orders"], "<u4").reshape(dim, len(self.ids))
        self.lists = np.take_along_axis(_units(codes).T, self.orders.astype(np.int64), axis=1)

    def feasible(self, unit: np.ndarray, focus: np.ndarray, t: float) -> np.ndarray | None:
        """Vectors whose focus coordinates all lie in their ranges; None for all of them."""
        if t <= -1 or not len(focus):
            return None
        hits, asked = np.zeros(len(self.ids), np.int16), 0
        for f in focus:
            turn, open_ = np.arccos(np.clip(unit[f], -1, 1)), np.arccos(min(t, 1.0))
            lo, hi = np.cos(min(np.pi, turn + open_)) - SLACK, np.cos(max(0.0, turn - open_)) + SLACK
            i, j = np.searchsorted(self.lists[f], lo, "left"), np.searchsorted(self.lists[f], hi, "right")
            if j - i < len(self.ids):              # a range that holds the whole list asks nothing
                hits[self.orders[f, i:j]] += 1
                asked += 1
        return np.flatnonzero(hits == asked) if asked else None


class _Anchor:
    """One anchor: its score intervals and the best rows of each so far."""

    def __init__(self, r: dict, type_: np.dtype, k: int, same_label: bool, focus: int):
        codes = np.array(r["codes"], np.int64)
        self.row, self.id, self.label, self.k, self.same = r["row"], r["id"], r["label"], k, same_label
        self.codes, self.length = codes.astype(type_), r["length"]
        self.unit = _units(codes[None])[0]
        self.focus = np.argsort(-np.abs(self.unit), kind="stable")[:focus]
        self.low, self.high = list(r["low"]), list(r["high"])
        none = np.zeros(0, np.int64)
        self.best = [(none, none)] * len(self.low)

    def needed(self, j: int) -> int:
        scores = self.best[j][0]
        return max(self.low[j], int(scores[-1])) if len(scores) == self.k else self.low[j]

    def meet(self, b: _Bucket) -> int:
        """Look for better rows in a bucket; how many were verified."""
        asked = [j for j in range(len(self.low)) if self.low[j] <= self.high[j]]
        if not asked:
            return 0
        least = min(map(self.needed, asked))
        reach = self.length * b.top
        if least > reach * (1 + SLACK):
            return 0
        cand = None
        if least > 0:                              # shorter vectors of the bucket need a greater cosine still
            cand = b.feasible(self.unit, self.focus, least / reach - SLACK)
        codes, ids, labels = (b.codes, b.ids, b.labels) if cand is None else (b.codes[cand], b.ids[cand], b.labels[cand])
        scores = codes @ self.codes
        scores = scores.astype(np.int64)
        ok = (labels == self.label) & (ids != self.id) if self.same else labels != self.label
        for j in asked:
            pick = np.flatnonzero(ok & (scores >= self.needed(j)) & (scores <= self.high[j]))
            if len(pick):
                s, i = np.r_[self.best[j][0], scores[pick]], np.r_[self.best[j][1], ids[pick]]
                first = np.lexsort((i, -s))[:self.k]
                self.best[j] = s[first], i[first]
        return len(ids)


def best_rows(anchors: DataFrame, buckets: DataFrame, dim: int, type_: np.dtype, k: int, same_label: bool,
              group_anchors: int = GROUP_ANCHORS, stripes: int = STRIPES, focus: int = FOCUS) -> DataFrame:
    """``row, place, score, id, rank``: the first ``k`` rows of each interval (``place`` from 0) of each anchor.

    ``anchors``: ``row, id, label, codes, length, low array<bigint>, high array<bigint>``.
    """
    spark = anchors.sparkSession
    groups = -(-anchors.count() // group_anchors) or 1
    anchors = anchors.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    # the cosine that the least demanding anchor of a group needs for a bucket of length 1
    live = anchors.select("group", "length", F.explode(F.filter(F.arrays_zip("low", "high"), lambda x: x["low"] <= x["high"])).alias("x"))
    reach = live.groupBy("group").agg(F.min(F.when(F.col("x.low") <= 0, 0.0).otherwise(F.col("x.low") / F.col("length"))).alias("least"))
    numbered = buckets.select("bucket", "top", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("group")) \
        .join(reach, "group").where(F.col("top") * (1 + SLACK) >= F.col("least")).select("bucket", "group")
    stripe = F.pmod(F.xxhash64("bucket"), F.lit(stripes)).cast("int").alias("stripe")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    anchor_cols = {"row": "bigint", "id": "bigint", "label": "bigint", "codes": "array<bigint>", "length": "double",
                   "low": "array<bigint>", "high": "array<bigint>"}
    bucket_cols = {"top": "double", "ids": "binary", "labels": "binary", "vectors": "binary", "orders": "binary"}
    stream = anchors.select("group", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), F.lit(-1).cast("bigint").alias("nth"),
                            *anchor_cols, *[none(t, c) for c, t in bucket_cols.items()]) \
        .unionByName(buckets.withColumnRenamed("codes", "vectors").join(numbered, "bucket")
                     .select("group", stripe, F.col("bucket").alias("nth"), *[none(t, c) for c, t in anchor_cols.items()], *bucket_cols))
    ordered = stream.repartition(groups * stripes, "group", "stripe").sortWithinPartitions("group", "stripe", "nth")
    out = pa.schema([("row", pa.int64()), ("place", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])

    def found(held):
        for a in held:
            for j, (s, i) in enumerate(a.best):
                if len(s):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), a.row)), pa.array(np.full(len(s), j, np.int32)),
                                                      pa.array(s), pa.array(i)], schema=out)

    def run(batches):
        held, at = [], None
        for b in slices(batches, 16):
            for r in b.to_pylist():
                if (r["group"], r["stripe"]) != at:
                    yield from found(held)
                    held, at = [], (r["group"], r["stripe"])
                if r["nth"] < 0:
                    held.append(_Anchor(r, type_, k, same_label, focus))
                elif held:
                    bucket = _Bucket({**r, "codes": r["vectors"]}, dim, type_)
                    for a in held:
                        a.meet(bucket)
        yield from found(held)
    hits = ordered.mapInArrow(run, "row bigint, place int, score bigint, id bigint")
    rank = F.row_number().over(Window.partitionBy("row", "place").orderBy(F.desc("score"), "id")).alias("rank")
    return hits.select("*", rank).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                   bucket_rows: int = BUCKET_ROWS, group_anchors: int = GROUP_ANCHORS, stripes: int = STRIPES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    spark = vectors.sparkSession
    rows = prepared(vectors, id_col, label_col, vector_col)
    out = None
    sizes = rows.groupBy("dim").agg(F.max(F.array_max(F.transform("codes", F.abs))).alias("largest")).collect()
    for r in sizes:                                # one pass for each length of array; as a rule there is one
        of = rows.where(F.col("dim") == r["dim"])
        type_ = _product_type(r["largest"] or 0, r["dim"])
        buckets = _buckets(of, r["dim"], bucket_rows)
        anchors = of.where(F.col("id") % ANCHOR_EVERY == 0).select("row", "id", "label", "codes", "length")
        whole = anchors.withColumn("low", F.array(F.lit(LEAST))).withColumn("high", F.array(F.lit(MOST)))
        search = {"dim": r["dim"], "type_": type_, "group_anchors": group_anchors, "stripes": stripes}
        near = best_rows(whole, buckets, k=POSITIVES, same_label=True, **search).groupBy("row") \
            .agg(F.sort_array(F.collect_list(F.struct("rank", "score", "id"))).alias("near"))
        # 30 p <= 100 n <= 90 p in whole numbers; a negative p leaves nothing between
        low = F.expr(f"transform(near, x -> IF(x.score < 0, 1L, (cast(x.score as decimal(20)) * {LOW_SHARE} + {OF - 1}) div {OF}))")
        high = F.expr(f"transform(near, x -> IF(x.score < 0, 0L, (cast(x.score as decimal(20)) * {HIGH_SHARE}) div {OF}))")
        asked = written(anchors.join(near, "row").withColumn("low", low).withColumn("high", high), "neg-asked")
        hits = best_rows(asked.drop("near"), buckets, k=NEGATIVES, same_label=False, **search)
        named = hits.join(asked.select("row", F.col("id").alias("anchor_id"), "near"), "row") \
            .withColumn("positive", F.element_at("near", F.col("place") + 1))
        no_id = lambda c: F.when(c != NO_ID, c)
        got = named.select("anchor_id", no_id(F.col("positive.id")).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                           no_id(F.col("id")).alias("negative_id"), F.col("positive.score").alias("positive_score"),
                           F.col("score").alias("negative_score"))
        out = got if out is None else out.unionByName(got)
    return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
                                     "negative_score bigint") if out is None else out
