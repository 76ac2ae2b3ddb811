"""Linear classifiers of all groups in one run: softmax regression by iterative parameter mixing.

Train rows of a group are dealt into blocks of about ``BLOCK_ROWS``. In a
round every block starts from its group's weights, makes ``LOCAL_EPOCHS``
passes of mini-batch steps (Adam moments, warm-up, linear decline of the step
size, decoupled weight decay) and returns its weights; Spark averages them for
each group, weighted by rows, as a partial aggregate. A group of one block is
trained exactly as on one machine. A group whose loss has settled takes no
part in further rounds. The number of jobs depends on the rounds only, not
on the number of groups.

A row's features are its word tokens hashed into ``DIMS`` places, counts
damped by log(1 + n) and of unit length, and a constant.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions.text import word_tokens
from corpusprep.operators.joins import bounded_broadcast, join_by, null_safe_groups
from corpusprep.operators.labels import label_encode, label_map_sorted
from corpusprep.schema import ROW_IDX, SPLIT, TEST, TRAIN, group_cols
from corpusprep.session import scratch_path

DIMS = 1 << 12
BLOCK_ROWS = 4096
BATCH_ROWS = 16
ROUNDS = 4
LOCAL_EPOCHS = 5
STEP = 0.05
WARM_UP = 0.1
DECAY = 0.001
#: A group stops when a round changes its mean loss by less.
SETTLED = 1e-3
SEED = 42
BETAS, TINY = (0.9, 0.999), 1e-8


def _kept(rows: DataFrame, name: str) -> DataFrame:
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


# ------------------------------------------------------------------ in a block
class Features:
    """Hashed bags of a block's rows as compressed sparse rows of unit length, with a constant at place ``dims``."""

    def __init__(self, bags: Sequence[Sequence[int]], dims: int):
        cols, vals, ends = [], [], [0]
        for bag in bags:
            c, n = np.unique(np.asarray(bag, np.int64), return_counts=True)
            v = np.log1p(n)
            v = v / np.sqrt((v * v).sum()) if len(v) else v
            cols.append(np.append(c, dims))
            vals.append(np.append(v, 1.0))
            ends.append(ends[-1] + len(c) + 1)
        self.cols = np.concatenate(cols) if cols else np.zeros(0, np.int64)
        self.vals = np.concatenate(vals) if vals else np.zeros(0)
        self.ends = np.array(ends)

    def part(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers (from 0), places and values of the chosen rows."""
        size = self.ends[rows + 1] - self.ends[rows]
        at = np.arange(size.sum()) + np.repeat(self.ends[rows] - np.cumsum(size) + size, size)
        return np.repeat(np.arange(len(rows)), size), self.cols[at], self.vals[at]


def _bags(rows: pa.StructArray) -> list[np.ndarray]:
    bag = rows.field("bag")
    return np.split(bag.flatten().to_numpy(), np.cumsum(bag.value_lengths().to_numpy())[:-1]) if len(bag) else []


def _added(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Matrix of ``n`` rows: the rows of ``values`` added up, one after the other, at their places."""
    k = values.shape[1]
    return np.bincount((at[:, None] * k + np.arange(k)).ravel(), weights=values.ravel(), minlength=n * k).reshape(n, k)


def probabilities(w: np.ndarray, row: np.ndarray, cols: np.ndarray, vals: np.ndarray, n: int) -> np.ndarray:
    z = _added(row, w[cols] * vals[:, None], n)
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train_block(x: Features, y: np.ndarray, w: np.ndarray, first_epoch: int, epochs: int, all_epochs: int, seed: int) -> np.ndarray:
    """Weights after ``epochs`` passes; the step size follows the schedule of ``all_epochs``."""
    w, m, s = w.copy(), np.zeros_like(w), np.zeros_like(w)
    change, root = np.empty_like(w), np.empty_like(w)
    batches = -(-len(y) // BATCH_ROWS)
    total = batches * all_epochs
    warm = max(1, int(WARM_UP * total))
    done = 0
    for e in range(first_epoch, first_epoch + epochs):
        order = np.random.default_rng([seed, e]).permutation(len(y))
        every, all_cols, all_vals = x.part(order)
        cuts = np.searchsorted(every, np.arange(batches + 1) * BATCH_ROWS)
        for b in range(batches):
            rows = order[b * BATCH_ROWS:(b + 1) * BATCH_ROWS]
            here = slice(cuts[b], cuts[b + 1])
            row, cols, vals = every[here] - b * BATCH_ROWS, all_cols[here], all_vals[here]
            p = probabilities(w, row, cols, vals, len(rows))
            p[np.arange(len(rows)), y[rows]] -= 1
            g = _added(cols, p[row] * (vals / len(rows))[:, None], len(w))
            at = e * batches + b + 1
            done += 1
            step = STEP * min(at / warm, max(0.0, (total - at + 1) / max(1, total - warm)))
            # m = b0 * m + (1 - b0) * g and s = b1 * s + (1 - b1) * g * g, in place
            m *= BETAS[0]
            m += np.multiply(g, 1 - BETAS[0], out=change)
            np.multiply(g, 1 - BETAS[1], out=change)
            change *= g
            s *= BETAS[1]
            s += change
            # w -= step * (m' / (sqrt(s') + tiny) + decay * w)
            np.sqrt(np.divide(s, 1 - BETAS[1] ** done, out=root), out=root)
            root += TINY
            np.divide(m, 1 - BETAS[0] ** done, out=change)
            change /= root
            change += np.multiply(w, DECAY, out=root)
            change *= step
            w -= change
    return w


def mean_loss(x: Features, y: np.ndarray, w: np.ndarray) -> float:
    row, cols, vals = x.part(np.arange(len(y)))
    p = probabilities(w, row, cols, vals, len(y))
    return float(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).mean())


# ------------------------------------------------------------------ over groups
def _blocks(rows: DataFrame, text: str, by: list[str], extra: list[str], dims: int, block_rows: int) -> DataFrame:
    """``by, slice, rows``: blocks of ``(row_idx, *extra, bag)``, about ``block_rows`` rows each."""
    bag = F.transform(word_tokens(F.col(text)), lambda t: F.pmod(F.xxhash64(t), F.lit(dims)).cast("int"))
    bags = rows.select(*by, ROW_IDX, *extra, F.coalesce(bag, F.array().cast("array<int>")).alias("bag"))
    sizes, small = bounded_broadcast(rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("__n")))
    dealt = join_by(bags, sizes, by, broadcast=small)
    return dealt.groupBy(*by, F.pmod(F.xxhash64(ROW_IDX), "__n").cast("int").alias("slice")).agg(
        F.sort_array(F.collect_list(F.struct(ROW_IDX, *extra, "bag"))).alias("rows"))


@null_safe_groups
def softmax_fit(split_df: DataFrame, text: str, label: str, by: Sequence[str] | None = None, dims: int = DIMS,
                rounds: int = ROUNDS, local_epochs: int = LOCAL_EPOCHS, block_rows: int = BLOCK_ROWS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """``(models, label map)``: ``by, labels, weights array<double>, loss, rounds`` for each group with train rows.

    ``weights`` is the flat matrix of ``dims + 1`` places by ``labels``
    classes (the order of the label map's ids). Rows without a label are left out.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    by = group_cols(by)
    lmap = label_map_sorted(split_df, label, by)
    train = label_encode(split_df.where(F.col(SPLIT) == TRAIN), lmap, label, by).where(F.col("label_id") >= 0)
    counts = lmap.groupBy(*by).agg(F.count(F.lit(1)).cast("int").alias("labels"))
    blocks = _kept(join_by(_blocks(train, text, by, ["label_id"], dims, block_rows), counts, by), "linear-blocks")
    out = T.StructType([*[blocks.schema[c] for c in by], T.StructField("labels", T.IntegerType()), T.StructField("n", T.LongType()),
                        T.StructField("loss", T.DoubleType()), T.StructField("weights", T.ArrayType(T.DoubleType()))])
    names = [f.name for f in out]

    def round_of(nth: int):
        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    b = batch.slice(i, 1)
                    r = {c: b.column(b.schema.get_field_index(c))[0] for c in ("slice", "labels", "rows", "weights")}
                    rows, labels = r["rows"].values, r["labels"].as_py()
                    y = rows.field("label_id").to_numpy()
                    w = r["weights"].values
                    w = np.zeros((dims + 1, labels)) if w is None else w.to_numpy().reshape(dims + 1, labels)
                    x = Features(_bags(rows), dims)
                    loss = mean_loss(x, y, w)
                    w = train_block(x, y, w, nth * local_epochs, local_epochs, rounds * local_epochs, seed + r["slice"].as_py())
                    cols = [b.column(b.schema.get_field_index(c)) for c in by]
                    flat = pa.ListArray.from_arrays(pa.array([0, w.size], pa.int32()), pa.array(w.ravel()))
                    yield pa.RecordBatch.from_arrays([*cols, pa.array([labels], pa.int32()), pa.array([len(y)], pa.int64()),
                                                      pa.array([loss]), flat], names=names)
        return run

    models = None
    for nth in range(rounds):
        if models is None:
            work = blocks.withColumn("weights", F.lit(None).cast("array<double>"))
        else:
            # one weight matrix for each block of an open group
            work = join_by(blocks, models.where("open").select(*by, "weights"), by)
        mixed = work.mapInArrow(round_of(nth), out).groupBy(*by, "labels").agg(
            Summarizer.mean(array_to_vector("weights"), F.col("n").cast("double")).alias("w"),
            (F.sum(F.col("loss") * F.col("n")) / F.sum("n")).alias("loss"))
        new = mixed.select(*by, "labels", vector_to_array("w").alias("weights"), "loss", F.lit(nth + 1).alias("rounds"))
        if models is None:
            models = _kept(new.withColumn("open", F.lit(True)), "linear-models")
            continue
        old = models.select(*by, "labels", F.col("weights").alias("w0"), F.col("loss").alias("l0"), F.col("rounds").alias("r0"))
        models = _kept(join_by(old, new.drop("labels"), by, "left").select(
            *by, "labels", F.coalesce("weights", "w0").alias("weights"), F.coalesce("loss", "l0").alias("loss"),
            F.coalesce("rounds", "r0").alias("rounds"),
            F.coalesce(F.abs(F.col("loss") - F.col("l0")) >= SETTLED, F.lit(False)).alias("open")), "linear-models")
        if not models.where("open").limit(1).count():
            break
    return models.drop("open"), lmap


@null_safe_groups
def softmax_predict(rows: DataFrame, models: DataFrame, text: str, by: Sequence[str] | None = None, dims: int = DIMS,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``by, row_idx, pred_id, confidence`` for the rows of groups that have a model; ties go to the smaller id."""
    by = group_cols(by)
    work = join_by(_blocks(rows, text, by, [], dims, block_rows), models.select(*by, "labels", "weights"), by)
    out = T.StructType([*[work.schema[c] for c in by], T.StructField(ROW_IDX, T.LongType()), T.StructField("pred_id", T.IntegerType()),
                        T.StructField("confidence", T.DoubleType())])
    names = [f.name for f in out]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                b = batch.slice(i, 1)
                part = b.column(b.schema.get_field_index("rows"))[0].values
                labels = b.column(b.schema.get_field_index("labels"))[0].as_py()
                w = b.column(b.schema.get_field_index("weights"))[0].values.to_numpy().reshape(dims + 1, labels)
                x = Features(_bags(part), dims)
                p = probabilities(w, *x.part(np.arange(len(part))), len(part))
                keys = [b.column(b.schema.get_field_index(c)).take(pa.array(np.zeros(len(part), np.int64))) for c in by]
                yield pa.RecordBatch.from_arrays([*keys, part.field(ROW_IDX).cast(pa.int64()),
                                                  pa.array(p.argmax(axis=1).astype(np.int32)), pa.array(p.max(axis=1))], names=names)
    return work.mapInArrow(run, out)


@null_safe_groups
def softmax_evaluate(split_df: DataFrame, text: str, label: str, by: Sequence[str] | None = None, **kw) -> DataFrame:
    """Fit on the train rows, predict the test rows of every group: ``by, row_idx, label_id, pred_id, confidence``."""
    by = group_cols(by)
    models, lmap = softmax_fit(split_df, text, label, by, **kw)
    test = split_df.where(F.col(SPLIT) == TEST)
    pred = softmax_predict(test, models, text, by, **{k: v for k, v in kw.items() if k in ("dims", "block_rows")})
    actual = label_encode(test.select(*by, ROW_IDX, label), lmap, label, by)
    return join_by(actual, pred, [*by, ROW_IDX]).select(*by, ROW_IDX, "label_id", "pred_id", "confidence")
