"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (runs of ``PASSAGE`` bytes of the whole
text). Each passage is encoded, gated attention weighs the passages of a
bag, and the weighted mean of their codes is scored:

    h = tanh(W f),  e = w.(tanh(V h) * sigmoid(U h)),  a = softmax(e),
    score = sigmoid(c.(sum a h) + b)

Only document labels are used; which passage is bad is learned. ``f`` are
counts of character classes and of repeated words, from the text alone.

The model is fitted on at most ``SAMPLE`` labelled documents (smallest hash
of the id) that are not held out.

Defined results: a null or empty text is one empty passage; a null label
takes no part; of several labels of one id the largest counts; with no
labelled row every score is the same; repeated rows give repeated rows; a
null id is held out; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import hash_sample, map_text

SAMPLE = 3000
PASSAGE = 384
#: Score from which the predicted label is 1.
THRESHOLD = 0.3
FOLDS = 5
CODE, GATE = 24, 16

_PUNCT = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASSES = 6 + len(_PUNCT)
FEATURES = _CLASSES + 4


def _class_table() -> np.ndarray:
    t = np.full(256, 5, np.int64)                 # not ASCII
    t[:128] = 4                                   # control
    for c in range(128):
        ch = chr(c)
        t[c] = 0 if ch.islower() else 1 if ch.isupper() else 2 if ch.isdigit() else 3 if c in (9, 10, 11, 12, 13, 32) else t[c]
    for i, c in enumerate(_PUNCT):
        t[c] = 6 + i
    return t


_CLASS = _class_table()


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages ``[n, FEATURES]`` and the number of passages of each text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") or b" " for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    count = -(-sizes // PASSAGE)
    flat = np.frombuffer(b"".join(raw), np.uint8)
    first = np.cumsum(count) - count
    start = np.cumsum(sizes) - sizes
    within = np.arange(len(flat)) - np.repeat(start, sizes)
    bag = np.repeat(first, sizes) + within // PASSAGE
    n = int(count.sum())
    cls = _CLASS[flat]
    hist = np.bincount(bag * _CLASSES + cls, minlength=n * _CLASSES).reshape(n, _CLASSES).astype(np.float64)
    length = hist.sum(axis=1)
    # words: runs without white space, told apart by length and by sums over their bytes
    blank = cls == 3
    head = ~blank & np.r_[True, blank[:-1] | (within[1:] == 0)]
    at = np.flatnonzero(head)
    f = np.zeros((n, 4))
    if len(at):
        value = np.where(blank, 0, flat.astype(np.int64))
        total = np.r_[0, np.cumsum(value)]
        twisted = np.r_[0, np.cumsum(value * value)]
        ends = np.r_[at[1:], len(flat)]
        chars = np.r_[0, np.cumsum(~blank)]
        size = chars[ends] - chars[at]
        key = ((total[ends] - total[at]) * 1_000_003 + (twisted[ends] - twisted[at])) * 64 + np.minimum(size, 63)
        same_bag = np.r_[False, bag[at][1:] == bag[at][:-1]]
        again = np.r_[False, key[1:] == key[:-1]] & same_bag
        words = np.maximum(np.bincount(bag[at], minlength=n), 1)
        f[:, 0] = np.bincount(bag[at], weights=again, minlength=n) / words
        f[:, 1] = np.bincount(bag[at], weights=size <= 1, minlength=n) / words
        f[:, 2] = np.log1p(np.bincount(bag[at], weights=size, minlength=n) / words)
    f[:, 3] = length / PASSAGE
    return np.c_[np.sqrt(hist / length[:, None]), f].astype(np.float32), count


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    c: np.ndarray
    b: float

    def forward(self, f: np.ndarray, count: np.ndarray):
        h = np.tanh(((f - self.mean) / self.scale) @ self.w1 + self.b1)
        t, g = np.tanh(h @ self.v), 1 / (1 + np.exp(-(h @ self.u)))
        e = (t * g) @ self.w
        first = np.cumsum(count) - count
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, first), count))
        a /= np.repeat(np.add.reduceat(a, first), count)
        z = np.add.reduceat(a[:, None] * h, first)
        return h, t, g, a, z, 1 / (1 + np.exp(-np.clip(z @ self.c + self.b, -40, 40)))

    def score(self, f: np.ndarray, count: np.ndarray) -> np.ndarray:
        return self.forward(f, count)[-1] if len(count) else np.zeros(0)


def fit(f: np.ndarray, count: np.ndarray, y: np.ndarray, steps: int = 150, rate: float = 0.02, l2: float = 1e-4,
        seed: int = 7) -> Model:
    """Adam on the mean log loss of the bags; the same input gives the same model."""
    rng = np.random.default_rng(seed)
    if not len(y):
        return Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros((FEATURES, CODE)), np.zeros(CODE), np.zeros((CODE, GATE)),
                     np.zeros((CODE, GATE)), np.zeros(GATE), np.zeros(CODE), 0.0)
    f = f.astype(np.float32)
    mean, scale = f.mean(axis=0), f.std(axis=0) + 1e-3
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    p = {"w1": rng.normal(0, FEATURES ** -0.5, (FEATURES, CODE)), "b1": np.zeros(CODE), "v": rng.normal(0, CODE ** -0.5, (CODE, GATE)),
         "u": rng.normal(0, CODE ** -0.5, (CODE, GATE)), "w": rng.normal(0, 0.1, GATE), "c": rng.normal(0, 0.1, CODE),
         "b": np.array(np.log(share / (1 - share)))}
    m, s = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    first, x = np.cumsum(count) - count, (f - mean) / scale
    for step in range(1, steps + 1):
        model = Model(mean, scale, **{k: x_ if k != "b" else float(x_) for k, x_ in p.items()})
        h, t, g, a, z, out = model.forward(f, count)
        ds = (out - y) / len(y)
        dz = np.repeat(ds[:, None] * p["c"], count, axis=0)
        da = (dz * h).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, first), count))
        dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ p["v"].T + dg @ p["u"].T) * (1 - h * h)
        grad = {"w1": x.T @ dh, "b1": dh.sum(axis=0), "v": h.T @ dt, "u": h.T @ dg, "w": (t * g).T @ de, "c": z.T @ ds, "b": ds.sum()}
        for k in p:
            d = grad[k] + (l2 * p[k] if k != "b" else 0)
            m[k] = 0.9 * m[k] + 0.1 * d
            s[k] = 0.999 * s[k] + 0.001 * d * d
            p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean, scale, **{k: x_ if k != "b" else float(x_) for k, x_ in p.items()})


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents that are not held out; the driver gets their passage features."""
    key = F.col(id_col).cast("bigint")
    picked = labels.where(F.col(label_col).isin(0, 1) & ~held_out(key)).groupBy(key.alias("__id")) \
        .agg(F.max(label_col).cast("int").alias("y"))
    picked = hash_sample(picked, "__id", sample)
    texts = docs.select(key.alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "__id").select("text", "y", "__id")

    def run(batches):
        for b in batches:
            f, count = passages(b.column(0).to_pylist())
            ends = np.cumsum(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[e - n:e].tobytes() for n, e in zip(count, ends, strict=True)], pa.binary()), b.column(1), b.column(2)],
                names=["f", "y", "id"])
    got = map_text(texts, run, "f binary, y int, id bigint").orderBy("id", "f").toArrow()
    rows = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for x in got["f"].to_pylist()]
    f = np.concatenate(rows) if rows else np.zeros((0, FEATURES))
    return fit(f, np.array([len(r) for r in rows], np.int64), got["y"].to_numpy().astype(np.float64))


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)        # a few thousand numbers

    def run(batches):
        for b in batches:
            f, count = passages(b.column(2).to_pylist())
            s = sent.value.score(f, count)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])
    key = F.col(id_col).cast("bigint")
    return map_text(docs.select(key.alias("doc_id"), held_out(key).alias("held_out"), F.col(text_col).alias("text")), run,
                    "doc_id bigint, held_out boolean, score double, predicted int")
