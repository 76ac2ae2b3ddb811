"""Toxicity: cumulative-link ordinal regression over sparse text features.

Grades 0..K-1 are ordered; one weight vector is shared by all thresholds:
P(grade >= j) = sigmoid(w.x - b_j) with b_1 <= b_2 <= ... The expected
severity is the sum of these probabilities.

Features are words (runs of letters, lower case) and the first four and five
letters of longer words, each present or not in the whole text. Those that
are told apart by the labels (chi-square of presence, over the sample) enter
the model.

The model is fitted on at most ``SAMPLE`` labelled documents (smallest hash
of the id). ``labels`` say only toxic or not, so grades are made from them: a
document that is not toxic is 0, a toxic one 1, or 2 if it holds more
indicator features than the median of the toxic ones.

Defined results: a null or empty text has no features and so the severity of
the intercepts alone; a null or missing label takes no part in the fit; with
one class only (or no labelled rows) nothing is toxic; repeated rows give
repeated rows; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import Memo, hash_sample, map_text, written

#: Labelled documents the model is fitted on, at most.
SAMPLE = 12_000
#: Features the model holds, at most, and the chi-square from which one enters.
FEATURES = 8192
MIN_CHI2 = 15.0
#: Features are hashed to so many slots.
SLOTS = 1 << 22
#: A document is rejected from this probability of being toxic at all.
REJECT = 0.5
#: Chunks a worker remembers, in each of two generations.
MEMO = 150_000

_LETTERS = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    """Names of the features of one lower-case word."""
    out = [word]
    if len(word) > 4:
        out.append("^" + word[:4])
    if len(word) > 5:
        out.append("^" + word[:5])
    return out


def slot(feature: str) -> int:
    """A hash that is the same in every process (FNV-1a)."""
    h = 0xCBF29CE484222325
    for c in feature.encode("utf-8", "surrogatepass"):
        h = (h ^ c) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return (h ^ h >> 32) % SLOTS


class Slots:
    """Slots of the features of a chunk (a text between white space), remembered."""

    def __init__(self, known: frozenset[int] | None = None):
        self.known, self.memo = known, Memo(MEMO)

    def _of(self, chunk: str) -> tuple[int, ...]:
        found = {slot(f) for w in _LETTERS.findall(chunk) for f in features_of(w)}
        return tuple(found if self.known is None else found & self.known)

    def text(self, text: str | None) -> set[int]:
        chunks = set((text or "").lower().split())
        for c in self.memo.unknown(chunks):
            self.memo.known[c] = self._of(c)
        return set().union(*map(self.memo.known.__getitem__, chunks))


@dataclass(frozen=True)
class Model:
    slots: np.ndarray       # sorted
    weights: np.ndarray
    cuts: np.ndarray        # ascending, one for each grade above 0

    def at_least(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - x[:, None], -40, 40)))


def fit(rows: list[np.ndarray], grades: np.ndarray, k: int, features: int = FEATURES, min_chi2: float = MIN_CHI2,
        l2: float = 0.2, steps: int = 400, rate: float = 0.1) -> Model:
    """Fit on present slots and grades 0..k-1 (Adam on the ordinal likelihood; cuts kept ordered by their gaps)."""
    n = len(rows)
    flat = np.concatenate(rows) if n else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(n), [len(r) for r in rows])
    names, col = np.unique(flat, return_inverse=True)
    hot = grades > 0
    a = np.bincount(col, weights=hot[doc], minlength=len(names))
    both = np.bincount(col, minlength=len(names)).astype(float)
    pos = float(hot.sum())
    chi = np.zeros(len(names))
    if 0 < pos < n:
        d = both * (n - both) * pos * (n - pos)
        chi = np.where(d > 0, n * (a * n - both * pos) ** 2 / np.maximum(d, 1e-9), 0)
    best = np.flatnonzero((chi >= min_chi2) & (both >= 3))
    best = np.sort(best[np.argsort(-chi[best], kind="stable")[:features]])
    place = np.full(len(names), -1)
    place[best] = np.arange(len(best))
    use = place[col] >= 0
    doc, col = doc[use], place[col[use]]
    w = np.zeros(len(best))
    # cut 1 and the logarithms of the gaps to the next ones
    share = [np.clip((grades >= j).mean() if n else 0, 1e-3, 1 - 1e-3) for j in range(1, k)]
    first = float(-np.log(share[0] / (1 - share[0])))
    gaps = np.log(np.maximum(np.diff([-np.log(s / (1 - s)) for s in share]), 0.05))
    theta = np.r_[w, first, gaps]
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    if not 0 < pos < n:
        return Model(names[best], w, np.full(k - 1, 40.0) + np.arange(k - 1))
    y = grades[:, None] >= np.arange(1, k)[None, :]          # cumulative targets
    for t in range(1, steps + 1):
        w, cuts = theta[:len(best)], theta[len(best)] + np.r_[0, np.cumsum(np.exp(theta[len(best) + 1:]))]
        x = np.bincount(doc, weights=w[col], minlength=n)
        g = 1 / (1 + np.exp(np.clip(cuts[None, :] - x[:, None], -40, 40)))     # P(grade >= j)
        upper, lower = np.c_[np.ones(n), g], np.c_[g, np.zeros(n)]             # P(grade = j) = upper - lower
        r = np.arange(n)
        up, lo = upper[r, grades], lower[r, grades]
        p = np.maximum(up - lo, 1e-9)
        # d log p / d (x - cut): slope of the upper and lower link
        su, sl = up * (1 - up) / p, lo * (1 - lo) / p
        gx = -(su - sl)
        gc = np.zeros(k - 1)
        np.add.at(gc, np.maximum(grades - 1, 0), np.where(grades > 0, su, 0))
        np.add.at(gc, np.minimum(grades, k - 2), np.where(grades < k - 1, -sl, 0))
        tail = np.cumsum(gc[::-1])[::-1] / n
        grad = np.r_[np.bincount(col, weights=gx[doc], minlength=len(best)) / n + l2 / n * w,
                     tail[0], tail[1:] * np.exp(theta[len(best) + 1:])]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad ** 2
        theta = theta - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    w, cuts = theta[:len(best)], theta[len(best)] + np.r_[0, np.cumsum(np.exp(theta[len(best) + 1:]))]
    return Model(names[best], w, cuts)


def severity_grades(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Grades 0, 1, 2 of the sample: see the module text."""
    found = fit(rows, toxic.astype(np.int64), 2, steps=1)
    hits = np.array([np.isin(r, found.slots, assume_unique=True).sum() for r in rows], float)
    middle = np.median(hits[toxic > 0]) if (toxic > 0).any() else 0.0
    return np.where(toxic > 0, 1 + (hits > middle), 0).astype(np.int64)


def telling_slots(sampled: DataFrame, features: int = FEATURES, min_chi2: float = MIN_CHI2) -> list[int]:
    """Slots of ``sampled(slots, y)`` that the label tells apart, counted in Spark; at most ``features``."""
    all_ = sampled.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("pos")).first()
    n, pos = float(all_["n"]), float(all_["pos"])
    if not 0 < pos < n:
        return []
    c = sampled.select(F.explode("slots").alias("slot"), "y").groupBy("slot") \
        .agg(F.count(F.lit(1)).cast("double").alias("both"), F.sum("y").cast("double").alias("a")).where("both >= 3")
    apart = F.col("both") * (n - F.col("both")) * pos * (n - pos)
    chi = F.when(apart > 0, n * F.pow(F.col("a") * n - F.col("both") * pos, 2) / apart).otherwise(F.lit(0.0))
    best = c.withColumn("chi", chi).where(F.col("chi") >= min_chi2).orderBy(F.desc("chi"), "slot").limit(features)
    return [r["slot"] for r in best.select("slot").collect()]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents; the driver gets their telling slots only."""
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).cast("bigint").alias("__id")) \
        .agg(F.max(label_col).cast("int").alias("y"))
    picked = hash_sample(known, "__id", sample)
    texts = docs.select(F.col(id_col).cast("bigint").alias("__id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(picked), "__id").select("text", "y", "__id")

    def run(batches):
        slots = Slots()
        for b in batches:
            sets = [sorted(slots.text(t)) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.list_(pa.int32())), b.column(1), b.column(2)], names=["slots", "y", "id"])
    sampled = written(map_text(texts, run, "slots array<int>, y int, id bigint"), "toxicity-sample")
    chosen = np.array(sorted(telling_slots(sampled)), np.int32)

    def keep(batches):
        for b in batches:
            sets = [np.intersect1d(np.array(s, np.int32), chosen, assume_unique=True).tolist() for s in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.list_(pa.int32())), b.column(1), b.column(2)], names=["slots", "y", "id"])
    got = map_text(sampled, keep, "slots array<int>, y int, id bigint").orderBy("id", "slots").toArrow()
    rows = [np.array(s, np.int64) for s in got["slots"].to_pylist()]
    toxic = got["y"].to_numpy().astype(np.int64)
    return fit(rows, severity_grades(rows, toxic), 3)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """``doc_id, expected_severity, p_toxic, grade, toxic`` for every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)       # at most FEATURES weights

    def run(batches):
        m = sent.value
        weight = dict(zip(m.slots.tolist(), m.weights.tolist(), strict=True))
        slots = Slots(frozenset(weight))
        for b in batches:
            x = np.array([sum(weight[s] for s in sorted(slots.text(t))) for t in b.column(1).to_pylist()], float)
            p = m.at_least(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array((p >= reject).sum(axis=1).astype(np.int32)),
                 pa.array(p[:, 0] >= reject)], names=["doc_id", "expected_severity", "p_toxic", "grade", "toxic"])
    return map_text(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")), run,
                    "doc_id bigint, expected_severity double, p_toxic double, grade int, toxic boolean")


def grade_toxicity(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    return score(docs, train(docs, labels, **kw))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """``docs`` without the rows the model rejects; all columns unchanged, no join."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        m = sent.value
        weight = dict(zip(m.slots.tolist(), m.weights.tolist(), strict=True))
        slots = Slots(frozenset(weight))
        for b in batches:
            x = np.array([sum(weight[s] for s in sorted(slots.text(t))) for t in b.column(at).to_pylist()], float)
            yield b.filter(pa.array(m.at_least(x)[:, 0] < reject))
    return map_text(docs, run, docs.schema)
