"""Train/test leakage: exact and near duplicates, totals and the gate.

Input is a split corpus (``split`` column) with one text column, usually the
tagged text. Checks compare rows of one group only (``scope='sheet'``); a
wider scope is a shorter ``by`` list.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusprep.functions import similarity as sim
from corpusprep.operators.joins import bounded_broadcast, cpu_partitions, join_by, null_safe_groups, reuse
from corpusprep.operators.ranking import DEFAULT_SEED, shuffle_key
from corpusprep.schema import SPLIT, TEST, TRAIN, group_cols

# Similarity threshold, fail threshold, sample count.
SIMILARITY_THRESHOLD = 0.9
FAIL_THRESHOLD = 0.01
SAMPLE_PAIRS = 5
# Texts (and their characters) per slice inside one (group, length bucket); hot
# buckets are salted into several slices so no task holds all pairs of a bucket.
SALT_ROWS = 2000
SALT_CHARS = 8 << 20
# The same where only character counts travel.
SALT_COUNTS = 3000
# Tasks per slot over the cells, whose work differs much.
CELL_TASKS = 16

# Slack on float bounds so that a pair exactly at the threshold is never cut.
EPS = 1e-9

SCOPES = {"sheet": ["workbook", "sheet"], "workbook": ["workbook"], "corpus": []}


def scope_cols(scope: str) -> list[str]:
    if scope not in SCOPES:
        raise ValueError(f"unknown scope {scope!r}")
    return list(SCOPES[scope])


# --------------------------------------------------------------------------
# exact duplicates
# --------------------------------------------------------------------------
def text_sides(split_df: DataFrame, text: str, by: Sequence[str] | None = None) -> DataFrame:
    """One row per (group, text) with flags for presence in each split.

    A text that repeats a third of all rows is pre-aggregated map side
    (``bool_or`` is partial), so the hot key costs one row per task.
    """
    by = group_cols(by)
    return split_df.groupBy(*by, text).agg(
        F.bool_or(F.col(SPLIT) == TRAIN).alias("in_train"),
        F.bool_or(F.col(SPLIT) == TEST).alias("in_test"),
    )


def exact_duplicates(split_df: DataFrame, text: str, by: Sequence[str] | None = None) -> DataFrame:
    """Number of distinct texts found in both splits, per group.

    Texts are keyed by ``md5(text)``, so the shuffle carries 32 characters
    per distinct text and task instead of whole texts."""
    by = group_cols(by)
    return _shared_ids(_text_ids(split_df, text, by), by)


def _text_ids(split_df: DataFrame, text: str, by: list[str]) -> DataFrame:
    return split_df.select(*by, SPLIT, F.md5(F.col(text)).alias("__tid"))


def _shared_ids(ids: DataFrame, by: list[str]) -> DataFrame:
    return text_sides(ids, "__tid", by).groupBy(*by).agg(
        F.count_if(F.col("in_train") & F.col("in_test")).cast("bigint").alias("exact_duplicates"))


# --------------------------------------------------------------------------
# near duplicates (lossless candidate plan)
# --------------------------------------------------------------------------
def _distinct_texts(split_df: DataFrame, text: str, by: list[str], seed: int, with_text: bool = False,
                    kept: dict[str, Column] | None = None) -> DataFrame:
    """Collapse each split to distinct texts with multiplicity and first
    position, keyed by ``md5(text)``; ``kept``: further columns made of a text."""
    kept = {"text": F.col(text)} if with_text else kept or {}
    pre = split_df.select(*by, SPLIT, F.md5(F.col(text)).alias("tid"), F.length(F.col(text)).alias("len"),
                          F.concat(shuffle_key("row_idx", seed), F.lit(":"),
                                   F.lpad(F.col("row_idx").cast("string"), 20, "0")).alias("__pos"),
                          *[c.alias(name) for name, c in kept.items()])
    extra = [F.first(name).alias(name) for name in kept]
    return pre.groupBy(*by, SPLIT, "tid").agg(
        F.first("len").alias("len"), F.count(F.lit(1)).alias("mult"), F.min("__pos").alias("pos"), *extra)


def _cells(split_df: DataFrame, text: str, by: list[str], threshold: float, seed: int,
           with_text: bool = False, counts: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Distinct train and test texts dealt into cells ``(group, lb, salt)``:
    a pair whose lengths allow the threshold meets in exactly one cell.

    Lengths are bucketed by ``floor(ln(len)/ln((2-t)/t))``; a qualifying pair
    lies in the same or a neighbouring bucket, so test texts are replicated to
    three buckets. Big buckets are salted on both sides (a grid of train
    slices x test slices of about ``SALT_ROWS`` texts, with texts also of
    about ``SALT_CHARS`` characters), so no cell holds more than these. With
    ``counts``, a column made of the text, a text is its id as bytes, its
    length and that column, and a slice holds ``SALT_COUNTS`` texts.
    """
    def bucketed(d: DataFrame) -> DataFrame:
        if threshold > 0:
            log_r = math.log(sim.band_ratio(threshold))
            lb = F.floor(F.log(F.greatest(F.col("len"), F.lit(1)).cast("double")) / F.lit(log_r))
        else:
            lb = F.lit(0)
        return d.where(F.col("tid").isNotNull()).withColumn("lb", lb.cast("bigint"))

    def sides(d: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
        near = F.explode(F.array(F.col("lb") - 1, F.col("lb"), F.col("lb") + 1)).alias("lb")
        return (d.where(F.col(SPLIT) == TRAIN).select(*by, "lb", *cols),
                d.where(F.col(SPLIT) == TEST).select(*by, near, *cols))

    cols = ["tid", "len", "mult", "pos"] + (["text"] if with_text else []) if counts is None else ["tid", "len", "counts"]
    texts = _distinct_texts(split_df, text, by, seed, with_text, None if counts is None else {"counts": counts})
    tr, te = sides(bucketed(texts), cols)

    # 2-D salt grid per join bucket: train texts are cut into S_tr slices and
    # test texts (from the three neighbouring buckets) into S_te slices; a
    # train row is copied to every test slice and vice versa, so each pair
    # meets in exactly one cell.
    def slices(side: DataFrame, name: str) -> DataFrame:
        rows = F.ceil(F.count(F.lit(1)) / F.lit(SALT_ROWS if counts is None else SALT_COUNTS))
        chars = F.ceil(F.sum("len") / F.lit(SALT_CHARS)) if with_text else F.lit(1)
        return side.groupBy(*by, "lb").agg(F.greatest(rows, chars, F.lit(1)).cast("int").alias(name))

    light = sides(bucketed(_distinct_texts(split_df, text, by, seed)), ["len"])
    grid = slices(light[0], "s_tr").join(slices(light[1], "s_te"), by + ["lb"])
    grid, _ = bounded_broadcast(grid)
    tr = tr.join(grid, on=by + ["lb"]).select(
        *by, "lb", *cols, F.pmod(F.xxhash64("tid"), F.col("s_tr")).cast("int").alias("si"),
        F.explode(F.sequence(F.lit(0), F.col("s_te") - 1)).alias("sj"))
    te = te.join(grid, on=by + ["lb"]).select(
        *by, "lb", *cols, F.explode(F.sequence(F.lit(0), F.col("s_tr") - 1)).alias("si"),
        F.pmod(F.xxhash64("tid"), F.col("s_te")).cast("int").alias("sj"))
    salt = F.concat_ws(":", "si", "sj").alias("salt")
    if counts is not None:
        cols = [F.unhex("tid").alias("tid"), *cols[1:]]
    return tr.select(*by, "lb", salt, *cols), te.select(*by, "lb", salt, *cols)


def length_band_pairs(split_df: DataFrame, text: str, by: Sequence[str] | None = None,
                      threshold: float = SIMILARITY_THRESHOLD, seed: int = DEFAULT_SEED) -> DataFrame:
    """Pairs of distinct (train, test) texts of one group whose lengths allow
    ``ratio >= threshold``: ``2*min(la,lb) >= t*(la+lb)``; equal texts excluded."""
    by = group_cols(by)
    cols = ["tid", "len", "mult", "pos"]
    if threshold >= 1.0:
        d = _distinct_texts(split_df, text, by, seed)
        a = d.select(*by, *[F.col(c).alias(f"tr_{c}") for c in cols])
        b = d.select(*by, *[F.col(c).alias(f"te_{c}") for c in cols])
        return a.join(b, on=by).where(F.lit(False))
    tr, te = _cells(split_df, text, by, threshold, seed)
    a = tr.select(*by, "lb", "salt", *[F.col(c).alias(f"tr_{c}") for c in cols])
    b = te.select(*by, "lb", "salt", *[F.col(c).alias(f"te_{c}") for c in cols])
    pairs = a.join(b, on=by + ["lb", "salt"]).where(
        (F.lit(2) * F.least("tr_len", "te_len") >= F.lit(threshold) * (F.col("tr_len") + F.col("te_len")) - F.lit(EPS))
        & (F.col("tr_tid") != F.col("te_tid")))
    return pairs.drop("lb", "salt")


def _per_cell(split_df: DataFrame, text: str, by: list[str], threshold: float, seed: int, compare,
              columns: list[T.StructField], counts: Column | None = None) -> DataFrame:
    """Rows that ``compare(train, test)`` (two Arrow tables) yields for every
    cell, beside the cell's group. Pairs stay inside the task: what travels
    is each text (or its ``counts``), once for each cell it stands in."""
    tr, te = _cells(split_df, text, by, threshold, seed, with_text=counts is None, counts=counts)
    te = te.select(*[F.col(c).alias(f"te_{c}") for c in te.columns])        # both sides come from one frame
    schema = T.StructType([tr.schema[c] for c in by] + columns)
    names = [c.name for c in columns]
    keys = by + ["lb", "salt"]
    parts = cpu_partitions(split_df.sparkSession, CELL_TASKS)

    def run(train: pa.Table, test: pa.Table) -> pa.Table:
        test = test.rename_columns([c.removeprefix("te_") for c in test.column_names])
        if train.num_rows and test.num_rows:
            found = compare(train, test)
        else:
            found = pa.table([pa.array([], to_arrow_type(c.dataType)) for c in columns], names=names)
        at = pa.array(np.zeros(found.num_rows, np.int64))
        return pa.table([train.column(c).take(at) for c in by] + found.columns, names=by + names)

    te_keys = [f"te_{c}" for c in keys]
    return tr.repartition(parts, *keys).groupBy(*keys).cogroup(te.repartition(parts, *te_keys).groupBy(*te_keys)) \
        .applyInArrow(run, schema)


def _near_pairs(threshold: float, autojunk: bool):
    def compare(train: pa.Table, test: pa.Table) -> pa.Table:
        a, b = train.column("text").to_pylist(), test.column("text").to_pylist()
        ta, tb = train.column("tid").to_pylist(), test.column("tid").to_pylist()
        rows, cols, score = [], [], []
        for i, j in sim.candidates(a, b, threshold, EPS):
            if ta[i] == tb[j]:
                continue
            r = sim.ratio(a[i], b[j], autojunk)
            if r >= threshold:
                rows.append(i), cols.append(j), score.append(r)
        rows, cols = pa.array(rows, pa.int64()), pa.array(cols, pa.int64())
        pairs = pc.multiply(train.column("mult").take(rows), test.column("mult").take(cols))
        return pa.table([train.column("text").take(rows), test.column("text").take(cols), pa.array(score, pa.float64()),
                         pa.array([round(x, 3) for x in score], pa.float64()), pairs,     # as Python rounds, as reports show it
                         train.column("pos").take(rows), test.column("pos").take(cols)],
                        names=["train_text", "test_text", "similarity", "similarity_3", "pairs", "train_pos", "test_pos"])
    return compare


@null_safe_groups
def near_duplicate_pairs(split_df: DataFrame, text: str, by: Sequence[str] | None = None,
                         threshold: float = SIMILARITY_THRESHOLD, seed: int = DEFAULT_SEED,
                         autojunk: bool = False) -> DataFrame:
    """All (train, test) text pairs of one group with ``ratio >= threshold``
    and different texts (``autojunk=True`` ignores common characters of test
    texts from 200 characters on, as difflib does by default: it loses pairs
    and is there for comparison only); ``pairs`` is the product of both multiplicities, so
    repeated texts count as repeated pairs.

    Candidate steps (each only drops pairs that cannot qualify): length band
    cells, and inside a cell's task hashed character counts, 4-gram counts of
    short texts, LCS of prefixes and of whole texts (``sim.candidates``);
    survivors get the exact difflib ratio (train first). No pair that fails
    leaves its task.
    """
    by = group_cols(by)
    string, double = T.StringType(), T.DoubleType()
    columns = [T.StructField(n, t) for n, t in (
        ("train_text", string), ("test_text", string), ("similarity", double), ("similarity_3", double),
        ("pairs", T.LongType()), ("train_pos", string), ("test_pos", string))]
    if threshold >= 1.0:
        schema = T.StructType([split_df.schema[c] for c in by] + columns)
        return split_df.sparkSession.createDataFrame([], schema)
    return _per_cell(split_df, text, by, threshold, seed, _near_pairs(threshold, autojunk), columns)


def near_duplicate_counts(pairs: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    by = group_cols(by)
    return pairs.groupBy(*by).agg(F.sum("pairs").cast("bigint").alias("near_duplicates"))


@null_safe_groups
def sample_pairs(pairs: DataFrame, by: Sequence[str] | None = None, k: int = SAMPLE_PAIRS) -> DataFrame:
    """First ``k`` pairs per group in (test order, train order); similarity
    rounded to 3 places the way Python rounds (half-even on the binary
    value). Returns ``group, sample_near_duplicates``."""
    by = group_cols(by)
    w = Window.partitionBy(*by).orderBy("test_pos", "train_pos")
    # k pairs of texts hold the first k rows; then each stands as often as its rows repeat
    top = pairs.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k) \
        .withColumn("__rep", F.explode(F.sequence(F.lit(1), F.least("pairs", F.lit(k)).cast("int"))))
    again = Window.partitionBy(*by).orderBy("__rn", "__rep")
    top = top.withColumn("__rn", F.row_number().over(again)).where(F.col("__rn") <= k)
    return top.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(
        F.col("__rn").alias("n"), "train_text", "test_text",
        F.col("similarity_3").alias("similarity")))).alias("sample_near_duplicates"))


# --------------------------------------------------------------------------
# per-sheet report, totals and gate
# --------------------------------------------------------------------------
@null_safe_groups
def sheet_report(split_df: DataFrame, text: str, by: Sequence[str] | None = None,
                 threshold: float | None = SIMILARITY_THRESHOLD, seed: int = DEFAULT_SEED,
                 autojunk: bool = False, with_samples: bool = False) -> DataFrame:
    """``num_train, num_test, exact_duplicates, near_duplicates`` per group.

    ``threshold=None`` skips the near-duplicate search; then there is no
    column ``near_duplicates``. Only the texts' ids are kept for both counts,
    the search reads the texts again.
    """
    by = group_cols(by)
    ids = reuse(_text_ids(split_df, text, by))
    counts = ids.groupBy(*by).agg(
        F.count_if(F.col(SPLIT) == TRAIN).cast("bigint").alias("num_train"),
        F.count_if(F.col(SPLIT) == TEST).cast("bigint").alias("num_test"))
    out = counts.join(_shared_ids(ids, by), by, "left")
    if threshold is not None:
        pairs = near_duplicate_pairs(split_df, text, by, threshold, seed, autojunk)
        if with_samples:
            pairs = pairs.persist()
            out = out.join(sample_pairs(pairs, by), by, "left")
        out = out.join(near_duplicate_counts(pairs, by), by, "left")
    return out.fillna(0, subset=_found(out))


def _found(report: DataFrame) -> list[str]:
    """The duplicate counts that a report holds: near ones only if they were looked for."""
    return [c for c in ("exact_duplicates", "near_duplicates") if c in report.columns]


def leakage_rollup(report: DataFrame) -> DataFrame:
    """Totals per sheet, per workbook and overall (``level`` = grouping id)."""
    return report.rollup("workbook", "sheet").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("num_train").cast("bigint").alias("num_train"),
        F.sum("num_test").cast("bigint").alias("num_test"),
        *[F.sum(c).cast("bigint").alias(c) for c in _found(report)],
    )


def leakage_gate(report: DataFrame, fail_threshold: float = FAIL_THRESHOLD) -> DataFrame:
    """One row: totals, ratio (rounded to 4) and PASS / FAIL / NO_DATA.

    The ratio mixes distinct exact texts and near pairs, as specified, so it
    can exceed 1; it is compared with the threshold before rounding. Without
    a column ``near_duplicates`` it is a gate on exact duplicates alone.
    """
    found = _found(report)
    t = report.agg(
        F.coalesce(F.sum(F.col("num_train") + F.col("num_test")), F.lit(0)).cast("bigint").alias("total_records"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in found],
        F.count(F.lit(1)).alias("__groups"),
    )
    raw = F.when(F.col("total_records") > 0,
                 sum((F.col(c) for c in found), F.lit(0)) / F.col("total_records")
                 ).otherwise(F.lit(0.0))
    return t.select(
        "total_records", *found,
        F.round(raw, 4).alias("leakage_ratio"),
        F.when(F.col("__groups") == 0, F.lit("NO_DATA"))
         .when(raw <= F.lit(fail_threshold), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
    )


class LeakageError(AssertionError):
    pass


def assert_no_leakage(gate: DataFrame) -> None:
    row = gate.first()
    if row is not None and row["status"] == "FAIL":
        raise LeakageError(f"leakage ratio {row['leakage_ratio']} exceeds the fail threshold")


# --------------------------------------------------------------------------
# candidate steps exposed on their own, and the approximate option
# --------------------------------------------------------------------------
@null_safe_groups
def char_overlap_pairs(split_df: DataFrame, text: str, by: Sequence[str] | None = None,
                       threshold: float = SIMILARITY_THRESHOLD, seed: int = DEFAULT_SEED) -> DataFrame:
    """Length-band pairs whose exact character multiset overlap
    ``sum_c min(count_a(c), count_b(c))`` reaches ``t*(la+lb)/2``.

    Characters are counted once for each row, and only the counts travel to the cells of the length band, where
    they are compared, so no pair that fails leaves its task; the search for near duplicates uses the hashed-bin
    bound, which is never smaller than this one.
    """
    by = group_cols(by)
    string, integer = T.StringType(), T.IntegerType()
    columns = [T.StructField(n, t) for n, t in (
        ("tr_tid", string), ("te_tid", string), ("tr_len", integer), ("te_len", integer), ("overlap", T.LongType()))]
    if threshold >= 1.0:
        return split_df.sparkSession.createDataFrame([], T.StructType([split_df.schema[c] for c in by] + columns))
    return _per_cell(split_df, text, by, threshold, seed, _overlap_pairs(threshold), columns, counts=_char_counts(F.col(text)))


@F.pandas_udf(T.BinaryType())
def _char_counts(texts: pd.Series) -> pd.Series:
    return texts.map(sim.packed_counts, na_action="ignore")


def _overlap_pairs(threshold: float):
    def compare(train: pa.Table, test: pa.Table) -> pa.Table:
        tids = [pa.array([x.hex() for x in t.column("tid").to_pylist()], pa.string()) for t in (train, test)]
        ta, tb = (np.array(x.to_pylist()) for x in tids)
        rows, cols, shared = [], [], []
        profiles = [[sim.unpacked_counts(x) for x in t.column("counts").to_pylist()] for t in (train, test)]
        for i, j, n in sim.count_overlaps(*profiles, threshold, EPS):
            keep = tb[j] != ta[i]
            rows.append(np.full(keep.sum(), i)), cols.append(j[keep]), shared.append(n[keep])
        rows, cols, shared = (pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)) for x in (rows, cols, shared))
        return pa.table([tids[0].take(rows), tids[1].take(cols), train.column("len").take(rows),
                         test.column("len").take(cols), shared], names=["tr_tid", "te_tid", "tr_len", "te_len", "overlap"])
    return compare


@null_safe_groups
def minhash_pairs(split_df: DataFrame, text: str, by: Sequence[str] | None = None,
                  max_distance: float = 0.5, ngram: int = 3, bands: int = 5, rows_per_band: int = 2,
                  num_features: int = 1 << 18, seed: int = DEFAULT_SEED) -> DataFrame:
    """Approximate near duplicates for very large groups (recall below 1).

    Word ``ngram`` shingles -> binary ``HashingTF`` -> MLlib ``MinHashLSH``
    signatures (``bands * rows_per_band`` hash functions). Candidate pairs
    share one band, i.e. all ``rows_per_band`` min-hashes of that band, and
    the group is part of the join key, so texts of different groups are
    never paired and one common shingle cannot make a giant bucket. Exact
    Jaccard distance of the shingle sets is checked on the candidates whose
    set sizes allow it: only their texts are sent, as texts, which are a
    quarter of their shingles. Texts with fewer than ``ngram`` words use their single words; texts
    without words cannot be hashed and are not compared.
    """
    from pyspark.ml.feature import HashingTF, MinHashLSH
    from pyspark.ml.functions import vector_to_array
    by = group_cols(by)
    d = _shingled(_distinct_texts(split_df, text, by, seed, with_text=True), "text", "__sh", ngram).where(F.size("__sh") > 0)
    d = HashingTF(inputCol="__sh", outputCol="__f", numFeatures=num_features, binary=True).transform(d)
    n_hash = bands * rows_per_band
    lsh = MinHashLSH(inputCol="__f", outputCol="__h", numHashTables=n_hash, seed=seed).fit(d)
    h = reuse(lsh.transform(d).select(*by, SPLIT, "tid", "mult", F.size("__sh").alias("n"),
                                      F.transform("__h", lambda v: vector_to_array(v)[0]).alias("__mh")))
    band_keys = F.explode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.struct(
        b.alias("band"), F.slice("__mh", b * rows_per_band + 1, rows_per_band).alias("key"))))
    keyed = h.select(*by, SPLIT, "tid", "mult", "n", band_keys.alias("__b")).select(*by, SPLIT, "tid", "mult", "n", "__b.band", "__b.key")

    def side(part: str, name: str) -> DataFrame:
        return keyed.where(F.col(SPLIT) == part).select(
            *by, "band", "key", F.col("tid").alias(f"{name}_tid"), F.col("mult").alias(f"{name}_mult"), F.col("n").alias(f"{name}_n"))
    # the sets share at most the smaller one
    sizes = F.lit(1.0) - F.least("train_n", "test_n") / F.greatest("train_n", "test_n") <= F.lit(max_distance + EPS)
    cand = side(TRAIN, "train").join(side(TEST, "test"), by + ["band", "key"]).where((F.col("train_tid") != F.col("test_tid")) & sizes) \
        .select(*by, "train_tid", "test_tid", "train_mult", "test_mult").distinct()
    cand, _ = bounded_broadcast(cand)
    wanted, small = bounded_broadcast(cand.select(*by, F.explode(F.array(
        F.struct(F.lit(TRAIN).alias(SPLIT), F.col("train_tid").alias("tid")),
        F.struct(F.lit(TEST).alias(SPLIT), F.col("test_tid").alias("tid")))).alias("__t")).select(*by, "__t.*").distinct())
    texts = join_by(split_df.select(*by, SPLIT, F.md5(F.col(text)).alias("tid"), F.col(text).alias("text")), wanted,
                    [*by, SPLIT, "tid"], "left_semi", broadcast=small).groupBy(*by, SPLIT, "tid").agg(F.first("text").alias("text"))
    j = cand
    for part, name in ((TRAIN, "train"), (TEST, "test")):
        j = j.join(texts.where(F.col(SPLIT) == part).select(*by, F.col("tid").alias(f"{name}_tid"), F.col("text").alias(f"__{name}")),
                   by + [f"{name}_tid"])
    j = _shingled(_shingled(j, "__train", "a", ngram), "__test", "b", ngram)
    dist = F.lit(1.0) - F.size(F.array_intersect("a", "b")) / F.size(F.array_union("a", "b"))
    # a generator, because a filter would go below the shingles and make them once more
    near = F.explode(F.filter(F.array(dist), lambda x: x <= F.lit(max_distance))).alias("jaccard_distance")
    return j.select(*by, "train_tid", "test_tid", near, (F.col("train_mult") * F.col("test_mult")).cast("bigint").alias("pairs"))


def _shingled(df: DataFrame, text: str, out: str, ngram: int) -> DataFrame:
    """``df`` with the set of word shingles of ``text``: of single words where there are fewer than ``ngram``."""
    from pyspark.ml.feature import NGram
    from corpusprep.functions.text import word_tokens
    d = NGram(n=ngram, inputCol="__w", outputCol="__ng").transform(df.withColumn("__w", word_tokens(F.col(text))))
    return d.withColumn(out, F.array_distinct(F.when(F.size("__ng") > 0, F.col("__ng")).otherwise(F.col("__w")))).drop("__w", "__ng")
