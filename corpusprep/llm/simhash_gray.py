"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are reduced to distinct values, routed to shards, and joined
inside each shard through an index: values are sorted by Gray rank, so
neighbours differ in few bits; runs of ``FANOUT`` values become a node that
holds the bits all of them share (a mask and a pattern), runs of nodes become
upper nodes, up to one root a shard. A pair of nodes whose shared bits differ
in more than the allowed distance is dropped with everything under it; on the
way down only the bits newly shared by the children are compared and the
differences add up.

Shards: values within distance d agree on at least one of d + 1 bit blocks,
so each value goes to one shard for each block, none is lost. A shard above
``SHARD_ROWS`` is split by the blocks of its other bits, and what is still
above by pairs of salts. Each shard gives spanning links only, never all
pairs; components over them are found by alternating stars.

Defined results: null and empty texts, and texts without words, have
fingerprint zero, and link like any other. A null id is nobody's smallest:
the component of rows without any id is null. Rows that share an id each get
their row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import connected_components, forest, key_of, map_text, written

SHINGLE = 3
MAX_BITS = 3
SEED = 42
FANOUT = 16
#: Values joined in one shard before it is split; also the size of a salt.
SHARD_ROWS = 4096
#: Node pairs expanded at once; bounds a task's memory.
FRONTIER = 1 << 18

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_SLOT = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits; bit set if set in over half the shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, SEED) for s in shingles], dtype=np.uint64)
    counts = np.bincount((h.view(np.uint8).reshape(-1, 8) + _SLOT).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    bits = counts.ravel() * 2 > len(h)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp``; ``fp`` is the fingerprint as a signed bigint."""
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["doc_id", "text_hash", "fp"])
    return map_text(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                                F.col(text_col).alias("text")), run, "doc_id bigint, text_hash bigint, fp bigint")


# ------------------------------------------------------------------ the index
def gray_rank(v: np.ndarray) -> np.ndarray:
    """Position of each 64-bit value in the reflected Gray sequence."""
    r = v.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


class GrayIndex:
    """Levels of nodes over values sorted by (shard, Gray rank); level 0 are the values."""

    def __init__(self, shard: np.ndarray, values: np.ndarray):
        full = np.full(len(values), ~np.uint64(0))
        self.levels = [(values, full, np.arange(len(values)), np.ones(len(values), np.int64))]
        group, pattern, mask = shard, values, full
        while True:
            first = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)
            start = np.flatnonzero(first)
            within = np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)]))
            heads = np.flatnonzero(within % FANOUT == 0)
            sizes = np.diff(np.r_[heads, len(group)])
            common = (np.bitwise_and.reduceat(mask, heads)
                      & ~(np.bitwise_or.reduceat(pattern, heads) ^ np.bitwise_and.reduceat(pattern, heads))
                      if len(heads) else mask)
            # a bit is shared if all children share it and agree on it
            pattern, mask, group = pattern[heads] & common, common, group[heads]
            self.levels.append((pattern, mask, heads, sizes))
            if len(np.unique(group)) == len(group):
                break
        self.roots = len(group)

    def links(self, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Batches of value pairs (i < j) within ``max_bits``, depth first so that memory stays bounded."""
        top = len(self.levels) - 1
        r = np.arange(self.roots)
        stack = [(top, r, r, np.zeros(len(r), np.int64), np.zeros(len(r), np.uint64))]
        while stack:
            level, i, j, acc, seen = stack.pop()
            if level == 0:
                far = i < j
                yield i[far], j[far]
                continue
            if len(i) > 1 and len(i) * FANOUT * FANOUT > FRONTIER:
                half = len(i) // 2
                stack.append((level, i[half:], j[half:], acc[half:], seen[half:]))
                stack.append((level, i[:half], j[:half], acc[:half], seen[:half]))
                continue
            _, _, heads, sizes = self.levels[level]
            pattern, mask, _, _ = self.levels[level - 1]
            ni, nj = sizes[i], sizes[j]
            n = ni * nj
            pair = np.repeat(np.arange(len(i)), n)
            k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
            ci, cj = heads[i][pair] + k // nj[pair], heads[j][pair] + k % nj[pair]
            keep = ci <= cj if level > 1 else ci < cj
            pair, ci, cj = pair[keep], ci[keep], cj[keep]
            shared = mask[ci] & mask[cj]
            fresh = shared & ~seen[pair]          # bits not compared further up
            total = acc[pair] + np.bitwise_count((pattern[ci] ^ pattern[cj]) & fresh)
            keep = total <= max_bits
            stack.append((level - 1, ci[keep], cj[keep], total[keep], shared[keep]))


def _join_shards(max_bits: int):
    """Batches sorted by shard -> spanning links ``a, b`` of the values linked within each shard."""
    def solve(shard: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        u = values.view(np.uint64)
        order = np.lexsort((gray_rank(u), shard))
        shard, u = shard[order], u[order]
        root = np.arange(len(u))
        for i, j in GrayIndex(shard, u).links(max_bits):
            root = forest(len(u), i, j, root)
        v = u.view(np.int64)
        linked = root != np.arange(len(u))
        return pa.RecordBatch.from_arrays([pa.array(v[linked]), pa.array(v[root[linked]])], names=["a", "b"])

    def run(batches):
        held_s, held_v, n = [], [], 0
        for b in batches:
            s, v = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            held_s.append(s)
            held_v.append(v)
            n += len(s)
            if n < 8 * SHARD_ROWS:
                continue
            s, v = np.concatenate(held_s), np.concatenate(held_v)
            cut = np.searchsorted(s, s[-1])       # the last shard may go on
            if cut:
                yield solve(s[:cut], v[:cut])
            held_s, held_v, n = [s[cut:]], [v[cut:]], len(s) - cut
        if n:
            yield solve(np.concatenate(held_s), np.concatenate(held_v))
    return run


def _block_keys(fp: Column, used: Column, blocks: int, bits: int, prefix: Column) -> Column:
    """Keys of the ``blocks`` bit blocks of ``bits`` low bits after dropping ``used``-th block's turn."""
    width = bits // blocks
    mask = (1 << width) - 1
    return F.array(*[F.xxhash64(prefix, F.lit(i), used,
                                F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit(mask if i < blocks - 1 else (1 << (bits - i * width)) - 1)))
                     for i in range(blocks)])


def route(values: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``shard, fp``: each value in every shard in which a near value may be; shards hold few values.

    Keys are 64-bit hashes of (level, block, bits). Two keys that collide
    only make a shard larger; links are always confirmed by bit distance.
    """
    blocks = max_bits + 1
    fp = F.col("fp")
    first = values.select("fp", F.explode(_block_keys(fp, F.lit(0), blocks, 64, F.lit(1))).alias("shard"))
    sizes = first.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_rows)
    marked = first.join(sizes, "shard", "left")
    small = marked.where(F.col("n").isNull()).select("shard", "fp")
    # a large shard shares one block; all 64 bits are cut anew, at other places, under its key
    inner = F.shiftrightunsigned(fp, 8).bitwiseXOR(F.shiftleft(fp, 56))
    second = marked.where(F.col("n").isNotNull()).select(
        "fp", F.explode(_block_keys(inner, F.lit(1), blocks, 64, F.col("shard"))).alias("shard"))
    sizes = second.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_rows)
    marked = second.join(sizes, "shard", "left")
    fine = marked.where(F.col("n").isNull()).select("shard", "fp")
    # still large: salts, and one shard for each pair of salts
    salts = F.ceil(F.col("n") / shard_rows).cast("int")
    mine = F.pmod(F.xxhash64("fp"), salts).cast("int")
    cells = F.transform(F.sequence(F.lit(0), salts - 1), lambda o: F.xxhash64(
        F.col("shard"), F.least(mine, o), F.greatest(mine, o)))
    salted = marked.where(F.col("n").isNotNull()).select(F.explode(cells).alias("shard"), "fp")
    return small.union(fine).union(salted)


def near_links(values: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Spanning links ``a, b`` of distinct values ``fp`` within ``max_bits``."""
    routed = route(values, max_bits, shard_rows)
    return routed.repartition("shard").sortWithinPartitions("shard").mapInArrow(_join_shards(max_bits), "a bigint, b bigint")


def _rooted(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, text_hash, fp)`` of every row, and ``(fp, first_id, root)`` of every distinct fingerprint."""
    fps = written(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-class")
    comp = connected_components(near_links(classes.select("fp"), max_bits))
    return fps, classes.join(comp, F.col("fp") == F.col("node"), "left") \
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every document."""
    fps, rooted = _rooted(docs, id_col, text_col, shingle, max_bits)
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = rooted.join(ids, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                        "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component: the smallest id (nulls last), then the smallest text hash.

    Of rows equal in both, the first by the other columns stays.
    """
    fps, rooted = _rooted(docs, id_col, text_col, shingle, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    kept = fps.groupBy("fp").agg(first).join(rooted.select("fp", "root"), "fp") \
        .groupBy("root").agg(F.min("first").alias("first")) \
        .select(key_of("first.doc_id").alias("__kept_id"), F.col("first.text_hash").alias("__kept_hash"))
    keyed = docs.withColumn("__kept_id", key_of(id_col)).withColumn("__kept_hash", F.xxhash64(text_col))
    others = [F.col(c) for c in docs.columns if c not in (id_col, text_col)] or [F.lit(0)]
    w = Window.partitionBy("__kept_id", "__kept_hash").orderBy(*others)
    return keyed.join(kept, ["__kept_id", "__kept_hash"], "left_semi").withColumn("__nth", F.row_number().over(w)) \
        .where(F.col("__nth") == 1).select(*docs.columns)
