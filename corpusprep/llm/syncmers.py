"""Document fingerprints from closed syncmers, in DataFrame operations only.

A text is cut into units inside its words, the runs without white space. A
word of up to ``2 * UNIT`` code points is cut from its start into units of up
to ``UNIT``; a longer one (text without spaces, URLs, base64) has a unit of
``UNIT`` code points at every code point, so that its units do not depend on
where it starts. A k-mer is ``K`` units in a row, its inner s-mers are ``S`` units in a
row. A k-mer is an anchor if its smallest inner s-mer (by hash) is the first
or the last one. This depends on the k-mer alone, so equal runs of
units give equal anchors wherever they stand. Equal passages have equal units
but for the word at either end that is cut, and there only units that reach
over the cut differ if the word is long in both texts.

The fingerprint holds all anchors of the text in text order, repeats
included, as eight hex digits each; beside it stand their positions, the
number of the unit at which each k-mer starts. The likeness of two
fingerprints is twice the number of their common anchors over the number of
all anchors of both; an anchor that stands m times in one and n times in the
other is common min(m, n) times. A sketch, the ``SIZE`` smallest distinct
anchors, is an extra of ``fingerprints``; no likeness uses it.

Defined results: a null text is an empty text; a text without words has the
empty fingerprint; one with fewer than ``K`` units has one anchor, its whole
sequence; two empty fingerprints have likeness 1. In the edit query a null id
sorts first, and rows that share an id are ordered by their texts; a single
row is its own next document; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import NULL_KEY, key_of

UNIT = 4
#: One match for each unit, which is group 1: the rest of a word, the first unit of a short word, or one code point of a long one.
UNITS = r"(?=(X{1,%d}))(?:X{1,%d}+(?!X)|(?<!X)X{%d}(?=X{1,%d}+(?!X))|X)".replace("X", r"[^\x20\x09-\x0D]") % ((UNIT,) * 4)
K, S = 4, 2
SIZE = 128
#: Rows aimed at in a block of neighbouring ids, and the most blocks there are (then they grow).
BLOCK_ROWS = 512
MAX_BLOCKS = 10_000
#: Bounds are searched in steps of so many.
STEP = 128


def with_anchors(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name`` (all anchors in text order), ``name_at`` (unit positions) and ``name_keys`` (see ``_numbered``)."""
    h, s, n = f"__{name}_h", f"__{name}_s", F.size(f"__{name}_h")
    units = F.regexp_extract_all(F.col(text), F.lit(UNITS), F.lit(1))
    df = df.withColumn(h, F.transform(units, lambda u: F.xxhash64(u)))
    pairs = F.zip_with(h, F.slice(h, S, F.greatest(n, F.lit(1))), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn(s, pairs)

    def inner(i: Column) -> list[Column]:
        return [F.get(F.col(s), i + j) for j in range(K - S + 1)]

    def closed(i: Column) -> Column:
        first, *mid, last = inner(i)
        return F.least(first, last) <= F.least(first, *mid, last)
    low = F.lit(0xFFFFFFFF)
    df = df.withColumn(f"{name}_at", F.when(n >= K, F.filter(F.sequence(F.lit(0), n - K), closed))
                       .when(n > 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>")))
    df = df.withColumn(name, F.when(n >= K, F.transform(f"{name}_at", lambda i: F.xxhash64(*inner(i)).bitwiseAND(low)))
                       .when(n > 0, F.array(F.xxhash64(h).bitwiseAND(low))).otherwise(F.array().cast("array<bigint>")))
    return _numbered(df, name).drop(h, s)


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """Add ``name_keys``: each anchor with the number of its earlier equals above its 32 bits, so that all differ."""
    a, at, n = f"__{name}_sorted", f"__{name}_starts", F.size(name)
    df = df.withColumn(a, F.sort_array(name))
    df = df.withColumn(at, F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(a, i) != F.get(a, i - 1))))
                       .otherwise(F.array().cast("array<int>")))
    ends = F.concat(F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), F.array(n))
    keys = F.flatten(F.zip_with(at, ends, lambda b, e: F.transform(
        F.sequence(F.lit(0), e - b - 1), lambda k: F.get(a, b) + k.cast("bigint") * F.lit(1 << 32))))
    keys = F.when(F.size(at) < n, keys).otherwise(F.col(a))
    return df.withColumn(f"{name}_keys", keys).drop(a, at)


def as_string(ordered: str) -> Column:
    return F.lower(F.array_join(F.transform(ordered, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def likeness(a: str, b: str) -> Column:
    """Of two arrays of numbered anchors."""
    n = F.size(a) + F.size(b)
    return F.when(n == 0, F.lit(1.0)).otherwise(2 * F.size(F.array_intersect(a, b)).cast("double") / n)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, positions`` of every document, and ``anchors``, the sketch."""
    t = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return with_anchors(t, "text", "all").select(
        "doc_id", as_string("all").alias("fingerprint"), F.col("all_at").alias("positions"),
        F.slice(F.sort_array(F.array_distinct("all")), 1, SIZE).alias("anchors"))


def _bounds(keys: DataFrame) -> list[int]:
    """First key of each block of neighbouring ids, ascending; at most about ``MAX_BLOCKS``."""
    blocks = min(MAX_BLOCKS, keys.count() // BLOCK_ROWS + 1)
    rows = keys.repartitionByRange(blocks, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("k")) \
        .orderBy("k").select("k").collect()
    return [r["k"] for r in rows]


def _block_of(key: Column, bounds: list[int]) -> Column:
    """Number (from 1) of the last bound that is at most ``key``; two short searches instead of one long."""
    every = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    coarse = F.array(*[F.lit(b).cast("bigint") for b in bounds[::STEP]])
    c = F.size(F.filter(coarse, lambda b: b <= key)) if len(bounds) > STEP else F.lit(1)
    c = F.greatest(c, F.lit(1))
    return (F.greatest(F.size(F.filter(F.slice(every, (c - 1) * STEP + 1, STEP), lambda b: b <= key)), F.lit(1)) + (c - 1) * STEP)


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each text and of its edited text, and how alike they are.

    The edited text's last floor(n_chars / 2) code points are the first as
    many (or all) of the next document. Blocks of neighbouring ids are dealt
    out once; the first row of each block also goes to the block before it,
    as the next document of that block's last row.
    """
    t = docs.select(key_of(id_col).alias("key"), F.col(id_col).cast("bigint").alias("doc_id"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bounds = _bounds(t.select("key")) or [NULL_KEY]
    every = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    t = t.withColumn("block", _block_of(F.col("key"), bounds).cast("int"))
    own = F.struct(F.col("block").alias("b"), F.lit(False).alias("guest"))
    before = F.struct(F.when(F.col("block") == 1, F.lit(len(bounds))).otherwise(F.col("block") - 1).alias("b"), F.lit(True).alias("guest"))
    copies = F.when(F.col("key") == F.element_at(every, F.col("block")), F.array(own, before)).otherwise(F.array(own))
    t = t.withColumn("copy", F.explode(copies)).select("key", "doc_id", "text", F.col("copy.b").alias("block"), F.col("copy.guest").alias("guest"))
    t = with_anchors(t.repartition("block"), "text", "own").withColumn("own", as_string("own"))
    w = Window.partitionBy("block").orderBy("guest", "key", "text")
    t = t.withColumn("next_text", F.lead("text").over(w)).withColumn("next_keys", F.lead("own_keys").over(w)).where(~F.col("guest"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    t = t.withColumn("n_chars", n.cast("bigint")) \
        .withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    t = with_anchors(t.drop("text", "next_text"), "edited", "new")
    return t.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    F.col("own").alias("fingerprint"), F.col("own_at").alias("positions"),
                    as_string("new").alias("edited_fingerprint"), F.col("new_at").alias("edited_positions"),
                    likeness("own_keys", "new_keys").alias("near_edited"), likeness("own_keys", "next_keys").alias("near_next"))
