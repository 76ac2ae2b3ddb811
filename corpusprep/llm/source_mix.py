"""Mixing sources to target weights, in DataFrame operations only.

Each document gets a hash-random key (md5 of seed and id). Keys are cut into
ranges by their leading hex digits; a histogram of words for each
``(source, range)`` and its running sum give the words before each range.
A source's target holds a whole number of passes over it plus a rest: the
one range in which the rest ends is range-sorted and summed up row by row, in
as many tasks as a shuffle has; all other ranges are wholly in or wholly out
and are not moved. So the result is that of sorting each whole source, and no
source, range or id (null ids share a key) is sorted in one task.

Defined results: a null text has size 0; a null source is a source of its
own, ordered last; rows that tie in key and id are ordered by size, and
equal rows are interchangeable; a source of size 0 has target 0; an empty
table gives no rows. Other columns are ignored. The sources themselves are
taken to be few enough to sort in one task (one row each).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import prefix_sums, written

SEED = 42
WEIGHTS = (5, 2, 1)
#: A target stops at so many times its source's size.
MAX_EPOCHS = 3
#: Leading hex digits of a key that make its range: 4,096 ranges a source.
RANGE_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words; the string is split once and no word list is kept."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+", "")
    parts = F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    ends_blank = trimmed.rlike(r"[\x20\x09-\x0D]\z").cast("int")
    return F.when(trimmed == "", F.lit(0)).otherwise(parts - ends_blank).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes(source, source_size)`` with ``target``: weight shares of the total, capped, excess reshared.

    Resharing the excess by weight until none is above its cap settles at
    min(cap, weight * level). Sources are sorted by cap / weight; those below
    the level are at their cap, and the rest share what is left by weight.
    """
    by_point = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)).cast("bigint") for w in weights])
    t = sizes.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_point) - 1) % len(weights) + 1).cast("int"))) \
             .withColumn("cap", F.col("source_size") * max_epochs)
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    t = t.withColumn("left", left).withColumn("weight_left", weight_left) \
         .withColumn("capped", F.col("cap") * F.col("weight_left") <= F.col("left") * F.col("weight"))
    # the first source that is not at its cap has what is left and the weights that share it
    first = F.min(F.when(~F.col("capped"), F.struct((F.col("cap") / F.col("weight")).alias("r"), F.col("source").isNull(),
                                                    "source", "left", "weight_left"))).over(every)
    share = F.col("weight") * first["left"] / first["weight_left"]
    return t.select("source", "source_size", "weight",
                    F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share.cast("double")).alias("target"))


def _sized(docs: DataFrame, columns: list[Column], id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """``columns`` with each row's source, words and key, written: texts are counted once."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    return written(docs.select(*columns, F.col(source_col).cast("string").alias("__source"), n_words(F.col(text_col)).alias("__size"),
                               F.col(id_col).cast("bigint").alias("__id"), key.alias("__key")), "mix-sizes")


def _taken(sized: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """Add ``__source_size``, ``__target`` and ``__taken``: the words taken of this very row."""
    sized = sized.withColumn("__range", F.substring("__key", 1, RANGE_DIGITS))
    hist = sized.groupBy("__source", "__range").agg(F.sum("__size").alias("words"))
    by_source = hist.groupBy("__source").agg(F.sum("words").alias("source_size"))
    goal = targets(by_source.withColumnRenamed("__source", "source"), weights, max_epochs) \
        .withColumn("budget", F.floor("target").cast("bigint")) \
        .withColumn("passes", F.coalesce(F.expr("budget div nullif(source_size, 0)"), F.lit(0))) \
        .withColumn("rest", F.col("budget") - F.col("passes") * F.col("source_size"))
    run = Window.partitionBy("__source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ends = hist.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
    g, e = goal.alias("g"), ends.alias("e")
    cuts = g.join(e, F.col("g.source").eqNullSafe(F.col("e.__source")), "left") \
        .groupBy("g.source", "source_size", "target", "passes", "rest") \
        .agg(F.max(F.when(F.col("before") <= F.col("rest"), F.struct("__range", "before"))).alias("cut"))
    cuts = written(cuts.select(F.col("source").alias("__of"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
                               F.col("passes").alias("__passes"), F.col("rest").alias("__rest"), F.col("cut.__range").alias("__cut"),
                               F.col("cut.before").alias("__cut_before")), "mix-cuts")
    rows = sized.join(cuts, F.col("__source").eqNullSafe(F.col("__of"))).drop("__of")
    # the range in which a budget ends is ranked by distributed prefix sums; equal rows part by any number
    inside = rows.where(F.col("__range") == F.col("__cut")).withColumn("__any", F.monotonically_increasing_id())
    inside = prefix_sums(inside, ["__source", "__key", "__id", "__size", "__any"], "__size", "__start").drop("__any")
    first = inside.groupBy(F.col("__source").alias("__of")).agg(F.min("__start").alias("__first"))
    inside = inside.join(first, F.col("__source").eqNullSafe(F.col("__of"))) \
        .withColumn("__upto", F.col("__start") - F.col("__first") + F.col("__cut_before")) \
        .withColumn("__last", F.greatest(F.lit(0), F.least(F.col("__size"), F.col("__rest") - F.col("__upto")))) \
        .drop("__start", "__first", "__of", "__upto")
    outside = rows.where(F.col("__range") != F.col("__cut")) \
        .withColumn("__last", F.when(F.col("__range") < F.col("__cut"), F.col("__size")).otherwise(F.lit(0)))
    return inside.unionByName(outside).withColumn("__taken", (F.col("__passes") * F.col("__size") + F.col("__last")).cast("bigint"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, seed: int = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every document.

    ``taken`` counts words: whole passes times the size, plus the words of
    the last, partial pass; in it the document in which the budget ends gives
    only the words that are left. Each source so takes floor(target) words.
    """
    rows = _taken(_sized(docs, [], id_col, text_col, source_col, seed), weights, max_epochs)
    return rows.select(F.col("__id").alias("doc_id"), F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                       F.col("__target").alias("target"), F.col("__taken").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: Sequence[int] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The mix itself: each document once for each pass that takes it, the columns of ``docs``.

    Of the document in which a source's budget ends, the last copy has only
    the words taken, joined by single spaces (and ``n_chars``, if there is
    such a column, counts them). A document without words is in no pass. Each
    row has its own share, whatever ids, sizes or texts it has in common with others.
    """
    columns = [F.col(c).alias(f"__doc_{i}") for i, c in enumerate(docs.columns)]      # other names cannot clash
    rows = _taken(_sized(docs, columns, id_col, text_col, source_col, seed), weights, MAX_EPOCHS).where(F.col("__taken") > 0)
    # words of each copy: full passes, then what is left of the last one
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("__taken") / F.col("__size")).cast("int"))))
    keep = F.least(F.col("__size"), F.col("__taken") - (F.col("__copy") - 1) * F.col("__size")).cast("int")
    named = {c: F.col(f"__doc_{i}") for i, c in enumerate(docs.columns)}
    head = F.array_join(F.slice(F.split(F.regexp_replace(named[text_col], r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+"),
                                1, keep), " ")
    cut = keep < F.col("__size")
    shown = {**named, text_col: F.when(cut, head).otherwise(named[text_col])}
    if "n_chars" in named:
        shown["n_chars"] = F.when(cut, F.length(head).cast("bigint")).otherwise(named["n_chars"])
    return rows.select(*[shown[c].alias(c) for c in docs.columns])
