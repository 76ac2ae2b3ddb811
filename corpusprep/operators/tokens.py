"""Word tokens, vocabulary and fixed-length token ids.

The reference feeds a pretrained sub-word tokenizer; here the built-in
tokenizer is word level (lower-cased letter/digit runs) with a vocabulary
learnt from train rows. A user tokenizer can be plugged in with
``encode_with`` (Arrow batches, loaded once per task).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions.text import word_tokens
from corpusprep.operators.joins import reuse, sized_join
from corpusprep.schema import SPLIT, TRAIN

# Special tokens and their ids, default lengths.
PAD, UNK, CLS, SEP = "[PAD]", "[UNK]", "[CLS]", "[SEP]"
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 1, 2, 3
FIRST_WORD_ID = 4
MAX_LENGTH = 128
VOCAB_SIZE = 30000


def token_counts(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    """Token frequencies (partial aggregation, so hot tokens combine map side)."""
    by = list(by)
    return df.select(*by, F.explode(word_tokens(F.col(text))).alias("token")) \
        .groupBy(*by, "token").agg(F.count(F.lit(1)).cast("bigint").alias("count"))


def vocabulary(split_df: DataFrame, text: str, size: int = VOCAB_SIZE, by: Sequence[str] = (),
               train_only: bool = True) -> DataFrame:
    """Top-``size`` tokens by (count desc, token); ids start after the four
    special tokens. Returns ``[by], token, token_id, count``.

    With no ``by`` the top-k is a bounded ``TakeOrderedAndProject`` (each task
    keeps ``size`` rows); per group it is a window with a group limit.
    """
    by = list(by)
    src = split_df.where(F.col(SPLIT) == TRAIN) if train_only and SPLIT in split_df.columns else split_df
    counts = token_counts(src, text, by)
    if not by:
        top = counts.orderBy(F.col("count").desc(), F.col("token")).limit(size)
        w = Window.orderBy(F.col("count").desc(), F.col("token"))
        return top.select("token", (F.row_number().over(w) + FIRST_WORD_ID - 1).cast("int").alias("token_id"),
                          "count")
    w = Window.partitionBy(*by).orderBy(F.col("count").desc(), F.col("token"))
    return counts.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= size) \
        .select(*by, "token", (F.col("__rn") + FIRST_WORD_ID - 1).cast("int").alias("token_id"), "count")


def encode(df: DataFrame, text: str, vocab: DataFrame, keys: Sequence[str], max_length: int = MAX_LENGTH,
           by: Sequence[str] = ()) -> DataFrame:
    """Add ``input_ids`` and ``attention_mask`` (length ``max_length``).

    ``[CLS] w1 .. wk [SEP] [PAD]..``: words beyond ``max_length - 2`` are cut
    before the lookup, unknown words map to ``[UNK]``, the mask marks real
    tokens. Words are exploded with their position, joined to the bounded
    vocabulary (broadcast behind a size check) and gathered back per row.
    """
    keys, by = list(keys), list(by)
    df = reuse(df)
    if max_length < 2:
        raise ValueError("max_length must leave room for [CLS] and [SEP]")
    room = max_length - 2
    words = df.select(*keys, F.posexplode(F.slice(word_tokens(F.col(text)), 1, room)).alias("pos", "token")) \
        if room > 0 else df.select(*keys).where(F.lit(False)).withColumn("pos", F.lit(0)).withColumn("token", F.lit(""))
    v = vocab.select(*by, "token", "token_id")
    ids = sized_join(words, v, on=by + ["token"], how="left") \
        .withColumn("token_id", F.coalesce("token_id", F.lit(UNK_ID)))
    gathered = ids.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("pos", "token_id"))).alias("__ids"))
    body = F.coalesce(F.transform(F.col("__ids"), lambda x: x["token_id"]), F.array().cast("array<int>"))
    n = F.size(body)
    pad = F.greatest(F.lit(max_length) - n - 2, F.lit(0))
    out = df.join(gathered, on=keys, how="left").withColumn("__body", body)
    return out.withColumn(
        "input_ids", F.concat(F.array(F.lit(CLS_ID)), F.col("__body"), F.array(F.lit(SEP_ID)),
                              F.array_repeat(F.lit(PAD_ID), pad)).cast("array<int>")
    ).withColumn(
        "attention_mask", F.concat(F.array_repeat(F.lit(1), F.size("__body") + 2),
                                   F.array_repeat(F.lit(0), pad)).cast("array<int>")
    ).drop("__ids", "__body")


def encode_with(df: DataFrame, text: str, tokenizer_factory: Callable[[], Callable[[list[str]], list[list[int]]]],
                max_length: int = MAX_LENGTH, pad_id: int = PAD_ID) -> DataFrame:
    """Custom tokenizer hook: ``tokenizer_factory()`` is called once per task
    and must return ``texts -> list of id lists`` (already with any boundary
    tokens). Ids are cut to ``max_length`` and padded; mask marks real ids.
    """
    schema = T.StructType([T.StructField("input_ids", T.ArrayType(T.IntegerType())),
                           T.StructField("attention_mask", T.ArrayType(T.IntegerType()))])

    @F.pandas_udf(schema)
    def _enc(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tok = tokenizer_factory()
        for texts in batches:
            ids = [list(x)[:max_length] for x in tok(texts.fillna("").tolist())]
            yield pd.DataFrame({
                "input_ids": [x + [pad_id] * (max_length - len(x)) for x in ids],
                "attention_mask": [[1] * len(x) + [0] * (max_length - len(x)) for x in ids],
            })

    return df.withColumn("__enc", _enc(F.col(text))) \
        .withColumn("input_ids", F.col("__enc.input_ids")) \
        .withColumn("attention_mask", F.col("__enc.attention_mask")).drop("__enc")
