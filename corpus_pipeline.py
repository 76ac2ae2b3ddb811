"""The corpus pipeline: stages over ``documents``, each calling one operator.

Each stage takes ``(spark, docs, sf_dir)``; its rows are written as Parquet
and read again as the next one's ``docs``. All but the last return the
columns of ``documents``:

* toxicity: documents the ordinal model rejects go; the rest is unchanged;
* simhash: one document of each near-duplicate group stays (smallest id);
* pii: personal data in the texts is replaced by its kind;
* mixing: each document stands once for each pass of the mix that takes it;
* bpe: token ids of each document, with digests of ids and decoded text.

Null and empty texts pass all stages (mixing takes no document without
words); a missing or one-sided label set rejects nothing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusprep.llm import bpe_transducer, ordinal_toxicity, pii_scan, simhash_gray, source_mix
from corpusprep.llm.common import table, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ordinal_toxicity.keep_clean(docs, ordinal_toxicity.train(docs, table(spark, sf_dir, "labels")))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_gray.keep_one(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii_scan.mask_pii(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_transducer.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=True)


STAGES = [("toxicity", toxicity), ("simhash", simhash), ("pii", pii), ("mixing", mixing), ("bpe", bpe)]
#: A fitted classifier and tokenizer files are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
