"""Line dedup: levelled sorted runs of line hashes.

A document's lines are hashed once (128 bits of the stripped, lower-cased
line); documents come in batches. A run is a table of ``hash, docs`` sorted
by hash, cut into buckets that are files of their own, so runs are merged
bucket by bucket without a shuffle. A new batch counts its documents for each
hash, merge-anti-joins the hashes that a run already shows to be frequent
(they are settled and need no more counting) and adds the rest as a run of
level 0. When a level holds ``fanout`` runs they are compacted into one run
of the next level, counts added. In the end a hash is frequent if its counts
over all runs reach ``min_docs``; the lines are joined with these hashes and
the documents with the places of the lines they lose.

Equal texts lose equal lines, so hashes are kept once for each distinct text,
with its number of documents. A line that stands in a third of all documents
is one hash of a map-side sum, and one row of the side that lines meet.

Defined results: a row is a document, repeated rows and null ids included; a
null or empty text is one empty line; lines whose key is empty always stay;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm.common import map_text, written
from corpusprep.session import scratch_path

MIN_DOCS = 10
BATCHES = 6
FANOUT = 2
SPACE = b" \t\n\x0b\x0c\r"
HASH_BYTES = 16


def line_hash(line: bytes) -> bytes | None:
    """Hash of a line's key; None if the key is empty."""
    key = line.strip(SPACE).lower()                # bytes.lower() touches A-Z only
    return hashlib.blake2b(key, digest_size=HASH_BYTES).digest() if key else None


def _hashed(texts: DataFrame) -> DataFrame:
    """``key, hashes`` for ``key, text``: one hash for each line, null for an empty key."""
    def run(batches):
        for b in batches:
            hashes = [[line_hash(x) for x in t.split(b"\n")] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hashes, pa.list_(pa.binary()))], names=["key", "hashes"])
    return map_text(texts.select("key", F.col("text").cast("binary")), run, "key binary, hashes array<binary>")


class LineRuns:
    """The runs of one corpus: add batches, compact, ask for the frequent hashes."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, max(2, fanout)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        counts.select("hash", "docs").write.bucketBy(self.buckets, "hash").sortBy("hash") \
            .option("path", scratch_path(self.spark, "line-run")).saveAsTable(name)
        return name

    def _tables(self) -> list[str]:
        return [t for level in self.levels for t in level]

    def _merged(self, tables: list[str]) -> DataFrame:
        """One row for each hash of the runs, counts added: merge joins of sorted buckets, without a shuffle for two runs."""
        def two(a: DataFrame, b: DataFrame) -> DataFrame:
            both = a.join(b.withColumnRenamed("docs", "more").hint("merge"), "hash", "full")
            return both.select("hash", (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"))
        return reduce(two, map(self.spark.table, tables))

    def add(self, lines: DataFrame) -> None:
        """Add a batch of ``hashes array<binary>, docs bigint``: a text's line hashes and its number of documents."""
        fresh = lines.select(F.explode(F.array_distinct("hashes")).alias("hash"), "docs").where("hash is not null") \
            .groupBy("hash").agg(F.sum("docs").alias("docs"))
        for t in self._tables():
            settled = self.spark.table(t).where(F.col("docs") >= self.min_docs).select("hash")
            fresh = fresh.join(settled.hint("merge"), "hash", "left_anti")
        self._add(self._write(fresh), 0)

    def _add(self, run: str, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._add(self._write(self._merged(runs)), level + 1)
            self._forget(runs)

    def _forget(self, runs: list[str]) -> None:
        for t in runs:                             # the files stay below the shared folder
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")

    def frequent(self) -> DataFrame:
        """``hash`` of every line found in at least ``min_docs`` documents, as a written table."""
        runs = self._tables()
        if not runs:
            return self.spark.createDataFrame([], "hash binary")
        return written(self._merged(runs).where(F.col("docs") >= self.min_docs).select("hash"), "line-frequent")

    def close(self) -> None:
        self._forget(self._tables())
        self.levels = []


def frequent_places(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``key, places`` for each distinct text (``docs``: ``key, text``) with frequent lines: their numbers from 0, ascending."""
    spark = docs.sparkSession
    texts = _hashed(docs).groupBy("key").agg(F.first("hashes").alias("hashes"), F.count(F.lit(1)).alias("docs")) \
        .withColumn("batch", F.pmod(F.xxhash64("key"), F.lit(batches)).cast("int"))
    path = scratch_path(spark, "line-hashes")
    texts.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("key binary, hashes array<binary>, docs bigint, batch int").parquet(path)
    runs = LineRuns(spark, min_docs, fanout)
    for i in range(batches):
        runs.add(lines.where(F.col("batch") == i))
    frequent = runs.frequent()
    runs.close()
    placed = lines.select("key", F.posexplode("hashes").alias("place", "hash")).where("hash is not null")
    return placed.join(frequent, "hash").groupBy("key").agg(F.sort_array(F.collect_list("place")).alias("places"))


def drop_frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                        batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``<id_col>, text, n_lines, n_dropped`` for every row: its text without the lines found in ``min_docs`` documents."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("key", F.unhex(F.md5("text")))
    lost = frequent_places(rows.select("key", "text"), min_docs, batches, fanout)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts, counts, dropped = [], [], []
            for t, places in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                lines = t.split("\n")
                counts.append(len(lines))
                at = places.values
                dropped.append(0 if at is None else len(at))
                if at is not None:
                    keep = np.ones(len(lines), bool)
                    keep[at.to_numpy()] = False
                    t = "\n".join([x for x, k in zip(lines, keep.tolist(), strict=True) if k])
                texts.append(t)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                                              pa.array(dropped, pa.int64())], names=["id", "text", "n_lines", "n_dropped"])
    out = map_text(rows.join(lost, "key", "left").select("id", "text", "places"), run,
                   f"id {kind}, text string, n_lines bigint, n_dropped bigint")
    return out.withColumnRenamed("id", id_col)
