"""Deterministic sharded WARC writer and reader.

Writing: the bytes before each record, in id order, come from distributed
prefix sums over a narrow table; they cut the ids into shards of about
``SHARD_BYTES``. Rows are range-sorted into their shards in one shuffle, and
each shard is written as a series of files: every record is a gzip member,
and a file that has reached ``ROLL_BYTES`` compressed is closed. Headers and
digests are made anew from the payload. A file is written under a temporary
name, renamed when whole, and named in a manifest table; readers only open
files of the manifest and check their size and digests.

Repeats: of equal payloads of at least ``MIN_REPEAT`` bytes the record with
the smallest id is a ``response``; the others are ``revisit`` records that
hold the HTTP head only. Equal payloads meet as (digest, smallest id), after
map-side aggregation, never as lists; which ids are repeats travels to the
writer as narrow rows that sort before the page itself.

Defined results: a null payload is empty; a null id sorts first, is nobody's
smallest (it revisits a record with an id if there is one, else it is a
response) and reads back as null; a null url has no target header; rows that
share the smallest id of a payload are all responses; equal input gives
equal files; an empty table gives an empty manifest. Other columns are
ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import (CommittedFile, key_of, prefix_sums, read_file, shard_bounds, shared_uri, slices,
                                   with_shard, written)

MIN_REPEAT = 100
#: Payload bytes of a shard (a task) on small inputs; it grows so that there are at most ``MAX_SHARDS``.
SHARD_BYTES = 8 << 20
MAX_SHARDS = 20_000
#: Compressed bytes from which a file is closed. Well below what a shard compresses to, so a shard is a series of files.
ROLL_BYTES = 1 << 20
#: The record format, and one date for all records so that reruns agree.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "file string, shard int, records bigint, bytes bigint, crc32 bigint"
RECORDS = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisits: tuple | None) -> bytes:
    """One record; ``revisits`` is ``(id of the response,)`` for a revisit."""
    head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: " + str(len(payload)).encode() + b"\r\n\r\n")
    block = head if revisits else head + payload
    lines = [VERSION, f"WARC-Type: {'revisit' if revisits else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}",
             f"WARC-Date: {DATE}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisits:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(revisits[0], digest)}",
                  f"X-Refers-To-Page: {revisits[0]}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8") + block + b"\r\n\r\n"


class _Series:
    """The files of one shard, rolled by compressed size."""

    def __init__(self, uri: str, shard: int, roll: int):
        self.uri, self.shard, self.roll, self.seq, self.file = uri, shard, roll, 0, None

    def add(self, data: bytes) -> dict | None:
        if self.file is None:
            self.name = f"part-{self.shard:06d}-{self.seq:05d}.warc.gz"
            self.file, self.n, self.crc = CommittedFile(self.uri, self.name), 0, 0
        member = gzip.compress(data, 6, mtime=0)
        self.file.write(member)
        self.crc = zlib.crc32(member, self.crc)
        self.n += 1
        return self.close() if self.file.size >= self.roll else None

    def close(self) -> dict | None:
        if self.file is None:
            return None
        self.file.commit()
        row = {"file": self.name, "shard": self.shard, "records": self.n, "bytes": self.file.size, "crc32": self.crc}
        self.file, self.seq = None, self.seq + 1
        return row


def _write(uri: str, roll: int):
    def rows(batches) -> Iterator[dict | None]:
        series, at, repeats = None, None, {}
        for b in slices(batches):
            for shard, key, tag, page_id, url, payload, digest, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if series is None or series.shard != shard:
                    if series:
                        yield series.close()
                    series = _Series(uri, shard, roll)
                if at != (shard, key):
                    at, repeats = (shard, key), {}
                if tag == 0:
                    repeats[digest] = (first,)
                    continue
                payload = (payload or "").encode("utf-8", "surrogatepass")
                yield series.add(record(page_id, url, payload, digest, repeats.get(digest)))
        if series:
            yield series.close()

    def run(batches):
        done = [r for r in rows(batches) if r]          # one row a file
        yield pa.RecordBatch.from_pylist(done, pa.schema([("file", pa.string()), ("shard", pa.int32()), ("records", pa.int64()),
                                                          ("bytes", pa.int64()), ("crc32", pa.int64())]))
    return run


def write_archives(pages: DataFrame, uri: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
                   min_repeat: int = MIN_REPEAT) -> tuple[str, DataFrame]:
    """Write one record for each row; returns the folder and the manifest."""
    uri = uri or shared_uri(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    base = pages.select(key_of(id_col).alias("key"), F.col(id_col).cast("bigint").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"), F.col(payload_col).cast("string").alias("payload"),
                        F.sha2(payload, 256).alias("digest"))
    light = prefix_sums(pages.select(key_of(id_col).alias("key"), F.col(id_col).cast("bigint").alias("page_id"),
                                     F.octet_length(payload).cast("bigint").alias("n"), F.sha2(payload, 256).alias("digest")),
                        ["key", "digest"], "n")
    light = written(light, "warc-light")
    bounds = shard_bounds(light, "key", shard_bytes, MAX_SHARDS)
    first = light.where(F.col("n") >= min_repeat).groupBy("digest") \
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")) \
        .where((F.col("copies") > 1) & F.col("first").isNotNull()).drop("copies")
    repeats = light.select("key", "page_id", "digest").join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("first")))
    both = base.select("key", F.lit(1).alias("tag"), "page_id", "url", "payload", "digest", F.lit(None).cast("bigint").alias("first")) \
        .unionByName(repeats.select("key", F.lit(0).alias("tag"), "page_id", F.lit(None).cast("string").alias("url"),
                                    F.lit(None).cast("string").alias("payload"), "digest", "first"))
    sorted_ = with_shard(both, "key", bounds).select(F.col("__shard").alias("shard"), "key", "tag", "page_id", "url", "payload",
                                                     "digest", "first") \
        .repartition(max(1, len(bounds)), "shard").sortWithinPartitions("shard", "key", "tag", "digest", "url")
    return uri, written(sorted_.mapInArrow(_write(uri, roll_bytes), MANIFEST), "warc-manifest")


# ------------------------------------------------------------------ reading
def members(stream) -> Iterator[tuple[bytes, int]]:
    """``(decompressed member, crc32 of the bytes so far)`` of a gzip file read in pieces."""
    z, out, crc = zlib.decompressobj(31), [], 0
    while piece := stream.read(1 << 20):
        crc = zlib.crc32(piece, crc)
        while piece:
            out.append(z.decompress(piece))
            if not z.eof:
                break
            piece = z.unused_data
            yield b"".join(out), crc
            z, out = zlib.decompressobj(31), []
    if out and not z.eof and any(out):
        raise ValueError("truncated archive")


def parse(data: bytes) -> dict:
    """Fields of one record; raises if a length or digest does not hold."""
    at = data.index(b"\r\n\r\n")
    version, *lines = data[:at].decode("utf-8").split("\r\n")
    h = dict(line.split(": ", 1) for line in lines)
    block = data[at + 4:at + 4 + int(h["Content-Length"])]
    if version != VERSION or len(data) != at + 8 + len(block):
        raise ValueError(f"bad record {h.get('WARC-Record-ID')}")
    if hashlib.sha256(block).hexdigest() != h["WARC-Block-Digest"].removeprefix("sha256:"):
        raise ValueError(f"block digest of {h['WARC-Record-ID']}")
    cut = block.index(b"\r\n\r\n") + 4
    http = dict(line.split(b": ", 1) for line in block[:cut - 4].split(b"\r\n")[1:])
    digest, kind = h["WARC-Payload-Digest"].removeprefix("sha256:"), h["WARC-Type"]
    payload = block[cut:] if kind == "response" else None
    size = int(http[b"Content-Length"])
    if payload is not None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {h['WARC-Record-ID']}")
    whole = lambda k: int(h[k]) if k in h else None
    return {"page_id": whole("X-Page-ID"), "url": h.get("WARC-Target-URI"), "record_type": kind,
            "refers_to": whole("X-Refers-To-Page"), "payload_bytes": size, "payload_digest": digest, "payload": payload}


def read_archives(uri: str, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of all files of the manifest; ``payload`` is null for revisits and if ``payloads`` is off."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def run(batches):
        for b in batches:
            for m in b.to_pylist():
                with read_file(uri, m["file"]) as f:
                    out, n, held, crc = [], 0, 0, 0
                    for data, crc in members(f):
                        r = parse(data)
                        if not payloads:
                            r["payload"] = None
                        out.append(r)
                        n += 1
                        held += len(r["payload"] or b"") + 256
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out, held = [], 0
                    if n != m["records"] or crc != m["crc32"]:
                        raise ValueError(f"{m['file']} is not the file of the manifest")
                    yield pa.RecordBatch.from_pylist(out, schema)
    files = manifest.sparkSession.sparkContext.defaultParallelism * 2
    return manifest.repartition(files, "file").mapInArrow(run, RECORDS)
