"""Token ids in files coded by a static range asymmetric numeral system.

A file holds whole documents in id order. One frequency table, counted over
all ids of the file, is shared by its blocks. A block is ``LANES`` interleaved
states over ``LANES * STEPS`` ids and needs nothing but the table, so blocks
are decoded in any order or side by side; the checkpoint index has each
block's byte offset, lengths and the checksums of its bytes and of its ids.

Layout (little endian): magic, header length, JSON header, then compressed
table, compressed document index, checkpoint index, blocks. The header has
the sizes and checksums of the three sections.

Writing: text bytes, summed in id order, cut the ids into shards; documents
are tokenized, range-sorted into their shards in one shuffle of packed ids,
and written as files of at least ``FILE_TOKENS`` ids (or the shard's rest)
under temporary names, renamed when whole and listed in a manifest. The
position of a file among all ids is a prefix sum over the manifest.

Defined results: a null or empty text has the end id alone; a null id sorts
first and reads back as null; rows that share an id are ordered by their ids;
an empty table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import (CommittedFile, key_of, map_text, prefix_sums, read_file, shard_bounds, shard_firsts,
                                   shared_uri, slices, written)

MAGIC = b"RANSIDS1"
LANES, STEPS = 32, 512
BLOCK = LANES * STEPS
FILE_TOKENS = 2 << 20
#: Text bytes of a shard on small inputs; it grows so that there are at most ``MAX_SHARDS``.
SHARD_BYTES = 8 << 20
MAX_SHARDS = 20_000
LOW = np.uint64(1 << 31)          # states stay in [2^31, 2^63)
CHECKPOINT = np.dtype([("offset", "<u8"), ("words", "<u4"), ("ids", "<u4"), ("crc", "<u4"), ("ids_crc", "<u4")])
#: Chunks that a worker remembers in each of two generations; words and their chunks share the memory.
MEMO = 300_000


# ------------------------------------------------------------------ the coder
def frequencies(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Frequencies of at least 1 that add up to a power of two."""
    bits = max(16, int(len(counts)).bit_length() + 3)
    free = (1 << bits) - len(counts)
    f = 1 + counts * free // counts.sum()
    f[np.argmax(counts)] += (1 << bits) - f.sum()
    return f, bits


class Table:
    """Symbols of a file with their frequencies; codes places, not ids."""

    def __init__(self, symbols: np.ndarray, freq: np.ndarray, bits: int):
        self.symbols, self.bits = symbols.astype(np.int64), bits
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.limit = self.freq * np.uint64((1 << 31 >> bits) << 32)

    def encode(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``places[block, step, lane]`` -> final states, and words and their mask as ``[block, step, lane]``."""
        b, steps, lanes = places.shape
        x = np.full((b, lanes), LOW, np.uint64)
        words, mask = np.zeros(places.shape, np.uint32), np.zeros(places.shape, bool)
        half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
        for t in range(steps - 1, -1, -1):
            s = places[:, t]
            f = self.freq[s]
            full = x >= self.limit[s]
            mask[:, t] = full
            words[:, t] = x & low
            x = np.where(full, x >> half, x)
            q = x // f
            x = (q << np.uint64(self.bits)) + (x - q * f) + self.start[s]
        return x, words, mask

    def decode(self, states: np.ndarray, words: np.ndarray, first: np.ndarray, steps: int) -> np.ndarray:
        """Places ``[block, step, lane]`` from states ``[block, lane]`` and the place of each block's first word."""
        lut = np.repeat(np.arange(len(self.freq), dtype=np.int32), self.freq.astype(np.int64))
        x, at = states.copy(), first.astype(np.int64).copy()
        out = np.empty((len(x), steps, x.shape[1]), np.int32)
        low, bits, half = np.uint64((1 << self.bits) - 1), np.uint64(self.bits), np.uint64(32)
        words = np.append(words, np.uint32(0)).astype(np.uint64)
        for t in range(steps):
            slot = x & low
            s = lut[slot.astype(np.int64)]
            out[:, t] = s
            x = self.freq[s] * (x >> bits) + slot - self.start[s]
            more = x < LOW
            taken = np.cumsum(more, axis=1)
            x = np.where(more, (x << half) | words[np.minimum(at[:, None] + taken - 1, len(words) - 1)], x)
            at += taken[:, -1]
        if (x != LOW).any():
            raise ValueError("a block does not end in the first state")
        return out


def pack(doc_ids: list[int | None], docs: list[np.ndarray]) -> bytes:
    """The bytes of one file."""
    flat = np.concatenate(docs).astype(np.uint32)
    counts = np.bincount(flat)              # ids are bounded by the vocabulary
    symbols = np.flatnonzero(counts)
    place = np.zeros(len(counts), np.int32)
    place[symbols] = np.arange(len(symbols))
    places = place[flat]
    freq, bits = frequencies(counts[symbols])
    table = Table(symbols, freq, bits)
    whole, rest = divmod(len(flat), BLOCK)
    parts = [(places[:whole * BLOCK].reshape(whole, STEPS, LANES), BLOCK)] if whole else []
    if rest:
        tail = np.zeros(-(-rest // LANES) * LANES, np.int32)
        tail[:rest] = places[whole * BLOCK:]
        parts.append((tail.reshape(1, -1, LANES), rest))
    blocks, index, offset = [], [], 0
    for group, size in parts:
        states, words, mask = table.encode(group)
        for i in range(len(group)):
            w = words[i][mask[i]]
            data = states[i].astype("<u8").tobytes() + w.astype("<u4").tobytes()
            at = len(index) * BLOCK
            index.append((offset, len(w), size, zlib.crc32(data), zlib.crc32(flat[at:at + size].astype("<u4").tobytes())))
            blocks.append(data)
            offset += len(data)
    sections = [zlib.compress(symbols.astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 6),
                zlib.compress(json.dumps(doc_ids).encode() + b"\n" + np.array([len(d) for d in docs], "<i8").tobytes(), 6),
                np.array(index, CHECKPOINT).tobytes()]
    head = json.dumps({"bits": bits, "symbols": len(symbols), "ids": len(flat), "documents": len(docs), "blocks": len(index),
                       "lanes": LANES, "steps": STEPS, "sections": [[len(s), zlib.crc32(s)] for s in sections]}).encode()
    return b"".join([MAGIC, len(head).to_bytes(8, "little"), head, *sections, *blocks])


class Reader:
    """One file: document index, and any run of blocks."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        n = int.from_bytes(data[8:16], "little")
        self.head = json.loads(data[16:16 + n])
        at, got = 16 + n, []
        for size, crc in self.head["sections"]:
            got.append(data[at:at + size])
            at += size
            if zlib.crc32(got[-1]) != crc:
                raise ValueError("a section's checksum does not hold")
        k = self.head["symbols"]
        table = np.frombuffer(zlib.decompress(got[0]), "<u4").astype(np.int64)
        self.table = Table(table[:k], table[k:], self.head["bits"])
        ids, sizes = zlib.decompress(got[1]).split(b"\n", 1)
        self.doc_ids, self.sizes = json.loads(ids), np.frombuffer(sizes, "<i8")
        self.index, self.blocks = np.frombuffer(got[2], CHECKPOINT), data[at:]

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids of blocks ``first`` to ``last`` (exclusive); other blocks are not touched."""
        index = self.index[first:last]
        out, lanes = [], self.head["lanes"]
        height = -(-index["ids"].astype(np.int64) // lanes)
        for steps in dict.fromkeys(height.tolist()):          # full blocks, then a shorter last one
            rows = index[height == steps]
            states, words, starts, n = [], [], [], 0
            for r in rows:
                a, b = int(r["offset"]), int(r["offset"]) + lanes * 8 + int(r["words"]) * 4
                data = self.blocks[a:b]
                if zlib.crc32(data) != r["crc"]:
                    raise ValueError("a block's checksum does not hold")
                states.append(np.frombuffer(data, "<u8", lanes))
                words.append(np.frombuffer(data, "<u4", offset=lanes * 8))
                starts.append(n)
                n += int(r["words"])
            got = self.table.decode(np.array(states, np.uint64), np.concatenate(words), np.array(starts), steps)
            for r, places in zip(rows, got.reshape(len(rows), -1), strict=True):
                ids = self.table.symbols[places[:int(r["ids"])]].astype("<u4")
                if zlib.crc32(ids.tobytes()) != r["ids_crc"]:
                    raise ValueError("the ids of a block do not have their checksum")
                out.append(ids)
        return np.concatenate(out) if out else np.zeros(0, "<u4")


# ------------------------------------------------------------------ tokenizing
class Learned(dict):
    """What a worker remembers, in two generations: a missing value comes from the older one or is learned."""

    def __init__(self, learn):
        self.learn, self.old = learn, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.learn(key)
        self[key] = value
        return value

    def turn(self, size: int) -> None:
        """Begin a generation when this one has more than ``size`` entries; often used entries stay."""
        if len(self) > size:
            self.old = dict(self)
            self.clear()


class WordTokens:
    """Ids of whole texts by the ``tokenizers`` library.

    The tokenizer drops white space and no token reaches across it, so a text
    is the sequence of its chunks, and each new chunk is tokenized once and
    remembered. A word of plain letters before closing marks is asked for
    apart from them, in lower case: normalizing and splitting leave such a
    word as it is, so the library's BPE model gets its bytes directly. Other
    chunks, and texts with a special token's string, go through the whole
    tokenizer.
    """

    MARKS = b".,;:!?*&$#%|"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        spec = json.loads(self.lib.to_str())
        self.special = [t["content"] for t in spec["added_tokens"]]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        splits = [p["pattern"].get("Regex", "") for p in steps if p["type"] == "Split"]
        names = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        # chunks are apart only if white space never enters a token and letters are lower-cased
        self.chunked = (names == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in steps] == ["Split", "ByteLevel"]
                        and "[\\p{L}]+" in splits[0] and "[^\\s\\p{L}\\p{N}]+" in splits[0] and spec["post_processor"] is None)
        # the printable character of each byte in a byte-level vocabulary
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = iter(range(256, 512))
        self.byte_char = {b: chr(b) if b in plain else chr(next(rest)) for b in range(256)}
        #: Bytes of an id in the memories and in ``packed``: two, if the vocabulary allows it.
        last = max(self.lib.get_vocab(with_added_tokens=True).values())
        self.width = 2 if last < 1 << 16 else 4
        self.id_bytes = [i.to_bytes(self.width, "little") for i in range(last + 1)]
        self.model = self.lib.model
        #: Chunks, the plain words within them among these, and the marks that close a chunk.
        self.chunks, self.tails = Learned(self._chunk), Learned(self._whole)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, f"<u{self.width}").tobytes() for e in self.lib.encode_batch(texts, add_special_tokens=False)]

    def _whole(self, chunk: bytes) -> bytes:
        return self._library([chunk.decode("utf-8")])[0]

    def _word(self, word: bytes) -> bytes:
        """Ids of a lower-case word of plain letters."""
        piece = word.decode("ascii") if word.isascii() else word.decode("latin-1").translate(self.byte_char)
        at = self.id_bytes
        return b"".join([at[t.id] for t in self.model.tokenize(piece)])

    def _plain(self, core: bytes) -> bytes | None:
        """A word of plain letters, not all of them ASCII, in lower case; None for all other chunks."""
        word = core.decode("utf-8")
        if not word.isalpha() or ord(max(word)) >= 0x250:
            return None
        low = word.lower()
        # a letter whose lower case holds a mark, which would join the tail, makes it longer
        return low.encode("utf-8") if len(low) == len(word) else None

    def _chunk(self, chunk: bytes) -> bytes:
        core = chunk.rstrip(self.MARKS)
        if core.isalpha():                      # bytes.isalpha() knows ASCII letters only
            word = core.lower()
        else:
            word = None if core.isascii() else self._plain(core)
            if word is None:
                return self._whole(chunk)
        ids = self._word(word) if word == chunk else self.chunks[word]
        return ids if len(core) == len(chunk) else ids + self.tails[chunk[len(core):]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        return [np.frombuffer(x, f"<u{self.width}").astype("<u4").tobytes() for x in self.packed(texts)]

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned integers of ``width`` bytes."""
        whole = [not self.chunked or any(s in t for s in self.special) for t in texts]
        cut = [[] if w else t.encode("utf-8").split() for t, w in zip(texts, whole, strict=True)]
        for memory in (self.chunks, self.tails):
            memory.turn(MEMO)
        get = self.chunks.__getitem__
        out = [b"".join(map(get, cs)) for cs in cut]
        for i in np.flatnonzero(whole):
            out[i] = self._library([texts[i]])[0]
        return out


_OPEN: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    if path not in _OPEN:
        _OPEN[path] = WordTokens(path)
    return _OPEN[path]


# ------------------------------------------------------------------ files
MANIFEST = pa.schema([("file", pa.string()), ("shard", pa.int32()), ("seq", pa.int32()), ("documents", pa.int64()),
                      ("tokens", pa.int64()), ("bytes", pa.int64()), ("crc32", pa.int64())])


def _write(uri: str, file_tokens: int):
    def files(batches) -> Iterator[dict]:
        _OPEN.clear()               # a worker that tokenized before holds its words no longer
        at, seq, ids, docs, n = None, 0, [], [], 0

        def flush() -> dict:
            name, data = f"part-{at:06d}-{seq:05d}.rans", pack(ids, docs)
            f = CommittedFile(uri, name)
            f.write(data)
            f.commit()
            return {"file": name, "shard": at, "seq": seq, "documents": len(ids), "tokens": n, "bytes": len(data),
                    "crc32": zlib.crc32(data)}
        for b in slices(batches):
            for shard, doc_id, width, packed in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if docs and (shard != at or n >= file_tokens):
                    yield flush()
                    seq, ids, docs, n = seq + 1, [], [], 0
                if shard != at:
                    at, seq = shard, 0
                ids.append(doc_id)
                docs.append(np.frombuffer(packed, f"<u{width}"))
                n += len(docs[-1])
        if docs:
            yield flush()

    def run(batches):
        yield pa.RecordBatch.from_pylist(list(files(batches)), MANIFEST)       # one row a file
    return run


def write_tokens(docs: DataFrame, path: str, end_id: int, uri: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 shard_bytes: int = SHARD_BYTES, file_tokens: int = FILE_TOKENS) -> tuple[str, DataFrame]:
    """Tokenize, code and write; returns the folder and the manifest."""
    uri = uri or shared_uri(docs.sparkSession, "rans")
    light = docs.select(key_of(id_col).alias("key"),
                        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("n"))
    bounds = shard_bounds(prefix_sums(light, ["key"], "n"), "key", shard_bytes, MAX_SHARDS)
    firsts = shard_firsts(bounds)

    def run(batches):
        tokens = word_tokens(path)
        width = max(tokens.width, 2 if end_id < 1 << 16 else 4)
        encode = tokens.packed if width == tokens.width else tokens.encode
        end = end_id.to_bytes(width, "little")
        for b in batches:
            out = [x + end for x in encode([t or "" for t in b.column(2).to_pylist()])]
            shard = np.searchsorted(firsts, b.column(0).to_numpy(), side="right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), b.column(0), b.column(1),
                                              pa.array(np.full(len(out), width, np.int32)), pa.array(out, pa.binary())],
                                             names=["shard", "key", "doc_id", "width", "ids"])
    coded = map_text(docs.select(key_of(id_col).alias("key"), F.col(id_col).cast("bigint").alias("doc_id"),
                                 F.col(text_col).alias("text")), run, "shard int, key bigint, doc_id bigint, width int, ids binary")
    sorted_ = coded.repartition(max(1, len(bounds)), "shard").sortWithinPartitions("shard", "key", "ids")
    schema = "file string, shard int, seq int, documents bigint, tokens bigint, bytes bigint, crc32 bigint"
    return uri, written(sorted_.mapInArrow(_write(uri, file_tokens), schema), "rans-manifest")


def read_tokens(uri: str, manifest: DataFrame, keep_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document, from the files."""
    files = prefix_sums(manifest, ["shard", "seq"], "tokens").select("file", "crc32", "start")
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:4 + keep_ids]

    def run(batches):
        for b in batches:
            for m in b.to_pylist():
                with read_file(uri, m["file"]) as f:
                    data = f.read()
                if zlib.crc32(data) != m["crc32"]:
                    raise ValueError(f"{m['file']} is not the file of the manifest")
                r = Reader(data)
                ids, ends = r.ids(), np.cumsum(r.sizes)
                raw = ids.tobytes()
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for n, e in zip(r.sizes.tolist(), ends.tolist(), strict=True)]
                cols = [pa.array(r.doc_ids, pa.int64()), pa.array(ends - r.sizes + m["start"]), pa.array(r.sizes.astype(np.int64)),
                        pa.array(crc, pa.int64())]
                if keep_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=names)
    n = manifest.sparkSession.sparkContext.defaultParallelism * 2
    return files.repartition(n, "file").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids)
