"""Byte-level BPE through a minimal acyclic transducer lexicon.

Words are counted over all documents; the most frequent ones are compiled,
with their ids, into a shared-suffix automaton whose arcs carry numbers: the
numbers on a word's path add up to its place in the id table. The automaton,
the id table and the merge table are one file, sent to every executor once
and memory-mapped by its workers. A word that is not in the lexicon is
merged exactly, lowest rank first, leftmost among equals.

Texts are cut where no token can reach across: at blanks between two
characters that are not white space, or, in texts with other white space
around a blank, by ``UNIT``. Each worker keeps the ids of the pieces it has
seen (two generations of ``MEMO`` entries).

Defined results: a null or empty text has no tokens and decodes to the empty
text; strings of added tokens in a text become their ids, as the tokenizer
file says; repeated rows give repeated rows; other columns are ignored; very
long words are merged with a heap in n log n.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import Memo, map_text, written

#: Words compiled into the lexicon; a bound on what the driver builds and executors map.
LEXICON_WORDS = 65_536
#: Longer words are left to the merge.
LEXICON_BYTES = 48
#: Units whose ids a worker remembers, in each of two generations, and words counted before a task passes them on.
MEMO = 150_000
COUNTED = 250_000
#: Words of at most so many bytes are merged many at a time.
ROW_BYTES = 48

# White space as Unicode has it (Python's \s also holds 1C to 1F).
_SPACE = "\t-\r \x85\xa0" + chr(0x1680) + chr(0x2000) + "-" + "".join(map(chr, (0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: A run of non-space with at most one blank before it, or white space as the word pattern cuts it.
UNIT = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")
#: Fixed value: the word pattern of byte-level BPE.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Fixed value: characters that the word pattern takes as one run when they follow a word's letters.
MARKS = ".,;:!?*&$#%|"


def chunk_words(chunk: str, blank: str) -> list[str] | None:
    """Words of ``blank + chunk``, a piece of text between two blanks (``blank`` is empty at the start of a text).

    None if white space stands at an edge: then what is beside the blank decides.
    """
    if not chunk:
        return None if blank else []
    if chunk[-1].isspace() or blank and chunk[0].isspace():
        return None
    core = chunk.rstrip(MARKS)
    if core.isalpha():
        return [blank + core, chunk[len(core):]] if len(core) < len(chunk) else [blank + core]
    return WORD.findall(blank + chunk)


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary -> the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Model:
    """The parts of a ``tokenizers`` byte-level BPE file that encoding needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        m, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (m["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
                or spec["normalizer"] or m.get("dropout") or m.get("ignore_merges") or m.get("end_of_word_suffix")
                or m.get("continuing_subword_prefix")):
            raise ValueError("not a plain byte-level BPE file")
        chars = byte_chars()
        vocab = m["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [b""] * size
        for t, i in vocab.items():
            self.tokens[i] = bytes(chars[c] for c in t) if all(c in chars for c in t) else t.encode()
        for t, i in self.special.items():
            self.tokens[i] = t.encode()
        self.byte_ids = np.zeros(256, np.int64)
        for c, b in chars.items():
            self.byte_ids[b] = vocab[c]
        merges = [p if isinstance(p, list) else p.split(" ") for p in m["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]


class Merger:
    """Exact merging of words that are not in the lexicon."""

    NONE = 1 << 40

    def __init__(self, byte_ids: np.ndarray, keys: np.ndarray, ranks: np.ndarray, made: np.ndarray):
        self.byte_ids, self.keys, self.ranks, self.made = byte_ids, keys, ranks, made

    def _rank(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self.ranks[at], self.NONE), at

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.array([len(w) for w in words])
        order = np.argsort(sizes, kind="stable")
        for at in range(0, len(order), 4096):
            rows = order[at:at + 4096]
            long = sizes[rows] > ROW_BYTES
            for r in rows[long]:
                out[r] = self.long(words[r])
            if len(rows := rows[~long]):
                for r, ids in zip(rows, self._rows([words[r] for r in rows], sizes[rows]), strict=True):
                    out[r] = ids
        return out

    def _rows(self, words: list[bytes], sizes: np.ndarray) -> list[bytes]:
        n, width = len(words), int(sizes.max())
        flat = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        ids = np.full((n, width + 1), -1, np.int64)
        ids[:, :width][np.arange(width) < sizes[:, None]] = flat
        rank, _ = self._rank(ids[:, :-1], ids[:, 1:])
        live, cols = np.arange(n), np.arange(width + 1)
        done = ids.copy()
        while len(live):
            p = rank.argmin(axis=1)
            row = np.arange(len(live))
            more = rank[row, p] < self.NONE
            done[live[~more]] = ids[~more]
            live, ids, rank, p = live[more], ids[more], rank[more], p[more]
            if not len(live):
                break
            row = np.arange(len(live))
            _, at = self._rank(ids[row, p], ids[row, p + 1])
            ids[row, p] = self.made[at]
            shift = np.minimum(cols + (cols > p[:, None]), width)
            ids = np.take_along_axis(ids, shift, 1)
            ids[:, -1] = -1
            rank = np.take_along_axis(rank, np.minimum(shift[:, :-1], width - 1), 1)
            rank[:, -1] = self.NONE
            for q in (np.maximum(p - 1, 0), p):
                rank[row, np.minimum(q, width - 1)] = self._rank(ids[row, q], ids[row, q + 1])[0]
        left = (done >= 0).sum(axis=1)
        packed = done[done >= 0].astype("<u4").tobytes()
        ends = np.cumsum(left) * 4
        return [packed[e - 4 * k:e] for e, k in zip(ends.tolist(), left.tolist(), strict=True)]

    def long(self, word: bytes) -> bytes:
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        nxt, prv, alive = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)], [True] * len(ids)
        first, at = self._rank(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64))
        heap = [(r, i, ids[i], ids[i + 1], m) for i, (r, m) in enumerate(zip(first.tolist(), self.made[at].tolist(), strict=True))
                if r < self.NONE]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], nxt[i] = m, False, nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
            for x, y in ((prv[i], i), (i, nxt[i])):
                if x >= 0 and y >= 0:
                    r, k = self._rank(np.array([ids[x]]), np.array([ids[y]]))
                    if r[0] < self.NONE:
                        heapq.heappush(heap, (int(r[0]), x, ids[x], ids[y], int(self.made[k[0]])))
        return np.array([v for v, ok in zip(ids, alive, strict=True) if ok], "<u4").tobytes()


# ------------------------------------------------------------------ the automaton
def minimal_automaton(words: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Arcs of the minimal automaton of sorted distinct ``words``: ``(state << 8 | byte, target, number, final)``.

    Words are added in order; when the next word leaves a branch, its states
    are replaced by equal ones already registered, so suffixes are shared.
    """
    register: dict[tuple, int] = {}
    arcs: list[list[tuple[int, int]]] = []     # registered states
    final: list[bool] = []
    path: list[tuple[int, list, list]] = [(-1, [], [False])]   # byte in, arcs, [is final], from the root

    def close(depth: int) -> None:
        while len(path) > depth:
            byte, out, end = path.pop()
            key = (end[0], tuple(out))
            if key not in register:
                register[key] = len(arcs)
                arcs.append(out)
                final.append(end[0])
            if path:
                path[-1][1].append((byte, register[key]))

    last = b""
    for w in words:
        same = len(os.path.commonprefix([last, w]))
        close(same + 1)
        for b in w[same:]:
            path.append((b, [], [False]))
        path[-1][2][0] = True
        last = w
    close(0)
    # states were registered children first, so counts are ready when needed; the root is the last one
    count = np.zeros(len(arcs), np.int64)
    rows = []
    for s, out in enumerate(arcs):
        n = int(final[s])
        for byte, t in out:
            rows.append((s << 8 | byte, t, n))
            n += int(count[t])
        count[s] = n
    a = np.array(rows, np.int64).reshape(-1, 3)
    return a[:, 0], a[:, 1], a[:, 2], np.array(final, np.uint8)


PARTS = ("keys", "target", "number", "final", "offsets", "ids", "byte_ids", "merge_keys", "merge_ranks", "merge_made")


def compile_lexicon(model: Model, words: list[bytes], path: str) -> None:
    """Write automaton, ids and merge table to one file that ``np.memmap`` can open."""
    words = sorted(set(words))
    keys, target, number, final = minimal_automaton(words)
    ids = Merger(model.byte_ids, model.keys, model.ranks, model.made).words(words)
    offsets = np.cumsum([0, *(len(x) for x in ids)])
    arrays = [keys, target, number, final, offsets, np.frombuffer(b"".join(ids), np.uint8),
              model.byte_ids, model.keys, model.ranks, model.made]
    at, head = 0, []
    for a in arrays:
        head.append((str(a.dtype), len(a), at))
        at += (a.nbytes + 7) // 8 * 8
    meta = json.dumps({"arrays": head, "special": model.special}).encode()
    with open(path, "wb") as f:
        f.write(len(meta).to_bytes(8, "little") + meta + b" " * (-len(meta) % 8))
        for a in arrays:
            f.write(a.tobytes() + b"\0" * (-a.nbytes % 8))


class Lexicon:
    """The memory-mapped file: ids of known words by walking the automaton, others by merging."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n = int.from_bytes(raw[:8].tobytes(), "little")
        meta = json.loads(raw[8:8 + n].tobytes())
        base = 8 + n + -n % 8
        part = {}
        for name, (kind, size, at) in zip(PARTS, meta["arrays"], strict=True):
            part[name] = raw[base + at:base + at + size * np.dtype(kind).itemsize].view(kind)
        self.keys, self.target, self.number = part["keys"], part["target"], part["number"]
        self.final, self.offsets, self.ids = part["final"], part["offsets"], part["ids"]
        self.root = len(self.final) - 1
        self.merger = Merger(part["byte_ids"], part["merge_keys"], part["merge_ranks"], part["merge_made"])
        self.special = meta["special"]
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.memo, self.chunks = Memo(MEMO), Memo(MEMO)

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """Place of each word in the id table, -1 if it is not in the lexicon."""
        sizes = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words) + b"\0", np.uint8).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        state, place = np.full(len(words), self.root), np.zeros(len(words), np.int64)
        if not len(self.keys):
            return np.full(len(words), -1)
        for k in range(int(min(sizes.max(initial=0), LEXICON_BYTES))):
            on = np.flatnonzero((sizes > k) & (state >= 0))
            if not len(on):
                break
            key = state[on] << 8 | flat[starts[on] + k]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            state[on] = np.where(hit, self.target[at], -1)
            place[on] += np.where(hit, self.number[at], 0)
        ok = (state >= 0) & (sizes <= LEXICON_BYTES)
        ok[ok] = self.final[state[ok]] == 1
        return np.where(ok, place, -1)

    def word_ids(self, words: list[bytes]) -> list[bytes]:
        place = self.lookup(words)
        a, b = self.offsets[place], self.offsets[np.minimum(place + 1, len(self.offsets) - 1)]
        table = memoryview(self.ids)
        out = [bytes(table[x:y]) if p >= 0 else b"" for p, x, y in zip(place.tolist(), a.tolist(), b.tolist(), strict=True)]
        unseen = np.flatnonzero(place < 0)
        for i, ids in zip(unseen, self.merger.words([words[i] for i in unseen]), strict=True):
            out[i] = ids
        return out

    def learn(self, units: list[str]) -> None:
        """Put the ids of ``units`` into the memo."""
        pieces = [WORD.findall(u) for u in units]
        words = list({w for p in pieces for w in p})
        ids = dict(zip(words, self.word_ids([w.encode() for w in words]), strict=True))
        for u, p in zip(units, pieces, strict=True):
            self.memo.known[u] = b"".join([ids[w] for w in p])

    def learn_chunks(self, chunks: list) -> None:
        """Put the ids of chunks (a 1-tuple: at the start of a text) into their memo; None for those the edges decide."""
        pieces = [chunk_words(c[0], "") if isinstance(c, tuple) else chunk_words(c, " ") for c in chunks]
        words = list({w for p in pieces if p for w in p})
        ids = dict(zip(words, self.word_ids([w.encode() for w in words]), strict=True))
        known = self.chunks.known
        for c, p in zip(chunks, pieces, strict=True):
            known[c] = None if p is None else ids[p[0]] if len(p) == 1 else b"".join([ids[w] for w in p])

    def parts(self, text: str) -> list[str]:
        return self.split.split(text) if self.split else [text]

    def _plain(self, parts: list[str]) -> list[bytes | None]:
        """Ids of each part; None where white space stands beside a blank."""
        cut = [p.split(" ") for p in parts]
        for c in cut:
            c[0] = (c[0],)
        if new := self.chunks.unknown(set().union(*cut)):
            self.learn_chunks(new)
        get = self.chunks.known.__getitem__
        out = []
        for c in cut:
            try:
                out.append(b"".join(map(get, c)))
            except TypeError:
                out.append(None)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        special = {t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}
        cut = [self.parts(t) for t in texts]
        flat = [p for c in cut for p in c if p not in special]
        ids = self._plain(flat)
        odd = [i for i, x in enumerate(ids) if x is None]
        units = [UNIT.findall(flat[i]) for i in odd]
        if new := self.memo.unknown(set().union(*units)):
            self.learn(new)
        for i, u in zip(odd, units, strict=True):
            ids[i] = b"".join(map(self.memo.known.__getitem__, u))
        left = iter(ids)
        return [b"".join([special[p] if p in special else next(left) for p in c]) if len(c) > 1 else next(left) if c[0] not in special
                else special[c[0]] for c in cut]


class Decoder:
    """Bytes of token ids by one gather over the vocabulary's bytes."""

    #: Ids decoded at once; bounds the memory of a very long text.
    IDS = 1 << 18

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def _gather(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        n = self.sizes[ids]
        ends = np.cumsum(n)
        at = np.repeat(self.starts[ids] - ends + n, n)
        at += np.arange(len(at))
        return self.flat[at].tobytes(), ends

    def decode(self, ids: list[bytes]) -> Iterator[bytes]:
        """Bytes of each text; short ones are decoded together."""
        held, n = [], 0
        for x in ids:
            if n + len(x) // 4 > self.IDS:
                yield from self._together(held)
                held, n = [], 0
            if len(x) // 4 > self.IDS:
                one = np.frombuffer(x, "<u4")
                yield b"".join(self._gather(one[i:i + self.IDS])[0] for i in range(0, len(one), self.IDS))
            else:
                held.append(x)
                n += len(x) // 4
        yield from self._together(held)

    def _together(self, ids: list[bytes]) -> Iterator[bytes]:
        data, ends = self._gather(np.frombuffer(b"".join(ids), "<u4"))
        last = np.cumsum([len(x) // 4 for x in ids])
        at = 0
        for k, x in zip(last.tolist(), ids, strict=True):
            end = int(ends[k - 1]) if x else at
            yield data[at:end]
            at = end


_OPEN: dict[str, Lexicon] = {}


def _lexicon(name: str) -> Lexicon:
    if name not in _OPEN:
        _OPEN.clear()
        _OPEN[name] = Lexicon(SparkFiles.get(name))
    return _OPEN[name]


# ------------------------------------------------------------------ over documents
def word_counts(docs: DataFrame, text_col: str = "text", special: Iterable[str] = ()) -> DataFrame:
    """``word, n`` of all documents; each task adds up its own words first.

    A text's first word counts as if a blank stood before it.
    """
    split = re.compile("|".join(map(re.escape, special))) if special else None

    def told(chunks: Counter) -> pa.RecordBatch:
        words: Counter = Counter()
        for c, n in chunks.items():
            pieces = chunk_words(c, " ")
            for w in WORD.findall(" " + c) if pieces is None else pieces:
                words[w] += n
        return pa.RecordBatch.from_arrays([pa.array([w.encode() for w in words], pa.binary()),
                                           pa.array(list(words.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        chunks: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                for p in (split.split(t) if split else [t]) if t else []:
                    chunks.update(p.split(" "))
            if len(chunks) > COUNTED:
                yield told(chunks)
                chunks = Counter()
        yield told(chunks)
    return map_text(docs.select(F.col(text_col).alias("text")), run, "word binary, n bigint") \
        .groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, size: int) -> DataFrame:
    """Words at least as frequent as the lowest count that at most ``size`` words reach.

    The threshold comes from the number of words for each count, so no task
    has to hand its own ``size`` candidates to the driver.
    """
    run = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)     # one row for each distinct count
    least = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).withColumn("upto", F.sum("words").over(run)) \
        .where(F.col("upto") <= size).agg(F.min("n").alias("n")).first()["n"]
    return counts.where(F.col("n") >= least if least is not None else F.lit(False))


def build_lexicon(docs: DataFrame, path: str, text_col: str = "text", size: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words of ``docs``, ``size`` at most; returns the name executors find the file by."""
    model = Model(path)
    counts = written(word_counts(docs, text_col, sorted(model.special))
                     .where((F.octet_length("word") <= LEXICON_BYTES) & (F.col("n") > 1)), "word-counts")
    top = frequent_words(counts, size).select("word").collect()         # at most ``size`` rows
    fd, file = tempfile.mkstemp(prefix="lexicon-", suffix=".bin")
    os.close(fd)
    compile_lexicon(model, [bytes(r["word"]) for r in top], file)
    docs.sparkSession.sparkContext.addFile(file)
    return os.path.basename(file)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     lexicon_words: int = LEXICON_WORDS, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``) of every document."""
    name = build_lexicon(docs, path, text_col, lexicon_words)
    decoder = docs.sparkSession.sparkContext.broadcast(Decoder(Model(path).tokens))      # bounded by the vocabulary

    def run(batches):
        lex, table = _lexicon(name), decoder.value
        for b in batches:
            ids = lex.encode([t or "" for t in b.column(1).to_pylist()])
            n, digest, back = [], [], []
            for x, text in zip(ids, table.decode(ids), strict=True):
                n.append(len(x) // 4)
                digest.append(hashlib.sha256(x).hexdigest())
                back.append(hashlib.sha256(text.decode("utf-8", "replace").encode()).hexdigest())
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(back, pa.string())]
            if keep_ids:
                flat = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
                cols.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), flat))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(cols)])
    return map_text(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")), run,
                    "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)
