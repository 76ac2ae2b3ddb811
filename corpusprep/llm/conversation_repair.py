"""Conversation structure repair: the cheapest edits as one integer minimum over a DAG.

Every row of a conversation is kept, re-roled or deleted and empty turns may
be inserted, so that the initials of the roles read ``(s?(ua)+)?``. A node of
the DAG is (rows read, grammar state); the weight of a path is one big
integer: its high digits are the cost, its low digits (three bits each, from
the left) the letters of the edits so far, with zeros at the end. Letters are
numbered in ASCII order, so the smallest integer is the cheapest path and,
among these, the ASCII-least audit; nothing else breaks ties. One path that
reads as many rows as another and whose letters begin with the other's holds
more insertions and costs more, so a node never compares a path with its own
continuation, and one integer for each node is enough.

Rows are numbered by a distributed range sort. At most ``SEGMENT_ROWS``
neighbouring rows of a conversation make a segment; its transfer (best path
from each state to each state) is found alone, so a conversation that holds a
large part of all rows is worked on by many tasks. A last pass streams a
conversation's transfers and then its rows in order, with one integer for each
state in memory, and gives out the repaired turns. SHA-256 of one
conversation is a serial hash: its rows pass through one task, not through
its memory.

Defined results: a null role or text is one space, a null conversation id a
conversation of its own, null turns come first; rows of one turn stand by
role and text (by their first 64 characters, then by digest); every row counts,
repeated ones too; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import slices, written

#: Letters in ASCII order with their digits, and the costs of the edits.
DELETE, INSERT, KEEP, REROLE = "DIKR"
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
COST = {"D": 4, "I": 3, "K": 0, "R": 3}
TRUNCATED_COST = 3
DIGIT_BITS = 3
TO_DIGITS, TO_LETTERS = str.maketrans("DIKR", "1234"), str.maketrans("1234", "DIKR")

#: The grammar (s?(ua)+)? : 0 nothing yet, 1 after s, 2 after u, 3 after a.
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
ACCEPTS = (0, 3)
STATES = range(len(NEXT))
FULL_ROLE = {"u": "user", "a": "assistant"}
SPACE = " \t\n\x0b\x0c\r"

SEGMENT_ROWS = 4096
#: Characters of role and text that order the rows of one turn before their digest does.
ORDER_CHARS = 64


def _edges(symbol: str) -> list[list[tuple[int, int, int]]]:
    """For each state: ``(digit, next state, cost)`` of the edits of a row with this symbol."""
    out = []
    for q in STATES:
        edges = [(DIGIT[DELETE], q, COST[DELETE])]
        if symbol not in "BP":
            extra = TRUNCATED_COST if symbol.islower() else 0
            if symbol.lower() in NEXT[q]:
                edges.append((DIGIT[KEEP], NEXT[q][symbol.lower()], COST[KEEP] + extra))
            edges += [(DIGIT[REROLE], NEXT[q][r], COST[REROLE] + extra) for r in FULL_ROLE if r in NEXT[q]]
        out.append(edges)
    return out


#: Symbols of a row: B blank, P duplicate; else the role's initial (X: any other), lower case if truncated.
EDGES = {s: _edges(s) for s in "BPSUAXsuax"}


def _max_letters(rows: int) -> int:
    """At most two insertions stand in a gap: a third leads back to a state reached with fewer."""
    return 3 * rows + 2


def _relax(best: list, used: list, q: int, w: int, letters: int) -> None:
    if best[q] is None or w < best[q]:
        best[q], used[q] = w, letters


def _insertions(best: list, used: list, width: int) -> None:
    """Insert edges of one layer: 0, 1 and 3 lead to 2, then 2 leads to 3."""
    for q, to in ((0, 2), (1, 2), (3, 2), (2, 3)):
        if best[q] is not None:
            w = best[q] + (COST[INSERT] << width) + (DIGIT[INSERT] << width - DIGIT_BITS * (used[q] + 1))
            _relax(best, used, to, w, used[q] + 1)


def audit_of(weight: int, width: int) -> tuple[int, str]:
    """``(cost, letters)`` of a weight whose low ``width`` bits are letters."""
    digits = f"{weight & ((1 << width) - 1):o}".rstrip("0")
    return weight >> width, digits.translate(TO_LETTERS)


@lru_cache(maxsize=20_000)
def transfer(pattern: str) -> tuple[tuple[int, int, int, str], ...]:
    """``(from, to, cost, letters)`` of the best path between each two states over the rows of ``pattern``."""
    width = DIGIT_BITS * _max_letters(len(pattern))
    moves = []
    for start in STATES:
        best, used = [None] * len(NEXT), [0] * len(NEXT)
        best[start] = 0
        _insertions(best, used, width)
        for symbol in pattern:
            now, letters = [None] * len(NEXT), [0] * len(NEXT)
            for q, w in enumerate(best):
                if w is not None:
                    for digit, to, cost in EDGES[symbol][q]:
                        _relax(now, letters, to, w + (cost << width) + (digit << width - DIGIT_BITS * (used[q] + 1)), used[q] + 1)
            _insertions(now, letters, width)
            best, used = now, letters
        moves += [(start, q, *audit_of(w, width)) for q, w in enumerate(best) if w is not None]
    return tuple(moves)


class Path:
    """Best integer to each state over the segments met so far."""

    def __init__(self):
        self.best, self.used, self.width = [None] * len(NEXT), [0] * len(NEXT), 0
        self.best[0] = 0

    def extend(self, rows: int, moves) -> None:
        more = DIGIT_BITS * _max_letters(rows)         # zeros at the end make room for the segment's letters
        self.width += more
        best, used = [None] * len(NEXT), [0] * len(NEXT)
        for start, to, cost, letters in moves:
            if self.best[start] is not None:
                n = self.used[start] + len(letters)
                low = int(letters.translate(TO_DIGITS), 8) if letters else 0
                _relax(best, used, to, (self.best[start] << more) + (cost << self.width) + (low << self.width - DIGIT_BITS * n), n)
        self.best, self.used = best, used

    def result(self) -> tuple[int, str]:
        return audit_of(min(self.best[q] for q in ACCEPTS if self.best[q] is not None), self.width)


# ------------------------------------------------------------------ Spark
def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage that crc32(``conv_id:turn``) % 20 chooses."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), fault.alias("fault"))
    return rows.where("fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _symbol(role: Column, text: Column) -> Column:
    end = F.rtrim(text, F.lit(SPACE))
    initial = F.upper(F.when(F.substring(role, 1, 1).isin("s", "u", "a"), F.substring(role, 1, 1)).otherwise("x"))
    return F.when(F.length(end) == 0, "B").when(F.right(end, F.lit(1)).isin(".", "!", "?"), initial).otherwise(F.lower(initial))


ORDER = ["conv_id", "turn", "role_head", "text_head", "digest"]


def _rows(conversations: DataFrame) -> DataFrame:
    """Rows without nulls in role and text, with the columns that order them."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), filled("role").alias("role"), filled("text").alias("text")) \
        .select("*", F.substring("role", 1, ORDER_CHARS).alias("role_head"), F.substring("text", 1, ORDER_CHARS).alias("text_head"),
                F.unhex(F.md5(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.md5("role"), "text"))).alias("digest"))


def _segments(rows: DataFrame, segment_rows: int) -> DataFrame:
    """``conv_id, segment, pattern``: one symbol for each row, at most ``segment_rows`` of them."""
    spark = rows.sparkSession
    narrow = rows.select(*ORDER, F.col("conv_id").isNull().alias("no_id"), _symbol(F.col("role"), F.col("text")).alias("symbol"),
                         F.monotonically_increasing_id().alias("any"))
    order = [*ORDER, "any"]                       # equal rows part by any number, so that ranges can cut among them
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = written(narrow.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                     .select("conv_id", "no_id", "digest", "symbol", F.monotonically_increasing_id().alias("place")), "conv-rows")
    # digests hold the id's text; a null id's are told from an empty id's by no_id
    repeated = placed.groupBy("digest", "no_id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1").select("digest", "no_id", "first")
    known = placed.join(repeated, ["digest", "no_id"], "left") \
        .withColumn("symbol", F.when((F.col("place") > F.col("first")) & (F.col("symbol") != "B"), "P").otherwise(F.col("symbol")))
    inner = F.sort_array(F.collect_list(F.struct("place", "symbol")))
    return known.groupBy("conv_id", F.expr(f"place div {segment_rows}").alias("segment")).agg(inner.alias("rows")) \
        .select("conv_id", "segment", F.array_join(F.transform("rows", lambda r: r["symbol"]), "").alias("pattern"))


_MOVES = "array<struct<start:int,end:int,cost:bigint,letters:string>>"


def _with_transfer(segments: DataFrame) -> DataFrame:
    """Add ``moves``: the segment's transfer."""
    at = segments.columns.index("pattern")
    schema = segments.select("*", F.lit(None).cast(_MOVES).alias("moves")).schema
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())]))

    def run(batches):
        for b in batches:
            moves = [[dict(zip(("start", "end", "cost", "letters"), m, strict=True)) for m in transfer(p)] for p in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(moves, kind)], names=[*b.schema.names, "moves"])
    return segments.mapInArrow(run, schema)


def _stream(conversations: DataFrame, ids: DataFrame | None, segment_rows: int) -> DataFrame:
    """For each conversation one head (kind 0), its segments (1) and its rows (2), in order and in one partition."""
    rows = _rows(conversations)
    heads = (conversations if ids is None else ids).select("conv_id").distinct()
    segs = _with_transfer(_segments(rows, segment_rows))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    blank = [none("bigint", "turn"), none("string", "role"), none("string", "text"), none("string", "role_head"),
             none("string", "text_head"), none("binary", "digest")]
    no_seg = [none("bigint", "segment"), none("string", "pattern"), none(_MOVES, "moves")]
    cols = ["turn", "role", "text", "role_head", "text_head", "digest"]
    union = heads.select("conv_id", F.lit(0).alias("kind"), *no_seg, *blank) \
        .unionByName(segs.select("conv_id", F.lit(1).alias("kind"), "segment", "pattern", "moves", *blank)) \
        .unionByName(rows.select("conv_id", F.lit(2).alias("kind"), *no_seg, *cols))
    return union.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "segment", "turn", "role_head", "text_head", "digest") \
        .select("conv_id", "kind", "pattern", "moves", "turn", "role", "text")


class _Conversation:
    """One conversation of the stream: its plan, then its repaired turns row by row."""

    def __init__(self, conv_id):
        self.conv_id, self.path, self.counts = conv_id, Path(), dict.fromkeys(("B", "P", "cut"), 0)
        self.plan = None
        self.at = self.state = self.place = 0
        self.low = self.high = self.last_turn = None
        self.turns = self.illegal = 0
        self.initial = None

    def segment(self, pattern: str, moves) -> None:
        self.path.extend(len(pattern), [(m["start"], m["end"], m["cost"], m["letters"]) for m in moves])
        self.counts["B"] += pattern.count("B")
        self.counts["P"] += pattern.count("P")
        self.counts["cut"] += sum(map(pattern.count, "suax"))

    def _begin(self) -> None:
        if self.plan is None:
            self.plan, self.path = self.path.result(), None

    def _inserted(self) -> Iterator[tuple]:
        audit = self.plan[1]
        while self.at < len(audit) and audit[self.at] == INSERT:
            self.at += 1
            yield self._turn("a" if self.state == 2 else "u", INSERT, None, "")

    def _turn(self, initial: str, edit: str, role: str | None, text: str) -> tuple:
        self.state = NEXT[self.state][initial]
        self.place += 1
        return self.conv_id, self.place, edit, FULL_ROLE[initial] if role is None else role, text

    def row(self, turn, role: str, text: str) -> Iterator[tuple]:
        self._begin()
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        yield from self._inserted()
        edit = self.plan[1][self.at]
        self.at += 1
        if edit == KEEP:
            yield self._turn(initial, KEEP, role, text)
        elif edit == REROLE:
            yield self._turn("a" if self.state == 2 else "u", REROLE, None, text)

    def close(self) -> Iterator[tuple]:
        self._begin()
        yield from self._inserted()

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _conversations(batches) -> Iterator[tuple[_Conversation, tuple | None]]:
    """``(conversation, repaired turn)`` in order; ``(conversation, None)`` when it is complete."""
    now = None
    for b in slices(batches):
        for r in b.to_pylist():
            if r["kind"] == 0:
                if now is not None:
                    yield from ((now, t) for t in now.close())
                    yield now, None
                now = _Conversation(r["conv_id"])
            elif r["kind"] == 1:
                now.segment(r["pattern"], r["moves"])
            else:
                yield from ((now, t) for t in now.row(r["turn"], r["role"], r["text"]))
    if now is not None:
        yield from ((now, t) for t in now.close())
        yield now, None


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _run(stream: DataFrame, fn, columns: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    kind = stream.schema["conv_id"].dataType.simpleString()
    rest = pa.schema([(n, t) for n, _, t in columns])

    def run(batches):
        first = next(batches, None)
        if first is not None:
            schema = pa.schema([pa.field("conv_id", first.schema.field("conv_id").type), *rest])
            yield from _batched(fn(_conversations(b for bs in ([first], batches) for b in bs)), schema)
    return stream.mapInArrow(run, f"conv_id {kind}, " + ", ".join(f"{n} {t}" for n, t, _ in columns))


def repaired_turns(conversations: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``conv_id, place, edit, role, text`` of the repaired conversations; ``place`` counts from 1."""
    return _run(_stream(conversations, None, segment_rows), lambda items: (t for _, t in items if t is not None),
                [("place", "bigint", pa.int64()), ("edit", "string", pa.string()), ("role", "string", pa.string()), ("text", "string", pa.string())])


def repair_report(conversations: DataFrame, ids: DataFrame | None = None, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row for each conversation of ``ids`` (default: of the rows): faults, cost, audit, SHA-256 of the repaired turns.

    ``ids`` must hold every conversation of the rows.
    """
    def fold(items):
        digest = hashlib.sha256()
        first = True
        for c, t in items:
            if t is not None:
                digest.update(f"{'' if first else chr(10)}{t[3]}:{t[4]}".encode())
                first = False
                continue
            cost, audit = c.plan
            yield (c.conv_id, c.gaps(), c.counts["B"], c.counts["P"], c.counts["cut"], c.illegal, cost, audit, digest.hexdigest())
            digest, first = hashlib.sha256(), True
    longs = [(n, "bigint", pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return _run(_stream(conversations, ids, segment_rows), fold,
                [*longs, ("audit", "string", pa.string()), ("repaired_sha256", "string", pa.string())])
