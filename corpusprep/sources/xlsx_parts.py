"""Worksheets of one workbook, whole or a stretch of their rows at a time.

A worksheet part is one compressed XML text. It can only be inflated from its
start, but inflating is some fifty times faster than parsing, so a worksheet
is split the way a text file is: stretch ``[lo, hi)`` of the inflated bytes
owns the rows whose tag starts there. Its reader inflates and counts the rows
before ``lo`` and parses only its own. No index has to be built beforehand.

Cell values come as text:

* numbers as they are stored; whole and shared strings as they are;
* numbers under a date format as ``YYYY-MM-DD HH:MM:SS`` (with microseconds
  if there are any), below 1 as a time ``HH:MM:SS``; ISO cells likewise;
* booleans as ``True`` / ``False``; error cells as null;
* the words of ``NA_WORDS`` as null, except in the header.
"""

from __future__ import annotations

import datetime as dt
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from functools import cached_property, lru_cache

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
NS = {"m": _MAIN}
REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}Relationship"
_ROW, _CELL, _IS, _V = (f"{{{_MAIN}}}{t}" for t in ("row", "c", "is", "v"))

# Words that a scan reads as missing.
NA_WORDS = frozenset(["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                      "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"])
# Numbers of the built-in date and time formats of the file format.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), 45, 47, *range(50, 59)])
_EPOCH_1900, _EPOCH_1904 = dt.datetime(1899, 12, 30), dt.datetime(1904, 1, 1)

CHUNK = 1 << 20
#: The rows of a worksheet begin within this many inflated bytes; otherwise its first stretch takes all of them.
PREAMBLE = 16 << 20

_NUMBER = re.compile(rb"""\sr\s*=\s*["'](\d+)""")

Row = tuple[int, dict[int, "str | None"]]


def _string(el) -> str:
    """Text of a shared or inline string: plain ``t`` or rich-text runs
    (phonetic runs are left out)."""
    t = el.find("m:t", NS)
    if t is not None:
        return t.text or ""
    return "".join((r.findtext("m:t", namespaces=NS) or "") for r in el.findall("m:r", NS))


def is_date_format(code: str) -> bool:
    """Whether a number format shows a date or time: one of ``ymdhs`` outside
    quotes, escapes and brackets. Elapsed time (``[h]``) stays a number."""
    if re.search(r"\[[hms]+\]", code, re.I):
        return False
    bare = re.sub(r'"[^"]*"|\\.|_.|\*.|\[[^\]]*\]', "", code).split(";")[0]
    return re.search(r"[ymdhs]", bare, re.I) is not None and "general" not in bare.lower()


def date_text(value: str, date1904: bool = False) -> str:
    """A serial day number as text; what is no such number stays as it is."""
    try:
        days = float(value)
        # the 1900 calendar counts a 29 February that was not: days before it are one further on
        start = _EPOCH_1904 if date1904 else _EPOCH_1900 + dt.timedelta(days=1 if 1 <= days < 60 else 0)
        at = start + dt.timedelta(microseconds=round(days * 86_400_000) * 1000)
    except (ValueError, OverflowError):
        return value
    if 0 <= days < 1:
        return at.time().isoformat() if at.date() == start.date() else "00:00:00"
    return at.isoformat(sep=" ")


@lru_cache(1 << 14)
def _col_index(letters: str) -> int:
    """Index of a column by a cell's reference, its row number left out."""
    n = 0
    for ch in re.match(r"[A-Z]+", letters).group(0):
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def header_names(head: dict[int, str | None], width: int) -> list[str]:
    """Columns without a header cell are named ``Unnamed: i``; repeated names
    get ``.1``, ``.2`` suffixes."""
    header, seen = [], {}
    for i in range(width):
        h = head.get(i)
        name = str(h) if h is not None else f"Unnamed: {i}"
        if name in seen:
            seen[name] += 1
            name = f"{name}.{seen[name]}"
        else:
            seen[name] = 0
        header.append(name)
    return header


class Workbook:
    """An opened workbook: its worksheets, shared strings and date styles."""

    def __init__(self, fh, na_words: frozenset[str] = NA_WORDS):
        self.zip = zipfile.ZipFile(fh)
        self.na_words = na_words
        names = set(self.zip.namelist())
        rels = {}
        if "xl/_rels/workbook.xml.rels" in names:
            for r in ET.fromstring(self.zip.read("xl/_rels/workbook.xml.rels")).iter(_PKG_REL):
                t = r.get("Target")
                rels[r.get("Id")] = t.lstrip("/") if t.startswith("/") else "xl/" + t
        root = ET.fromstring(self.zip.read("xl/workbook.xml"))
        props = root.find("m:workbookPr", NS)
        self.date1904 = props is not None and props.get("date1904") in ("1", "true")
        targets = [(s.get("name"), rels.get(s.get(REL_ID))) for s in root.find("m:sheets", NS).findall("m:sheet", NS)]
        #: (sheet name, part name or None)
        self.sheets = [(name, t if t in names else None) for name, t in targets]

    def inflated_bytes(self, part: str) -> int:
        return self.zip.getinfo(part).file_size

    @cached_property
    def shared(self) -> list[str]:
        """Shared strings, streamed: one element at a time is held as XML."""
        out: list[str] = []
        if "xl/sharedStrings.xml" in self.zip.namelist():
            with self.zip.open("xl/sharedStrings.xml") as fh:
                for _, el in ET.iterparse(fh):
                    if el.tag == f"{{{_MAIN}}}si":
                        out.append(_string(el))
                        el.clear()
        return out

    @cached_property
    def date_styles(self) -> frozenset[str]:
        """Cell styles (as written in cells) whose number format is a date or time."""
        if "xl/styles.xml" not in self.zip.namelist():
            return frozenset()
        root = ET.fromstring(self.zip.read("xl/styles.xml"))
        own = {f.get("numFmtId"): is_date_format(f.get("formatCode", "")) for f in root.iterfind("m:numFmts/m:numFmt", NS)}
        formats = [x.get("numFmtId", "0") for x in root.iterfind("m:cellXfs/m:xf", NS)]
        return frozenset(str(i) for i, f in enumerate(formats) if own.get(f, f.isdigit() and int(f) in DATE_FORMATS))

    def _value(self, c) -> str | None:
        kind = c.get("t", "n")
        if kind == "inlineStr":
            el = next((x for x in c if x.tag == _IS), None)
            return _string(el) if el is not None else None
        val = next((x.text for x in c if x.tag == _V), None)
        if not val or kind == "e":
            return None
        if kind == "s":
            return self.shared[int(val)]
        if kind == "b":
            return "True" if val == "1" else "False"
        if kind == "d":
            return dt.datetime.fromisoformat(val).replace(tzinfo=None).isoformat(sep=" ")
        if kind == "n" and c.get("s") in self.date_styles:
            return date_text(val, self.date1904)
        return val

    def _row(self, el, last: int) -> Row:
        rnum = int(el.get("r")) if el.get("r") else last + 1
        cells: dict[int, str | None] = {}
        i = -1
        for c in el:
            if c.tag == _CELL:
                ref = c.get("r")
                i = _col_index(ref.rstrip("0123456789")) if ref else i + 1
                cells[i] = self._value(c)
        return rnum, cells

    def raw_rows(self, part: str) -> Iterator[Row]:
        """``(row number, {column index: value})`` of the rows with a value, streamed."""
        last, body = 0, None
        with self.zip.open(part) as fh:
            for event, el in ET.iterparse(fh, events=("start", "end")):
                if event == "start":
                    body = el if el.tag == f"{{{_MAIN}}}sheetData" else body
                elif el.tag == _ROW:
                    last, cells = self._row(el, last)
                    body.clear()                       # rows already read are let go
                    if any(v is not None for v in cells.values()):
                        yield last, cells

    def raw_span(self, part: str, lo: int, hi: float) -> Iterator[Row]:
        """As ``raw_rows``, only the rows whose tag starts at inflated bytes ``[lo, hi)``."""
        with self.zip.open(part) as fh:
            span = _Span(fh, lo, hi)
            parser, last = ET.XMLPullParser(events=("end",)), None
            for piece in span.pieces():
                parser.feed(piece)
                parser.flush()
                for _, el in parser.read_events():
                    if el.tag == _ROW:
                        last, cells = self._row(el, span.before if last is None else last)
                        el.clear()                     # an empty element is left of each row of the stretch
                        if any(v is not None for v in cells.values()):
                            yield last, cells
        if not span.cuttable and lo == 0:
            yield from self.raw_rows(part)

    def rows(self, part: str, lo: int = 0, hi: float = float("inf")) -> Iterator[tuple[int, dict[str, str | None]]]:
        """``(row_idx, cells)`` below the header row; a row has the columns of
        the header and those up to its own last cell."""
        head = next(self.raw_rows(part), None)
        if head is None:
            return
        head_at, first = head
        names = header_names(first, max(first) + 1)
        for rnum, cells in (self.raw_rows(part) if lo == 0 and hi == float("inf") else self.raw_span(part, lo, hi)):
            if rnum <= head_at:
                continue
            if max(cells) >= len(names):
                names = header_names(first, max(cells) + 1)
            width = max(max(first), max(cells)) + 1
            yield rnum - head_at - 1, {names[i]: self._known(cells.get(i)) for i in range(width)}

    def _known(self, value: str | None) -> str | None:
        return None if value in self.na_words else value

    def outline(self, part: str | None) -> tuple[list[str], int]:
        """Column names and number of rows below the header, in one pass."""
        head, width, n = None, 0, 0
        for _, cells in self.raw_rows(part) if part else ():
            head, n = (cells, 0) if head is None else (head, n + 1)
            width = max(width, max(cells) + 1)
        return (header_names(head, width) if head is not None else []), n


class _Span:
    """The bytes of a worksheet that a parser needs for the rows starting in ``[lo, hi)``."""

    def __init__(self, fh, lo: int, hi: float):
        self.fh, self.lo, self.hi = fh, lo, hi
        #: Number of the last row before the first one handed out.
        self.before = 0
        #: False if no start of the rows was found as plain bytes (no rows, or another encoding).
        self.cuttable = False

    def pieces(self) -> Iterator[bytes]:
        buf, at, start = b"", 0, None              # ``at``: place of buf[0] in the inflated text
        opened = False
        while True:
            more = self.fh.read(CHUNK)
            buf += more
            if start is None:
                start = re.search(rb"<((?:[\w.-]+:)?)sheetData\s*>", buf)
                if start is None:
                    if not more or len(buf) > PREAMBLE:
                        return
                    continue
                self.cuttable = True
                name = start.group(1)
                tag = re.compile(rb"<" + name + rb"row(?=[\s/>])[^>]*>")
                end = b"</" + name + b"sheetData"
                yield buf[:start.end()]
                buf, at = buf[start.end():], start.end()
            # a tag or an end mark may go on in the next chunk
            cut = len(buf) if not more else max(buf.rfind(b"<"), 0)
            done = buf.find(end)
            cut = min(cut, done) if done >= 0 else cut
            whole, rest = buf[:cut], buf[cut:]
            if b"<!" in whole:
                raise ValueError("comments and CDATA are read with split_bytes=0 only")
            first = last = None
            if not opened and at + len(whole) <= self.lo:
                self._pass(whole, b"<" + name + b"row", tag)
            elif not opened:
                skipped = []
                for m in tag.finditer(whole):
                    if at + m.start() >= self.lo:
                        first = m.start()
                        break
                    skipped.append(m.group())
                self._count(skipped)
                opened = first is not None
            if opened:
                if at + len(whole) > self.hi:
                    last = next((m.start() for m in tag.finditer(whole) if at + m.start() >= self.hi), None)
                yield whole[first or 0:len(whole) if last is None else last]
            if last is not None or done >= 0 or not more:
                return
            buf, at = rest, at + len(whole)

    def _pass(self, whole: bytes, mark: bytes, tag: re.Pattern) -> None:
        """Move ``before`` over all rows of ``whole``; only the tags from the last one with a number are looked at."""
        tags, end = [], len(whole)
        while (end := whole.rfind(mark, 0, end)) >= 0:
            m = tag.match(whole, end)
            if m:
                tags.append(m.group())
                if _NUMBER.search(tags[-1]):
                    break
        self._count(tags[::-1])

    def _count(self, tags: list[bytes]) -> None:
        """Move ``before`` over rows: from the last one with a number, one up for each after it."""
        for back, t in enumerate(reversed(tags)):
            r = _NUMBER.search(t)
            if r:
                self.before = int(r.group(1)) + back
                return
        self.before += len(tags)


def stretches(n_bytes: int, part_bytes: int) -> list[tuple[int, float]]:
    """``[lo, hi)`` stretches of a worksheet of ``n_bytes``; the last is open."""
    n = max(-(-n_bytes // part_bytes), 1)
    return [(i * part_bytes, (i + 1) * part_bytes if i + 1 < n else float("inf")) for i in range(n)]
