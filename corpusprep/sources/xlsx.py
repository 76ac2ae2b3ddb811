"""Excel workbooks as a Spark data source (stdlib ``zipfile`` + XML only).

``spark.read.format("xlsx").load(folder)`` yields one row per worksheet row:
``workbook, sheet, row_idx, cells map<string,string>, _error``. A small
workbook is one input partition, read on an executor; the worksheets of a
large one are cut into stretches of rows that different tasks parse
(``sources.xlsx_parts``, which also states how cells become text). The first
row of a sheet is the header. Options:

* ``files``: ``ALL_FILES`` (default) lists ``*.xlsx`` of the folder (not
  recursive); otherwise a comma list, trimmed, blanks dropped; the keyword
  is compared case-sensitively unless ``keyword_case_sensitive`` is false;
* ``skip``: comma list of sheet names to leave out (normalised names);
* ``mode``: ``PERMISSIVE`` (default) turns an unreadable workbook into one
  row with ``_error`` set; ``FAILFAST`` raises;
* ``split_bytes``: inflated bytes of a worksheet that one task parses
  (32 MiB; 0 leaves every workbook to one task);
* ``na_words``: ``true`` (default) reads words such as ``N/A`` as null;
* ``output``: ``rows`` (default) or ``sheets`` (one row per worksheet with
  its columns and row count, including empty worksheets and, flagged
  ``skipped``, those left out by the skip list).

Files are opened through ``pyarrow.fs`` so the same code reads local, HDFS
or object-store folders.
"""

from __future__ import annotations

import datetime as dt
import io
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from corpusprep.functions.names import normalize_name_py
from corpusprep.sources.xlsx_parts import NA_WORDS, NS, Workbook, stretches

ROWS_SCHEMA = "workbook string, sheet string, row_idx bigint, cells map<string,string>, _error string"
SHEETS_SCHEMA = ("workbook string, sheet string, columns array<string>, n_rows bigint, skipped boolean, "
                 "_error string")
ALL_FILES = "ALL_FILES"
#: Inflated bytes of a worksheet that one task parses.
SPLIT_BYTES = 32 << 20
#: Worksheets rarely inflate to more than this many times the file; smaller files are not opened when planning.
INFLATES = 50
_EPOCH, _DAY = dt.datetime(1899, 12, 30), dt.timedelta(days=1)


def _fs(path: str):
    from pyarrow import fs as pafs
    if path.startswith("file:"):
        local = path[5:]
        if local.startswith("//"):
            local = local[2:]
        return pafs.LocalFileSystem(), "/" + local.lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def list_workbooks(folder: str, files: str | None = None, keyword_case_sensitive: bool = True) -> list[str]:
    """File names to read (names only, sorted). ``files`` is ``ALL_FILES``
    (compared case-sensitively unless ``keyword_case_sensitive=False``) or a
    comma list."""
    keyword = files.strip() if files is not None else ALL_FILES
    is_all = keyword == ALL_FILES if keyword_case_sensitive else keyword.upper() == ALL_FILES
    if not is_all:
        return [f.strip() for f in files.split(",") if f.strip()]
    from pyarrow import fs as pafs
    fs, p = _fs(folder)
    infos = fs.get_file_info(pafs.FileSelector(p, recursive=False))
    return sorted(i.base_name for i in infos if i.type == pafs.FileType.File and i.base_name.endswith(".xlsx")
                  and not i.base_name.startswith(("_", ".")))   # hidden and temporary files


class _Part(InputPartition):
    """A whole workbook (``sheet`` is None), or a stretch of one of its worksheets."""

    def __init__(self, path: str, name: str, sheet: int | None = None, lo: int = 0, hi: float = float("inf")):
        super().__init__(f"{path}#{sheet}:{lo}")
        self.path, self.name, self.sheet, self.lo, self.hi = path, name, sheet, lo, hi


class XlsxReader(DataSourceReader):
    def __init__(self, options: dict, output: str):
        self.folder = options.get("path", "")
        self.files = options.get("files")
        self.keyword_cs = options.get("keyword_case_sensitive", "true").lower() == "true"
        self.mode = options.get("mode", "PERMISSIVE").upper()
        self.output = output
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))
        self.na_words = NA_WORDS if options.get("na_words", "true").lower() == "true" else frozenset()
        skip = options.get("skip", "")
        self.skip = {normalize_name_py(s) for s in skip.split(",") if s.strip()}
        self.only: dict[str, set] = {}          # pushed equality / IN filters per key column

    def partitions(self):
        base = self.folder.rstrip("/")
        names = list_workbooks(self.folder, self.files, self.keyword_cs)
        if "workbook" in self.only:
            names = [n for n in names if n in self.only["workbook"]]
        return [part for n in names for part in self._parts(f"{base}/{n}", n)]

    def _parts(self, path: str, name: str) -> list[_Part]:
        """One part for a small workbook. Of a large one the directory and the
        list of worksheets are read, and its worksheets are cut into stretches."""
        whole = [_Part(path, name)]
        if self.split_bytes <= 0:
            return whole
        try:
            fs, p = _fs(path)
            info = fs.get_file_info(p)
            if info.size is None or info.size * INFLATES < self.split_bytes:
                return whole
            with fs.open_input_file(p) as fh:
                book = Workbook(fh)
                sizes = [book.inflated_bytes(t) if t else 0 for _, t in book.sheets]
        except Exception:  # noqa: BLE001 - the task that reads it reports the damage
            return whole
        if sum(sizes) <= self.split_bytes:
            return whole
        return [_Part(path, name, i, lo, hi) for i, size in enumerate(sizes)
                for lo, hi in (stretches(size, self.split_bytes) if self.output != "sheets" else [(0, float("inf"))])]

    def _error(self, workbook: str, sheet: str | None, e: Exception):
        if self.mode == "FAILFAST":
            raise e
        msg = f"{type(e).__name__}: {e}"
        if "sheet" in self.only and sheet not in self.only["sheet"]:
            return None                             # a pushed sheet filter excludes it
        return (workbook, sheet, None, None, msg) if self.output != "sheets" else \
            (workbook, sheet, None, None, None, msg)

    def read(self, partition):
        try:
            fs, p = _fs(partition.path)
            fh = fs.open_input_file(p)
            book = Workbook(fh, self.na_words)
        except Exception as e:  # noqa: BLE001 - reported as a row in PERMISSIVE mode
            row = self._error(partition.name, None, e)
            if row is not None:
                yield row
            return
        with fh:
            chosen = book.sheets if partition.sheet is None else [book.sheets[partition.sheet]]
            for sheet, target in chosen:
                if "sheet" in self.only and sheet not in self.only["sheet"]:
                    continue
                skipped = normalize_name_py(sheet) in self.skip
                try:
                    if self.output == "sheets":
                        yield (partition.name, sheet, *book.outline(target), skipped, None)
                    elif not skipped and target:
                        for idx, cells in book.rows(target, partition.lo, partition.hi):
                            yield (partition.name, sheet, idx, cells, None)
                except Exception as e:  # noqa: BLE001 - a damaged worksheet
                    row = self._error(partition.name, sheet, e)
                    if row is not None:
                        yield row


class XlsxPushdownReader(XlsxReader):
    """Reader that also takes ``workbook`` / ``sheet`` filters (used when the
    session enables ``spark.sql.python.filterPushdown.enabled``)."""

    def pushFilters(self, filters):
        """Accept ``workbook`` / ``sheet`` equality and IN filters: workbooks
        not named are never opened, worksheets not named are not parsed into
        rows. Everything else is returned to Spark."""
        for f in filters:
            col = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if col in ("workbook", "sheet"):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only[col] = self.only[col] & values if col in self.only else values
            else:
                yield f


class XlsxDataSource(DataSource):
    @classmethod
    def name(cls):
        return "xlsx"

    def schema(self):
        return SHEETS_SCHEMA if self.options.get("output", "rows") == "sheets" else ROWS_SCHEMA

    def reader(self, schema):
        cls = XlsxPushdownReader if self.options.get("pushdown", "false") == "true" else XlsxReader
        return cls(dict(self.options), self.options.get("output", "rows"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(XlsxDataSource)


def read_workbooks(spark: SparkSession, folder: str, files: str | None = None, skip: str = "",
                   mode: str = "PERMISSIVE", output: str = "rows", keyword_case_sensitive: bool = True,
                   split_bytes: int = SPLIT_BYTES, na_words: bool = True) -> DataFrame:
    register(spark)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false").lower() == "true"
    r = spark.read.format("xlsx").option("mode", mode).option("skip", skip).option("output", output) \
        .option("pushdown", str(pushdown).lower()).option("split_bytes", split_bytes) \
        .option("na_words", str(na_words).lower())
    if files is not None:
        r = r.option("files", files)
    r = r.option("keyword_case_sensitive", str(keyword_case_sensitive).lower())
    return r.load(folder)


def good_rows(raw: DataFrame, whole_workbooks: bool = False) -> DataFrame:
    """Rows that were read. A damaged worksheet leaves the rows before the
    damage and those of the workbook's other worksheets; with
    ``whole_workbooks`` a workbook with any damage is left out."""
    rows = raw.where(F.col("_error").isNull()).drop("_error")
    return rows.join(bad_files(raw).select("workbook"), "workbook", "left_anti") if whole_workbooks else rows


def bad_files(raw: DataFrame) -> DataFrame:
    """One row per workbook with damage."""
    return raw.where(F.col("_error").isNotNull()).groupBy("workbook").agg(F.min("_error").alias("error"))


# --------------------------------------------------------------------------
# writing workbooks (used to produce inputs from tables, and as a sink)
# --------------------------------------------------------------------------
def _col_ref(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _serial_day(v: dt.date) -> float:
    if not isinstance(v, dt.datetime):
        v = dt.datetime(v.year, v.month, v.day)
    elif hasattr(v, "to_pydatetime"):           # pandas' own arithmetic takes many times as long
        v = v.to_pydatetime(warn=False)
    return ((v.replace(tzinfo=None) if v.tzinfo else v) - _EPOCH) / _DAY


def _sheet_xml(header: list[str], rows: list[list]) -> str:
    out = ['<?xml version="1.0" encoding="UTF-8" standalone="yes"?>',
           f'<worksheet xmlns="{NS["m"]}"><sheetData>']
    refs = [_col_ref(i) for i in range(max(map(len, [header, *rows])))]
    for r, values in enumerate([header, *rows], start=1):
        cells = []
        for col, v in zip(refs, values):
            if v is None:
                continue
            if isinstance(v, dt.date):
                cells.append(f'<c r="{col}{r}" s="1"><v>{_serial_day(v)!r}</v></c>')
            elif isinstance(v, bool) or not isinstance(v, (int, float)):
                cells.append(f'<c r="{col}{r}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>')
            else:
                cells.append(f'<c r="{col}{r}"><v>{v!r}</v></c>')
        out.append(f'<row r="{r}">{"".join(cells)}</row>')
    out.append("</sheetData></worksheet>")
    return "".join(out)


def workbook_bytes(sheets: list[tuple[str, list[str], list[list]]]) -> bytes:
    """A minimal .xlsx holding the given worksheets (inline strings, dates as styled numbers)."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        over = "".join(
            f'<Override PartName="/xl/worksheets/sheet{i}.xml" '
            'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
            for i in range(1, len(sheets) + 1))
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                   '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Default Extension="xml" ContentType="application/xml"/>'
                   '<Override PartName="/xl/workbook.xml" '
                   'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
                   '<Override PartName="/xl/styles.xml" '
                   'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
                   f'{over}</Types>')
        z.writestr("_rels/.rels",
                   '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
                   'relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        sheet_el = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>'
                           for i, (n, _, _) in enumerate(sheets, start=1))
        z.writestr("xl/workbook.xml",
                   f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><workbook xmlns="{NS["m"]}" '
                   'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
                   f'<sheets>{sheet_el}</sheets></workbook>')
        rel_el = "".join(
            f'<Relationship Id="rId{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
            f'worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                   f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rel_el}'
                   '<Relationship Id="rIdStyles" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
                   'styles" Target="styles.xml"/></Relationships>')
        # style 1 shows a serial day number as date and time (built-in format 22)
        z.writestr("xl/styles.xml",
                   f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><styleSheet xmlns="{NS["m"]}">'
                   '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>')
        for i, (_, header, rows) in enumerate(sheets, start=1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", _sheet_xml(header, rows))
    return buf.getvalue()


def write_workbooks(df: DataFrame, folder: str, book_col: str, sheet_col: str, columns: list[str],
                    order_col: str | None = None, empty_sheets: tuple[str, ...] = ()) -> DataFrame:
    """Write one workbook ``<book>.xlsx`` per value of ``book_col`` into
    ``folder``, one worksheet per value of ``sheet_col`` (plus header-only
    ``empty_sheets``). Rows are shuffled by book, so each workbook is written
    by exactly one task; the caller bounds book size (for example with
    ``row_idx div rows_per_book``). Returns ``(file, sheets, rows)`` per
    workbook; an action must run it.
    """
    import pandas as pd

    folder = folder.rstrip("/")
    extra = [order_col] if order_col and order_col not in columns else []
    cols = [book_col, sheet_col] + columns + extra

    def _write(batches):
        frames = [b for b in batches]
        if not frames:
            return
        pdf = pd.concat(frames, ignore_index=True)
        for book, bg in pdf.groupby(book_col, sort=True):
            if order_col:
                bg = bg.sort_values(order_col, kind="stable")
            sheets = []
            for name, g in bg.groupby(sheet_col, sort=True):
                values = [g[c].astype(object).where(g[c].notna(), None).tolist() for c in columns]
                sheets.append((str(name), list(columns), list(zip(*values)) or [()] * len(g)))
            sheets += [(e, list(columns), []) for e in empty_sheets]
            fname = f"{book}.xlsx"
            write_bytes(f"{folder}/{fname}", workbook_bytes(sheets))
            yield pd.DataFrame({"file": [fname], "sheets": [len(sheets)], "rows": [len(bg)]})

    _ensure_dir(folder)
    return df.select(*cols).repartition(book_col).mapInPandas(_write, "file string, sheets int, rows long")


def _ensure_dir(folder: str) -> None:
    fs, p = _fs(folder)
    fs.create_dir(p, recursive=True)


def write_bytes(path: str, data: bytes) -> None:
    """Write a file atomically: a temporary name first, then a rename, so a
    retried or speculative task never leaves a half-written workbook."""
    import uuid
    fs, p = _fs(path)
    folder, name = p.rsplit("/", 1)
    tmp = f"{folder}/_tmp-{uuid.uuid4().hex}-{name}"
    with fs.open_output_stream(tmp) as out:
        out.write(data)
    fs.move(tmp, p)
