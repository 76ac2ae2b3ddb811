import datetime as dt
import io
import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusprep.sources import xlsx as xl
from corpusprep.sources import xlsx_parts as xp


def _book(sheet_xml: str, shared=(), styles="", props="") -> bytes:
    """A workbook with one worksheet given as XML, shared strings and number formats."""
    ns = f'xmlns="{xp.NS["m"]}"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}">{props}<sheets>'
                   '<sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   f'<Relationship Id="rId1" Type="{rel}/worksheet" Target="/xl/worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si>{s}</si>" for s in shared) + "</sst>")
        z.writestr("xl/styles.xml", f"<styleSheet {ns}>{styles}</styleSheet>")
        z.writestr("xl/worksheets/sheet1.xml", sheet_xml)
    return buf.getvalue()


def _rows(data: bytes, lo=0, hi=float("inf")):
    book = xp.Workbook(io.BytesIO(data))
    return list(book.rows("xl/worksheets/sheet1.xml", lo, hi))


def _sheet(body: str, prefix: str = "") -> str:
    p = f"{prefix}:" if prefix else ""
    ns = f'xmlns:{prefix}="{xp.NS["m"]}"' if prefix else f'xmlns="{xp.NS["m"]}"'
    return (f'<?xml version="1.0" encoding="UTF-8"?><{p}worksheet {ns}><{p}cols><{p}col min="1" max="2"/></{p}cols>'
            f'<{p}sheetData>{body}</{p}sheetData><{p}pageMargins left="1"/></{p}worksheet>')


@pytest.mark.parametrize("prefix", ["", "x"])
@pytest.mark.parametrize("numbered", ["all", "none", "some"])
@pytest.mark.parametrize("chunk", [7, 64, 1 << 20])
def test_stretches_give_the_rows_of_the_whole(monkeypatch, prefix, numbered, chunk):
    monkeypatch.setattr(xp, "CHUNK", chunk)
    p = f"{prefix}:" if prefix else ""
    body = [f"<{p}row/>"] * 2                          # empty rows before the header
    for i in range(40):
        r = f' r="{3 + i + (i > 20) * 5}"' if numbered == "all" or numbered == "some" and i % 7 == 0 else ""
        text = "é" * (i % 5) + " row "
        cells = "" if i == 11 else f'<{p}c t="inlineStr"><{p}is><{p}t>{text}{i}</{p}t></{p}is></{p}c><{p}c><{p}v>{i}</{p}v></{p}c>'
        cells += f"<{p}c><{p}v>9</{p}v></{p}c>" if i == 30 else ""      # a cell past the header
        body.append(f"<{p}row{r}>{cells}</{p}row>")
    xml = _sheet("\n".join(body), prefix)
    data = _book(xml)
    whole = _rows(data)
    assert len(whole) == 38 and whole[29 - 1][1]["Unnamed: 2"] == "9"
    n = len(xml.encode())
    for part in (17, 100, 333, n, 10 * n):
        cut = [row for lo, hi in xp.stretches(n, part) for row in _rows(data, lo, hi)]
        assert cut == whole, part


def test_odd_worksheets_in_stretches():
    for body in ("", '<row r="1"><c><v>a</v></c></row>'):
        data = _book(_sheet(body))
        assert [r for lo, hi in xp.stretches(500, 50) for r in _rows(data, lo, hi)] == _rows(data) == []
    none = _book(f'<worksheet xmlns="{xp.NS["m"]}"><sheetData/></worksheet>')
    assert [r for lo, hi in xp.stretches(500, 50) for r in _rows(none, lo, hi)] == []
    rows = '<row><c t="str"><v>h</v></c></row><row><c><v>1</v></c></row><row><c><v>2</v></c></row>'
    wide = _book(f'<?xml version="1.0" encoding="UTF-16"?><worksheet xmlns="{xp.NS["m"]}"><sheetData>{rows}</sheetData></worksheet>'
                 .encode("utf-16"))                       # not cuttable as bytes: the first stretch takes all
    assert [r for lo, hi in xp.stretches(500, 50) for r in _rows(wide, lo, hi)] == [(0, {"h": "1"}), (1, {"h": "2"})]
    noted = _book(_sheet(rows.replace("<row><c><v>2", "<!-- <row> --><row><c><v>2")))
    assert len(_rows(noted)) == 2
    with pytest.raises(ValueError):                       # refused, not misread
        [r for lo, hi in xp.stretches(500, 50) for r in _rows(noted, lo, hi)]


def test_cells_become_text():
    styles = ('<numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="0.0&quot;d&quot;"/>'
              '<numFmt numFmtId="166" formatCode="[h]:mm"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/>'
              '<xf numFmtId="164"/><xf numFmtId="165"/><xf numFmtId="166"/><xf numFmtId="21"/></cellXfs>')
    shared = ["<t>plain</t>", "<r><t>rich</t></r><r><t> text</t></r><rPh><t>no</t></rPh>", "<t>N/A</t>"]
    cells = ['<c t="s"><v>0</v></c>', '<c t="s"><v>1</v></c>', '<c t="s"><v>2</v></c>', '<c t="b"><v>1</v></c>',
             '<c t="e"><v>#REF!</v></c>', '<c s="1"><v>36526</v></c>', '<c s="2"><v>36526.75</v></c>', '<c s="3"><v>2.5</v></c>',
             '<c s="4"><v>1.5</v></c>', '<c s="5"><v>0.25</v></c>', '<c t="d"><v>2001-02-03T04:05:06</v></c>', '<c s="1"><v>59</v></c>',
             '<c t="str"><v>null</v></c>', '<c><v>1e3</v></c>', '<c s="1"><v>oops</v></c>', '<c t="str"><v></v></c>']
    head = "".join(f'<c t="inlineStr"><is><t>c{i}</t></is></c>' for i in range(len(cells)))
    xml = _sheet(f'<row>{head}</row><row>{"".join(cells)}</row>')
    (_, got), = _rows(_book(xml, shared, styles))
    assert list(got.values()) == ["plain", "rich text", None, "True", None, "2000-01-01 00:00:00", "2000-01-01 18:00:00", "2.5",
                                  "1.5", "06:00:00", "2001-02-03 04:05:06", "1900-02-28 00:00:00", None, "1e3", "oops", None]
    (_, old), = _rows(_book(xml, shared, styles, '<workbookPr date1904="1"/>'))
    assert old["c5"] == "2004-01-02 00:00:00"
    # a header named like a missing value keeps its name
    named = _book(_sheet('<row><c t="str"><v>NA</v></c></row><row><c t="str"><v>NA</v></c></row>'))
    assert _rows(named) == [(0, {"NA": None})]


def test_one_workbook_over_several_tasks(spark):
    d = tempfile.mkdtemp(prefix="corpusprep-test-")
    at = dt.datetime(2021, 3, 4, 5, 6, 7)
    rows = [[i, f"text {i}", at + dt.timedelta(days=i, milliseconds=i), "N/A" if i % 3 else "x"] for i in range(3000)]
    xl.write_bytes(os.path.join(d, "big.xlsx"), xl.workbook_bytes([("A", ["k", "t", "at", "w"], rows), ("B", ["k"], [[1]])]))
    xl.write_bytes(os.path.join(d, "bad.xlsx"), b"PK no")
    cut = xl.read_workbooks(spark, d, split_bytes=50_000)
    assert cut.rdd.getNumPartitions() > 8
    one = xl.read_workbooks(spark, d, split_bytes=0)
    assert one.rdd.getNumPartitions() == 2
    key = ["workbook", "sheet", "row_idx"]
    got, exp = (sorted(map(tuple, xl.good_rows(x).select(*key, F.to_json("cells")).collect())) for x in (cut, one))
    assert got == exp and len(got) == 3001
    kept = xl.good_rows(cut).where("sheet = 'A'")
    assert kept.where(F.col("cells")["w"].isNotNull()).count() == 1000
    last = kept.where("row_idx = 2999").first().cells
    assert last["at"] == str(at + dt.timedelta(days=2999, milliseconds=2999))
    assert [r.workbook for r in xl.bad_files(cut).collect()] == ["bad.xlsx"]
    assert xl.read_workbooks(spark, d, split_bytes=50_000, na_words=False).where(F.col("cells")["w"] == "N/A").count() == 2000
    sheets = {r.sheet: (list(r.columns), r.n_rows) for r in xl.good_rows(xl.read_workbooks(spark, d, output="sheets", split_bytes=50_000)).collect()}
    assert sheets == {"A": (["k", "t", "at", "w"], 3000), "B": (["k"], 1)}


def test_damaged_worksheet_leaves_the_rest(spark):
    d = tempfile.mkdtemp(prefix="corpusprep-test-")
    ok = '<row><c t="str"><v>h</v></c></row>' + '<row><c><v>1</v></c></row>' * 5
    xl.write_bytes(os.path.join(d, "cut.xlsx"), _book(_sheet(ok).replace("</sheetData>", "<row><c></row></sheetData>")))
    xl.write_bytes(os.path.join(d, "fine.xlsx"), _book(_sheet(ok)))
    raw = xl.read_workbooks(spark, d)
    assert {r.workbook for r in xl.bad_files(raw).collect()} == {"cut.xlsx"}
    assert xl.good_rows(raw).where("workbook = 'fine.xlsx'").count() == 5
    assert {r.workbook for r in xl.good_rows(raw, whole_workbooks=True).collect()} == {"fine.xlsx"}


def test_rows_before_a_stretch_are_not_read_one_by_one(monkeypatch):
    numbered = "".join(f'<row r="{i}"><c r="A{i}"><v>{i}</v></c></row>' for i in range(1, 60_001))
    bare = "".join(f"<row ><c><v>{i}</v></c></row>" for i in range(60_000))
    for rows, before in ((numbered, 60_000), (bare, 60_000), (numbered[:len(numbered) // 2].rsplit("<row", 1)[0] + bare, None)):
        xml = f'<worksheet xmlns="{xp.NS["m"]}"><sheetData>{rows}<row><c><v>7</v></c></row></sheetData></worksheet>'.encode()
        lo = xml.rindex(b"<row")
        want = before if before else rows.count("<row")
        seen = []
        count = xp._Span._count
        monkeypatch.setattr(xp._Span, "_count", lambda self, tags: (seen.append(len(tags)), count(self, tags))[1])
        span = xp._Span(io.BytesIO(xml), lo, float("inf"))
        out = b"".join(span.pieces())
        monkeypatch.undo()
        assert span.before == want and out.count(b"<row") == 1
        if rows is numbered:
            assert sum(seen) < 30_000           # only the chunk in which the stretch starts is gone through
