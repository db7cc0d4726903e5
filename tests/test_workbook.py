"""Workbooks: built here by hand, read by Spark tasks."""

import zipfile

import pytest

from smeltery.operators.keys import IngestionError
from smeltery.plans import jobs
from smeltery.sources.workbook import sheet_rows

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def cell(ref, value):
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, tuple):  # (serial number, style)
        return f'<c r="{ref}" s="{value[1]}"><v>{value[0]}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value}</v></c>'
    if value.startswith("#s"):
        return f'<c r="{ref}" t="s"><v>{value[2:]}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t>{value}</t></is></c>'


def workbook(path, rows, shared=()):
    body = "".join(
        f'<row r="{n}">' + "".join(cell(f"{'ABCDEF'[i]}{n}", v) for i, v in enumerate(r)) + "</row>"
        for n, r in rows
    )
    parts = {
        "xl/workbook.xml": f'<workbook {NS} {REL}><bookViews><workbookView activeTab="1"/></bookViews>'
                           '<sheets><sheet name="x" sheetId="1" r:id="rId1"/>'
                           '<sheet name="y" sheetId="2" r:id="rId2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="rId1" Target="worksheets/a.xml"/>'
                                      '<Relationship Id="rId2" Target="/xl/worksheets/b.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet {NS}><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm"/>'
                         '</numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/><xf numFmtId="170"/>'
                         "</cellXfs></styleSheet>",
        "xl/sharedStrings.xml": f"<sst {NS}>" + "".join(
            f"<si><r><t>{s[:1]}</t></r><r><t>{s[1:]}</t></r></si>" for s in shared) + "</sst>",
        "xl/worksheets/a.xml": f"<worksheet {NS}><sheetData/></worksheet>",
        "xl/worksheets/b.xml": f"<worksheet {NS}><sheetData>{body}</sheetData></worksheet>",
    }
    with zipfile.ZipFile(path, "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return str(path)


def test_cells(tmp_path):
    path = workbook(tmp_path / "c.xlsx", [
        (1, [" a ", "b"]), (3, [1, 2.0, True, "#s0", (46027.25, 1), (46027, 2)]), (4, [None, "x"]),
    ], shared=["hello"])
    with open(path, "rb") as f:
        rows = list(sheet_rows(f.read()))
    assert rows == [
        [" a ", "b"], [],
        ["1", "2.0", "True", "hello", "2026-01-05 06:00:00", "2026-01-05 00:00:00"], [None, "x"],
    ]


HEAD = [" source_id ", "event_time", "value", "category", "extra"]


def test_workbook_ingest_beside_csv(spark, lake, tmp_path):
    book = workbook(tmp_path / "Book one.XLSX", [
        (1, HEAD), (2, ["a", (46027.25, 1), 10, "Alpha", "note"]),
        (3, ["b", "2026-01-05T06:00:00Z", 1.5, "#s0"]),
    ], shared=["beta"])
    empty = workbook(tmp_path / "empty.xlsx", [])
    csv = tmp_path / "s.csv"
    csv.write_text("source_id,event_time,value,category\na,2026-01-05T06:00:00Z,10,alpha\n")
    done = jobs.ingest(spark, lake, "s", [book, empty, str(csv)])
    assert (done.total_records, done.inserted_records) == (3, 2)
    assert sorted(done.per_file.values()) == [0, 1, 2]
    rows = {r.source_id: r for r in lake.read(spark, "raw_records").collect()}
    assert rows["a"].payload["extra"] == "note" and rows["a"].row_num == 1
    assert rows["b"].value == "1.5" and rows["b"].category == "beta" and rows["b"].row_num == 2


def test_workbook_with_missing_columns(spark, lake, tmp_path):
    book = workbook(tmp_path / "bad.xlsx", [(1, ["source_id", "value"]), (2, ["a", 1])])
    with pytest.raises(IngestionError, match=r"Missing required columns: \['event_time', 'category'\]"):
        jobs.ingest(spark, lake, "s", [book])
    assert lake.read(spark, "raw_records").count() == 0
