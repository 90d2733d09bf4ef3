import io
import zipfile

import pytest

from moorage.operators import headers
from moorage.plans.registered.files import _workbook
from moorage.sources import files, workbook

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def book(sheet_xml, strings=None, second=None, styles=None):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {NS} {REL}><sheets><sheet name="One" sheetId="1" r:id="a"/><sheet name="Two" sheetId="2" r:id="b"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="a" Target="worksheets/s1.xml"/><Relationship Id="b" Target="/xl/worksheets/s2.xml"/></Relationships>')
        z.writestr("xl/worksheets/s1.xml", f"<worksheet {NS}><sheetData>{sheet_xml}</sheetData></worksheet>")
        z.writestr("xl/worksheets/s2.xml", f"<worksheet {NS}><sheetData>{second or ''}</sheetData></worksheet>")
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {NS}>{styles}</styleSheet>")
        if strings:
            z.writestr("xl/sharedStrings.xml", f"<sst {NS}>{strings}</sst>")
    return out.getvalue()


def cells(spark, data, sheet=0):
    df = spark.createDataFrame([("f", bytearray(data))], "path string, content binary")
    return workbook.excel_cells(df, sheet)


def test_cell_kinds_and_sparse_rows(spark):
    strings = "<si><t>plain</t></si><si><r><t>rich </t></r><r><t>text</t></r><rPh><t>no</t></rPh></si>"
    xml = (
        '<row r="2"><c r="B2" t="s"><v>0</v></c><c r="AA2" t="s"><v>1</v></c></row>'
        '<row r="5"><c r="A5"><v>42</v></c><c r="B5"><v>1.5</v></c><c r="C5" t="b"><v>1</v></c><c r="D5" t="str"><v>f</v></c><c r="E5"/>'
        '<c t="inlineStr"><is><t>next</t></is></c></row>'
    )
    got = [(r.r, r.c, r.v) for r in cells(spark, book(xml, strings)).collect()]
    assert [g[0] for g in got if g[1] is None] == [0, 2, 3]
    got = [g for g in got if g[1] is not None]
    assert got == [(1, 1, "plain"), (1, 26, "rich text"), (4, 0, "42"), (4, 1, "1.5"), (4, 2, "True"), (4, 3, "f"), (4, 5, "next")]


def test_sheet_by_name_and_errors(spark):
    data = book("", second='<row r="1"><c r="A1"><v>7</v></c></row>')
    assert [r.v for r in cells(spark, data, "Two").collect()] == ["7"]
    assert cells(spark, data, "Three").first().error and cells(spark, data, 5).first().error
    assert "BadZipFile" in cells(spark, b"no zip").first().error


def test_header_detection(spark, folder):
    for name, lines in {
        "good": [["title"], ["a", "b"], ["X Col", "y", "y"], [1, None, 3], ["NA", 5], [], ["7"]],
        "none": [["a", "b"], ["c", "d"]],
    }.items():
        with open(f"{folder}/{name}.xlsx", "wb") as out:
            out.write(_workbook(lines))
    long = workbook.excel_cells(files.listing(spark, folder, "*.xlsx"))
    same = workbook.excel_cells(files.contents(spark, folder, "*.xlsx"))
    assert sorted(map(str, long.collect())) == sorted(map(str, same.collect()))
    rows = headers.sheet_rows(long)
    found = {r.file.rsplit("/", 1)[1]: r for r in headers.header_rows(rows).collect()}
    assert found["good.xlsx"].header_row == 2 and "no header" in found["none.xlsx"].error
    (table,) = headers.tables(long)
    assert table.columns == ["file", "sheet", "r", "x_col", "y", "y_1"]
    assert [(r.x_col, r.y, r.y_1) for r in table.orderBy("r").collect()] == [("1", None, "3"), (None, "5", None), (None,) * 3, ("7", None, None)]
    explicit = headers.tables(long, explicit=0)
    assert sorted(t.columns[3:] for t in explicit) == [["a", "b"], ["title", "nan", "nan_1"]]


@pytest.mark.parametrize("number, text", [("3", "3"), ("3.0", "3"), ("0.1", "0.1"), ("1E3", "1000"), ("-2.50", "-2.5")])
def test_numbers_as_text(spark, number, text):
    assert cells(spark, book(f'<row r="1"><c r="A1"><v>{number}</v></c></row>')).first().v == text


def test_dates_and_errors(spark):
    styles = (
        '<numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm"/><numFmt numFmtId="165" formatCode="[Red]0.00&quot;days&quot;"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs>'
    )
    values = [("1", "45306"), ("2", "45306.75"), ("3", "45306"), ("0", "45306"), ("1", "0.5"), ("1", "1"), ("1", "61")]
    row = "".join(f'<c s="{s}"><v>{v}</v></c>' for s, v in values) + '<c t="e"><v>#DIV/0!</v></c>'
    got = [r.v for r in cells(spark, book(f'<row r="1">{row}</row>', styles=styles)).orderBy("c").collect()]
    assert got == ["2024-01-15 00:00:00", "2024-01-15 18:00:00", "45306", "45306", "12:00:00", "1900-01-01 00:00:00", "1900-03-01 00:00:00"]


def test_many_headers_are_read_once(spark):
    """Fifty sheets, each with columns of its own, and one without rows below its header."""
    cells = [(f"f{k}", "s", r, c, f"h{k}x{c}" if r == 0 else f"v{k}-{r}-{c}") for k in range(50) for r in range(4 if k else 1) for c in range(3)]
    cells += [("f51", "s", 0, c, f"h51x{c}") for c in range(3)] + [("f51", "s", 1, 0, "")]
    frame = spark.createDataFrame(cells, "file string, sheet string, r int, c int, v string")
    found = headers.tables(frame)
    assert len(found) == 51
    rows = {}
    for table in found:
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation") + plan.count("Scan") <= 1 and len(plan) < 2000
        for r in table.collect():
            rows.setdefault(r.file, []).append(tuple(r)[2:])
    assert {f: sorted(own) for f, own in rows.items()} == {f"f{k}": [(r, *(f"v{k}-{r}-{c}" for c in range(3))) for r in range(1, 4)] for k in range(1, 50)} | {"f51": [(1, None, None, None)]}
    assert {tuple(t.columns) for t in found} == {("file", "sheet", "r", *(f"h{k}x{c}" for c in range(3))) for k in [*range(50), 51]}
