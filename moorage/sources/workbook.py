"""Spreadsheet files -> cells in long form. Excel has no Spark reader, so files are unpacked in tasks."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree.ElementTree import iterparse

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from moorage.sources.files import open_input

CELLS = (
    T.StructType()
    .add("file", T.StringType())
    .add("sheet", T.StringType())
    .add("r", T.IntegerType())
    .add("c", T.IntegerType())
    .add("v", T.StringType())
    .add("error", T.StringType())
)
_ARROW = pa.schema(
    [("file", pa.string()), ("sheet", pa.string()), ("r", pa.int32()), ("c", pa.int32()), ("v", pa.string()), ("error", pa.string())]
)
_BATCH = 50_000
# Built-in number formats that show dates or times.
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, *range(27, 37), 45, 46, 47, *range(50, 59)}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _text(node) -> str:
    """Text of a string item: plain or rich runs, without phonetic hints."""
    return "".join(
        t.text or "" for run in node if _local(run.tag) != "rPh" for t in ([run] if _local(run.tag) == "t" else run)
        if _local(t.tag) == "t"
    )


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, node in iterparse(part):
            if _local(node.tag) == "si":
                out.append(_text(node))
                node.clear()
    return out


def _sheet_part(book: zipfile.ZipFile, sheet: int | str) -> tuple[str, str]:
    """Name and archive member of a sheet given by index or name."""
    with book.open("xl/workbook.xml") as part:
        sheets = [(n.get("name"), n.get(_REL)) for _, n in iterparse(part) if _local(n.tag) == "sheet"]
    with book.open("xl/_rels/workbook.xml.rels") as part:
        targets = {n.get("Id"): n.get("Target") for _, n in iterparse(part) if _local(n.tag) == "Relationship"}
    if isinstance(sheet, int):
        if sheet >= len(sheets):
            raise ValueError(f"no sheet at index {sheet}")
        name, rel = sheets[sheet]
    else:
        name, rel = next(((n, i) for n, i in sheets if n == sheet), (None, None))
        if rel is None:
            raise ValueError(f"no sheet named {sheet}")
    target = targets[rel]
    return name, target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indexes of the cell styles that show a number as a date or time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    custom, styles = {}, []
    with book.open("xl/styles.xml") as part:
        for _, node in iterparse(part):
            if _local(node.tag) == "numFmt":
                # Literal text, colours and locales say nothing about the kind of value.
                code = re.sub(r'"[^"]*"|\\.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', "", node.get("formatCode", ""), flags=re.I)
                custom[int(node.get("numFmtId"))] = bool(re.search("[dmhys]", code.split(";")[0], re.I))
            elif _local(node.tag) == "cellXfs":
                styles = [int(xf.get("numFmtId", 0)) for xf in node]
    return {i for i, fmt in enumerate(styles) if custom.get(fmt, fmt in _DATE_FORMATS)}


def _starts_1904(book: zipfile.ZipFile) -> bool:
    with book.open("xl/workbook.xml") as part:
        return any(n.get("date1904") in ("1", "true") for _, n in iterparse(part) if _local(n.tag) == "workbookPr")


def _date_text(serial: float, from_1904: bool) -> str:
    """Text of a day number: a time of day below 1, else a date with time."""
    days, part = divmod(serial, 1)
    time = timedelta(milliseconds=round(part * 86_400_000))
    if 0 <= serial < 1 and time < timedelta(days=1):
        return str((datetime(1900, 1, 1) + time).time())
    # Day 60 of the 1900 calendar does not exist.
    shift = 1 if not from_1904 and 0 < serial < 60 else 0
    first = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30)
    return str(first + timedelta(days=days + shift) + time)


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _value(cell, shared: list[str], dates: set[int], from_1904: bool) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(_text(n) for n in cell if _local(n.tag) == "is")
    raw = next((n.text for n in cell if _local(n.tag) == "v"), None)
    if raw is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(raw)]
    if kind == "b":
        return "True" if raw == "1" else "False"
    if kind == "n":
        number = float(raw)
        if int(cell.get("s", 0)) in dates:
            return _date_text(number, from_1904)
        return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)
    return raw


def _cells(source, sheet: int | str) -> Iterator[tuple[str, int, int | None, str | None]]:
    """Non-empty cells in order; an empty row that lies between others is one cell without column."""
    with zipfile.ZipFile(source) as book:
        shared, dates, from_1904 = _shared_strings(book), _date_styles(book), _starts_1904(book)
        name, part_name = _sheet_part(book, sheet)
        r = last = -1
        with book.open(part_name) as part:
            table = None
            for event, row in iterparse(part, events=("start", "end")):
                if event == "start":
                    table = row if _local(row.tag) == "sheetData" else table
                    continue
                if _local(row.tag) != "row":
                    continue
                r = int(row.get("r")) - 1 if row.get("r") else r + 1
                c = -1
                for cell in row:
                    c = _column(cell.get("r")) if cell.get("r") else c + 1
                    value = _value(cell, shared, dates, from_1904)
                    if value is not None and value != "":
                        yield from ((name, gap, None, None) for gap in range(last + 1, r))
                        last = r
                        yield name, r, c, value
                # Rows that are done leave memory.
                table.clear()


def _open(batch: pa.RecordBatch, at: int, path: str):
    if "content" in batch.schema.names:
        return io.BytesIO(batch.column("content")[at].as_py())
    return open_input(path)


def _unpack(sheet: int | str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, path in enumerate(batch.column("path").to_pylist()):
                rows = []
                try:
                    with _open(batch, at, path) as source:
                        for name, r, c, v in _cells(source, sheet):
                            rows.append((path, name, r, c, v, None))
                            if len(rows) == _BATCH:
                                yield _batch(rows)
                                rows = []
                except (OSError, zipfile.BadZipFile, KeyError, ValueError, IndexError, SyntaxError, OverflowError) as exc:
                    rows.append((path, None, None, None, None, f"{type(exc).__name__}: {exc}"))
                if rows:
                    yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def excel_cells(files: DataFrame, sheet: int | str = 0) -> DataFrame:
    """Non-empty cells of one sheet of every workbook in a frame of ``path`` and maybe ``content``.

    Listed files are opened by the tasks themselves, so no workbook travels through Spark as a value.

    Row and column numbers start at 0 and every value is text (dates as ISO text, error cells as
    empty); an empty row between others is a cell
    without column and value. A workbook that cannot be read
    gives one row with ``error`` set; cells stream out in batches, so a large sheet is never held whole.
    """
    columns = [c for c in ("path", "content") if c in files.columns]
    return files.select(*columns).mapInArrow(_unpack(sheet), CELLS)
