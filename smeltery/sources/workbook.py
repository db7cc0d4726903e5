"""XLSX rows inside a task, with the standard library only.

A worksheet holds at most 1,048,576 rows by its format, so one workbook always fits one
task; many workbooks are spread by Spark. Rows leave the task in bounded frames.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd

from smeltery.schemas import REQUIRED_COLUMNS

WORKBOOK_ROWS = "path string, seq bigint, payload map<string,string>, numeric array<string>, header_error string"
_FRAME_ROWS = 10_000

# The XML namespaces of the format, and its built-in date formats.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_BUILTIN_DATES = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}


class Number(str):
    """The text of a numeric cell: it counts as a number, not as what its spelling would mean."""


def workbook_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for path, content in zip(frame["path"], frame["content"]):
            yield from _workbook_frames(path, content)


def _workbook_frames(path: str, content: bytes) -> Iterator[pd.DataFrame]:
    rows = sheet_rows(content)
    first = next(rows, None)
    if first is None:
        return
    headers = [str(cell).strip() for cell in first]
    missing = [name for name in REQUIRED_COLUMNS if name not in headers]
    if missing:
        error = f"Missing required columns: {missing}"
        yield pd.DataFrame(
            {"path": [path], "seq": [0], "payload": [{}], "numeric": [[]], "header_error": [error]}
        )
        return
    held: list[tuple[dict, list[str]]] = []
    start = 0
    for row in rows:
        texts = [cell and str(cell) for cell in row] + [None] * (len(headers) - len(row))
        numbers = [name for name, cell in zip(headers, row) if isinstance(cell, Number)]
        held.append((dict(zip(headers, texts)), numbers))
        if len(held) == _FRAME_ROWS:
            yield _frame(path, start, held)
            start, held = start + len(held), []
    if held:
        yield _frame(path, start, held)


def _frame(path: str, start: int, rows: list[tuple[dict, list[str]]]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "path": path,
            "seq": range(start, start + len(rows)),
            "payload": [payload for payload, _ in rows],
            "numeric": [numbers for _, numbers in rows],
            "header_error": None,
        }
    )


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Cells of the active sheet as text (``Number`` where numeric), one list per row, gaps filled with None."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = _shared_strings(book)
        dates = _date_styles(book)
        sheet, epoch = _active_sheet(book)
        expected = 1
        with book.open(sheet) as stream:
            for _, node in ElementTree.iterparse(stream):
                if node.tag != f"{_MAIN}row":
                    continue
                number = int(node.get("r", expected))
                for _ in range(expected, number):
                    yield []
                expected = number + 1
                yield _row_cells(node, shared, dates, epoch)
                node.clear()


def _row_cells(node, shared, dates, epoch) -> list[str | None]:
    cells: list[str | None] = []
    for cell in node.iter(f"{_MAIN}c"):
        column = _column_index(cell.get("r"), len(cells))
        cells.extend([None] * (column - len(cells)))
        cells.append(_cell_text(cell, shared, dates, epoch))
    return cells


def _column_index(reference: str | None, default: int) -> int:
    letters = re.match(r"[A-Z]+", reference or "")
    if not letters:
        return default
    index = 0
    for letter in letters.group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def _cell_text(cell, shared, dates, epoch) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = cell.find(f"{_MAIN}is")
        return "" if inline is None else _plain_text(inline)
    value = cell.find(f"{_MAIN}v")
    if value is None or value.text is None:
        return None
    text = value.text
    if kind == "s":
        return shared[int(text)]
    if kind == "b":
        return str(text == "1")
    if kind != "n":
        return text
    if int(cell.get("s", 0)) in dates:
        moment = epoch + timedelta(milliseconds=round(float(text) * 86_400_000))
        return str(moment)
    return Number(float(text) if re.search("[.eE]", text) else int(text))


def _xml(book: zipfile.ZipFile, name: str):
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    root = _xml(book, "xl/sharedStrings.xml")
    items = [] if root is None else root.iter(f"{_MAIN}si")
    return [_plain_text(item) for item in items]


def _plain_text(item) -> str:
    """Text of a string item and its runs; readings given beside it are left out."""
    parts = [*item.findall(f"{_MAIN}t"), *item.findall(f"{_MAIN}r/{_MAIN}t")]
    return "".join(t.text or "" for t in parts)


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Positions of the cell styles that show a date or time."""
    root = _xml(book, "xl/styles.xml")
    if root is None:
        return set()
    dated = set(_BUILTIN_DATES)
    for fmt in root.iter(f"{_MAIN}numFmt"):
        code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", fmt.get("formatCode", "")).lower()
        if re.search("[ymdhs]", code):
            dated.add(int(fmt.get("numFmtId")))
    styles = root.find(f"{_MAIN}cellXfs")
    found = [] if styles is None else list(styles)
    return {i for i, style in enumerate(found) if int(style.get("numFmtId", 0)) in dated}


def _active_sheet(book: zipfile.ZipFile) -> tuple[str, datetime]:
    root = _xml(book, "xl/workbook.xml")
    view = root.find(f".//{_MAIN}workbookView")
    active = int(view.get("activeTab", 0)) if view is not None else 0
    properties = root.find(f"{_MAIN}workbookPr")
    uses_1904 = properties is not None and properties.get("date1904") in ("1", "true")
    epoch = datetime(1904, 1, 1) if uses_1904 else datetime(1899, 12, 30)
    relation = list(root.iter(f"{_MAIN}sheet"))[active].get(f"{_REL}id")
    targets = {r.get("Id"): r.get("Target") for r in _xml(book, "xl/_rels/workbook.xml.rels")}
    target = targets[relation].lstrip("/")
    return (target if target.startswith("xl/") else f"xl/{target}"), epoch
