"""Workbook (.xlsx) sheets as rows: one workbook per task row, with the standard library.

A sheet holds at most 1,048,576 rows, so a file is bounded by its format; many
files are read in parallel.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The namespaces of the workbook format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_OUT = pa.schema(
    [
        ("path", pa.string()),
        ("row_no", pa.int32()),
        ("names", pa.list_(pa.string())),
        ("cells", pa.map_(pa.string(), pa.string())),
        ("error", pa.string()),
    ]
)
_CHUNK = 5000


def _column_index(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _sheet_part(book: zipfile.ZipFile, sheet) -> str:
    sheets = ET.fromstring(book.read("xl/workbook.xml")).find(f"{_MAIN}sheets")
    listed = [(s.get("name"), s.get(f"{_LINK}id")) for s in sheets]
    wanted = listed[sheet][1] if isinstance(sheet, int) else dict(listed)[sheet]
    for rel in ET.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if rel.get("Id") == wanted:
            target = rel.get("Target")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise KeyError(sheet)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ET.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in root]


def _cell_text(cell: ET.Element, shared: list[str]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    value = cell.findtext(f"{_MAIN}v")
    if value is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    return value


def _rows(content: bytes, sheet) -> Iterator[tuple[int, dict[int, str]]]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = _shared_strings(book)
        with book.open(_sheet_part(book, sheet)) as part:
            last = -1
            for _, node in ET.iterparse(part):
                if node.tag != f"{_MAIN}row":
                    continue
                last = int(node.get("r")) - 1 if node.get("r") else last + 1
                cells, at = {}, -1
                for cell in node.iter(f"{_MAIN}c"):
                    at = _column_index(cell.get("r")) if cell.get("r") else at + 1
                    text = _cell_text(cell, shared)
                    if text not in (None, ""):
                        cells[at] = text
                node.clear()
                yield last, cells


def _records(path: str, content: bytes, sheet, header: int | None, skiprows: int) -> Iterator[dict]:
    """Data rows as name → text. A broken workbook gives one row with ``error`` alone."""
    names, row_no = None, 0
    title_at = None if header is None else skiprows + header
    made = []
    try:
        for at, cells in _rows(content, sheet):
            if at < skiprows or (title_at is not None and at < title_at):
                continue
            if title_at is not None and names is None:
                width = max(cells, default=-1) + 1
                names = [cells.get(i, f"Unnamed: {i}") for i in range(width)]
                continue
            if not cells:
                continue
            pairs = [
                (names[i] if names and i < len(names) else (f"Unnamed: {i}" if names else str(i)), v)
                for i, v in sorted(cells.items())
            ]
            made.append(
                {"path": path, "row_no": row_no, "names": names or [n for n, _ in pairs], "cells": pairs, "error": None}
            )
            row_no += 1
    except (zipfile.BadZipFile, ET.ParseError, KeyError, IndexError, ValueError, AttributeError) as err:
        made = [{"path": path, "row_no": None, "names": None, "cells": None, "error": f"{type(err).__name__}: {err}"}]
    yield from made


def read_workbooks(
    files: DataFrame, sheet_name: int | str = 0, header: int | None = 0, skiprows: int | None = None, columns=None
) -> DataFrame:
    """``binaryFile`` rows to ``(path, row_no, names, cells, error)`` rows of one sheet."""
    skip = skiprows or 0

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                chunk = []
                for record in _records(path, content, sheet_name, header, skip):
                    chunk.append(record)
                    if len(chunk) == _CHUNK:
                        yield pa.RecordBatch.from_pylist(chunk, schema=_OUT)
                        chunk = []
                if chunk:
                    yield pa.RecordBatch.from_pylist(chunk, schema=_OUT)

    return files.select("path", "content").mapInArrow(
        read, "path string, row_no int, names array<string>, cells map<string,string>, error string"
    )
