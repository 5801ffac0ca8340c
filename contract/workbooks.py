"""Writing small workbooks inside tasks, as input for the workbook query."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_LINK = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _text(value: str) -> str:
    return f'<c t="inlineStr"><is><t>{escape(value)}</t></is></c>'


def _book(rows: list[dict]) -> bytes:
    """A sheet ``other`` and a sheet ``customers``: a note line, a title line, one line per row."""
    lines = [_text("exported"), "".join(_text(t) for t in ("c_custkey", "c_name", "c_acctbal", "note"))]
    for r in rows:
        note = _text(r["note"]) if r["note"] else ""
        lines.append(f"<c><v>{r['c_custkey']}</v></c>{_text(r['c_name'])}<c><v>{r['bal']}</v></c>{note}")
    body = "".join(f'<row r="{i}">{line}</row>' for i, line in enumerate(lines, 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        sheets = '<sheet name="other" sheetId="1" r:id="a"/><sheet name="customers" sheetId="2" r:id="b"/>'
        z.writestr("xl/workbook.xml", f'<workbook {_MAIN} xmlns:r="{_LINK}"><sheets>{sheets}</sheets></workbook>')
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships><Relationship Id="a" Target="worksheets/sheet1.xml"/>'
            '<Relationship Id="b" Target="worksheets/sheet2.xml"/></Relationships>',
        )
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {_MAIN}><sheetData/></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {_MAIN}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


def workbook_writer(folder: str):
    """A map function that writes one workbook per ``(book, rows)`` row under ``folder``."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
        fs, root = FileSystem.from_uri(uri)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            paths = []
            for r in batch.to_pylist():
                paths.append(f"{root}/book-{r['book']}.xlsx")
                with fs.open_output_stream(paths[-1]) as f:
                    f.write(_book(r["rows"]))
            yield pa.record_batch({"path": pa.array(paths, pa.string())})

    return write
