"""Elements of XML documents by path, in one streaming pass (a small helper inside map tasks)."""

from __future__ import annotations

import io
import re
import sys
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle

# Executors need not have this package: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STEP = re.compile(r"[^\W\d][\w.\-]*|\*")


def path_steps(path: str) -> tuple[bool, list[str]]:
    """``(anywhere, steps)`` of ``/root/a/b``, ``./a/b`` (below the root) or ``//b``; ``*`` stands for any tag.

    ``/root`` is the root whatever its tag. Anything else in a path (predicates, axes) is an error.
    """
    text = path.rstrip("/")
    if text.startswith("//") or text.startswith(".//"):
        anywhere, steps = True, text.lstrip("./").split("/")
    else:
        anywhere = False
        if text.startswith("./"):
            steps = ["*", *text[2:].split("/")]
        else:
            steps = text.lstrip("/").split("/")
            steps[0] = "*" if steps[0] == "root" else steps[0]
    if not steps or not all(_STEP.fullmatch(s) for s in steps):
        raise ValueError(f"XML path {path!r} is not supported")
    return anywhere, steps


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _matches(open_tags: list[str], anywhere: bool, steps: list[str]) -> bool:
    tail = open_tags[-len(steps):] if anywhere else open_tags
    return len(tail) == len(steps) and all(s in ("*", t) for s, t in zip(steps, tail))


def _row(node: ET.Element) -> dict[str, str | None]:
    """Attributes as ``<tag>_<name>``, children as text: the last of a repeated one, NULL for one with children."""
    tag, found = _local(node.tag), {}
    for name, value in node.attrib.items():
        found[f"{tag}_{_local(name)}"] = value
    for child in node:
        text = (child.text or "").strip()
        found[_local(child.tag)] = text if text and len(child) == 0 else None
    if not found and (node.text or "").strip():
        found["_VALUE"] = node.text.strip()
    return found


def elements_at(content: bytes, encoding: str, anywhere: bool, steps: list[str]) -> Iterator[dict]:
    """The rows of all elements at the path; raises ``ParseError`` at the end of what is well formed."""
    tags: list[str] = []
    inside = 0  # elements are let go as soon as no matching one is open
    for event, node in ET.iterparse(io.BytesIO(content), events=("start", "end"), parser=ET.XMLParser(encoding=encoding)):
        if event == "start":
            tags.append(_local(node.tag))
            inside += _matches(tags, anywhere, steps)
        else:
            if _matches(tags, anywhere, steps):
                inside -= 1
                yield _row(node)
            tags.pop()
            if not inside:
                node.clear()


def path_rows(path: str, encoding: str):
    """Per document: its rows as maps, and whether it broke off."""
    anywhere, steps = path_steps(path)
    rows = pa.list_(pa.map_(pa.string(), pa.string()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                found, error = [], None
                try:
                    for row in elements_at(content, encoding, anywhere, steps):
                        found.append(list(row.items()))
                        if len(found) >= 1000:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([name]), pa.array([found], rows), pa.array([None], pa.string())], ["path", "rows", "error"]
                            )
                            found = []
                except ET.ParseError as err:
                    error = str(err)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([found], rows), pa.array([error], pa.string())], ["path", "rows", "error"]
                )

    return work
