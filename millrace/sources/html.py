"""Records, links and sections out of landed HTML pages.

A page table ``(page_id, url, html)`` is spread by Spark; each function here is a
column expression backed by an Arrow UDF over the page text, so other columns do
not pass through Python. Markup is parsed leniently with the standard library:
unclosed tags stay open until an enclosing tag ends.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import spread

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without an end tag, and elements whose text is not content.
_VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
_NOT_CONTENT = frozenset("script style template rt rp".split())
# Stands for an ampersand where references are kept as written: no text from a table holds a lone surrogate.
_AMPERSAND = "\ud800"


class _Node:
    __slots__ = ("tag", "attrs", "parts")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.parts = tag, attrs, []

    def walk(self) -> Iterator[_Node]:
        """Elements below this one, in document order, without recursion."""
        stack = [iter(self.parts)]
        while stack:
            part = next(stack[-1], None)
            if part is None:
                stack.pop()
            elif isinstance(part, _Node):
                yield part
                stack.append(iter(part.parts))

    def find_all(self, tag: str, klass: str | None = None) -> list[_Node]:
        return [
            n
            for n in self.walk()
            if n.tag == tag
            and (klass is None or klass in (n.attrs.get("class") or "").split() or n.attrs.get("class") == klass)
        ]

    def find(self, tag: str, klass: str | None = None) -> _Node | None:
        return next(iter(self.find_all(tag, klass)), None)

    def text(self) -> str:
        """Content strings below, each stripped, joined without a separator."""
        out, stack = [], [iter(self.parts)]
        while stack:
            part = next(stack[-1], None)
            if part is None:
                stack.pop()
            elif isinstance(part, str):
                out.append(part.strip())
            elif part.tag not in _NOT_CONTENT:
                stack.append(iter(part.parts))
        return "".join(out)

    def only_string(self) -> str | None:
        """The text of an element that holds one string, directly or down a chain of single elements."""
        node = self
        while len(node.parts) == 1:
            if isinstance(node.parts[0], str):
                return node.parts[0]
            node = node.parts[0]
        return None


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        found = {}
        for name, value in attrs:
            found[name] = value or ""
        node = _Node(tag, found)
        self.open[-1].parts.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        parts = self.open[-1].parts
        if parts and isinstance(parts[-1], str):
            parts[-1] += data
        else:
            parts.append(data)

    def handle_comment(self, data):
        self.open[-1].parts.append(_Node("template", {}))  # keeps neighbours apart, is no content


def parse(html: str) -> _Node:
    builder = _TreeBuilder()
    try:
        builder.feed(html)
        builder.close()
    except AssertionError:
        pass  # a marked section the parser gives up on: keep what was read so far
    return builder.root


def parse_as_written(html: str) -> _Node:
    """The page with ``_AMPERSAND`` for each ampersand, so that no character reference is decoded."""
    return parse(html.replace("&", _AMPERSAND))


def _link(scope: _Node, label: str) -> str | None:
    """``href`` of the first anchor whose only text is exactly ``label``."""
    anchor = next((a for a in scope.find_all("a") if a.only_string() == label), None)
    return anchor.attrs.get("href") if anchor else None


def table_records_of(root: _Node, link_label: str) -> list[dict]:
    table = root.find("table")
    lines = table.find_all("tr") if table else []
    if not lines:
        return []
    headers = [th.text() for th in lines[0].find_all("th")]
    out = []
    for line in lines[1:]:
        cells = line.find_all("td")
        if len(cells) == len(headers):
            record = dict(zip(headers, (c.text() for c in cells)))
            out.append({"row_no": len(out), "cells": list(record.items()), "details_link": _link(line, link_label)})
    return out


def table_titles(root: _Node) -> list[str] | None:
    table = root.find("table")
    first = table.find("tr") if table else None
    return [th.text() for th in first.find_all("th")] if first else None


def next_link(root: _Node, page: int, label: str, base: str) -> str | None:
    bar = root.find("ul", "pagination")
    if bar is None:
        return None
    href = _link(bar, str(page + 1))
    if href is None:
        href = _link(bar, label)
    return urljoin(base, href) if href else None


def _sections(root: _Node) -> list[tuple[str, list[tuple[str, str]]]]:
    """Title → label → value; a repeated title or label keeps its last value."""
    out: dict[str, dict[str, str]] = {}
    for section in root.find_all("div", "detail-section"):
        title = section.find("h3")
        if title is None:
            continue
        rows = {}
        for row in section.find_all("div", "row"):
            label, value = row.find("div", "label"), row.find("div", "value")
            if label is not None and value is not None:
                rows[label.text()] = value.text()
        out[title.text()] = rows
    return [(t, list(r.items())) for t, r in out.items()]


_STEP = re.compile(
    r"/(?P<deep>/?)(?:(?P<text>text\(\))|@(?P<attr>[\w:-]+)|(?P<tag>[\w*-]+)(?:\[@(?P<key>[\w:-]+)='(?P<want>[^']*)'\])?)"
)


def selector(path: str) -> list[dict]:
    text, at, out = path.lstrip("."), 0, []
    while at < len(text):
        found = _STEP.match(text, at)
        if not found:
            raise ValueError(f"unsupported selector {path!r}")
        out.append(found.groupdict())
        at = found.end()
    return out


def _select(scopes: list[_Node], path: str) -> list:
    """Elements, or strings when the path ends in ``text()`` or ``@attribute``."""
    for step in selector(path):
        if step["attr"]:
            return [n.attrs[step["attr"]] for n in scopes if step["attr"] in n.attrs]
        if step["text"]:
            return [p for n in scopes for p in n.parts if isinstance(p, str)]
        found = []
        for scope in scopes:
            below = scope.walk() if step["deep"] else (p for p in scope.parts if isinstance(p, _Node))
            found += [
                n
                for n in below
                if step["tag"] in ("*", n.tag) and (step["key"] is None or n.attrs.get(step["key"]) == step["want"])
            ]
        scopes = list({id(n): n for n in found}.values())
    return scopes


def field_records(root: _Node, table: str | None, item: str, fields: dict[str, str]) -> list[list[tuple[str, str | None]]]:
    scopes = _select([root], table) if table else [root]
    out = []
    for node in _select(scopes, item if item.startswith((".", "/")) else f".//{item}"):
        record = []
        for name, path in fields.items():
            hits = _select([node], path)
            value = hits[0] if hits else None
            value = value.text() if isinstance(value, _Node) else value
            record.append((name, value.strip() if value is not None else None))
        out.append(record)
    return out


def first_string(root: _Node, path: str) -> str | None:
    hits = _select([root], path)
    return hits[0].replace(_AMPERSAND, "&") if hits and isinstance(hits[0], str) else None


_TEXTS_ARROW = pa.map_(pa.string(), pa.string())
# Table rows and declared items, as Spark and as Arrow write their types.
ROWS = (
    "array<struct<row_no:int,cells:map<string,string>,details_link:string>>",
    pa.list_(pa.struct([("row_no", pa.int32()), ("cells", _TEXTS_ARROW), ("details_link", pa.string())])),
)
ITEMS = ("array<map<string,string>>", pa.list_(_TEXTS_ARROW))


def _over_pages(
    fn: Callable[[_Node], object], ddl: str, arrow: pa.DataType, html: Column, read: Callable[[str], _Node] = parse
) -> Column:
    @F.arrow_udf(ddl)
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([None if p is None else fn(read(p)) for p in pages.to_pylist()], type=arrow)

    return run(html)


def table_records(html: Column, link_label: str = "Anmälan") -> Column:
    """Rows of the page's first table as ``(row_no, cells, details_link)``.

    Titles are the ``th`` texts of the first row; a later row counts if it has as
    many ``td`` cells as there are titles.
    """
    return _over_pages(lambda root: table_records_of(root, link_label), *ROWS, html)


def table_headers(html: Column) -> Column:
    """Titles of the page's first table; NULL without a table."""
    return _over_pages(table_titles, "array<string>", pa.list_(pa.string()), html)


def detail_sections(html: Column) -> Column:
    """Section title → label → value."""
    return _over_pages(
        _sections, "map<string,map<string,string>>", pa.map_(pa.string(), _TEXTS_ARROW), html
    )


def next_page_link(html: Column, page: Column, base_url: str = "", label: str = "Nästa") -> Column:
    """Link to page + 1 in the pagination list, else the link named ``label``, else NULL."""

    @F.arrow_udf("string")
    def run(pages: pa.Array, numbers: pa.Array) -> pa.Array:
        return pa.array(
            [
                None if p is None or n is None else next_link(parse(p), n, label, base_url)
                for p, n in zip(pages.to_pylist(), numbers.to_pylist())
            ],
            pa.string(),
        )

    return run(html, page)


def select_first(html: Column, path: str, decode: bool = True) -> Column:
    """First string a selector finds, such as ``//a[@class='pagination-next']/@href``.

    Without ``decode``, character references stay as the page writes them.
    """
    selector(path)
    read = parse if decode else parse_as_written
    return _over_pages(lambda root: first_string(root, path), "string", pa.string(), html, read)


def select_items(html: Column, item_path: str, fields: dict[str, str], table_path: str | None = None) -> Column:
    """Items a selector finds, each as field → text by the field's own selector.

    Selectors are steps ``/tag`` or ``//tag`` with an optional ``[@attr='value']``,
    ending in an element, ``text()`` or ``@attr``.
    """
    for path in [*fields.values(), *([table_path] if table_path else [])]:
        selector(path)
    fields = dict(fields)
    return _over_pages(
        lambda root: field_records(root, table_path, item_path, fields), *ITEMS, html
    )


def anchors(html: Column) -> Column:
    """All links of the page as ``(href, label)``, in document order."""
    return _over_pages(
        lambda root: [
            {"href": a.attrs["href"], "label": a.text()} for a in root.find_all("a") if "href" in a.attrs
        ],
        "array<struct<href:string,label:string>>",
        pa.list_(pa.struct([("href", pa.string()), ("label", pa.string())])),
        html,
    )


def read_table_pages(
    pages: DataFrame, columns: list[str], keep: list[str], html: str = "html", link_label: str = "Anmälan"
) -> DataFrame:
    """Table rows of every page, with the named titles as columns and ``details_link``."""
    rows = spread(pages.select(*keep, html)).select(*keep, F.inline(table_records(F.col(html), link_label)))
    return rows.select(
        *keep, "row_no", *[F.try_element_at("cells", F.lit(c)).alias(c) for c in columns], "details_link"
    )


def read_items(
    pages: DataFrame, item_path: str, fields: dict[str, str], keep: list[str], html: str = "html", table_path=None
) -> DataFrame:
    """Declared items of every page, one row per item, one column per field."""
    items = select_items(F.col(html), item_path, fields, table_path)
    rows = spread(pages.select(*keep, html)).select(*keep, F.posexplode(items).alias("item_no", "f"))
    return rows.select(*keep, "item_no", *[F.try_element_at("f", F.lit(n)).alias(n) for n in fields])


def read_sections(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Detail sections of every page as ``(section, label, value)`` rows."""
    sections = spread(pages.select(*keep, html)).select(
        *keep, F.explode(detail_sections(F.col(html))).alias("section", "rows")
    )
    return sections.select(*keep, "section", F.explode("rows").alias("label", "value"))


def read_anchors(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Links of every page as ``(href, label)`` rows."""
    return spread(pages.select(*keep, html)).select(*keep, F.inline(anchors(F.col(html))))
