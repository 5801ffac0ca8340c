"""A paged remote read as a Spark data source, over a caller's fetch function.

The source yields landed bodies ``(feed, page, body)``; which pages count and what
items they hold is then DataFrame work (``sources.payloads``). Page and offset
feeds are split into ranges of pages that are fetched in parallel. A cursor is only
known from the page before, so a cursor feed is one task; feeds run side by side.
As a stream, feeds are read in spans of pages, on executors too.
"""

from __future__ import annotations

import hashlib
import json
import sys
import uuid
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from millrace.sources.payloads import DEFAULT_LIMIT

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "feed string, page bigint, body string"
Fetch = Callable[[str, dict], str | None]


def cursor_in(body: str, path: str):
    """The next cursor at a dotted path of a body, or None."""
    return _at_path(json.loads(body), path)


def _at_path(value, path: str):
    for part in path.split("."):
        if not isinstance(value, dict) or part not in value:
            return None
        value = value[part]
    return value or None


class _Stride(InputPartition):
    """Pages ``first``, ``first + step``, … of a feed, up to the first one that is past the end."""

    def __init__(self, feed: str, first: int, step: int):
        self.feed, self.first, self.step = feed, first, step


def has_items(body: str, data_key: str) -> bool:
    """Whether a body lists items: under the key, or as a list itself. A body that says neither counts as one."""
    try:
        value = json.loads(body)
    except ValueError:
        return True
    return _lists_items(value, data_key)


def _lists_items(value, data_key: str) -> bool:
    listed = value.get(data_key, [None]) if isinstance(value, dict) else value
    return not isinstance(listed, list) or bool(listed)


def next_cursor(body: str, data_key: str, path: str):
    """The cursor that follows a body, or None where the feed ends: without items or without a cursor."""
    value = json.loads(body)
    return _at_path(value, path) if _lists_items(value, data_key) else None


class _Reader(DataSourceReader):
    def __init__(self, fetch: Fetch, options: dict):
        self.fetch = fetch
        self.strategy = options.get("strategy", "none")
        if self.strategy not in ("none", "page", "offset", "cursor"):
            raise ValueError(f"unknown paging strategy {self.strategy!r}")
        self.feeds = json.loads(options.get("feeds", '[""]'))
        self.max_pages = int(options["max_pages"]) if options.get("max_pages") else None
        self.tasks = max(1, int(options.get("tasks_per_feed", 8)))
        self.data_key = options.get("data_key", "data")
        self.limit = int(options.get("limit", DEFAULT_LIMIT))
        self.names = {k: options.get(f"{k}_param", k) for k in ("page", "offset", "limit", "cursor")}
        self.cursor_path = options.get("cursor_path", "meta.next_cursor")

    def partitions(self) -> list[InputPartition]:
        """Numbered pages are dealt to ``tasks_per_feed`` tasks in turn, so neither a total nor a cap is needed."""
        if self.strategy in ("none", "cursor"):
            return [_Stride(f, 1, 1) for f in self.feeds]
        return [_Stride(f, first, self.tasks) for f in self.feeds for first in range(1, self.tasks + 1)]

    def params(self, number: int, cursor: str | None) -> dict:
        if self.strategy == "page":
            return {self.names["page"]: number}
        if self.strategy == "offset":
            return {self.names["limit"]: self.limit, self.names["offset"]: (number - 1) * self.limit}
        return {self.names["cursor"]: cursor} if cursor else {}

    def order(self, number: int) -> int:
        return (number - 1) * self.limit if self.strategy == "offset" else number

    def read(self, part: _Stride) -> Iterator[tuple]:
        cursor, number = None, part.first
        while self.max_pages is None or number <= self.max_pages:
            body = self.fetch(part.feed, self.params(number, cursor))
            if body is None:  # past the end
                return
            yield part.feed, self.order(number), body
            if self.strategy == "cursor":
                cursor = next_cursor(body, self.data_key, self.cursor_path)
                if cursor is None:
                    return
            elif self.strategy == "none" or not has_items(body, self.data_key):
                return
            number += part.step


class _Span(InputPartition):
    """The pages of a feed from where its span ``number - 1`` ended."""

    def __init__(self, feed: str, number: int):
        self.feed, self.number = feed, number


class _Marks:
    """Where each span of each feed ended: small files in a folder that the driver and all executors share.

    A mark is written once. A span that is read again reads exactly the pages its mark names, so a replayed batch
    holds the rows of the first one, however the feed has grown since.
    """

    def __init__(self, root: str):
        self.root = root

    def _folder(self, feed: str):
        from pyarrow.fs import FileSystem

        plain = "://" not in self.root and not self.root.startswith("file:")
        fs, path = FileSystem.from_uri(f"file://{self.root}" if plain else self.root)
        return fs, f"{path}/{hashlib.sha256(feed.encode()).hexdigest()}"

    def numbers(self, feed: str) -> list[int]:
        from pyarrow.fs import FileSelector

        fs, folder = self._folder(feed)
        found = fs.get_file_info(FileSelector(folder, allow_not_found=True))
        return sorted(int(f.base_name) for f in found if f.base_name.isdigit())

    def get(self, feed: str, number: int) -> dict | None:
        fs, folder = self._folder(feed)
        try:
            with fs.open_input_stream(f"{folder}/{number}") as file:
                return json.loads(file.read())
        except FileNotFoundError:
            return None

    def put(self, feed: str, number: int, mark: dict) -> None:
        fs, folder = self._folder(feed)
        fs.create_dir(folder, recursive=True)
        draft = f"{folder}/.{number}-{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as file:
            file.write(json.dumps(mark).encode())
        fs.move(draft, f"{folder}/{number}")

    def forget(self, feed: str, below: int) -> None:
        fs, folder = self._folder(feed)
        for number in self.numbers(feed):
            if number < below:
                fs.delete_file(f"{folder}/{number}")


class _SpanStream(DataSourceStreamReader):
    """Feeds read in spans of pages, a task per feed and batch; an offset counts the spans of each feed.

    The next cursor is known only once a page is read, so it stays where pages are read: the task that reads a span
    leaves a mark of a few bytes, with the page and cursor that follow. The driver looks at marks only, to see which
    feeds go on. A feed that has ended is asked once more by every newly started query, so scheduled runs find pages
    that have come since; pages that were there are not read again.
    """

    def __init__(self, fetch: Fetch, options: dict):
        if not options.get("marks"):
            raise ValueError("a stream of pages needs the option 'marks': a folder that the driver and all executors share")
        self.pages = _Reader(fetch, options)
        self.feeds = self.pages.feeds
        self.marks = _Marks(options["marks"].rstrip("/"))
        self.most = int(options.get("pages_per_batch", 100)) or None
        self.asked_again: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        return {f: 0 for f in self.feeds}

    def _last(self, feed: str) -> tuple[int, bool]:
        """The number of the feed's last finished span (-1 without one), and whether the feed ended there."""
        numbers = self.marks.numbers(feed)
        if not numbers:
            return -1, False
        mark = self.marks.get(feed, numbers[-1])
        return numbers[-1], bool(mark and mark["ended"])

    def latestOffset(self) -> dict:
        last = {f: self._last(f) for f in self.feeds}
        if self.asked_again is None:
            self.asked_again = {f: n for f, (n, ended) in last.items() if ended}
        return {f: n + 1 + (not ended or self.asked_again.get(f) == n) for f, (n, ended) in last.items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Span(f, k) for f in end for k in range(start.get(f, 0), end[f])]

    def read(self, part: _Span) -> Iterator[tuple]:
        at = {"page": 1, "cursor": None, "last": None, "ended": False}
        if part.number:
            at = self.marks.get(part.feed, part.number - 1)
            if at is None:
                raise RuntimeError(f"the mark before span {part.number} of feed {part.feed!r} is gone: marks belong to one checkpoint")
        known, first = self.marks.get(part.feed, part.number), at["page"]
        if at["ended"]:
            at = self._once_more(part.feed, at)
        while not at["ended"] and (at["page"] < known["page"] if known else not self.most or at["page"] < first + self.most):
            body = self._body(part.feed, at)
            if body is None:
                at = {**at, "ended": True}
            else:
                yield part.feed, self.pages.order(at["page"]), body
                at = self._after(at, body)
        if known is None:
            self.marks.put(part.feed, part.number, at)
        elif at["page"] != known["page"]:
            raise RuntimeError(f"feed {part.feed!r} has fewer pages than when span {part.number} was first read")

    def _body(self, feed: str, at: dict) -> str | None:
        if self.pages.max_pages is not None and at["page"] > self.pages.max_pages:
            return None
        return self.pages.fetch(feed, self.pages.params(at["page"], at["cursor"]))

    def _after(self, at: dict, body: str) -> dict:
        cursor = None
        if self.pages.strategy == "cursor":
            cursor = next_cursor(body, self.pages.data_key, self.pages.cursor_path)
            more = cursor is not None
        else:
            more = self.pages.strategy != "none" and has_items(body, self.pages.data_key)
        return {"page": at["page"] + 1, "cursor": cursor, "last": at["cursor"], "ended": not more}

    def _once_more(self, feed: str, at: dict) -> dict:
        """Where to go on in a feed that had ended: at a page that was not there, or behind one that led no further."""
        if self.pages.strategy == "none":
            return at
        if self.pages.strategy != "cursor" or at["page"] == 1:
            return {**at, "ended": False}
        body = self.pages.fetch(feed, self.pages.params(at["page"] - 1, at["last"]))
        cursor = None if body is None else cursor_in(body, self.pages.cursor_path)
        return at if cursor is None else {**at, "cursor": cursor, "ended": False}

    def commit(self, end: dict) -> None:
        """The mark a feed's next span begins at stays."""
        for feed, number in end.items():
            self.marks.forget(feed, number - 1)


def paged_source(fetch: Fetch, name: str = "paged") -> type[DataSource]:
    """A data source class for ``spark.dataSource.register`` that fetches with ``fetch(feed, params)``.

    Options: ``strategy`` (none, page, offset, cursor), ``feeds`` (JSON list),
    ``limit``, ``max_pages`` (no cap unless given), ``tasks_per_feed``, ``data_key``,
    ``<x>_param`` names, ``cursor_path``. A stream takes two more: ``marks``, a folder of its own that driver and
    executors share, and ``pages_per_batch`` (of each feed; 0 for all that there are).
    """

    class PagedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return _Reader(fetch, dict(self.options))

        def streamReader(self, schema) -> DataSourceStreamReader:
            return _SpanStream(fetch, dict(self.options))

    return PagedSource
