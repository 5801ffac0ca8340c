"""Lists that run over several landed web pages: which pages belong to a list, and the records on them.

A page table ``(feed, url, html)`` holds pages in any order. A list begins at its feed's first page and goes on along
next-page links; a page without records ends it, a page without a link, or whose link leads to no landed page, is its
last one. Where a page stands in its list is found by pointer jumping: in round k every page knows the page 2^k links
on, and what has been reached doubles, so a list of n pages takes about log2(n) rounds of joins on single pages. No
feed is walked or sorted in one task, and only keys and links take part; markup is parsed once.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import settle
from millrace.sources.html import (
    ITEMS,
    ROWS,
    field_records,
    first_string,
    next_link,
    parse,
    selector,
    table_records_of,
    table_titles,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_KEY = ["__feed", "__url"]


def _parts(
    records: tuple[str, pa.DataType], find: Callable, link: Callable, html: Column, url: Column, page: Column
) -> Column:
    """``(records, next_url, headers)`` of a page, from one parse."""
    kind = pa.struct([("records", records[1]), ("next_url", pa.string()), ("headers", pa.list_(pa.string()))])

    @F.arrow_udf(f"struct<records:{records[0]},next_url:string,headers:array<string>>")
    def run(pages: pa.Array, urls: pa.Array, numbers: pa.Array) -> pa.Array:
        out = []
        for text, at, number in zip(pages.to_pylist(), urls.to_pylist(), numbers.to_pylist()):
            root = parse(text or "")
            out.append({"records": find(root), "next_url": link(root, at, number), "headers": table_titles(root)})
        return pa.array(out, kind)

    return run(html, url, page)


def table_parts(
    html: Column, url: Column, page: Column, base_url: str | None = None, label: str = "Nästa", link_label: str = "Anmälan"
) -> Column:
    """Rows of the first table, its titles, and the link to page + 1 in the pagination list or the one named ``label``.

    Links are relative to ``base_url``, or else to the page's own URL.
    """

    def link(root, at, number):
        return None if number is None else next_link(root, number, label, base_url if base_url is not None else at or "")

    return _parts(ROWS, lambda root: table_records_of(root, link_label), link, html, url, page)


def item_parts(
    html: Column, url: Column, item_path: str, fields: dict[str, str], next_path: str | None,
    table_path: str | None = None, base_url: str | None = None,
) -> Column:
    """Declared items, and the link that the selector ``next_path`` finds first."""
    for path in [*fields.values(), *[p for p in (table_path, next_path) if p]]:
        selector(path)
    fields = dict(fields)

    def link(root, at, number):
        found = first_string(root, next_path) if next_path else None
        return urljoin(base_url if base_url is not None else at or "", found) if found else None

    return _parts(ITEMS, lambda root: field_records(root, table_path, item_path, fields), link, html, url, F.lit(None).cast("bigint"))


def ranked(links: DataFrame) -> DataFrame:
    """``(__feed, __url, place)``: pages on their feed's list, the first one at 0.

    ``links (__feed, __url, next_url, filled, first)`` has one row per page. A ring of links is left where it closes.
    """
    jump = settle(
        links.filter(F.col("filled") & F.col("next_url").isNotNull()).select(*_KEY, F.col("next_url").alias("to")), "jump"
    )
    reached = settle(links.filter("first").select(*_KEY, F.lit(0).cast("bigint").alias("place")), "reached")
    step, known = 1, reached.count()
    while True:
        onward = reached.join(jump, _KEY).select("__feed", F.col("to").alias("__url"), (F.col("place") + step).alias("place"))
        # Only landed pages are reached; one that is met again keeps its first place.
        landed = onward.join(links.select(*_KEY), _KEY, "left_semi")
        reached = settle(reached.unionByName(landed).groupBy(*_KEY).agg(F.min("place").alias("place")), "reached")
        found = reached.count()
        if found == known:
            return reached
        known, step = found, 2 * step
        twice = jump.select("__feed", F.col("__url").alias("to"), F.col("to").alias("then"))
        jump = settle(jump.join(twice, ["__feed", "to"]).select(*_KEY, F.col("then").alias("to")), "jump")


def follow(
    pages: DataFrame,
    parts: Column,
    first: Column,
    feed: str | None = "feed",
    url: str = "url",
    html: str = "html",
    sequence: str | None = None,
    max_pages: int | None = None,
) -> DataFrame:
    """Pages on their list, with ``place`` (from 1), ``records``, ``next_url`` and ``headers`` in place of their markup.

    ``parts`` is ``table_parts`` or ``item_parts``; ``first`` tells each feed's first page. Of a URL that landed more
    than once in a feed the row with the greatest ``sequence`` counts (without one, any single row). Without ``feed``
    all pages are one feed; a NULL feed is a feed, too; a page without URL is on no list. ``max_pages`` is a cap for
    those who want one.
    """
    told = pages.withColumns({
        "__p": parts,
        "__feed": F.coalesce(F.col(feed).cast("string"), F.lit("\0")) if feed else F.lit(""), "__url": F.col(url),
        "__first": F.coalesce(first, F.lit(False)), "__row": F.monotonically_increasing_id(),
        "__sequence": F.col(sequence) if sequence else F.lit(0),
    })
    # Written before anything reads it twice: one parse, and row numbers that stay.
    told = settle(told.filter(F.col(url).isNotNull()).drop(html), "parsed")
    one = told.groupBy(*_KEY).agg(
        F.max(F.struct(
            "__sequence", "__row", F.col("__p.next_url").alias("next_url"), (F.size("__p.records") > 0).alias("filled"),
            F.col("__first").alias("first"),
        )).alias("m")
    )
    links = settle(one.select(*_KEY, "m.next_url", "m.filled", "m.first", F.col("m.__row").alias("__row")), "links")
    places = ranked(links).join(links.filter("filled").select(*_KEY, "__row"), _KEY)
    places = places.select("__row", (F.col("place") + 1).alias("place"))
    if max_pages is not None:
        places = places.filter(F.col("place") <= max_pages)
    kept = [c for c in pages.columns if c not in ("place", "records", "next_url", "headers", html)]
    return told.join(settle(places, "places"), "__row").select(*kept, "place", "__p.*")


def read_listed_tables(
    pages: DataFrame, columns: list[str], keep: list[str], first: Column, html: str = "html", url: str = "url",
    page: str = "page", feed: str | None = "feed", base_url: str | None = None, **options,
) -> DataFrame:
    """Table rows of every list: ``keep``, ``place``, ``row_no``, the named titles, ``details_link``."""
    parts = table_parts(F.col(html), F.col(url), F.col(page).cast("bigint"), base_url)
    listed = follow(pages, parts, first, feed, url, html, **options)
    rows = listed.select(*keep, "place", F.inline("records"))
    return rows.select(
        *keep, "place", "row_no", *[F.try_element_at("cells", F.lit(c)).alias(c) for c in columns], "details_link"
    )


def read_listed_items(
    pages: DataFrame, item_path: str, fields: dict[str, str], next_path: str, keep: list[str], first: Column,
    html: str = "html", url: str = "url", feed: str | None = "feed", table_path: str | None = None,
    base_url: str | None = None, **options,
) -> DataFrame:
    """Declared items of every list: ``keep``, ``place``, ``item_no``, one column per field."""
    parts = item_parts(F.col(html), F.col(url), item_path, fields, next_path, table_path, base_url)
    listed = follow(pages, parts, first, feed, url, html, **options)
    rows = listed.select(*keep, "place", F.posexplode("records").alias("item_no", "f"))
    return rows.select(*keep, "place", "item_no", *[F.try_element_at("f", F.lit(n)).alias(n) for n in fields])
