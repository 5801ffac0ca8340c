"""Landed API responses: items of a body and the page at which a feed ends.

Input is a table of response bodies with a feed id and a page order (page number,
offset or fetch sequence). Where a feed ends is an aggregate — the first page that
stops it — computed with a map-side combine, then joined back. There is no window
over a feed, so a feed that holds a third of all pages is not sorted in one task;
the join's large side is split by AQE when a feed is hot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.payload import has_next, members, next_cursor, payload_items
from millrace.session import sized

DEFAULT_LIMIT = 100
_STOP = "__last_kept"


def with_items(
    pages: DataFrame,
    body: str = "body",
    data_key: str = "data",
    extract: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add ``items`` (array of JSON texts) from the body, by key or by the caller's column function."""
    items = extract(F.col(body)) if extract else payload_items(F.col(body), data_key)
    # A function that finds nothing may say NULL: such a page has no items, and ends its feed as one.
    return pages.withColumn("items", F.coalesce(items, F.array().cast("array<string>")))


def _last_kept(facts: DataFrame, feed: list[str], order: str, stops: Column, cap: Column | None) -> DataFrame:
    """The last page of each feed that is kept: the first that ends it, or the last under the cap.

    The test sits in the aggregate and not in a filter: a filter would be pushed below
    the columns it uses, and each body be parsed again for every mention.
    """
    stop = F.min(F.when(stops, F.col(order)))
    last = stop if cap is None else F.least(stop, cap)
    return facts.groupBy(*feed).agg(last.alias(_STOP)).filter(F.col(_STOP).isNotNull())


def take_pages(
    pages: DataFrame,
    strategy: str,
    feed: str | list[str],
    order: str,
    body: str = "body",
    limit: int = DEFAULT_LIMIT,
    cursor_path: str = "meta.next_cursor",
    max_pages: int | None = None,
) -> DataFrame:
    """Keep each feed's pages up to the one that ends it. ``pages`` carries ``items``.

    ``page``: the first page without items, or without a next page.
    ``offset``: the first page with fewer than ``limit`` items.
    ``cursor``: the first page without items, or without a next cursor.
    ``none``: all pages.

    An ending page without items contributes nothing, so it may stay. There is no cap
    unless the caller gives one: ``max_pages`` pages from each feed's own first page on,
    whatever numbers its pages carry.
    """
    feed = [feed] if isinstance(feed, str) else list(feed)
    if not feed:
        raise ValueError("pages need a feed column")
    if strategy not in ("none", "page", "offset", "cursor"):
        raise ValueError(f"unknown paging strategy {strategy!r}")
    if strategy == "none":
        return pages
    cap = None
    if max_pages is not None:
        cap = F.min(order) + (max_pages - 1) * (limit if strategy == "offset" else 1)
    facts = pages.select(*feed, order, F.size("items").alias("n"), F.col(body).alias("text"))
    if strategy == "page":
        facts = facts.withColumn("top", members(F.col("text")))
        facts = facts.withColumn("meta", members(F.try_element_at("top", F.lit("meta"))))
        stops = (F.col("n") == 0) | ~has_next(F.col("top"), F.col("meta"), F.col("n"))
    elif strategy == "offset":
        stops = F.col("n") < limit
    else:
        stops = (F.col("n") == 0) | next_cursor(F.col("text"), cursor_path).isNull()
    # One row per feed; its true size decides the join, so bodies need not be shuffled.
    last = sized(_last_kept(facts, feed, order, stops, cap), "last-pages")
    kept = pages.join(last, feed, "left")
    return kept.filter(F.col(_STOP).isNull() | (F.col(order) <= F.col(_STOP))).select(*pages.columns)


def explode_items(pages: DataFrame, keep: list[str], schema: str) -> DataFrame:
    """One row per item, parsed with an explicit schema; ``item_no`` counts within the page from 0."""
    return (
        pages.select(*keep, F.posexplode("items").alias("item_no", "item"))
        .withColumn("item", F.from_json("item", schema))
        .select(*keep, "item_no", "item.*")
    )
