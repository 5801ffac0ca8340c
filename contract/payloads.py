"""Landed response bodies and paged sources, built from orders."""

from __future__ import annotations

import json
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from contract.base import FEED_PAGES, ORDER_ITEM, ORDER_PAGES_SQL, fresh_database, order_pages, query
from millrace.functions.payload import elements
from millrace.session import new_folder, settle
from millrace.sources.extracts import register_extract
from millrace.sources.paged import paged_source
from millrace.sources.payloads import explode_items, take_pages, with_items
from millrace.sources.tables import run_sql
from millrace.streaming.intake import load_available

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_COLUMNS = "feed, o_orderkey, o_custkey, o_totalprice, o_orderpriority"
_SELECT = f"SELECT {_COLUMNS} FROM ({ORDER_PAGES_SQL}) p"


def _orders(pages):
    return explode_items(pages, ["feed"], ORDER_ITEM).select(*[c.strip() for c in _COLUMNS.split(",")])


def _landed(pages):
    """Bodies as a fetcher leaves them: a stored table of ``(feed, page order, body)``."""
    return with_items(settle(pages, "bodies"))


def body_text(text: str, *columns):
    return F.format_string(text, *columns)


@query("payload_items", f"{_SELECT} WHERE page % 4 <> 3")
def payload_items(spark, sf_dir):
    """Bodies of four shapes: under the key, a bare list, without items, under the key with NULL beside."""
    pages = order_pages(spark, sf_dir)
    shape = F.col("page") % 4
    body = (
        F.when(shape == 1, body_text('{"data": %s, "meta": {"next": "x"}}', "items_json"))
        .when(shape == 2, F.col("items_json"))
        .when(shape == 3, body_text('{"other": %s}', "items_json"))
        .otherwise(body_text('{"next": null, "data": %s}', "items_json"))
    )
    return _orders(with_items(pages.withColumn("body", body)))


@query("payload_custom", _SELECT)
def payload_custom(spark, sf_dir):
    """The caller's own extract function, a column function over the body."""
    pages = order_pages(spark, sf_dir).withColumn("body", body_text('{"payload": {"rows": %s}}', "items_json"))
    return _orders(with_items(pages, extract=lambda body: elements(F.get_json_object(body, "$.payload.rows"))))


# Feeds end at page 15; odd feeds send an empty page 10 before that.
_PAGE_STOP = "page <= 15 AND NOT (page >= 10 AND (page_no // 20) % 2 = 1)"


@query("pages_until_last", f"{_SELECT} WHERE {_PAGE_STOP}")
def pages_until_last(spark, sf_dir):
    pages = order_pages(spark, sf_dir)
    odd = F.expr(f"page_no div {FEED_PAGES}") % 2 == 1
    items = F.when(odd & (F.col("page") == 10), "[]").otherwise(F.col("items_json"))
    kind = F.col("page") % 3
    more = F.when(F.col("page") == 15, "false").otherwise("true")
    link = F.when(F.col("page") == 15, "null").otherwise('"/p"')
    body = (
        F.when(kind == 0, body_text('{"has_more": %s, "data": %s}', more, items))
        .when(kind == 1, body_text('{"meta": {"next": %s}, "has_more": true, "data": %s}', link, items))
        .otherwise(body_text('{"next": %s, "data": %s}', link, items))
    )
    return _orders(take_pages(_landed(pages.select("feed", "page", body.alias("body"))), "page", "feed", "page"))


@query("pages_by_offset", f"{_SELECT} WHERE page < 12 OR (page = 12 AND slot < 60)")
def pages_by_offset(spark, sf_dir):
    """Page 12 of every feed is short; what follows it is not part of the feed."""
    pages = order_pages(spark, sf_dir, keep=(F.col("page") != 12) | (F.col("slot") < 60))
    landed = pages.select(
        "feed", ((F.col("page") - 1) * 100).alias("offset"), body_text('{"data": %s}', "items_json").alias("body")
    )
    return _orders(take_pages(_landed(landed), "offset", "feed", "offset", limit=100))


@query("pages_by_cursor", f"{_SELECT} WHERE page <= 17")
def pages_by_cursor(spark, sf_dir):
    pages = order_pages(spark, sf_dir)
    cursor = F.when(F.col("page") == 17, "").otherwise(F.concat(F.lit("c"), F.col("page")))
    body = body_text('{"page": {"after": "%s"}, "data": %s}', cursor, "items_json")
    landed = pages.select("feed", "page", body.alias("body"))
    return _orders(take_pages(_landed(landed), "cursor", "feed", "page", cursor_path="page.after"))


# For the data source: eight feeds whose pages grow with the data.
_FEEDS = 8
_BLOCK = 10
# Pages of a feed that lie in one file, about 10 MB of bodies.
_FILE_PAGES = 1000


def _served(spark, sf_dir, feeds: int, body):
    """A fetch function over orders landed as page bodies in files of many pages: ``(feed, page number) -> body``, None past the end.

    ``body`` makes the response text from ``items_json``, ``number`` (of the page in its feed) and ``last``.
    A task keeps the pages of the file it last read, so a file that is asked for page by page is opened once.
    """
    folder = new_folder(spark, "bodies")
    pages = order_pages(spark, sf_dir)
    final = pages.agg(F.max("page_no")).first()[0]
    number = F.expr(f"page_no div {feeds} + 1")
    landed = pages.select(
        F.concat(F.lit("feed-"), F.col("page_no") % feeds).alias("feed"), number.alias("number"),
        F.expr(f"(page_no div {feeds} + 1) div {_FILE_PAGES}").alias("block"), "items_json",
        (F.col("page_no") + feeds > final).alias("last"),
    )
    landed = landed.select("feed", "number", "block", body.alias("body"))
    landed.repartition("feed", "block").write.partitionBy("feed", "block").parquet(folder)
    root = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"

    kept: dict = {}

    def block_of(feed: str, block: int) -> dict[int, str]:
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSelector, FileSystem

        fs, path = FileSystem.from_uri(f"{root}/feed={feed}/block={block}")
        found: dict[int, str] = {}
        for file in fs.get_file_info(FileSelector(path, allow_not_found=True)):
            if file.base_name.endswith(".parquet"):
                with fs.open_input_file(file.path) as source:
                    rows = pq.ParquetFile(source).read(["number", "body"], use_threads=False)
                found.update(zip(rows.column("number").to_pylist(), rows.column("body").to_pylist()))
        return found

    def serve(feed: str, number: int) -> str | None:
        place = (feed, number // _FILE_PAGES)
        if place not in kept:
            found = block_of(*place)
            kept.clear()
            kept[place] = found
        return kept[place].get(number)

    return serve


def _feeds(count: int) -> str:
    return json.dumps([f"feed-{i}" for i in range(count)])


def _by_feed(count: int) -> str:
    return f"""
    SELECT 'feed-' || CAST((o_orderkey // 100) % {count} AS VARCHAR) AS feed, o_orderkey, o_custkey, o_totalprice,
           o_orderpriority
    FROM orders
    """


def _cursor_body():
    after = F.when(F.col("last"), "null").otherwise(F.format_string('"at-%d"', F.col("number") + 1))
    return body_text('{"page": {"after": %s}, "data": %s}', after, "items_json")


@query("paged_source", _by_feed(_FEEDS))
def paged_source_query(spark, sf_dir):
    """Pages fetched by a data source: a fetch function over bodies landed in page blocks."""
    serve = _served(spark, sf_dir, _FEEDS, body_text('{"has_more": true, "data": %s}', "items_json"))
    spark.dataSource.register(paged_source(lambda feed, params: serve(feed, params["page"]), "order_pages"))
    pages = spark.read.format("order_pages").options(strategy="page", feeds=_feeds(_FEEDS), tasks_per_feed=_BLOCK).load()
    # Each page is fetched once: what follows reads the landed bodies.
    return _orders(take_pages(with_items(settle(pages, "landed")), "page", "feed", "page"))


@query("paged_source_offset", _by_feed(_FEEDS))
def paged_source_offset(spark, sf_dir):
    """The same feeds asked for by limit and offset, under a service's own parameter names."""
    serve = _served(spark, sf_dir, _FEEDS, body_text('{"data": %s}', "items_json"))
    spark.dataSource.register(
        paged_source(lambda feed, params: serve(feed, params["from"] // params["count"] + 1), "order_offsets")
    )
    pages = spark.read.format("order_offsets").options(
        strategy="offset", feeds=_feeds(_FEEDS), tasks_per_feed=_BLOCK, limit=100, limit_param="count", offset_param="from",
    ).load()
    return _orders(with_items(settle(pages, "landed")))


@query("paged_source_cursor", _by_feed(_FEEDS))
def paged_source_cursor(spark, sf_dir):
    """The same feeds led by cursors: a task per feed."""
    serve = _served(spark, sf_dir, _FEEDS, _cursor_body())
    spark.dataSource.register(
        paged_source(lambda feed, params: serve(feed, int(params.get("after", "at-1")[3:])), "order_cursors")
    )
    pages = spark.read.format("order_cursors").options(
        strategy="cursor", feeds=_feeds(_FEEDS), cursor_param="after", cursor_path="page.after",
    ).load()
    return _orders(take_pages(with_items(settle(pages, "landed")), "cursor", "feed", "page", cursor_path="page.after"))


@query("paged_stream_cursor", _by_feed(2))
def paged_stream_cursor(spark, sf_dir):
    """Two cursor feeds as a stream into a table: a span of three pages, then, after a restart, all the rest."""
    serve = _served(spark, sf_dir, 2, _cursor_body())
    spark.dataSource.register(
        paged_source(lambda feed, params: serve(feed, int(params.get("after", "at-1")[3:])), "order_stream")
    )
    table, marks, checkpoint = f"{fresh_database(spark)}.bodies", new_folder(spark, "marks"), new_folder(spark, "checkpoint")
    for pages in (3, 0):
        stream = spark.readStream.format("order_stream").options(
            strategy="cursor", feeds=_feeds(2), cursor_param="after", cursor_path="page.after", marks=marks, pages_per_batch=pages,
        ).load()
        load_available(stream, table, checkpoint).awaitTermination()
    return _orders(with_items(spark.table(table)))


def _lines(body: str):
    """Order lines of a body that nests them by priority, and leaves the priority to the group."""
    for group in json.loads(body)["groups"]:
        for order, price in group["orders"].items():
            yield {"o_orderkey": order, "o_totalprice": price, "o_orderpriority": group["priority"]}


@query(
    "payload_udtf",
    f"SELECT feed, o_orderkey, o_totalprice, o_orderpriority FROM ({ORDER_PAGES_SQL}) p WHERE o_totalprice > 1000",
)
def payload_udtf(spark, sf_dir):
    """A caller's own Python extract over nested bodies, called from SQL with the columns it is to give."""
    orders = explode_items(with_items(order_pages(spark, sf_dir), extract=lambda _: elements(F.col("items_json"))), ["feed", "page"], ORDER_ITEM)
    grouped = orders.groupBy("feed", "page", "o_orderpriority").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("o_orderkey").cast("string"), "o_totalprice"))).alias("orders")
    )
    bodies = grouped.groupBy("feed", "page").agg(
        F.to_json(F.struct(F.collect_list(F.struct(F.col("o_orderpriority").alias("priority"), "orders")).alias("groups"))).alias("body")
    )
    register_extract(spark, "order_lines", _lines)
    return run_sql(
        spark,
        """
        SELECT p.feed, i.* FROM bodies p,
               LATERAL order_lines(
                   p.body, CAST(NULL AS STRUCT<o_orderkey: BIGINT, o_totalprice: DOUBLE, o_orderpriority: STRING>)) i
        WHERE i.o_totalprice > :least
        """,
        {"least": 1000}, {"bodies": settle(bodies, "bodies")},
    )


@query("payload_custom_end", f"{_SELECT} WHERE page <= 9")
def payload_custom_end(spark, sf_dir):
    """The caller's own extract function says NULL for page 10: the feed ends there."""
    pages = order_pages(spark, sf_dir)
    body = F.when(F.col("page") == 10, F.lit('{"gone": true}')).otherwise(body_text('{"rows": %s}', "items_json"))
    landed = settle(pages.select("feed", "page", body.alias("body")), "bodies")
    items = with_items(landed, extract=lambda b: elements(F.get_json_object(b, "$.rows")))
    return _orders(take_pages(items, "page", "feed", "page"))


@query(
    "pages_long_feed",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
    """,
)
def pages_long_feed(spark, sf_dir):
    """One feed of all pages, numbered from 101 on, through a job: as many pages as the data has, none dropped."""
    from contract.base import RUN_TIME
    from millrace.plans.pipeline import run

    database = fresh_database(spark)
    order_pages(spark, sf_dir).select(
        F.lit("all").alias("feed"), (F.col("page_no") + 101).alias("page"),
        body_text('{"has_more": true, "data": %s}', "items_json").alias("body"),
    ).write.saveAsTable(f"{database}.bodies")
    spec = {
        "job_id": "long", "loader": {"database": database, "table": "stored"},
        "source": {"type": "api", "table": f"{database}.bodies", "pagination_strategy": "page", "item_schema": ORDER_ITEM},
    }
    run(spark, spec, RUN_TIME)
    return spark.table(f"{database}.stored")
