"""Registration and the helpers the contract queries share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import new_folder
from millrace.sinks.tables import create_database

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The one run time all queries use, so results repeat exactly.
RUN_TIME = datetime(2024, 6, 1, 12, 0, 0)
RUN_TIME_SQL = "TIMESTAMP '2024-06-01 12:00:00'"


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its checking SQL."""

    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh_database(spark: SparkSession) -> str:
    """A database of its own for a query's tables, located in the shared folder."""
    name = f"mr_{uuid.uuid4().hex[:12]}"
    create_database(spark, name, new_folder(spark, name))
    return name


def comma_text(col: Column) -> Column:
    """A number as text with a decimal comma."""
    return F.replace(col.cast("string"), F.lit("."), F.lit(","))


# Orders packed as response pages: 100 consecutive keys per page, 20 pages per feed.
PAGE_ROWS = 100
FEED_PAGES = 20
ORDER_ITEM = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string"


def order_pages(spark: SparkSession, sf_dir: str, keep: Column | None = None) -> DataFrame:
    """``(page_no, feed, page, items_json)``: order keys are unique, so a page holds at most 100.

    ``keep`` may see ``page`` and ``slot`` (place within the page) and leaves orders out
    of their page; the page stays.
    """
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
        F.expr(f"o_orderkey div {PAGE_ROWS}").alias("page_no"),
    ).withColumns(
        {
            "page": F.col("page_no") % FEED_PAGES + 1,
            "slot": F.col("o_orderkey") - F.col("page_no") * PAGE_ROWS,
        }
    )
    item = F.struct("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    if keep is not None:
        item = F.when(keep, item)
    return orders.groupBy("page_no").agg(F.array_sort(F.collect_list(item)).alias("items")).select(
        "page_no",
        F.concat(F.lit("feed-"), F.expr(f"page_no div {FEED_PAGES}")).alias("feed"),
        (F.col("page_no") % FEED_PAGES + 1).alias("page"),
        F.to_json("items").alias("items_json"),
    )


# The same numbering in the checking SQL.
ORDER_PAGES_SQL = """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority,
           o_orderkey // 100 AS page_no, (o_orderkey // 100) % 20 + 1 AS page,
           o_orderkey % 100 AS slot, 'feed-' || CAST(o_orderkey // 2000 AS VARCHAR) AS feed
    FROM orders
"""
