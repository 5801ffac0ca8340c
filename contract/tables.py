"""Table extracts and SQL pass-through: what users write as SQL text with named binds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.base import fresh_database, load, query
from millrace.sources.tables import balanced_cuts, extract_table, range_predicates, run_sql


@query(
    "table_extract",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderstatus = 'F' AND o_totalprice > 1000
    """,
)
def table_extract(spark, sf_dir):
    return extract_table(
        load(spark, sf_dir, "orders"),
        columns=["o_orderkey", "o_custkey", "o_totalprice"],
        where="o_orderdate >= CAST(:since AS timestamp_ntz) AND o_orderstatus = :status AND o_totalprice > :least",
        params={"since": "1996-01-01", "status": "F", "least": 1000},
    )


def _views(spark, sf_dir, *names):
    return {n: load(spark, sf_dir, n) for n in names}


# Money is summed as decimal, so the sum does not depend on the order of rows.
JOIN_AGG = """
    SELECT c_mktsegment AS segment, n_name AS nation, count(*) AS line_count,
           count(DISTINCT o_orderkey) AS order_count,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
         JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderdate >= {since} AND l_returnflag = {flag}
    GROUP BY c_mktsegment, n_name
"""


@query("sql_join_agg", JOIN_AGG.format(since="TIMESTAMP '1995-01-01'", flag="'R'"))
def sql_join_agg(spark, sf_dir):
    sql = JOIN_AGG.format(since="CAST(:since AS timestamp_ntz)", flag=":flag")
    return run_sql(
        spark, sql, {"since": "1995-01-01", "flag": "R"},
        _views(spark, sf_dir, "lineitem", "orders", "customer", "nation"),
    )


SEMI_ANTI = """
    SELECT c_custkey, c_name, c_acctbal FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
      AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
"""


@query("sql_semi_anti", SEMI_ANTI)
def sql_semi_anti(spark, sf_dir):
    return run_sql(spark, SEMI_ANTI, views=_views(spark, sf_dir, "customer", "orders"))


ROLLUP = """
    SELECT l_returnflag, l_linestatus, grouping(l_returnflag) + grouping(l_linestatus) AS level,
           count(*) AS line_count, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
"""


@query(
    "sql_rollup",
    ROLLUP.replace("grouping(l_returnflag) + grouping(l_linestatus)", "CAST(grouping(l_returnflag) + grouping(l_linestatus) AS INTEGER)"),
)
def sql_rollup(spark, sf_dir):
    sql = ROLLUP.replace(
        "grouping(l_returnflag) + grouping(l_linestatus)", "CAST(grouping(l_returnflag) + grouping(l_linestatus) AS INT)"
    )
    return run_sql(spark, sql, views=_views(spark, sf_dir, "lineitem"))


TOPK = """
    SELECT o_custkey, o_orderkey, o_totalprice, place FROM (
        SELECT o_custkey, o_orderkey, o_totalprice,
               CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS place
        FROM orders) t
    WHERE place <= 3
"""


@query("sql_window_topk", TOPK)
def sql_window_topk(spark, sf_dir):
    return run_sql(spark, TOPK, views=_views(spark, sf_dir, "orders"))


SETOPS = """
    (SELECT c_nationkey AS nation, c_mktsegment AS segment FROM customer WHERE c_acctbal < 0
     INTERSECT
     SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 9000)
    UNION
    (SELECT s_nationkey, 'SUPPLIER' FROM supplier
     EXCEPT
     SELECT s_nationkey, 'SUPPLIER' FROM supplier WHERE s_acctbal < 0)
"""


@query("sql_setops", SETOPS)
def sql_setops(spark, sf_dir):
    return run_sql(spark, SETOPS, views=_views(spark, sf_dir, "customer", "supplier"))


# The range predicate rides on an equality, so the join is hashed and not nested.
RANGE_JOIN = """
    SELECT o_orderpriority, count(*) AS lines_in_window, count(DISTINCT o_orderkey) AS orders_in_window
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
         AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL {days} DAYS
    GROUP BY o_orderpriority
"""


@query("sql_range_join", RANGE_JOIN.format(days="400"))
def sql_range_join(spark, sf_dir):
    return run_sql(spark, RANGE_JOIN.format(days="'400'"), views=_views(spark, sf_dir, "orders", "lineitem"))


@query(
    "ranged_extract",
    """
    SELECT l_orderkey, count(*) AS line_count, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN NULL WHEN l_orderkey % 3 = 1 THEN 7 ELSE l_orderkey * l_orderkey END AS l_orderkey,
                 l_extendedprice FROM lineitem)
    GROUP BY l_orderkey
    """,
)
def ranged_extract(spark, sf_dir):
    """A table whose keys are missing, repeated or far apart, read in ranges that hold about equally many rows."""
    key = F.when(F.col("l_orderkey") % 3 == 1, 7).when(F.col("l_orderkey") % 3 == 2, F.col("l_orderkey") * F.col("l_orderkey"))
    stored = f"{fresh_database(spark)}.far"
    load(spark, sf_dir, "lineitem").select(key.alias("l_orderkey"), "l_extendedprice").write.saveAsTable(stored)
    low, high, rows = spark.sql(f"SELECT min(l_orderkey), max(l_orderkey), count(*) FROM {stored}").first()
    cuts = balanced_cuts(lambda text: run_sql(spark, text).collect(), stored, "l_orderkey", low, high, rows, 8)
    ranges = [extract_table(spark.table(stored), None, p) for p in range_predicates("l_orderkey", cuts)]
    read = reduce(DataFrame.unionByName, ranges)
    return read.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("total")
    )
