"""Stored tables: every write mode, merges, deletes, the register table, graph elements."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from contract.base import RUN_TIME, RUN_TIME_SQL, fresh_database, load, query
from millrace.operators.graph import dangling_ends, edges, valid_edges, vertex_label, vertices
from millrace.operators.register import transform_register
from millrace.sinks.tables import (
    append,
    create_register_table,
    create_table,
    delete_rows,
    load_register,
    merge_into,
    overwrite_partitions,
    replace,
    table_exists,
    write_table,
)


def _customer_table(spark, sf_dir) -> str:
    table = f"{fresh_database(spark)}.customer"
    write_table(load(spark, sf_dir, "customer"), table)
    return table


def _shown(table):
    """NULL keys as -1, so that the compared integer columns have no NULLs."""
    return table.na.fill(-1, ["c_custkey", "c_nationkey"])


def _order_changes(spark, sf_dir):
    """Every order as a change to its customer: repeated keys, unknown keys, NULL keys, a subset of columns."""
    key = (
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), None)
        .when(F.col("o_orderstatus") == "P", F.col("o_custkey") + 1000000000)
        .otherwise(F.col("o_custkey"))
    )
    return load(spark, sf_dir, "orders").select(
        key.alias("c_custkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"),
        F.col("o_orderkey").alias("change_no"),
    )


_CHANGES = """
    b AS (SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
                      WHEN o_orderstatus = 'P' THEN o_custkey + 1000000000 ELSE o_custkey END AS k,
                 o_totalprice AS bal, o_orderpriority AS seg, o_orderkey AS seq FROM orders)
"""


@query(
    "merge_update",
    f"""
    WITH {_CHANGES},
    d AS (SELECT * FROM b WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq DESC) = 1)
    SELECT coalesce(c_custkey, k) AS c_custkey, c_name, coalesce(c_nationkey, -1) AS c_nationkey,
           CASE WHEN k IS NOT NULL THEN bal ELSE c_acctbal END AS c_acctbal,
           CASE WHEN k IS NOT NULL THEN seg ELSE c_mktsegment END AS c_mktsegment
    FROM customer FULL JOIN d ON c_custkey = k
    UNION ALL SELECT -1, NULL, -1, bal, seg FROM b WHERE k IS NULL
    """,
)
def merge_update_query(spark, sf_dir):
    table = _customer_table(spark, sf_dir)
    merge_into(_order_changes(spark, sf_dir), table, ["c_custkey"], sequence="change_no")
    return _shown(spark.table(table))


@query(
    "merge_partitions",
    f"""
    WITH {_CHANGES},
    d AS (SELECT * FROM b WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq DESC) = 1)
    SELECT coalesce(c_custkey, k) AS c_custkey, c_name, coalesce(c_nationkey, -1) AS c_nationkey,
           CASE WHEN k IS NOT NULL THEN bal ELSE c_acctbal END AS c_acctbal,
           CASE WHEN k IS NOT NULL THEN seg ELSE c_mktsegment END AS c_mktsegment
    FROM customer FULL JOIN d ON c_custkey = k
    UNION ALL SELECT -1, NULL, -1, bal, seg FROM b WHERE k IS NULL
    """,
)
def merge_partitions(spark, sf_dir):
    """The same merge into a table partitioned by the segment, which the merge changes."""
    table = f"{fresh_database(spark)}.customer"
    write_table(load(spark, sf_dir, "customer"), table, partition_by=["c_mktsegment"])
    merge_into(_order_changes(spark, sf_dir), table, ["c_custkey"], sequence="change_no")
    return _shown(spark.table(table))


@query(
    "merge_nothing",
    f"""
    WITH {_CHANGES},
    d AS (SELECT * FROM b WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq) = 1)
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    UNION ALL SELECT k, NULL, -1, bal, seg FROM d WHERE k NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT -1, NULL, -1, bal, seg FROM b WHERE k IS NULL
    """,
)
def merge_nothing_query(spark, sf_dir):
    table = _customer_table(spark, sf_dir)
    merge_into(_order_changes(spark, sf_dir), table, ["c_custkey"], "ignore", "change_no")
    return _shown(spark.table(table))


def _orders(spark, sf_dir, status: str | None = None):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    return orders.filter(F.col("o_orderstatus") == status) if status else orders


_ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus FROM orders"


@query(
    "append_table",
    f"""
    {_ORDERS_SQL} WHERE o_orderstatus IN ('O', 'F')
    UNION ALL SELECT o_orderkey, -1, NULL, NULL, o_orderstatus FROM orders WHERE o_orderstatus = 'P'
    """,
)
def append_table(spark, sf_dir):
    """Three appends; the last lacks columns, which become NULL."""
    table = f"{fresh_database(spark)}.orders"
    write_table(_orders(spark, sf_dir, "O"), table)
    append(_orders(spark, sf_dir, "F"), table)
    append(_orders(spark, sf_dir, "P").select("o_orderstatus", "o_orderkey"), table)
    return spark.table(table).na.fill(-1, ["o_custkey"])


@query(
    "replace_table",
    "SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice, o_orderdate, o_orderstatus FROM orders "
    "WHERE o_orderstatus = 'F'",
)
def replace_table(spark, sf_dir):
    """The new state is computed from the table it replaces."""
    table = f"{fresh_database(spark)}.orders"
    write_table(_orders(spark, sf_dir), table)
    current = spark.table(table).filter("o_orderstatus = 'F'")
    replace(current.withColumn("o_totalprice", F.col("o_totalprice") * 2), table)
    return spark.table(table)


@query(
    "write_modes",
    f"SELECT *, CAST(0 AS BIGINT) AS second_ignore, TRUE AS refused FROM ({_ORDERS_SQL}) o",
)
def write_modes(spark, sf_dir):
    """``ignore`` writes once and then not again, ``error`` refuses an existing table."""
    table = f"{fresh_database(spark)}.orders"
    write_table(_orders(spark, sf_dir), table, "ignore")
    second = write_table(_orders(spark, sf_dir), table, "ignore")
    refused = False
    try:
        write_table(_orders(spark, sf_dir), table, "error")
    except ValueError:
        refused = True
    return spark.table(table).withColumns(
        {"second_ignore": F.lit(second).cast("bigint"), "refused": F.lit(refused)}
    )


@query(
    "overwrite_partition",
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderstatus
    FROM orders
    """,
)
def overwrite_partition(spark, sf_dir):
    table = f"{fresh_database(spark)}.orders"
    write_table(_orders(spark, sf_dir), table, "append", ["o_orderstatus"])
    changed = _orders(spark, sf_dir, "F").withColumn("o_totalprice", -F.col("o_totalprice"))
    overwrite_partitions(changed, table)
    return spark.table(table)


@query(
    "create_table",
    """
    SELECT v.made_from, v.created, v.again, count(*) AS row_count, v.n_columns
    FROM events, (VALUES ('data', TRUE, FALSE, 5), ('default', TRUE, FALSE, 3), ('struct', TRUE, FALSE, 2),
                         ('text', TRUE, FALSE, 3)) v(made_from, created, again, n_columns)
    GROUP BY ALL
    """,
)
def create_table_query(spark, sf_dir):
    """Tables made from data, a struct, a column text, or nothing; each then takes in all events."""
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    database = fresh_database(spark)
    struct = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    plans = {
        "data": (events, events),
        "struct": (struct, events.select("event_id", "value")),
        "text": ("event_id BIGINT, event_type STRING, later DOUBLE", events.select("event_type", "event_id")),
        "default": (None, events.select(F.col("event_type").alias("source"), F.col("ts").alias("data_timestamp"))),
    }
    out = []
    for name, (schema, rows) in plans.items():
        table = f"{database}.{name}_table"
        created = create_table(spark, table, schema) and table_exists(spark, table)
        again = create_table(spark, table, schema)
        append(rows, table)
        stored = spark.table(table)
        out.append(
            stored.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("made_from"), F.lit(created).alias("created"), F.lit(again).alias("again"),
                "row_count", F.lit(len(stored.columns)).alias("n_columns"),
            )
        )
    first, *rest = out
    for df in rest:
        first = first.unionByName(df)
    return first


@query(
    "delete_where",
    f"""
    SELECT o.*, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O' AND o_totalprice < 200000) AS deleted
    FROM ({_ORDERS_SQL}) o WHERE NOT (o_orderstatus = 'O' AND o_totalprice < 200000)
    """,
)
def delete_where(spark, sf_dir):
    table = f"{fresh_database(spark)}.orders"
    write_table(_orders(spark, sf_dir), table)
    gone = delete_rows(
        spark, table, "o_orderstatus = :status AND o_totalprice < :least", {"status": "O", "least": 200000}
    )
    return spark.table(table).withColumn("deleted", F.lit(gone).cast("bigint"))


@query(
    "delete_from_partitions",
    f"{_ORDERS_SQL} WHERE NOT (o_orderstatus = 'O' OR o_totalprice < 200000)",
)
def delete_from_partitions(spark, sf_dir):
    table = f"{fresh_database(spark)}.orders"
    write_table(_orders(spark, sf_dir), table, partition_by=["o_orderstatus"])
    delete_rows(spark, table, "o_orderstatus = 'O' OR o_totalprice < 200000")
    return spark.table(table)


@query(
    "register_table",
    f"""
    SELECT CAST(NULL AS TIMESTAMP) AS publication_date, 'user ' || CAST(user_id AS VARCHAR) AS issuer,
           CAST(NULL AS VARCHAR) AS person_in_leading_position, event_type AS transaction_type,
           date_trunc('second', ts) AS transaction_date, value AS volume, value AS price,
           'Swedish FSA' AS source, {RUN_TIME_SQL} AS ingestion_timestamp, CAST(CAST(ts AS DATE) AS VARCHAR) AS transaction_day
    FROM events
    """,
)
def register_table(spark, sf_dir):
    """The fixed business table, partitioned by day; a column it lacks is left out."""
    table = f"{fresh_database(spark)}.insider_trading"
    create_register_table(spark, table)
    raw = load(spark, sf_dir, "events").select(
        F.concat(F.lit("user "), F.col("user_id")).alias("Emittent"),
        F.col("event_type").alias("Karaktär"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Transaktionsdatum"),
        F.replace(F.col("value").cast("string"), F.lit("."), F.lit(",")).alias("Volym"),
        F.col("value").cast("string").alias("Pris"),
        F.lit("see page").alias("Detaljer"),
    )
    load_register(transform_register(raw, RUN_TIME), table)
    return spark.table(table).select(
        "publication_date", "issuer", "person_in_leading_position", "transaction_type", "transaction_date", "volume",
        "price", "source", "ingestion_timestamp", F.col("transaction_date_day").cast("string").alias("transaction_day"),
    )


@query(
    "table_formats",
    f"""
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
    FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def table_formats(spark, sf_dir):
    """Another file format by name: appended, merged, deleted from."""
    table = f"{fresh_database(spark)}.orders"
    recent = _orders(spark, sf_dir)
    write_table(recent, table, "append", ["o_orderstatus"], "orc")
    zeroed = _orders(spark, sf_dir, "F").withColumn("o_totalprice", F.lit(0.0))
    write_table(zeroed, table, "merge", fmt="orc", merge_keys=["o_orderkey"])
    delete_rows(spark, table, "o_orderstatus = 'P'")
    return spark.table(table).withColumn("day", F.col("o_orderdate").cast("date").cast("string"))


# --- graph elements -------------------------------------------------------------------------


def _lines(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"
    )


@query(
    "graph_vertices",
    """
    SELECT CAST(l_orderkey AS VARCHAR) || '!' || CAST(l_linenumber AS VARCHAR) AS id, 'sales_line' AS label,
           l_partkey, l_suppkey, l_quantity, l_returnflag
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_returnflag DESC) = 1
    """,
)
def graph_vertices(spark, sf_dir):
    return vertices(_lines(spark, sf_dir), vertex_label("sales", "line"), ["l_orderkey", "l_linenumber"], ["l_partkey"])


@query(
    "graph_auto_ids",
    """
    SELECT DISTINCT sha256('{"user_id":' || CAST(user_id AS VARCHAR) || ',"event_type":"' || event_type || '"}') AS id,
           'web_visitor' AS label, user_id, event_type
    FROM events
    """,
)
def graph_auto_ids(spark, sf_dir):
    return vertices(load(spark, sf_dir, "events").select("user_id", "event_type"), "web_visitor")


@query(
    "graph_edges",
    """
    SELECT CAST(l_suppkey AS VARCHAR) AS src, CAST(l_partkey AS VARCHAR) AS dst, 'supplies' AS label,
           l_orderkey, l_linenumber, l_quantity, l_returnflag
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey
                               ORDER BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC, l_returnflag DESC) = 1
    """,
)
def graph_edges(spark, sf_dir):
    return edges(_lines(spark, sf_dir), "supplies", "l_suppkey", "l_partkey", order=["l_orderkey"])


@query(
    "graph_multi_edges",
    """
    SELECT CAST(l_suppkey AS VARCHAR) AS src, CAST(l_partkey AS VARCHAR) AS dst, 'supplies' AS label, l_returnflag,
           max(l_quantity) AS l_quantity
    FROM lineitem GROUP BY l_suppkey, l_partkey, l_returnflag
    """,
)
def graph_multi_edges(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_returnflag", "l_quantity")
    return edges(rows, "supplies", "l_suppkey", "l_partkey", "MULTIPLE", ["l_returnflag"], ["l_quantity"])


def _supply(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber")
    made = edges(lines, "supplies", "l_suppkey", "l_partkey", "MULTIPLE")
    suppliers = vertices(load(spark, sf_dir, "supplier").filter("s_acctbal >= 0"), "supplier", ["s_suppkey"])
    parts = vertices(load(spark, sf_dir, "part").filter("p_size <= 40"), "part", ["p_partkey"])
    return made, suppliers, parts


@query(
    "graph_dangling",
    """
    SELECT 'source' AS "end", CAST(l_suppkey AS VARCHAR) AS id, count(*) AS n_edges FROM lineitem
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) GROUP BY l_suppkey
    UNION ALL
    SELECT 'target', CAST(l_partkey AS VARCHAR), count(*) FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40) GROUP BY l_partkey
    """,
)
def graph_dangling(spark, sf_dir):
    return dangling_ends(*_supply(spark, sf_dir))


@query(
    "graph_valid_edges",
    """
    SELECT CAST(l_suppkey AS VARCHAR) AS src, CAST(l_partkey AS VARCHAR) AS dst, 'supplies' AS label,
           l_orderkey, l_linenumber
    FROM lineitem
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
      AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 40)
    """,
)
def graph_valid_edges(spark, sf_dir):
    return valid_edges(*_supply(spark, sf_dir))


@query(
    "merge_null_partition",
    """
    SELECT o_orderkey, o_custkey % 210 AS bucket, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS prio,
           CASE WHEN o_orderkey % 3 = 0 THEN -1.0 ELSE o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def merge_null_partition(spark, sf_dir):
    """Two partition columns with some 1,050 partitions, NULL among their values; the batch touches most of them."""
    table = f"{fresh_database(spark)}.orders"
    rows = load(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 210).alias("bucket"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("prio"), "o_totalprice",
    )
    write_table(rows, table, partition_by=["bucket", "prio"])
    batch = rows.filter("o_orderkey % 3 = 0").withColumn("o_totalprice", F.lit(-1.0))
    merge_into(batch, table, ["o_orderkey"])
    return spark.table(table).select("o_orderkey", "bucket", "prio", "o_totalprice")


@query(
    "replace_partitioned",
    """
    SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
    """,
)
def replace_partitioned(spark, sf_dir):
    """A partitioned table is replaced from its own rows, twice."""
    table = f"{fresh_database(spark)}.orders"
    rows = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    write_table(rows, table, partition_by=["o_orderpriority"])
    replace(spark.table(table).filter("o_orderstatus = 'F'"), table)
    replace(spark.table(table).withColumn("o_totalprice", F.col("o_totalprice") * 2), table)
    return spark.table(table).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query(
    "merge_days",
    """
    SELECT event_id, CASE WHEN event_type = 'click' THEN ts + INTERVAL 40 DAY ELSE ts END AS ts,
           strftime(CASE WHEN event_type = 'click' THEN ts + INTERVAL 40 DAY ELSE ts END, '%Y-%m-%d') AS ts_day
    FROM events
    """,
)
def merge_days(spark, sf_dir):
    """Events by day; a merge moves some to other days, and the derived day moves along."""
    table = f"{fresh_database(spark)}.events"
    events = load(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type")
    write_table(events.select("event_id", "ts"), table, partition_by=["days(ts)"])
    moved = events.filter("event_type = 'click'").select("event_id", F.expr("ts + INTERVAL 40 DAYS").alias("ts"))
    merge_into(moved, table, ["event_id"])
    return spark.table(table).select("event_id", "ts", F.col("ts_day").cast("string").alias("ts_day"))
