"""Names, conversions, steps, the register transform, checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.base import RUN_TIME, RUN_TIME_SQL, comma_text, fresh_database, load, query
from millrace.functions.coerce import convert_types, fill_missing
from millrace.functions.names import clean_column_names, rename_present
from millrace.operators.checks import (
    key_check,
    null_report,
    schema_drift,
    schema_fingerprint,
    validate,
)
from millrace.operators.register import (
    REGISTER_CRITICAL,
    REGISTER_REQUIRED,
    REGISTER_TYPES,
    search_register,
    transform_register,
)
from millrace.operators.steps import add_constants, apply_steps
from millrace.sinks.tables import write_table
from millrace.sources.tables import list_tables, table_columns


def raw_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices and quantities as people type them: decimal commas, spaces, blanks, junk."""
    price = comma_text(F.col("l_extendedprice"))
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
        F.when(F.col("l_linenumber") == 7, "n/a")
        .when(F.col("l_returnflag") == "R", F.concat(F.lit(" "), price, F.lit(" ")))
        .when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1), F.concat(F.lit("1."), price))
        .otherwise(price)
        .alias("price"),
        F.when(F.col("l_discount") == 0, "  ").otherwise(F.col("l_quantity").cast("string")).alias("quantity"),
        F.when(F.col("l_linenumber") == 3, F.date_format("l_shipdate", "dd/MM/yyyy"))
        .when(F.col("l_linenumber") == 5, "soon")
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("shipped"),
    )


@query(
    "coerce_numbers",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CASE WHEN l_linenumber = 7 OR (l_returnflag = 'A' AND l_linenumber = 1) THEN NULL
                ELSE l_extendedprice END AS price,
           CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity END AS quantity,
           CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_quantity AS VARCHAR) END AS quantity_text
    FROM lineitem
    """,
)
def coerce_numbers(spark, sf_dir):
    raw = raw_lineitem(spark, sf_dir).withColumn("quantity_text", F.col("quantity"))
    typed = convert_types(raw, numbers=["price", "quantity", "no_such_column"])
    return fill_missing(typed).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "price", "quantity", "quantity_text"
    )


@query(
    "coerce_dates",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS ordered
    FROM orders
    """,
)
def coerce_dates(spark, sf_dir):
    text = (
        F.when(F.col("o_orderpriority") == "5-LOW", "not yet")
        .when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd 00:00:00"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    raw = load(spark, sf_dir, "orders").select("o_orderkey", text.alias("ordered"))
    return convert_types(raw, dates=["ordered"], date_formats=["%Y-%m-%d", "%d/%m/%Y", "%Y-%m-%d %H:%M:%S"])


@query(
    "coerce_booleans",
    """
    SELECT event_id, user_id,
           CASE event_type WHEN 'click' THEN 'true' WHEN 'view' THEN 'false' WHEN 'purchase' THEN 'true'
                           ELSE 'none' END AS flag
    FROM events
    """,
)
def coerce_booleans(spark, sf_dir):
    word = (
        F.when(F.col("event_type") == "click", "JA")
        .when(F.col("event_type") == "view", "nej")
        .when(F.col("event_type") == "purchase", "Y")
        .when(F.col("event_type") == "error", " ja")
        .otherwise("x")
    )
    raw = load(spark, sf_dir, "events").select("event_id", "user_id", word.alias("flag"))
    typed = convert_types(raw, booleans=["flag", "user_id"])
    return typed.withColumn("flag", F.coalesce(F.col("flag").cast("string"), F.lit("none")))


@query(
    "rename_clean",
    f"""
    SELECT c_custkey AS cust_key, c_name AS customer, c_nationkey AS nation_key, c_acctbal AS acct_bal,
           c_mktsegment AS market_segment, 'crm' AS source, {RUN_TIME_SQL} AS ingestion_timestamp
    FROM customer
    """,
)
def rename_clean(spark, sf_dir):
    titled = load(spark, sf_dir, "customer").toDF("Cust Key", "Full-Name", "Nation Key", "Acct-Bal", "Market Segment")
    cleaned = clean_column_names(titled)
    return add_constants(rename_present(cleaned, {"full_name": "customer", "absent": "x"}), "crm", RUN_TIME)


@query(
    "step_chain",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity - 1 AS pieces, l_extendedprice AS revenue,
           l_shipdate AS shipped, l_extendedprice / (l_quantity - 1) AS unit_price
    FROM lineitem WHERE l_quantity - 1 > 0
    """,
)
def step_chain(spark, sf_dir):
    # The division comes before the filter that removes its zeros.
    raw = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", (F.col("l_quantity") - 1).alias("quantity"),
        F.col("l_extendedprice").alias("revenue"), "l_shipdate",
    )
    return apply_steps(
        raw,
        [
            {"add_column": {"name": "unit_price", "formula": "revenue / quantity"}},
            {"rename_columns": {"l_shipdate": "shipped", "quantity": "pieces"}},
            {"filter": {"condition": "pieces > 0"}},
        ],
    )


def register_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and their customers as raw register records: Swedish titles, all text."""
    orders, customer = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("Publiceringsdatum"),
        F.col("c_name").alias("Emittent"),
        F.concat(F.lit("Person "), F.col("o_custkey")).alias("Person i ledande ställning"),
        F.col("c_mktsegment").alias("Befattning"),
        F.when(F.col("c_acctbal") < 0, "Ja").otherwise("Nej").alias("Närstående"),
        F.col("o_orderstatus").alias("Karaktär"),
        F.col("o_orderpriority").alias("Instrumentnamn"),
        F.lit("Aktie").alias("Instrumenttyp"),
        F.concat(F.lit("SE"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0")).alias("ISIN"),
        F.when(F.col("o_orderstatus") == "P", "okänt")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("Transaktionsdatum"),
        comma_text(F.col("o_totalprice")).alias("Volym"),
        F.lit("Antal").alias("Volymsenhet"),
        F.when(F.col("o_orderpriority") == "5-LOW", "-").otherwise(comma_text(F.col("c_acctbal"))).alias("Pris"),
        F.lit("SEK").alias("Valuta"),
        F.lit("Aktuell").alias("Status"),
        F.concat(F.lit("/detalj/"), F.col("o_orderkey")).alias("details_link"),
    )


REGISTER_SQL = f"""
    SELECT o_orderdate AS publication_date, c_name AS issuer,
           'Person ' || CAST(o_custkey AS VARCHAR) AS person_in_leading_position,
           c_mktsegment AS position, CASE WHEN c_acctbal < 0 THEN 'Ja' ELSE 'Nej' END AS related_party,
           o_orderstatus AS transaction_type, o_orderpriority AS instrument_name, 'Aktie' AS instrument_type,
           'SE' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS isin,
           CASE WHEN o_orderstatus = 'P' THEN NULL
                ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS transaction_date,
           o_totalprice AS volume, 'Antal' AS volume_unit,
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE c_acctbal END AS price,
           'SEK' AS currency, 'Aktuell' AS status, '/detalj/' || CAST(o_orderkey AS VARCHAR) AS details_link,
           'Swedish FSA' AS source, {RUN_TIME_SQL} AS ingestion_timestamp
    FROM orders JOIN customer ON o_custkey = c_custkey
"""


@query("register_transform", REGISTER_SQL)
def register_transform(spark, sf_dir):
    return transform_register(register_records(spark, sf_dir), RUN_TIME)


@query(
    "register_search",
    f"""
    SELECT isin, issuer, person_in_leading_position, transaction_date, volume FROM ({REGISTER_SQL}) r
    WHERE transaction_date >= TIMESTAMP '1996-01-01' AND transaction_date < TIMESTAMP '1997-01-01'
      AND contains(lower(issuer), 'customer#') AND contains(lower(person_in_leading_position), 'person 1')
    """,
)
def register_search(spark, sf_dir):
    found = search_register(
        transform_register(register_records(spark, sf_dir), RUN_TIME),
        start=datetime(1996, 1, 1), end=datetime(1996, 12, 31), issuer="CUSTOMER#", person="person 1",
    )
    return found.select("isin", "issuer", "person_in_leading_position", "transaction_date", "volume")


@query(
    "null_report",
    """
    WITH t AS (
        SELECT CASE WHEN l_linenumber = 7 OR (l_returnflag = 'A' AND l_linenumber = 1) THEN NULL
                    ELSE l_extendedprice END AS price,
               CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity END AS quantity,
               CASE WHEN l_linenumber = 5 THEN NULL ELSE l_shipdate END AS shipped
        FROM lineitem)
    SELECT 'price' AS column_name, count(*) FILTER (price IS NULL) AS null_count, count(*) AS row_count FROM t
    UNION ALL SELECT 'quantity', count(*) FILTER (quantity IS NULL), count(*) FROM t
    UNION ALL SELECT 'shipped', count(*) FILTER (shipped IS NULL), count(*) FROM t
    """,
)
def null_report_query(spark, sf_dir):
    typed = convert_types(
        raw_lineitem(spark, sf_dir), ["shipped"], ["price", "quantity"], date_formats=["%Y-%m-%d", "%d/%m/%Y"]
    )
    return null_report(typed, ["price", "quantity", "shipped", "no_such_column"])


@query(
    "validation_report",
    """
    WITH t AS (SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS p
               FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT 'required_column' AS "check", c AS column_name, TRUE AS passed, 'error' AS severity,
           CAST(NULL AS VARCHAR) AS detail
    FROM (VALUES ('issuer'), ('transaction_date'), ('volume'), ('price')) v(c)
    UNION ALL SELECT 'has_rows', NULL, n > 0, 'error', CASE WHEN n = 0 THEN 'no rows' END FROM t
    UNION ALL SELECT 'null_values', 'issuer', TRUE, 'warning', NULL
    UNION ALL SELECT 'null_values', 'transaction_date', p = 0, 'warning',
                     CASE WHEN p > 0 THEN CAST(p AS VARCHAR) || ' null values' END FROM t
    UNION ALL SELECT 'column_type', c, TRUE, 'warning', NULL
    FROM (VALUES ('transaction_date'), ('volume'), ('price')) v(c)
    """,
)
def validation_report(spark, sf_dir):
    records = transform_register(register_records(spark, sf_dir), RUN_TIME)
    return validate(records, REGISTER_REQUIRED, REGISTER_CRITICAL, REGISTER_TYPES)


@query(
    "table_profile",
    """
    SELECT 'orders' AS table_name, c AS column_name, p AS position, t AS data_type, n AS null_count, r AS row_count
    FROM (SELECT count(*) AS r, count(*) - count(o_orderkey) AS n1, count(*) - count(o_custkey) AS n2,
                 count(*) - count(o_orderstatus) AS n3, count(*) - count(o_totalprice) AS n4,
                 count(*) - count(o_orderdate) AS n5, count(*) - count(o_orderpriority) AS n6 FROM orders) o,
    LATERAL (VALUES ('o_orderkey', 1, 'bigint', n1), ('o_custkey', 2, 'bigint', n2), ('o_orderstatus', 3, 'string', n3),
                    ('o_totalprice', 4, 'double', n4), ('o_orderdate', 5, 'timestamp_ntz', n5),
                    ('o_orderpriority', 6, 'string', n6)) v(c, p, t, n)
    """,
)
def table_profile(spark, sf_dir):
    """The catalog's column rows of a stored table beside the NULLs counted in each column."""
    database = fresh_database(spark)
    write_table(load(spark, sf_dir, "orders"), f"{database}.orders")
    columns = table_columns(spark, f"{database}.orders").join(
        list_tables(spark, database).select(F.concat(F.lit(f"{database}."), "table_name").alias("table_name")), "table_name"
    )
    found = columns.join(null_report(spark.table(f"{database}.orders")), "column_name")
    return found.select(
        F.substring_index("table_name", ".", -1).alias("table_name"),
        "column_name", "position", "data_type", "null_count", "row_count",
    )


@query(
    "key_check",
    """
    WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS key_count, CAST(0 AS BIGINT) AS null_key_rows,
           count(*) FILTER (n > 1) AS repeated_keys, count(*) FILTER (n > 1) = 0 AS is_key
    FROM k
    """,
)
def key_check_query(spark, sf_dir):
    return key_check(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _payload_columns(events: DataFrame) -> DataFrame:
    """Column rows found in event payloads: members per event type, and their kind."""
    payload = F.to_json(
        F.struct(
            "user_id",
            F.when(F.col("ts") >= "2024-01-15", F.col("value").cast("string")).alias("value_text"),
            F.when(F.col("ts") < "2024-01-15", F.col("value")).alias("value"),
            F.when((F.col("ts") < "2024-01-15") | (F.col("event_type") == "click"), F.col("props")).alias("props"),
        )
    )
    members = events.select("event_type", F.explode(F.from_json(payload, "map<string,variant>")).alias("m", "v"))
    return members.select(
        F.col("event_type").alias("table_name"),
        F.col("m").alias("column_name"),
        F.when(F.col("m").isin("user_id"), "bigint").when(F.col("m") == "value", "double").otherwise("string")
        .alias("data_type"),
        F.lit(True).alias("is_nullable"),
    ).distinct()


_PAYLOAD_SQL = """
    early AS (SELECT DISTINCT event_type FROM events WHERE ts < TIMESTAMP '2024-01-15'),
    late AS (SELECT DISTINCT event_type FROM events WHERE ts >= TIMESTAMP '2024-01-15'),
    old_cols AS (SELECT event_type AS table_name, c AS column_name, t AS data_type FROM early,
                 (VALUES ('user_id', 'bigint'), ('value', 'double'), ('props', 'string')) v(c, t)),
    new_cols AS (SELECT event_type AS table_name, c AS column_name, t AS data_type FROM late,
                 (VALUES ('user_id', 'bigint'), ('value_text', 'string'), ('props', 'string')) v(c, t)
                 WHERE c <> 'props' OR event_type = 'click')
"""


@query(
    "schema_drift",
    f"""
    WITH {_PAYLOAD_SQL}
    SELECT coalesce(o.table_name, n.table_name) AS table_name, coalesce(o.column_name, n.column_name) AS column_name,
           CASE WHEN o.column_name IS NULL THEN 'added' WHEN n.column_name IS NULL THEN 'removed'
                ELSE 'retyped' END AS change,
           o.data_type AS old_type, n.data_type AS new_type
    FROM old_cols o FULL JOIN new_cols n ON o.table_name = n.table_name AND o.column_name = n.column_name
    WHERE o.data_type IS DISTINCT FROM n.data_type
    """,
)
def schema_drift_query(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    return schema_drift(
        _payload_columns(events.filter("ts < '2024-01-15'")), _payload_columns(events.filter("ts >= '2024-01-15'"))
    )


@query(
    "schema_fingerprint",
    f"""
    WITH {_PAYLOAD_SQL}
    SELECT table_name,
           md5('[' || string_agg('{{"name":"' || column_name || '","type":"' || data_type || '","nullable":true}}', ','
                                 ORDER BY column_name) || ']') AS fingerprint
    FROM (SELECT * FROM old_cols UNION SELECT * FROM new_cols) GROUP BY table_name
    """,
)
def schema_fingerprint_query(spark, sf_dir):
    return schema_fingerprint(_payload_columns(load(spark, sf_dir, "events")))
