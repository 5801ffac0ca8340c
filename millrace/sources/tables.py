"""Tables and SQL: extracts, bounded parallel reads, pass-through queries, catalog facts."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.checks import schema_rows

DEFAULT_FETCH_ROWS = 10_000


def run_sql(
    spark: SparkSession, query: str, params: Mapping[str, Any] | None = None, views: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """SQL text with ``:name`` binds over the session's tables and the given views."""
    if not views:
        return spark.sql(query, args=dict(params or {}))
    # The names hold for this query only: views of the caller's that bear them come back.
    before = {name: spark.table(name) for name in views if any(t.name == name and t.isTemporary for t in spark.catalog.listTables())}
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return spark.sql(query, args=dict(params or {}))
    finally:
        for name in views:
            spark.catalog.dropTempView(name)
            if name in before:
                before[name].createOrReplaceTempView(name)


def extract_table(
    table: DataFrame,
    columns: list[str] | None = None,
    where: str | None = None,
    params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Projection and WHERE text with named binds; both reach the scan of ``table``."""
    if where:
        table = table.sparkSession.sql(f"SELECT * FROM {{t}} WHERE {where}", args=dict(params or {}), t=table)
    return table.select(*columns) if columns else table


def catalog_table(spark: SparkSession, table: str, schema: str | None = None) -> DataFrame:
    return spark.table(f"{schema}.{table}" if schema else table)


_BIND = re.compile(r"('(?:[^']|'')*')|(?<![:\w]):([A-Za-z_]\w*)")


def sql_literal(value: Any) -> str:
    """A value as an SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def with_literals(query: str, params: Mapping[str, Any] | None) -> str:
    """Named binds as literals: a remote query is one text. Quoted texts are left alone."""
    return _BIND.sub(lambda m: m[1] or sql_literal(dict(params or {})[m[2]]), query)


def jdbc_query(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str] | None = None,
    params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """A query run by the remote database, with named binds."""
    query = with_literals(query, params)
    return spark.read.format("jdbc").options(url=url, query=query, **dict(properties or {})).load()


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str | None = None,
    partitions: int | None = None,
    rows_per_read: int = 1_000_000,
    fetch_rows: int = DEFAULT_FETCH_ROWS,
    properties: Mapping[str, str] | None = None,
    find_key: bool = False,
) -> DataFrame:
    """A remote table, read in parallel ranges of a whole-number or date key.

    The key's bounds and the row count come from one small remote aggregate. Ranges of a whole-number key hold about
    equally many rows, however the keys are spread: where to cut is asked of the database by counts of key intervals
    (``balanced_cuts``). Each task reads its own range, in batches of ``fetch_rows``. Ranges are disjoint and cover
    everything (NULL keys go with the first), so nothing is read twice or missed, whatever ties the key has. With
    ``find_key`` the first primary-key column is taken where none is given; without a key the table is one task.
    """
    options = {"fetchsize": str(fetch_rows), **dict(properties or {})}
    if key is None and find_key:
        schema, _, name = table.rpartition(".")
        found = jdbc_primary_key(spark, url, name, schema or None, properties).head(1)
        key = found[0]["column_name"] if found else None
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key is None:
        return reader.load()

    def ask(query: str) -> list:
        return jdbc_query(spark, url, query, properties).collect()  # a row per interval

    low, high, rows = ask(f"SELECT min({key}) AS lo, max({key}) AS hi, count(*) AS n FROM {table}")[0]
    if isinstance(low, Decimal) and low == int(low) and high == int(high):
        low, high = int(low), int(high)
    if not isinstance(low, int):
        return reader.options(**key_ranges(key, low, high, int(rows), rows_per_read, partitions)).load()
    parts = partitions or max(1, -(-int(rows) // rows_per_read))
    cuts = balanced_cuts(ask, table, key, low, high, int(rows), parts)
    return spark.read.jdbc(url, table, predicates=range_predicates(key, cuts), properties=options)


def key_ranges(key: str, low: Any, high: Any, rows: int, rows_per_read: int, partitions: int | None) -> dict[str, str]:
    """JDBC options that split a read into ranges of ``key``; none for an empty table."""
    if low is None:
        return {}
    parts = partitions or max(1, -(-rows // rows_per_read))
    return {"partitionColumn": key, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}


INTERVALS = 1000


def balanced_cuts(
    ask: Callable[[str], list], table: str, key: str, low: int, high: int, rows: int, parts: int, intervals: int = INTERVALS
) -> list[int]:
    """Keys at which to cut a table so that the ``parts`` ranges hold about equally many rows; fewer where keys repeat.

    ``ask`` runs SQL at the database and returns its rows. It counts the rows of ``intervals`` equal key intervals;
    one that holds more than half a range's rows is counted again more finely, down to single keys. So skewed keys cost
    a few counts, and never more rows than intervals come back.
    """
    share = rows / parts
    counted: list[tuple[int, int]] = []  # (first key, rows), by key
    open_spans = [(low, high, rows)]
    while open_spans and parts > 1:
        first, last, held = open_spans.pop()
        width = -(-(last - first + 1) // intervals)
        if held <= share / 2 or first == last:
            counted.append((first, held))
            continue
        found = ask(
            f"SELECT floor(({key} - {first}) / {width}) AS part, count(*) AS n FROM {table} "
            f"WHERE {key} BETWEEN {first} AND {last} GROUP BY floor(({key} - {first}) / {width})"
        )
        for part, n in ((int(r[0]), int(r[1])) for r in found):
            start = min(first + part * width, last)
            if width == 1:
                counted.append((start, n))
            else:
                open_spans.append((start, min(last, start + width - 1), n))
    # Rows without a key go with the first range.
    cuts, seen = [], rows - sum(n for _, n in counted)
    for start, n in sorted(counted):
        # A range ends before the interval that would take it further past its share than it is short of it.
        if seen and seen + n / 2 > share * (len(cuts) + 1) and len(cuts) < parts - 1:
            cuts.append(start)
        seen += n
    return cuts


def range_predicates(key: str, cuts: list[int]) -> list[str]:
    """Disjoint conditions for the ranges between cuts; the first one takes NULL keys, too."""
    if not cuts:
        return ["1 = 1"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *inner, f"{key} >= {cuts[-1]}"]


# The servers' own catalog views. Names come in as SQL literals.
_COLUMNS_SQL = {
    "standard": (
        "SELECT column_name, data_type, character_maximum_length, is_nullable "
        "FROM information_schema.columns WHERE table_name = {table} AND table_schema = {schema}"
    ),
    "oracle": (
        "SELECT column_name, data_type, char_length AS character_maximum_length, nullable AS is_nullable "
        "FROM all_tab_columns WHERE table_name = {table} AND owner = {schema}"
    ),
    "sqlite": (
        "SELECT name AS column_name, type AS data_type, NULL AS character_maximum_length, "
        "NOT \"notnull\" AS is_nullable FROM pragma_table_info({table})"
    ),
}
_TABLES_SQL = {
    "standard": (
        "SELECT table_name FROM information_schema.tables "
        "WHERE table_type = 'BASE TABLE' AND table_schema = {schema}"
    ),
    "oracle": "SELECT table_name FROM all_tables WHERE owner = {schema}",
    "sqlite": "SELECT name AS table_name FROM sqlite_master WHERE type = 'table'",
}
_KEYS_SQL = {
    "standard": (
        "SELECT k.column_name, k.ordinal_position AS key_position FROM information_schema.key_column_usage k "
        "JOIN information_schema.table_constraints c ON k.constraint_name = c.constraint_name "
        "AND k.table_schema = c.table_schema AND k.table_name = c.table_name "
        "WHERE c.constraint_type = 'PRIMARY KEY' AND k.table_name = {table} AND k.table_schema = {schema}"
    ),
    "oracle": (
        "SELECT k.column_name, k.position AS key_position FROM all_cons_columns k "
        "JOIN all_constraints c ON k.constraint_name = c.constraint_name AND k.owner = c.owner "
        "WHERE c.constraint_type = 'P' AND k.table_name = {table} AND k.owner = {schema}"
    ),
    "sqlite": "SELECT name AS column_name, pk AS key_position FROM pragma_table_info({table}) WHERE pk > 0",
}
# The schema a server uses when none is named.
DEFAULT_SCHEMA = {"postgresql": "public", "sqlserver": "dbo", "sqlite": "main"}


def catalog_sql(queries: Mapping[str, str], url: str, table: str | None = None, schema: str | None = None) -> str:
    """The catalog query text for the server a JDBC URL names."""
    server = url.split(":")[1]
    schema = schema or DEFAULT_SCHEMA.get(server)
    if schema is None:
        raise ValueError("name the schema: this server has no default one")

    text = queries.get(server, queries["standard"])
    return text.format(table=sql_literal(table or ""), schema=sql_literal(schema))


def jdbc_tables(spark: SparkSession, url: str, schema: str | None = None, properties=None) -> DataFrame:
    """Base tables of a schema."""
    return jdbc_query(spark, url, catalog_sql(_TABLES_SQL, url, None, schema), properties).toDF("table_name")


def jdbc_columns(spark: SparkSession, url: str, table: str, schema: str | None = None, properties=None) -> DataFrame:
    """Column rows of a remote table, from the server's own catalog."""
    df = jdbc_query(spark, url, catalog_sql(_COLUMNS_SQL, url, table, schema), properties)
    return df.toDF("column_name", "data_type", "character_maximum_length", "is_nullable")


def jdbc_primary_key(spark: SparkSession, url: str, table: str, schema: str | None = None, properties=None) -> DataFrame:
    """``(column_name, key_position)`` of the primary key, in key order."""
    df = jdbc_query(spark, url, catalog_sql(_KEYS_SQL, url, table, schema), properties)
    return df.toDF("column_name", "key_position").sort("key_position")


def list_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """Tables of a catalog schema, views and temporary views left out."""
    names = [
        (t.name,) for t in spark.catalog.listTables(schema) if not t.isTemporary and t.tableType in ("MANAGED", "EXTERNAL")
    ]
    return spark.createDataFrame(names, "table_name string")


def table_columns(spark: SparkSession, table: str) -> DataFrame:
    """Column rows of a catalog table or view."""
    return schema_rows(spark.table(table), table)
