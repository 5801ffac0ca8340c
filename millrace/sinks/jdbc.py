"""Tables in a database reached over JDBC: append, replace, merge."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.merge import merge
from millrace.session import observed, settle

DEFAULT_BATCH_ROWS = 10_000


def column_types(df: DataFrame, text: str = "VARCHAR(4000)") -> str:
    """Column types for a table created from ``df``: whole numbers stay 64 bit, text is ``text``."""

    def sql(dtype: T.DataType) -> str:
        if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
            return "INTEGER"
        if isinstance(dtype, T.LongType):
            return "BIGINT"
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            return "DOUBLE"
        if isinstance(dtype, T.BooleanType):
            return "BOOLEAN"
        if isinstance(dtype, T.DecimalType):
            return dtype.simpleString().upper()
        if isinstance(dtype, T.DateType):
            return "DATE"
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return "TIMESTAMP"
        return text

    return ", ".join(f"`{f.name}` {sql(f.dataType)}" for f in df.schema.fields)


def _writer(df: DataFrame, url: str, table: str, batch_rows: int, properties, declare: bool):
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows), **dict(properties or {})}
    if declare:
        options["createTableColumnTypes"] = column_types(df)
    return df.write.format("jdbc").options(**options)


def load(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    merge_keys: list[str] | None = None,
    on_conflict: str = "update",
    sequence: str | None = None,
    batch_rows: int = DEFAULT_BATCH_ROWS,
    properties: Mapping[str, str] | None = None,
    declare_types: bool = False,
) -> int:
    """Write rows in batches; returns how many were written.

    ``replace`` empties and refills the table and keeps its definition. ``merge``
    reads the table, merges in Spark and refills it; the merged state is settled in
    the shared folder first, since the table cannot be read while it is refilled.
    Neither is one transaction across tasks.
    """
    if mode == "merge":
        spark = df.sparkSession
        target = spark.read.format("jdbc").options(url=url, dbtable=table, **dict(properties or {})).load()
        merged = merge(target, df, merge_keys or [], on_conflict, sequence)
        df, mode = settle(merged, "jdbc-merge"), "replace"
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = _writer(df, url, table, batch_rows, properties, declare_types)
    if mode == "append":
        writer.mode("append").save()
    elif mode == "replace":
        writer.option("truncate", "true").mode("overwrite").save()
    else:
        raise ValueError(f"unknown write mode {mode!r}")
    return observed(seen, "rows") or 0
