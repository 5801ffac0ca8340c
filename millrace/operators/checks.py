"""Validation reports and schema comparison.

Every report is a DataFrame, so it can be stored, joined with the run ledger or
shown. Counts are taken in one aggregation over the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECK_SCHEMA = "check string, column_name string, passed boolean, severity string, detail string"
SCHEMA_ROWS = (
    "table_name string, column_name string, position int, data_type string, "
    "character_maximum_length int, is_nullable boolean"
)


def required_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row per required column: present or not."""
    have = set(df.columns)
    rows = [
        ("required_column", c, c in have, "error", None if c in have else "column is missing")
        for c in columns
    ]
    return df.sparkSession.createDataFrame(rows, CHECK_SCHEMA)


def type_report(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """One row per expected column that exists: its type as declared or not."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [
        (
            "column_type", c, actual[c] == want, "warning",
            None if actual[c] == want else f"has type {actual[c]}, expected {want}",
        )
        for c, want in expected.items()
        if c in actual
    ]
    return df.sparkSession.createDataFrame(rows, CHECK_SCHEMA)


def null_counts(columns: Iterable[str]) -> list[Column]:
    """Aggregate columns counting NULLs, for ``agg`` or for ``observe``."""
    return [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{c}") for c in columns]


def null_report(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``(column_name, null_count, row_count)`` for the columns that exist, in one pass."""
    have = set(df.columns)
    columns = [c for c in (df.columns if columns is None else columns) if c in have]
    totals = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"))
            for i, c in enumerate(columns)
        ]
    )
    return totals.select(F.inline(pairs), "row_count")


def validate(
    df: DataFrame,
    required: Iterable[str] = (),
    critical: Iterable[str] = (),
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """All checks as one report: required columns, emptiness, NULLs, types; one pass over the data.

    ``severity`` is ``error`` for the rules that make the data invalid (a missing
    column, no rows) and ``warning`` for the rest.
    """
    present = [c for c in critical if c in df.columns]
    totals = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(present)],
    )

    def finding(check: str, column: str | None, bad: Column, severity: str, detail: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"),
            F.lit(column).cast("string").alias("column_name"),
            (~bad).alias("passed"),
            F.lit(severity).alias("severity"),
            F.when(bad, detail).alias("detail"),
        )

    counted = [finding("has_rows", None, F.col("n") == 0, "error", F.lit("no rows"))]
    for i, c in enumerate(present):
        text = F.concat(F.col(f"n{i}").cast("string"), F.lit(" null values"))
        counted.append(finding("null_values", c, F.col(f"n{i}") > 0, "warning", text))
    return (
        required_columns(df, required)
        .unionByName(totals.select(F.inline(F.array(*counted))))
        .unionByName(type_report(df, types or {}))
    )


def is_valid(report: DataFrame) -> bool:
    """True when no ``error`` rule failed."""
    return report.filter("severity = 'error' and not passed").isEmpty()


def schema_rows(df: DataFrame, table: str) -> DataFrame:
    """The columns of a table as rows, in order."""

    def length(dtype: T.DataType):
        return dtype.length if isinstance(dtype, (T.CharType, T.VarcharType)) else None

    rows = [
        (table, f.name, i, f.dataType.simpleString(), length(f.dataType), f.nullable)
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.createDataFrame(rows, SCHEMA_ROWS)


def schema_fingerprint(schema: DataFrame) -> DataFrame:
    """``(table_name, fingerprint)``: md5 over the name-ordered columns of each table.

    The group is one table's column list, so it is bounded by the table's width.
    """
    column = F.struct(
        F.col("column_name").alias("name"),
        F.col("data_type").alias("type"),
        F.col("is_nullable").alias("nullable"),
    )
    return schema.groupBy("table_name").agg(
        F.md5(F.to_json(F.array_sort(F.collect_list(column)))).alias("fingerprint")
    )


def schema_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns added, removed, retyped or made (non-)nullable between two schema-row tables."""
    keys = ["table_name", "column_name"]
    old = before.select(*keys, F.col("data_type").alias("old_type"), F.col("is_nullable").alias("old_nullable"))
    new = after.select(*keys, F.col("data_type").alias("new_type"), F.col("is_nullable").alias("new_nullable"))
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
        .when(F.col("old_nullable") != F.col("new_nullable"), "nullability")
    )
    return (
        old.join(new, keys, "full_outer")
        .withColumn("change", change)
        .filter("change is not null")
        .select(*keys, "change", "old_type", "new_type")
    )


def key_check(df: DataFrame, keys: list[str]) -> DataFrame:
    """Do ``keys`` identify rows? Counts of rows, keys, NULL keys and repeated keys.

    Rows are counted per key first, with a map-side combine, so a key that holds
    a large share of the rows is one row per task by the time it is shuffled.
    """
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("null_key", any_null)
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count_if(~F.col("null_key")).alias("key_count"),
        F.coalesce(F.sum(F.when(F.col("null_key"), F.col("n"))), F.lit(0)).alias("null_key_rows"),
        F.count_if(~F.col("null_key") & (F.col("n") > 1)).alias("repeated_keys"),
    )
    return counts.withColumn("is_key", (F.col("null_key_rows") == 0) & (F.col("repeated_keys") == 0))


def header_drift(before: DataFrame, after: DataFrame, page: str = "url") -> DataFrame:
    """Pages whose table header changed between two ``(page, headers array)`` tables."""
    old = before.select(F.col(page), F.col("headers").alias("old_headers"))
    new = after.select(F.col(page), F.col("headers").alias("new_headers"))
    empty = F.array().cast("array<string>")
    joined = old.join(new, page, "full_outer").select(
        page,
        F.coalesce("old_headers", empty).alias("old_headers"),
        F.coalesce("new_headers", empty).alias("new_headers"),
    )
    return joined.filter(F.col("old_headers") != F.col("new_headers")).select(
        page,
        F.array_except("new_headers", "old_headers").alias("added"),
        F.array_except("old_headers", "new_headers").alias("removed"),
    )
