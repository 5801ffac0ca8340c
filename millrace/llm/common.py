"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# White space between words, as the queries define it.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its checking SQL, if SQL can express it."""

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


def text_of(docs: DataFrame) -> Column:
    """The text column with null as empty."""
    return F.coalesce(docs["text"], F.lit(""))


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id's decimal text falls into ``part`` of ``parts``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))
