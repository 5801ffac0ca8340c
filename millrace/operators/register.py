"""The insider-trading register: raw Swedish columns to the stored business table."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.coerce import DATE_FORMATS, convert_types
from millrace.functions.names import rename_present
from millrace.operators.steps import add_constants

# Register column titles and the names they are stored under.
REGISTER_NAMES = {
    "Publiceringsdatum": "publication_date",
    "Emittent": "issuer",
    "Person i ledande ställning": "person_in_leading_position",
    "Befattning": "position",
    "Närstående": "related_party",
    "Karaktär": "transaction_type",
    "Instrumentnamn": "instrument_name",
    "Instrumenttyp": "instrument_type",
    "ISIN": "isin",
    "Transaktionsdatum": "transaction_date",
    "Volym": "volume",
    "Volymsenhet": "volume_unit",
    "Pris": "price",
    "Valuta": "currency",
    "Status": "status",
    "Detaljer": "details",
    "details_link": "details_link",
}
REGISTER_SOURCE = "Swedish FSA"
REGISTER_REQUIRED = ("issuer", "transaction_date", "volume", "price")
REGISTER_CRITICAL = ("issuer", "transaction_date")
REGISTER_TYPES = {"transaction_date": "timestamp_ntz", "volume": "double", "price": "double"}

# The stored table, one column per line.
REGISTER_TABLE_DDL = """
    publication_date TIMESTAMP_NTZ,
    issuer STRING,
    person_in_leading_position STRING,
    position STRING,
    related_party STRING,
    transaction_type STRING,
    instrument_name STRING,
    instrument_type STRING,
    isin STRING,
    transaction_date TIMESTAMP_NTZ,
    volume DOUBLE,
    volume_unit STRING,
    price DOUBLE,
    currency STRING,
    status STRING,
    details_link STRING,
    source STRING,
    ingestion_timestamp TIMESTAMP_NTZ
"""


def transform_register(df: DataFrame, run_time: datetime, date_formats=DATE_FORMATS) -> DataFrame:
    """Rename, convert, add constants: one projection over the raw records.

    The unit of volume stays text: it is a unit name, not a number.
    """
    renamed = rename_present(df, REGISTER_NAMES)
    typed = convert_types(
        renamed,
        dates=("publication_date", "transaction_date"),
        numbers=("volume", "price"),
        date_formats=date_formats,
    )
    return add_constants(typed, REGISTER_SOURCE, run_time)


def default_window(run_time: datetime, days: int = 7) -> tuple[date, date]:
    """The search window of a run without dates: the week before it."""
    return (run_time - timedelta(days=days)).date(), run_time.date()


def search_register(
    df: DataFrame,
    start: date | datetime | None = None,
    end: date | datetime | None = None,
    issuer: str | None = None,
    person: str | None = None,
    date_col: str = "transaction_date",
    issuer_col: str = "issuer",
    person_col: str = "person_in_leading_position",
) -> DataFrame:
    """Optional filters over register records: days inclusive, names by containment.

    The upper bound is written as ``< next day``, so both bounds stay plain
    comparisons on the column and reach the scan.
    """

    def day(value):
        return value.date() if isinstance(value, datetime) else value

    # A table stored by day has the day as partition column: the same bounds there leave out folders.
    partition = f"{date_col}_day"
    if partition in df.columns:
        if start is not None:
            df = df.filter(F.col(partition) >= F.lit(day(start)))
        if end is not None:
            df = df.filter(F.col(partition) <= F.lit(day(end)))
    if start is not None:
        df = df.filter(F.col(date_col) >= F.lit(day(start)).cast("timestamp_ntz"))
    if end is not None:
        df = df.filter(F.col(date_col) < F.lit(day(end) + timedelta(days=1)).cast("timestamp_ntz"))
    if issuer:
        df = df.filter(F.contains(F.lower(issuer_col), F.lit(issuer.lower())))
    if person:
        df = df.filter(F.contains(F.lower(person_col), F.lit(person.lower())))
    return df
