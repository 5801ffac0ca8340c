"""Tolerant conversions of text columns: numbers, dates, booleans, blanks.

Everything here is a native column expression, so it stays inside whole-stage
code generation. A value that cannot be read becomes NULL; nothing raises under
ANSI mode.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words read as booleans, without regard to case.
TRUE_WORDS = ("yes", "true", "y", "1", "ja")
FALSE_WORDS = ("no", "false", "n", "0", "nej")

# Cell texts that mean "missing" in delimited text.
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# What counts as a number, with a comma or a dot as decimal mark.
NUMBER_PATTERN = r"^\s*[+-]?(?:(?:\d+[.,]?\d*|[.,]\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))\s*$"

# Date patterns tried in this order when the caller names none.
DATE_FORMATS = (
    "%Y-%m-%d",
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%dT%H:%M:%S",
    "%Y-%m-%d %H:%M:%S.%f",
    "%Y-%m-%dT%H:%M:%S.%f",
)

# Strptime directives and the Spark pattern letters they mean.
_DIRECTIVES = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%I": "hh",
    "%M": "mm", "%S": "ss", "%f": "[SSSSSS][SSSSS][SSSS][SSS][SS][S]", "%p": "a",
    "%b": "MMM", "%B": "MMMM", "%a": "EEE", "%A": "EEEE", "%j": "DDD",
    "%z": "xx", "%%": "%",
}


# Digit directives and how many digits they take.
_WIDTHS = {"%Y": 4, "%m": 2, "%d": 2, "%H": 2, "%M": 2, "%S": 2, "%f": 6}


def spark_pattern(fmt: str) -> str:
    """Translate a strptime format; a text without ``%`` is already a Spark pattern."""
    if "%" not in fmt:
        return fmt
    out, literal, i = [], "", 0

    def flush() -> None:
        nonlocal literal
        if literal:
            quoted = literal.replace("'", "''")
            out.append(f"'{quoted}'" if any(ch.isalpha() or ch in "'[]{}#" for ch in literal) else literal)
            literal = ""

    while i < len(fmt):
        token = fmt[i : i + 2]
        if token in _DIRECTIVES:
            if token == "%%":
                literal += "%"
            else:
                flush()
                out.append(_DIRECTIVES[token])
            i += 2
        elif fmt[i] == "%":
            raise ValueError(f"date directive {token!r} is not supported")
        else:
            literal += fmt[i]
            i += 1
    flush()
    return "".join(out)


def _digits_only(fmt: str) -> tuple[str, list[tuple[str, int]]] | None:
    """For a format of digit fields: the pattern of its texts, and where each field starts.

    None for formats with names, halves of the day, zones or short years.
    """
    shape, places, at, i = "", [], 1, 0
    while i < len(fmt):
        field = fmt[i : i + 2]
        if field in _WIDTHS and "%f" not in [f for f, _ in places]:
            places.append((field, at))
            shape += r"\d{1,6}" if field == "%f" else rf"\d{{{_WIDTHS[field]}}}"
            at += _WIDTHS[field]
            i += 2
        elif fmt[i] == "%" or "%f" in [f for f, _ in places]:
            return None
        else:
            shape += re.escape(fmt[i])
            at += 1
            i += 1
    names = [f for f, _ in places]
    whole = {"%Y", "%m", "%d"} <= set(names) and len(names) == len(set(names))
    return (f"^{shape}$", places) if whole else None


def _by_place(col: Column, shape: str, places: list[tuple[str, int]]) -> Column:
    """Put the digit fields in ISO order and cast: no formatter, and no exception on a misfit."""
    at = dict(places)

    def field(name: str) -> Column:
        return F.substring(col, at[name], _WIDTHS[name]) if name in at else F.lit("00")

    if [f for f, _ in places] == ["%Y", "%m", "%d"] and at["%m"] == 6 and at["%d"] == 9 and r"\-" in shape:
        iso = col
    else:
        parts = [field("%Y"), F.lit("-"), field("%m"), F.lit("-"), field("%d")]
        if {"%H", "%M", "%S", "%f"} & set(at):
            parts += [F.lit(" "), field("%H"), F.lit(":"), field("%M"), F.lit(":"), field("%S")]
        if "%f" in at:
            parts += [F.lit("."), field("%f")]
        iso = F.concat(*parts)
    return F.when(col.rlike(shape), iso.try_cast("timestamp_ntz"))


def to_timestamp(col: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text to a zone-less timestamp: the first format that fits wins, else NULL."""

    def tried(fmt: str) -> Column:
        digits = _digits_only(fmt)
        if digits:
            return _by_place(col, *digits)
        return F.try_to_timestamp(col, F.lit(spark_pattern(fmt))).cast("timestamp_ntz")

    columns = [tried(f) for f in formats]
    return columns[0] if len(columns) == 1 else F.coalesce(*columns)


def to_number(col: Column) -> Column:
    """Text to double with ``,`` as a decimal mark; anything else is NULL.

    The pattern guards the cast, which by itself also reads ``1d`` and ``NaN``.
    """
    return F.when(col.rlike(NUMBER_PATTERN), F.replace(col, F.lit(","), F.lit(".")).try_cast("double"))


def to_boolean(col: Column) -> Column:
    """Yes/no words to boolean. Not trimmed: `` ja`` is not a known word."""
    word = F.lower(col)
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def ntz(value: datetime) -> Column:
    """A zone-less timestamp literal, independent of any machine's zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_ntz(instant: Column) -> Column:
    """An instant as the zone-less timestamp it shows in UTC, whatever the session's zone."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def blank_to_null(col: Column) -> Column:
    return F.when(F.trim(col) != "", col)


def null_words_to_null(col: Column, words: Iterable[str] = NULL_WORDS) -> Column:
    return F.when(~col.isin(*words), col)


def _is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def _date_of(df: DataFrame, name: str, formats: Sequence[str]) -> Column:
    dtype, col = df.schema[name].dataType, F.col(f"`{name}`")
    if _is_text(dtype):
        return to_timestamp(col, formats)
    if isinstance(dtype, T.IntegralType):  # nanoseconds since the epoch
        return F.timestamp_micros(F.floor(col / 1000).cast("bigint")).cast("timestamp_ntz")
    return col.cast("timestamp_ntz")


def convert_types(
    df: DataFrame,
    dates: Iterable[str] = (),
    numbers: Iterable[str] = (),
    booleans: Iterable[str] = (),
    date_formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Convert the named columns in one projection; names that are absent are skipped.

    Numeric and boolean conversion touches text columns only, so a column that
    already has a number type keeps it.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    changed: dict[str, Column] = {}
    for name in dates:
        if name in types:
            changed[name] = _date_of(df, name, date_formats)
    for name in numbers:
        if name in types and _is_text(types[name]):
            changed[name] = to_number(F.col(f"`{name}`"))
    for name in booleans:
        if name in types and _is_text(types[name]):
            changed[name] = to_boolean(F.col(f"`{name}`"))
    return df.withColumns(changed) if changed else df


def fill_missing(df: DataFrame, how: str = "fill_null") -> DataFrame:
    """Missing-value policy: under ``fill_null`` blank text becomes NULL."""
    if how != "fill_null":
        raise ValueError(f"unknown missing-value policy {how!r}")
    blank = {
        f.name: blank_to_null(F.col(f"`{f.name}`")) for f in df.schema.fields if _is_text(f.dataType)
    }
    return df.withColumns(blank) if blank else df
