"""Configured transformation steps: derive, rename, filter, add constants."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.coerce import ntz
from millrace.functions.names import rename_present

# A divisor: a number, or a name with an optional call, or only a bracket.
_DIVISOR = re.compile(r"\s*[+-]?\s*(`[^`]+`|[\w.]+)?")
_QUOTED = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`")


def null_on_zero_division(formula: str) -> str:
    """Wrap every divisor in ``nullif(…, 0)``.

    Spark is in ANSI mode by default, where ``x / 0`` fails the job; the steps
    may filter the zero rows only after deriving the column.
    """
    out, i = [], 0
    while i < len(formula):
        quoted = _QUOTED.match(formula, i)
        if quoted:
            out.append(quoted.group())
            i = quoted.end()
        elif formula[i] == "/":
            end = _DIVISOR.match(formula, i + 1).end()
            if end < len(formula) and formula[end] == "(":
                depth = 0
                for end in range(end, len(formula)):
                    depth += (formula[end] == "(") - (formula[end] == ")")
                    if depth == 0:
                        break
                end += 1
            divisor = null_on_zero_division(formula[i + 1 : end].strip())
            out.append(f"/ nullif({divisor}, 0)")
            i = end
        else:
            out.append(formula[i])
            i += 1
    return "".join(out)


def add_column(df: DataFrame, name: str, formula: str) -> DataFrame:
    return df.withColumn(name, F.expr(null_on_zero_division(formula)))


def add_constants(df: DataFrame, source: str, run_time: datetime) -> DataFrame:
    """Source name and intake time. The time is an argument, so a rerun repeats exactly."""
    return df.withColumns(
        {"source": F.lit(source), "ingestion_timestamp": ntz(run_time)}
    )


def _apply(df: DataFrame, step: Mapping[str, Any]) -> DataFrame:
    if len(step) != 1:
        raise ValueError(f"a step names exactly one operation, got {sorted(step)}")
    ((kind, args),) = step.items()
    if kind == "add_column":
        return add_column(df, args["name"], args["formula"])
    if kind == "rename_columns":
        return rename_present(df, args)
    if kind == "filter":
        return df.filter(F.expr(args["condition"]))
    raise ValueError(f"unknown step {kind!r}")


def apply_steps(df: DataFrame, steps: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Run the steps in the order given; later steps see the names earlier ones made."""
    return reduce(_apply, steps, df)
