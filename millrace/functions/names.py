"""Column names: cleaning and renaming."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

from pyspark.sql import DataFrame


def clean_name(name: str) -> str:
    return name.lower().replace(" ", "_").replace("-", "_")


def _checked(names: list[str]) -> list[str]:
    twice = sorted(n for n, k in Counter(names).items() if k > 1)
    if twice:
        raise ValueError(f"several columns would be named {twice}")
    return names


def clean_column_names(df: DataFrame) -> DataFrame:
    """Lower case, spaces and hyphens to underscores; a collision is an error."""
    return df.toDF(*_checked([clean_name(c) for c in df.columns]))


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the mapped columns that exist and leave the rest alone."""
    return df.toDF(*_checked([mapping.get(c, c) for c in df.columns]))
