"""A caller's own extract function over landed bodies, as a table function that SQL can call.

``SELECT p.feed, i.* FROM pages p, LATERAL my_items(p.body, CAST(NULL AS STRUCT<id: BIGINT, label: STRING>)) i``

The columns follow from the call: they are the fields of the second argument's type, seen when the query is analysed,
so one function serves bodies of many shapes. Bodies are handed to Python one at a time where they lie; nothing is shuffled.
Where the extract can be said as a column function, ``payloads.with_items`` does without Python.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterable, Mapping
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Extract = Callable[[str], Iterable[Mapping[str, Any]]]


def as_type(value: Any, kind: T.DataType) -> Any:
    """A value as JSON gives it in a column's type; one that does not fit is an error, as a cast would be."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return tuple(as_type(value.get(f.name), f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return [as_type(v, kind.elementType) for v in value]
    if isinstance(kind, T.MapType):
        return {as_type(k, kind.keyType): as_type(v, kind.valueType) for k, v in value.items()}
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    if isinstance(kind, T.BooleanType):
        if not isinstance(value, bool):
            raise ValueError(f"{value!r} is no boolean")
        return value
    if isinstance(kind, T.IntegralType):
        if isinstance(value, float) and not value.is_integer():
            raise ValueError(f"{value!r} is no whole number")
        return int(value)
    if isinstance(kind, T.FractionalType):
        return Decimal(str(value)) if isinstance(kind, T.DecimalType) else float(value)
    if isinstance(kind, T.DateType):
        return value if isinstance(value, date) else date.fromisoformat(value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return value if isinstance(value, datetime) else datetime.fromisoformat(value)
    return value


def extract_function(extract: Extract, skip_errors: bool = False) -> type:
    """The table function's class: ``(body, columns)`` to a row per item; fields that an item lacks are NULL.

    A NULL body has no items. An error of the function, or a value that does not fit its column, ends the query, or
    with ``skip_errors`` leaves the body out whole.
    """

    class Items:
        def __init__(self, found: AnalyzeResult):
            self.fields = found.schema.fields

        @staticmethod
        def analyze(body: AnalyzeArgument, columns: AnalyzeArgument) -> AnalyzeResult:
            if not isinstance(columns.dataType, T.StructType):
                raise ValueError("the second argument declares the columns: CAST(NULL AS STRUCT<...>)")
            return AnalyzeResult(columns.dataType)

        def eval(self, body: str, columns):
            if body is None:
                return
            try:
                rows = [tuple(as_type(item.get(f.name), f.dataType) for f in self.fields) for item in extract(body)]
            except Exception:
                if skip_errors:
                    return
                raise
            yield from rows

    return Items


def register_extract(spark: SparkSession, name: str, extract: Extract, skip_errors: bool = False) -> None:
    """Make ``extract(body) -> items`` callable from SQL under ``name``."""
    spark.udtf.register(name, F.udtf(extract_function(extract, skip_errors)))
