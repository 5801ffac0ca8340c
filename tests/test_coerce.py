"""Conversion edge values, and that conversions stay native and narrow."""

import math
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.functions.coerce import convert_types, fill_missing, spark_pattern
from millrace.functions.names import clean_column_names, rename_present
from millrace.operators.steps import apply_steps, null_on_zero_division

NUMBERS = [
    ("1,5", 1.5), ("1.234,5", None), ("1 000", None), ("", None), (" 7 ", 7.0), ("1e3", 1000.0), ("-1,5e-2", -0.015),
    ("inf", math.inf), ("-Infinity", -math.inf), ("NaN", None), ("nan", None), ("0x1A", None), ("1d", None),
    ("2f", None), ("+3", 3.0), (".5", 0.5), ("5.", 5.0), (".", None), ("1_000", None), ("n/a", None), (None, None),
]
BOOLEANS = [
    ("JA", True), ("nej", False), ("Y", True), ("n", False), ("TRUE", True), ("False", False), ("1", True),
    ("0", False), ("yes", True), ("No", False), (" ja", None), ("x", None), ("", None), (None, None),
]
DATES = [
    ("2024-01-02", datetime(2024, 1, 2)), ("03/04/2024", datetime(2024, 4, 3)), ("bad", None), (None, None),
    ("2024-13-01", None), ("2024-02-30", None), ("2024-01-02 03:04:05", datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02 03:04:05.25", datetime(2024, 1, 2, 3, 4, 5, 250000)), ("", None),
]


def _column(spark, pairs, **kind):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(pairs)], "i int, v string")
    return [r["v"] for r in convert_types(df, **kind).sort("i").collect()]


def test_numbers(spark):
    assert _column(spark, NUMBERS, numbers=["v"]) == [w for _, w in NUMBERS]


def test_booleans(spark):
    assert _column(spark, BOOLEANS, booleans=["v"]) == [w for _, w in BOOLEANS]


def test_dates(spark):
    formats = ["%Y-%m-%d", "%d/%m/%Y", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M:%S.%f"]
    assert _column(spark, DATES, dates=["v"], date_formats=formats) == [w for _, w in DATES]


def test_first_matching_format_wins(spark):
    pair = [("03/04/2024", None)]
    assert _column(spark, pair, dates=["v"], date_formats=["%m/%d/%Y", "%d/%m/%Y"]) == [datetime(2024, 3, 4)]


def test_other_types_and_absent_columns_are_left_alone(spark):
    df = spark.createDataFrame([(1, 2.5, True)], "a int, b double, c boolean")
    out = convert_types(df, dates=["x"], numbers=["a", "b", "y"], booleans=["c", "a"])
    assert out.schema == df.schema


def test_conversions_are_native_and_narrow(spark):
    df = spark.createDataFrame([("1,5", "2024-01-02", "ja")], "n string, d string, b string")
    plan = convert_types(df, ["d"], ["n"], ["b"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=20))
def test_comma_numbers_round_trip(spark, values):
    pairs = [(repr(float(v)).replace(".", ","), float(v)) for v in values]
    assert _column(spark, pairs, numbers=["v"]) == [w for _, w in pairs]


def test_patterns():
    assert spark_pattern("%d/%m/%Y") == "dd/MM/yyyy"
    assert spark_pattern("%Y-%m-%dT%H:%M") == "yyyy-MM-dd'T'HH:mm"
    assert spark_pattern("dd.MM.yyyy") == "dd.MM.yyyy"
    with pytest.raises(ValueError):
        spark_pattern("%Q")


def test_fill_missing(spark):
    df = spark.createDataFrame([("  ", 1), ("x ", None)], "t string, n int")
    assert [tuple(r) for r in fill_missing(df).collect()] == [(None, 1), ("x ", None)]
    with pytest.raises(ValueError):
        fill_missing(df, "drop")


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], ["Full Name", "b-C"])
    assert clean_column_names(df).columns == ["full_name", "b_c"]
    assert rename_present(df, {"b-C": "c", "zz": "y"}).columns == ["Full Name", "c"]
    with pytest.raises(ValueError):
        clean_column_names(spark.createDataFrame([(1, 2)], ["a b", "A-b"]))
    with pytest.raises(ValueError):
        rename_present(df, {"b-C": "Full Name"})


@pytest.mark.parametrize(
    "formula, want",
    [
        ("a / b", "a / nullif(b, 0)"),
        ("a/(b+c)/d * 2", "a/ nullif((b+c), 0)/ nullif(d, 0) * 2"),
        ("f(x) / g(y, z/w)", "f(x) / nullif(g(y, z/ nullif(w, 0)), 0)"),
        ("concat('a/b', `c/d`)", "concat('a/b', `c/d`)"),
        ("a * b", "a * b"),
    ],
)
def test_division(formula, want):
    assert null_on_zero_division(formula) == want


def test_steps(spark):
    df = spark.createDataFrame([(10.0, 2), (5.0, 0), (8.0, None)], "revenue double, quantity int")
    out = apply_steps(
        df,
        [
            {"add_column": {"name": "unit", "formula": "revenue / quantity"}},
            {"rename_columns": {"quantity": "n", "absent": "x"}},
            {"filter": {"condition": "n >= 0"}},
        ],
    )
    assert [tuple(r) for r in out.collect()] == [(10.0, 2, 5.0), (5.0, 0, None)]
    with pytest.raises(ValueError):
        apply_steps(df, [{"explode": {}}])
