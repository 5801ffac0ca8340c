"""Checks, schema rows, graph elements, ledger reports."""

from datetime import datetime

import pytest

from millrace.operators.checks import (
    is_valid,
    key_check,
    required_columns,
    schema_drift,
    schema_fingerprint,
    schema_rows,
    type_report,
    validate,
)
from millrace.operators.graph import edges, key_id, property_types, vertices
from millrace.plans.ledger import alerts, last_runs, watermark
from millrace.sinks.jdbc import column_types
from millrace.sources.tables import (
    balanced_cuts,
    range_predicates,
    _COLUMNS_SQL,
    _KEYS_SQL,
    _TABLES_SQL,
    catalog_sql,
    extract_table,
    key_ranges,
    list_tables,
    run_sql,
    table_columns,
    with_literals,
)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_validation(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "issuer string, volume int")
    report = validate(df, ["issuer", "price"], ["issuer", "absent"], {"volume": "double", "absent": "string"})
    assert found(report) == sorted(
        [
            ("required_column", "issuer", True, "error", None),
            ("required_column", "price", False, "error", "column is missing"),
            ("has_rows", None, True, "error", None),
            ("null_values", "issuer", False, "warning", "1 null values"),
            ("column_type", "volume", False, "warning", "has type int, expected double"),
        ],
        key=repr,
    )
    assert not is_valid(report)
    assert is_valid(validate(df, ["issuer"], ["issuer"]))
    assert not is_valid(validate(df.limit(0)))
    assert found(required_columns(df, [])) == [] and found(type_report(df, {})) == []


def test_schema_rows_drift_and_fingerprint(spark):
    old = spark.createDataFrame([], "a int, b string, c double")
    new = spark.createDataFrame([], "c double, a bigint, d date")
    assert found(schema_drift(schema_rows(old, "t"), schema_rows(new, "t"))) == [
        ("t", "a", "retyped", "int", "bigint"), ("t", "b", "removed", "string", None),
        ("t", "d", "added", None, "date"),
    ]
    same = spark.createDataFrame([], "c double, b string, a int")
    marks = [schema_fingerprint(schema_rows(d, "t")).first()["fingerprint"] for d in (old, same, new)]
    assert marks[0] == marks[1] != marks[2]


def test_key_check(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 3)], "a int, b int")
    assert found(key_check(df, ["a", "b"])) == [(4, 2, 1, 1, False)]
    assert found(key_check(df.limit(0), ["a"])) == [(0, 0, 0, 0, True)]


def test_catalog(spark):
    from contract.base import fresh_database
    from millrace.sinks.tables import create_table

    database = fresh_database(spark)
    create_table(spark, f"{database}.one", "a INT, b STRING")
    spark.sql(f"CREATE VIEW {database}.v AS SELECT 1 AS x")
    assert found(list_tables(spark, database)) == [("one",)]
    assert [r[1:4] for r in found(table_columns(spark, f"{database}.one"))] == [("a", 1, "int"), ("b", 2, "string")]


def test_extract_pushes_down(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    out = extract_table(orders, ["o_orderkey"], "o_totalprice > :p AND o_orderstatus = :s", {"p": 5.0, "s": "F"})
    plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert "GreaterThan(o_totalprice,5.0)" in plan and "EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan


def test_sql_binds(spark):
    views = {"t_binds": spark.range(5)}
    assert found(run_sql(spark, "SELECT id FROM t_binds WHERE id > :low", {"low": 2}, views)) == [(3,), (4,)]
    injected = {"low": "0 OR 1=1"}
    with pytest.raises(Exception):
        run_sql(spark, "SELECT id FROM t_binds WHERE id > :low", injected, views).collect()


def test_remote_binds():
    text = "SELECT ':x', a::int FROM t WHERE d > :last AND n = :n AND s = :s AND z = :z"
    params = {"last": datetime(2024, 1, 2, 3), "n": 5, "s": "o'x :n", "z": None}
    assert with_literals(text, params) == (
        "SELECT ':x', a::int FROM t WHERE d > TIMESTAMP '2024-01-02 03:00:00' AND n = 5 AND s = 'o''x :n' AND z = NULL"
    )
    with pytest.raises(KeyError):
        with_literals("SELECT :missing", {})


def test_remote_catalog_queries_and_ranges():
    url = "jdbc:postgresql://h/db"
    assert "table_schema = 'public'" in catalog_sql(_TABLES_SQL, url)
    assert "table_name = 'o''x' AND table_schema = 's'" in catalog_sql(_COLUMNS_SQL, url, "o'x", "s")
    assert "pragma_table_info('t')" in catalog_sql(_KEYS_SQL, "jdbc:sqlite:f.db", "t")
    assert "all_constraints" in catalog_sql(_KEYS_SQL, "jdbc:oracle:thin:@h", "T", "S")
    with pytest.raises(ValueError):
        catalog_sql(_TABLES_SQL, "jdbc:mysql://h/db")
    assert key_ranges("id", 1, 100, 2_500_000, 1_000_000, None) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "3"
    }
    assert key_ranges("id", None, None, 0, 10, None) == {}


def test_column_types(spark):
    df = spark.createDataFrame([], "a bigint, b double, c timestamp_ntz, d boolean, e string, f decimal(9,2), g date")
    assert column_types(df) == (
        "`a` BIGINT, `b` DOUBLE, `c` TIMESTAMP, `d` BOOLEAN, `e` VARCHAR(4000), `f` DECIMAL(9,2), `g` DATE"
    )


def test_vertex_ids_are_unique_and_repeatable(spark):
    df = spark.createDataFrame([("a!b", "c"), ("a", "b!c"), ("a\\", "!b"), (None, "x")], "k string, l string")
    ids = [r[0] for r in df.select(key_id("k", "l")).collect()]
    assert len({i for i in ids if i}) == 3 and ids[3] is None
    assert vertices(df, "t", ["k", "l"]).count() == 3
    auto = vertices(df.union(df), "t")
    assert auto.count() == 4 and sorted(r.id for r in auto.collect()) == sorted(r.id for r in auto.collect())
    with pytest.raises(ValueError):
        vertices(df, "t", ["z"])


def test_edges(spark):
    df = spark.createDataFrame([(1, 2, "x", 1), (1, 2, "y", 2), (None, 2, "z", 3), (1, 3, "x", 4)], "s int, t int, kind string, n int")
    assert found(edges(df, "e", "s", "t", order=["n"])) == [("1", "2", "e", "y", 2), ("1", "3", "e", "x", 4)]
    assert edges(df, "e", "s", "t", "MULTIPLE").count() == 3
    assert edges(df.union(df), "e", "s", "t", "MULTIPLE", ["kind"]).count() == 3
    with pytest.raises(ValueError):
        edges(df, "e", "s", "t", "MANY")


def test_property_types(spark):
    df = spark.createDataFrame([], "a bigint, b int, c string, d timestamp_ntz, e double, f boolean, g array<int>")
    assert [r[1] for r in property_types(df).collect()] == ["LONG", "INT", "TEXT", "DATE", "DOUBLE", "BOOLEAN", "TEXT"]


LEDGER = (
    "job_id string, run_id string, start_time timestamp_ntz, status string, rows_processed bigint, error_message string"
)


def test_ledger_reports(spark):
    rows = [("j", f"r{i:02}", datetime(2024, 1, 1, i), "success" if i < 12 else "failed", i, None) for i in range(14)]
    ledger = spark.createDataFrame(rows, LEDGER)
    kept = last_runs(ledger)
    assert sorted(r["run_id"] for r in kept.collect()) == [f"r{i:02}" for i in range(4, 14)]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()
    now = datetime(2024, 2, 1)
    assert watermark(ledger, "j", now) == datetime(2024, 1, 1, 11)
    assert watermark(ledger, "other", now) == datetime(2024, 1, 25)
    fired = found(alerts(ledger, alert_on_zero_records=True).select("run_id", "rule"))
    assert fired == [("r00", "zero_records"), ("r12", "failure"), ("r13", "failure")]
    assert found(alerts(ledger, False, False, False)) == []


@pytest.mark.parametrize("keys", [
    list(range(1000)), [5] * 900 + list(range(100)), [i**3 for i in range(500)], [0] * 10, [-(10**12), *range(300), 10**15],
    [10**17 + i for i in range(400)] + [3],
])
def test_ranges_hold_equally_many_rows_of_skewed_keys(spark, keys):
    """Over a view in place of a server: the counts are plain SQL."""
    spark.createDataFrame([(k,) for k in [*keys, None, None]], "k long").createOrReplaceTempView("far_keys")
    asked = []

    def ask(text):
        asked.append(text)
        got = spark.sql(text).collect()
        assert len(got) <= 21
        return got

    cuts = balanced_cuts(ask, "far_keys", "k", min(keys), max(keys), len(keys) + 2, 5, intervals=20)
    counts = [spark.table("far_keys").filter(p).count() for p in range_predicates("k", cuts)]
    assert sum(counts) == len(keys) + 2 and cuts == sorted(set(cuts))
    heaviest = max(keys.count(k) for k in set(keys)) if len(set(keys)) < 500 else 1
    assert max(counts) <= 1.5 * (len(keys) + 2) / 5 + heaviest
    assert len(asked) <= 60
    assert balanced_cuts(ask, "far_keys", "k", min(keys), max(keys), len(keys) + 2, 1) == []
    spark.catalog.dropTempView("far_keys")


def test_range_predicates():
    assert range_predicates("k", []) == ["1 = 1"]
    assert range_predicates("k", [3]) == ["k < 3 OR k IS NULL", "k >= 3"]
    assert range_predicates("k", [3, 9]) == ["k < 3 OR k IS NULL", "k >= 3 AND k < 9", "k >= 9"]
