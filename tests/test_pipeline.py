"""Whole jobs from a spec: the shipped kinds of job, overrides, registries, ledger."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from contract.base import fresh_database
from millrace.plans.pipeline import (
    as_frame,
    deep_merge,
    register_loader,
    register_source,
    register_transformer,
    resolve_variables,
    run,
)

NOW = datetime(2024, 6, 1, 12)


def test_spec_helpers(spark):
    base = {"a": {"x": 1, "y": [1]}, "b": 2}
    merged = deep_merge(base, {"a": {"x": 9}, "c": 3})
    assert merged == {"a": {"x": 9, "y": [1]}, "b": 2, "c": 3} and base["a"]["x"] == 1
    spec = {"h": "${HOST:-local}:${PORT}", "l": ["${PORT}"], "n": 5}
    assert resolve_variables(spec, {"PORT": "1"}) == {"h": "local:1", "l": ["1"], "n": 5}
    with pytest.raises(KeyError):
        resolve_variables("${NOPE}", {})
    assert [tuple(r) for r in as_frame(spark, [{"a": 1}, {"b": "x", "a": 2}]).collect()] == [(1, None), (2, "x")]
    assert [tuple(r) for r in as_frame(spark, {"a": 1}).collect()] == [(1,)]
    assert as_frame(spark, 5).columns == [] and as_frame(spark, []).columns == []
    df = spark.range(1)
    assert as_frame(spark, df) is df


@pytest.fixture
def keepers(spark):
    name = f"{fresh_database(spark)}.keepers"
    df = spark.createDataFrame(
        [(1, "a", "2024-01-01"), (2, "b", "2024-02-01"), (3, "c", "bad")], "keeper int, name string, seen_on string"
    )
    df.write.saveAsTable(name)
    return name


def test_database_job_merges(spark, keepers):
    database = keepers.split(".")[0]
    spec = {
        "job_id": "db", "source": {"type": "postgresql", "schema": database, "table": "keepers",
                                   "columns": ["keeper", "name", "seen_on"],
                                   "where_clause": "name <> :skip", "where_params": {"skip": "a"}},
        "transformer": {"type": "base", "date_columns": ["seen_on"], "handle_missing_values": "fill_null"},
        "loader": {"type": "table", "database": database, "table": "stored", "write_mode": "merge",
                   "merge_keys": ["keeper"]},
    }
    first = run(spark, spec, NOW)
    assert (first.status, first.rows_processed, first.rows_loaded) == ("success", 2, 2)
    run(spark, spec, NOW, overrides={"source": {"where_params": {"skip": "b"}}})
    got = sorted(tuple(r) for r in spark.table(f"{database}.stored").collect())
    assert got == [(1, "a", datetime(2024, 1, 1)), (2, "b", datetime(2024, 2, 1)), (3, "c", None)]
    query = {**spec, "source": {"type": "db", "query": f"SELECT keeper FROM {keepers} WHERE keeper > :k",
                                "query_params": {"k": 1}},
             "loader": {"database": database, "table": "asked"}}
    assert run(spark, query, NOW).rows_loaded == 2


def test_incremental_file_job(spark, folder):
    import os

    database = fresh_database(spark)
    ledger = f"{database}.ledger"
    spec = {
        "job_id": "boxes",
        "source": {"type": "csv", "source_path": folder, "file_pattern": "boxes_*.csv", "incremental": True, "first_days": 7,
                   "add_file_metadata": True, "file_options": {"dtype": {"depot": "str"}}},
        "transformer": {"required_columns": ["site"],
                        "transformations": [{"rename_columns": {"depot": "site"}}]},
        "loader": {"database": database, "table": "boxes"},
    }

    def drop(name, text, at):
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
        stamp = (at - datetime(1970, 1, 1)).total_seconds()
        os.utime(f"{folder}/{name}", (stamp, stamp))

    drop("boxes_0.csv", "depot,n\n00,0\n", NOW - timedelta(days=30))
    drop("boxes_1.csv", "depot,n\n01,1\n", NOW - timedelta(days=1))
    clock = lambda: NOW + timedelta(minutes=5)
    assert run(spark, spec, NOW, ledger=ledger, now=clock).rows_loaded == 1  # a week back
    drop("boxes_2.csv", "depot,n\n02,2\n", NOW + timedelta(minutes=1))  # lands while the first run is active
    later = NOW + timedelta(hours=1)
    assert run(spark, spec, later, ledger=ledger, now=lambda: later).rows_loaded == 1
    last = later + timedelta(hours=1)
    assert run(spark, spec, last, ledger=ledger, now=lambda: last).status == "no_data"
    assert sorted(r["site"] for r in spark.table(f"{database}.boxes").collect()) == ["01", "02"]
    everything = {**spec, "job_id": "all", "loader": {"database": database, "table": "everything"}}
    everything["source"] = {k: v for k, v in spec["source"].items() if k != "first_days"}
    assert run(spark, everything, last, ledger=f"{database}.other").rows_loaded == 3  # the first run has no window
    entries = [(r["status"], r["rows_loaded"]) for r in spark.table(ledger).sort("start_time").collect()]
    assert entries == [("success", 1), ("success", 1), ("no_data", 0)]


def test_register_job_from_pages(spark):
    database = fresh_database(spark)
    html = (
        "<table><tr><th>Emittent</th><th>Transaktionsdatum</th><th>Volym</th><th>Pris</th></tr>"
        "<tr><td>Bolag AB</td><td>2024-05-02</td><td>1000,5</td><td>12,25</td></tr>"
        "<tr><td>Annat AB</td><td>2024-05-03</td><td>7</td><td>x</td></tr></table>"
    )
    spark.createDataFrame([(1, html)], "page_id int, html string").write.saveAsTable(f"{database}.pages")
    spec = {
        "job_id": "insider",
        "source": {"type": "fsa_scraper", "table": f"{database}.pages",
                   "columns": ["Emittent", "Transaktionsdatum", "Volym", "Pris"]},
        "transformer": {"type": "fsa", "validate_schema": True},
        "loader": {"type": "table", "database": database, "table": "insider"},
    }
    assert run(spark, spec, NOW).rows_loaded == 2
    got = spark.table(f"{database}.insider").sort("issuer").collect()
    assert [(r["issuer"], r["transaction_date"], r["volume"], r["price"], r["source"]) for r in got] == [
        ("Annat AB", datetime(2024, 5, 3), 7.0, None, "Swedish FSA"),
        ("Bolag AB", datetime(2024, 5, 2), 1000.5, 12.25, "Swedish FSA"),
    ]
    spark.createDataFrame([(1, "<p>no table")], "page_id int, html string").write.saveAsTable(f"{database}.bare")
    assert run(spark, deep_merge(spec, {"source": {"table": f"{database}.bare"}}), NOW).status == "no_data"
    lacking = deep_merge(spec, {"source": {"columns": ["Emittent"]}, "loader": {"table": "not_made"}})
    result = run(spark, lacking, NOW)
    assert result.status == "invalid" and not spark.catalog.tableExists(f"{database}.not_made")


def test_declared_scraper_job_overwrites_partitions(spark):
    database = fresh_database(spark)
    item = "<div class='product-item'><h3 class='product-title'>{}</h3><span class='price'>{}</span><meta itemprop='d' content='{}'></div>"
    pages = [(1, item.format("A", "1,5", "2024-01-01") + item.format("B", "2", "2024-01-02"))]
    spark.createDataFrame(pages, "page_id int, html string").createOrReplaceTempView("price_pages")
    spec = {
        "source": {"type": "web_scraper", "table": "price_pages",
                   "extraction": {"item_xpath": "//div[@class='product-item']",
                                  "fields": {"product_name": ".//h3/text()", "price": ".//span/text()", "day": ".//meta/@content"}}},
        "transformer": {"numeric_columns": ["price"]},
        "loader": {"database": database, "table": "prices", "write_mode": "overwrite_partition", "partition_by": "day"},
    }
    run(spark, spec, NOW)
    spark.createDataFrame([(1, item.format("C", "3", "2024-01-02"))], "page_id int, html string").createOrReplaceTempView("price_pages")
    run(spark, spec, NOW)
    assert sorted(tuple(r) for r in spark.table(f"{database}.prices").collect()) == [
        ("A", 1.5, "2024-01-01"), ("C", 3.0, "2024-01-02")
    ]


def test_api_job(spark):
    database = fresh_database(spark)
    rows = [("f", n, f'{{"data": [{{"amount": "{n},5"}}], "has_more": {"true" if n < 3 else "false"}}}') for n in range(1, 6)]
    spark.createDataFrame(rows, "feed string, page bigint, body string").createOrReplaceTempView("bodies")
    spec = {
        "source": {"type": "api", "table": "bodies", "pagination_strategy": "page", "item_schema": "amount string"},
        "transformer": {"numeric_columns": ["amount"]},
        "loader": {"database": database, "table": "transactions"},
    }
    assert run(spark, spec, NOW).rows_loaded == 3
    assert sorted(r["amount"] for r in spark.table(f"{database}.transactions").collect()) == [1.5, 2.5, 3.5]


def test_graph_loader(spark, keepers):
    database = keepers.split(".")[0]
    spec = {
        "source": {"type": "db", "table": keepers},
        "loader": {"type": "graph", "database": database, "table": "people", "primary_keys": ["keeper"]},
    }
    assert run(spark, spec, NOW).rows_loaded == 3
    got = {(r["id"], r["label"]) for r in spark.table(f"{database}.people").collect()}
    assert got == {(str(i), f"{database}_people") for i in (1, 2, 3)}


def test_user_parts_and_failures(spark):
    database = fresh_database(spark)
    seen = []
    register_source("Numbers", lambda spark, cfg, at: spark.range(cfg["n"]))
    register_transformer("double_it", lambda df, cfg, at: df.withColumn("id", F.col("id") * 2))
    register_loader("keep", lambda df, cfg: seen.extend(r["id"] for r in df.collect()) or len(seen))
    spec = {"job_id": "own", "source": {"type": "numbers", "n": 3}, "transformer": {"type": "double_it"}, "loader": {"type": "KEEP"}}
    assert run(spark, spec, NOW).rows_loaded == 3 and sorted(seen) == [0, 2, 4]
    ledger = f"{database}.ledger"
    with pytest.raises(ValueError, match="unknown source"):
        run(spark, {**spec, "source": {"type": "nope"}}, NOW, ledger=ledger, now=lambda: NOW)
    bad = {**spec, "transformer": {"type": "base", "transformations": [{"filter": {"condition": "raise_error('boom')"}}]}}
    with pytest.raises(Exception, match="boom"):
        run(spark, bad, NOW, ledger=ledger, now=lambda: NOW)
    assert [r["status"] for r in spark.table(ledger).collect()] == ["failed", "failed"]


def test_empty_input_replaces_nothing(spark):
    database = fresh_database(spark)
    spark.range(5).write.saveAsTable(f"{database}.src")
    spec = {"job_id": "j", "source": {"type": "db", "query": f"SELECT id FROM {database}.src WHERE id < :n", "query_params": {"n": 5}},
            "loader": {"database": database, "table": "kept", "write_mode": "replace"},
            "monitoring": {"alert_on_zero_records": True, "alert_on_structure_change": True}}
    assert run(spark, spec, NOW).rows_loaded == 5
    empty = run(spark, spec, NOW, overrides={"source": {"query_params": {"n": 0}}}, ledger=f"{database}.ledger")
    assert empty.status == "no_data" and [a[0] for a in empty.alerts] == ["zero_records"]
    assert spark.table(f"{database}.kept").count() == 5
    assert [r["rule"] for r in spark.table(f"{database}.ledger_alerts").collect()] == ["zero_records"]
    wider = run(spark, {**spec, "loader": {**spec["loader"], "write_mode": "append"},
                        "source": {"type": "db", "query": f"SELECT cast(id AS int) AS id FROM {database}.src"}}, NOW)
    assert wider.alerts == (("structure_change", "j has other columns (of another type: id)"),)


def test_transformer_brings_its_own_checks(spark):
    from millrace.operators.checks import validate

    database = fresh_database(spark)
    spark.range(3).write.saveAsTable(f"{database}.src")
    register_transformer(
        "strict", lambda df, cfg, at: df.withColumn("n", F.lit(None).cast("int")), lambda df, cfg: validate(df, ["absent"], [], {})
    )
    spec = {"job_id": "strict", "source": {"type": "db", "table": "src", "schema": database},
            "transformer": {"type": "strict", "validate_schema": True}, "loader": {"database": database, "table": "out"}}
    result = run(spark, spec, NOW)
    assert result.status == "invalid" and [a[0] for a in result.alerts] == ["validation_failure"]
    assert not spark.catalog.tableExists(f"{database}.out")
