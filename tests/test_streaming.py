"""Streams into tables: batches that are run again, and batches in the run ledger."""

import pytest
from pyspark.sql import functions as F

from millrace.sinks.tables import merge_into
from millrace.streaming.intake import LedgerListener, append_once, load_available, stream_files


@pytest.fixture
def table(spark, folder):
    name = f"s_{folder.rsplit('-', 1)[1].lower()}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/db'")
    return f"{name}.t"


def ids(spark, table):
    return sorted(r[0] for r in spark.table(table).select("id").collect())


@pytest.mark.parametrize("parts", ["", " PARTITIONED BY (p)"])
def test_what_a_broken_attempt_left_is_replaced(spark, table, parts):
    spark.sql(f"CREATE TABLE {table} (id BIGINT, p INT) USING parquet{parts}")
    rows = spark.range(10).selectExpr("id", "CAST(id % 3 AS INT) AS p").repartition(3)
    append_once(rows.filter("id < 3"), table, "x", 0, True)
    append_once(rows.filter("id < 3"), table, "x", 0, True)  # done: nothing happens
    assert ids(spark, table) == [0, 1, 2]
    # Files of batch 1 and of another stream's are there, but nothing says that they are complete.
    for stream, kept in (("x", "id = 4"), ("y", "id = 9")):
        append_once(rows.filter(kept), table, stream, 1, False)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('millrace.stream.x' = '0')")
    append_once(rows.filter("id IN (4, 5)"), table, "x", 1, True)
    append_once(rows.filter("id = 6"), table, "x", 10, False)
    assert ids(spark, table) == [0, 1, 2, 4, 5, 6, 9]
    append_once(rows.filter("id = 7"), table, "x", 11, False)
    assert ids(spark, table) == [0, 1, 2, 4, 5, 6, 7, 9] and spark.conf.get("mapreduce.output.basename", None) is None


def test_a_repeated_batch_after_files_were_rewritten(spark, table):
    spark.sql(f"CREATE TABLE {table} (id BIGINT, v STRING) USING parquet")
    rows = spark.range(4).selectExpr("id", "'a' AS v")
    append_once(rows, table, "x", 3, True)
    merge_into(spark.createDataFrame([(1, "b"), (7, "c")], "id long, v string"), table, ["id"])
    append_once(rows, table, "x", 3, True)
    assert ids(spark, table) == [0, 1, 2, 3, 7] and spark.table(table).filter("v = 'b'").count() == 1


def test_failures_and_batches_without_input_in_the_ledger(spark, table, folder):
    database = table.rsplit(".", 1)[0]
    listener = LedgerListener(spark, f"{database}.runs")
    spark.streams.addListener(listener)
    spark.range(6).write.parquet(f"{folder}/in")

    def run(steps):
        stream = stream_files(spark, f"{folder}/in", "parquet", "id bigint", "*.parquet")
        load_available(stream, table, f"{folder}/mark", steps, job_id="job").awaitTermination()

    try:
        run(lambda df: df.filter("id > 1"))
        run(lambda df: df.filter("id > 1"))  # nothing new
        spark.range(6, 9).write.mode("append").parquet(f"{folder}/in")
        with pytest.raises(Exception):
            run(lambda df: df.select((F.col("id") + F.raise_error(F.lit("odd row")).cast("bigint")).alias("id")))
        run(lambda df: df.filter("id > 1"))
        spark._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(listener)
    runs = spark.table(f"{database}.runs").sort("start_time").collect()
    assert [(r["job_id"], r["status"], r["rows_processed"], r["rows_loaded"]) for r in runs] == [
        ("job", "success", 6, 4), ("job", "failed", 0, 0), ("job", "success", 3, 3),
    ]
    assert all(r["end_time"] >= r["start_time"] for r in runs) and ids(spark, table) == [2, 3, 4, 5, 6, 7, 8]
