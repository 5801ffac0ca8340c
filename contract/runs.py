"""Run ledger reports and whole jobs run from a spec."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.base import RUN_TIME, fresh_database, load, query
from millrace.plans.ledger import alerts, job_status, last_runs, run_rows, watermarks
from millrace.plans.pipeline import run
from millrace.session import new_folder


def _ledger(spark, sf_dir):
    """Events as runs: the user is the job, errors are failed runs."""
    events = load(spark, sf_dir, "events")
    status = (
        F.when(F.col("event_type") == "error", "failed")
        .when((F.col("event_type") == "view") & (F.col("value") > 30), "invalid")
        .otherwise("success")
    )
    failed = status != "success"
    rows = F.round(F.col("value")).cast("bigint")
    return run_rows(
        events.select(
            F.concat(F.lit("job-"), F.col("user_id")).alias("job_id"),
            F.col("ts").alias("start_time"),
            F.expr("timestampadd(MILLISECOND, cast(round(value * 1000) as int), ts)").alias("end_time"),
            status.alias("status"),
            F.when(rows > 2, rows).alias("rows_processed"),
            F.when(~failed, rows).alias("rows_loaded"),
            F.when(status == "failed", F.concat(F.lit("error "), F.col("event_id"))).alias("error_message"),
        )
    )


LEDGER_SQL = """
    SELECT 'job-' || CAST(user_id AS VARCHAR) AS job_id,
           'job-' || CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d%H%M%S') AS run_id,
           ts AS start_time, ts + to_milliseconds(CAST(round(value * 1000) AS BIGINT)) AS end_time,
           round(value * 1000) * 1000 / 1e6 AS duration_seconds,
           CASE WHEN event_type = 'error' THEN 'failed'
                WHEN event_type = 'view' AND value > 30 THEN 'invalid' ELSE 'success' END AS status,
           CASE WHEN round(value) > 2 THEN CAST(round(value) AS BIGINT) ELSE 0 END AS rows_processed,
           CASE WHEN event_type = 'error' OR (event_type = 'view' AND value > 30) THEN 0
                ELSE CAST(round(value) AS BIGINT) END AS rows_loaded,
           CASE WHEN event_type = 'error' THEN 'error ' || CAST(event_id AS VARCHAR) END AS error_message
    FROM events
"""


@query("run_ledger", LEDGER_SQL)
def run_ledger(spark, sf_dir):
    return _ledger(spark, sf_dir)


@query(
    "run_last10",
    f"""
    SELECT * FROM ({LEDGER_SQL}) l
    QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY start_time DESC, run_id DESC) <= 10
    """,
)
def run_last10(spark, sf_dir):
    return last_runs(_ledger(spark, sf_dir))


@query(
    "run_status",
    f"""
    SELECT job_id, max(start_time) AS last_run, max(end_time) FILTER (status = 'success') AS last_successful_run,
           arg_max(status, start_time) AS last_status, arg_max(rows_loaded, start_time) AS last_run_rows,
           count(*) AS run_count
    FROM ({LEDGER_SQL}) l GROUP BY job_id
    """,
)
def run_status(spark, sf_dir):
    return job_status(_ledger(spark, sf_dir))


@query(
    "run_watermarks",
    f"""
    SELECT job_id, coalesce(max(start_time) FILTER (status = 'success'), TIMESTAMP '2024-05-25 12:00:00') AS watermark
    FROM ({LEDGER_SQL}) l GROUP BY job_id
    """,
)
def run_watermarks(spark, sf_dir):
    return watermarks(_ledger(spark, sf_dir), RUN_TIME)


@query(
    "run_alerts",
    f"""
    WITH l AS ({LEDGER_SQL})
    SELECT job_id, run_id, 'failure' AS rule, job_id || ' ended with an error: ' || error_message AS message
    FROM l WHERE status = 'failed'
    UNION ALL SELECT job_id, run_id, 'validation_failure', job_id || ' was refused by its checks'
    FROM l WHERE status = 'invalid'
    UNION ALL SELECT job_id, run_id, 'zero_records', job_id || ' found no rows'
    FROM l WHERE status <> 'failed' AND rows_processed = 0
    """,
)
def run_alerts(spark, sf_dir):
    return alerts(_ledger(spark, sf_dir), alert_on_zero_records=True)


def _shipping_spec(spark, sf_dir) -> dict:
    """Shipped lines as CSV files, and the job that takes them in."""
    folder = new_folder(spark, "shipping")
    lines = load(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("left_dock"),
        F.format_string("S%06d", "l_suppkey").alias("shipper"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("part"),
        (F.col("l_quantity") - 1).cast("int").alias("pieces"),
        F.col("l_extendedprice").alias("amount"),
        "l_returnflag",
    )
    lines.write.option("header", True).csv(folder)
    return {
        "job_id": "shipping",
        "source": {
            "type": "csv", "source_path": folder, "file_pattern": "part-*.csv",
            "file_options": {
                "delimiter": ",", "encoding": "utf-8", "header": 0, "parse_dates": ["left_dock"],
                "dtype": {"shipper": "str", "part": "str", "pieces": "int", "amount": "float", "l_returnflag": "str"},
                "same_header": True,
            },
        },
        "transformer": {
            "type": "base",
            "date_columns": ["left_dock"],
            "numeric_columns": ["pieces", "amount"],
            "handle_missing_values": "fill_null",
            "required_columns": ["sender", "per_piece"],
            "transformations": [
                {"filter": {"condition": "pieces >= 1"}},
                {"rename_columns": {"shipper": "sender"}},
                {"add_column": {"name": "per_piece", "formula": "amount / pieces"}},
            ],
        },
        "loader": {
            "type": "table", "database": fresh_database(spark), "table": "shipped", "write_mode": "append",
            "partition_by": "l_returnflag",
        },
    }


@query(
    "pipeline_job",
    """
    SELECT CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS left_dock, printf('S%06d', l_suppkey) AS sender,
           'P' || CAST(l_partkey AS VARCHAR) AS part, CAST(l_quantity - 1 AS BIGINT) AS pieces,
           l_extendedprice AS amount, l_extendedprice / (l_quantity - 1) AS per_piece, l_returnflag
    FROM lineitem WHERE l_quantity > 1
    """,
)
def pipeline_job(spark, sf_dir):
    spec = _shipping_spec(spark, sf_dir)
    run(spark, spec, RUN_TIME)
    return spark.table(f"{spec['loader']['database']}.shipped")


@query(
    "pipeline_counts",
    """
    SELECT 'shipping' AS job_id, 'shipping_20240601120000' AS run_id, 'success' AS status,
           CAST(90 AS DOUBLE) AS duration_seconds, count(*) AS rows_processed,
           count(*) FILTER (l_quantity > 1) AS rows_loaded, count(*) FILTER (l_quantity > 1) AS table_rows
    FROM lineitem
    """,
)
def pipeline_counts(spark, sf_dir):
    """The ledger row of the job: rows read and stored are counted while they are written."""
    from datetime import timedelta

    spec = _shipping_spec(spark, sf_dir)
    database = spec["loader"]["database"]
    run(spark, spec, RUN_TIME, ledger=f"{database}.ledger", now=lambda: RUN_TIME + timedelta(seconds=90))
    stored = spark.table(f"{database}.shipped").agg(F.count(F.lit(1)).alias("table_rows"))
    entry = spark.table(f"{database}.ledger").withColumn("k", F.lit(1))
    return entry.join(stored.withColumn("k", F.lit(1)), "k").select(
        "job_id", "run_id", "status", "duration_seconds", "rows_processed", "rows_loaded", "table_rows"
    )


@query(
    "pipeline_alerts",
    """
    SELECT 'orders-' || o_orderstatus AS job_id, rule, message
    FROM (SELECT DISTINCT o_orderstatus FROM orders) s, (
        VALUES ('zero_records', ' found no rows'), ('structure_change', ' has other columns (new: extra)')) r(rule, rest),
        (SELECT 1) one, LATERAL (SELECT 'orders-' || o_orderstatus || rest AS message) m
    """,
)
def pipeline_alerts(spark, sf_dir):
    """Per order status: a job whose second run has no rows, and whose third has a column more."""
    database = fresh_database(spark)
    orders = load(spark, sf_dir, "orders")
    orders.write.saveAsTable(f"{database}.src")
    for status in [r[0] for r in orders.select("o_orderstatus").distinct().collect()]:  # three values
        spec = {
            "job_id": f"orders-{status}",
            "source": {"type": "db", "query": f"SELECT * FROM {database}.src WHERE o_orderstatus = :s", "query_params": {"s": status}},
            "loader": {"database": database, "table": f"kept_{status}", "write_mode": "replace"},
            "monitoring": {"alert_on_zero_records": True, "alert_on_structure_change": True},
        }
        run(spark, spec, RUN_TIME, ledger=f"{database}.ledger")
        run(spark, spec, RUN_TIME, {"source": {"query_params": {"s": "none"}}}, ledger=f"{database}.ledger")
        wider = f"SELECT *, 1 AS extra FROM {database}.src WHERE o_orderstatus = :s"
        try:
            run(spark, spec, RUN_TIME, {"source": {"query": wider}, "monitoring": {"alert_on_failure": False}}, ledger=f"{database}.ledger")
        except ValueError:
            pass  # the table has no such column; the alert says so
    return spark.table(f"{database}.ledger_alerts").select("job_id", "rule", "message")
