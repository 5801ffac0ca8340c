"""Run ledger: one appended row per run, and the reports read from it."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.coerce import ntz
from millrace.sinks.tables import append, create_table

LEDGER_SCHEMA = (
    "job_id string, run_id string, start_time timestamp_ntz, end_time timestamp_ntz, duration_seconds double, "
    "status string, rows_processed bigint, rows_loaded bigint, error_message string"
)
KEPT_RUNS = 10
FIRST_WINDOW = timedelta(days=7)


def run_rows(runs: DataFrame) -> DataFrame:
    """Ledger rows from ``(job_id, start_time, end_time, status, rows_processed, rows_loaded, error_message)``."""
    micros = F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time"))
    return runs.select(
        "job_id",
        F.concat_ws("_", "job_id", F.date_format("start_time", "yyyyMMddHHmmss")).alias("run_id"),
        "start_time",
        "end_time",
        (micros / 1e6).alias("duration_seconds"),
        "status",
        F.coalesce("rows_processed", F.lit(0)).cast("bigint").alias("rows_processed"),
        F.coalesce("rows_loaded", F.lit(0)).cast("bigint").alias("rows_loaded"),
        "error_message",
    )


def record_run(
    spark: SparkSession,
    ledger: str,
    job_id: str,
    start_time: datetime,
    end_time: datetime,
    status: str,
    rows_processed: int = 0,
    rows_loaded: int = 0,
    error_message: str | None = None,
) -> None:
    """Append one run to the ledger table."""
    create_table(spark, ledger, LEDGER_SCHEMA)
    given = spark.createDataFrame(
        [(job_id, start_time, end_time, status, rows_processed, rows_loaded, error_message)],
        "job_id string, start_time timestamp_ntz, end_time timestamp_ntz, status string, "
        "rows_processed bigint, rows_loaded bigint, error_message string",
    )
    append(run_rows(given).coalesce(1), ledger)


def last_runs(ledger: DataFrame, keep: int = KEPT_RUNS) -> DataFrame:
    """The latest ``keep`` runs of each job.

    Spark limits each task to ``keep`` rows per job before the shuffle, so a job with
    most of the runs is not gathered whole.
    """
    latest = Window.partitionBy("job_id").orderBy(F.desc("start_time"), F.desc("run_id"))
    return ledger.withColumn("n", F.row_number().over(latest)).filter(F.col("n") <= keep).drop("n")


def job_status(ledger: DataFrame) -> DataFrame:
    """Per job: last run, last success, last status and rows loaded by the last run."""
    run = F.struct("start_time", "run_id", "status", "rows_loaded")
    per_job = ledger.groupBy("job_id").agg(
        F.max(run).alias("last"),
        F.max(F.when(F.col("status") == "success", F.col("end_time"))).alias("last_successful_run"),
        F.count(F.lit(1)).alias("run_count"),
    )
    return per_job.select(
        "job_id",
        F.col("last.start_time").alias("last_run"),
        "last_successful_run",
        F.col("last.status").alias("last_status"),
        F.col("last.rows_loaded").alias("last_run_rows"),
        "run_count",
    )


def watermarks(ledger: DataFrame, run_time: datetime) -> DataFrame:
    """Per job, the instant files must be newer than: the start of the last success.

    The start and not the end, so files that land during a run are not lost. A job
    without a success looks back seven days.
    """
    start = F.max(F.when(F.col("status") == "success", F.col("start_time")))
    return ledger.groupBy("job_id").agg(F.coalesce(start, ntz(run_time - FIRST_WINDOW)).alias("watermark"))


def last_success(ledger: DataFrame, job_id: str) -> datetime | None:
    """The start of the job's last successful run, None without one."""
    done = ledger.filter((F.col("job_id") == job_id) & (F.col("status") == "success"))
    return done.agg(F.max("start_time")).first()[0]


def watermark(ledger: DataFrame, job_id: str, run_time: datetime) -> datetime:
    row = watermarks(ledger.filter(F.col("job_id") == job_id), run_time).first()
    return row["watermark"] if row else run_time - FIRST_WINDOW


def alerts(
    ledger: DataFrame,
    alert_on_failure: bool = True,
    alert_on_validation_failure: bool = True,
    alert_on_zero_records: bool = False,
) -> DataFrame:
    """``(job_id, run_id, rule, message)`` of every rule a run fired."""
    failed = F.col("status") == "failed"
    rules = [
        (alert_on_failure, "failure", failed,
         F.concat(F.col("job_id"), F.lit(" ended with an error: "), F.coalesce("error_message", F.lit("")))),
        (alert_on_validation_failure, "validation_failure", F.col("status") == "invalid",
         F.concat(F.col("job_id"), F.lit(" was refused by its checks"))),
        (alert_on_zero_records, "zero_records", ~failed & (F.col("rows_processed") == 0),
         F.concat(F.col("job_id"), F.lit(" found no rows"))),
    ]
    fired = [
        F.when(cond, F.struct(F.lit(name).alias("rule"), message.alias("message")))
        for on, name, cond, message in rules
        if on
    ]
    if not fired:
        return ledger.select("job_id", "run_id", F.lit("").alias("rule"), F.lit("").alias("message")).limit(0)
    return ledger.select("job_id", "run_id", F.inline(F.array_compact(F.array(*fired))))


def run_alerts(
    job_id: str, status: str, processed: int, error: str | None, changed: str | None, wanted: dict
) -> list[tuple[str, str]]:
    """``(rule, message)`` of the alerts that one run fires, by its ``monitoring`` settings.

    The defaults are those of ``alerts``; a changed structure is told on request only.
    """
    rules = [
        ("failure", wanted.get("alert_on_failure", True), status == "failed", f"{job_id} ended with an error: {error or ''}"),
        ("validation_failure", wanted.get("alert_on_validation_failure", True), status == "invalid", f"{job_id} was refused by its checks"),
        ("zero_records", wanted.get("alert_on_zero_records", False), status != "failed" and not processed, f"{job_id} found no rows"),
        ("structure_change", wanted.get("alert_on_structure_change", False), changed is not None, f"{job_id} has other columns ({changed})"),
    ]
    return [(rule, message) for rule, on, fired, message in rules if on and fired]


def record_alerts(spark: SparkSession, table: str, job_id: str, run_time: datetime, fired: list[tuple[str, str]]) -> None:
    """Append the alerts of one run; the table is created with the first."""
    if fired:
        rows = spark.createDataFrame(
            [(job_id, run_time, rule, message) for rule, message in fired],
            "job_id string, start_time timestamp_ntz, rule string, message string",
        )
        create_table(spark, table, rows)
        append(rows.coalesce(1), table)
