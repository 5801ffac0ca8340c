"""Incremental intake as a stream: new files of a folder, or paged feeds, into a table."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.plans.ledger import record_run
from millrace.sinks.tables import append, create_table, merge_into, overwrite_partitions

# Hadoop's setting for how the files of a write are named.
_BASE_NAME = "mapreduce.output.basename"


def stream_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: str,
    pattern: str = "*",
    max_files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """Files of a folder as a stream. Each file is read once: the checkpoint knows which."""
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", pattern).options(**options)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(path)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in a checkpoint: restarts share it, a new checkpoint has a new one."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def append_once(batch: DataFrame, table: str, stream: str, number: int, in_doubt: bool) -> None:
    """Append a batch of a stream so that doing it again adds nothing.

    A batch's files carry stream and number in their names, so what a broken attempt has left is found and removed
    before the batch is stored again; they become visible with the files themselves, in one commit. The number last
    stored is a property of the table besides, for when files have been rewritten since. Only the first batch of a
    run can be a repeated one; ``in_doubt`` says so, and saves the others the look at the table's files.
    """
    spark, key, name = batch.sparkSession, f"millrace.stream.{stream}", f"stream-{stream}-{number}"
    if in_doubt:
        last = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == key).head(1)
        if last and int(last[0]["value"]) >= number:
            return
        left = spark.table(table).filter(F.startswith("_metadata.file_name", F.lit(f"{name}-"))).select("_metadata.file_path").distinct()
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for row in left.toLocalIterator():  # the files of one batch
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row[0]))
            path.getFileSystem(conf).delete(path, False)
        spark.catalog.refreshTable(table)
    # A stream's batches have a session of their own, so no other write sees the name.
    spark.conf.set(_BASE_NAME, name)
    try:
        append(batch, table)
    finally:
        spark.conf.unset(_BASE_NAME)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{number}')")


class LedgerListener(StreamingQueryListener):
    """Writes a ledger row for every batch of the streams it is told of, from their observed counts.

    ``rows_processed`` is what came in, ``rows_loaded`` what went to the table. A query that ends with an error adds
    a failed row. Batches without input are no runs.
    """

    def __init__(self, spark: SparkSession, ledger: str):
        super().__init__()
        self.spark, self.ledger, self.jobs = spark, ledger, {}

    def onQueryStarted(self, event) -> None:
        if event.name:
            self.jobs[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        job, seen = self.jobs.get(str(progress.runId)), progress.observedMetrics
        if job is None or "taken" not in seen or not seen["taken"]["n"]:
            return
        start = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")).replace(tzinfo=None)
        end = start + timedelta(milliseconds=progress.batchDuration)
        record_run(self.spark, self.ledger, job, start, end, "success", seen["taken"]["n"], seen["stored"]["n"])

    def onQueryTerminated(self, event) -> None:
        job = self.jobs.pop(str(event.runId), None)
        if job is not None and event.exception:
            now = datetime.now(timezone.utc).replace(tzinfo=None)
            record_run(self.spark, self.ledger, job, now, now, "failed", 0, 0, event.exception.split("\n")[0])


def load_available(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    steps: Callable[[DataFrame], DataFrame] = lambda df: df,
    merge_keys: list[str] | None = None,
    sequence: str | None = None,
    partition_by: list[str] | None = None,
    batch_column: str | None = None,
    job_id: str | None = None,
) -> StreamingQuery:
    """Take in what has arrived since the last run, then stop.

    ``steps`` are the same transformations a batch job uses. A batch that is replayed
    after a crash between write and commit is stored once: with ``merge_keys`` it is
    upserted again; with ``batch_column`` the table is partitioned by the batch
    number first, and a batch replaces its own partition; with neither its files are
    known by their names (``append_once``; plain file tables). ``job_id`` names the
    query, so that a ``LedgerListener`` on the session records each batch.
    """
    if job_id:
        stream = stream.observe("taken", F.count(F.lit(1)).alias("n"))
    shaped = steps(stream)
    schema = shaped.schema
    if job_id:
        shaped = shaped.observe("stored", F.count(F.lit(1)).alias("n"))
    if batch_column:
        partition_by = [batch_column, *(partition_by or [])]
        schema = T.StructType([*schema.fields, T.StructField(batch_column, T.LongType())])
    create_table(stream.sparkSession, table, schema, partition_by)
    begun: list[str] = []

    def store(batch: DataFrame, number: int) -> None:
        if merge_keys:
            merge_into(batch, table, merge_keys, sequence=sequence)
        elif batch_column:
            overwrite_partitions(batch.withColumn(batch_column, F.lit(number).cast("bigint")), table)
        else:
            first = not begun
            if first:
                begun.append(_stream_id(batch.sparkSession, checkpoint))
            append_once(batch, table, begun[0], number, in_doubt=first)

    writer = shaped.writeStream.queryName(job_id) if job_id else shaped.writeStream
    return writer.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
