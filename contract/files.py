"""File scans: tables written out as files of each kind, read back through the sources."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from contract.base import RUN_TIME, RUN_TIME_SQL, fresh_database, load, query
from contract.damage import damage
from contract.workbooks import workbook_writer
from millrace.session import new_folder
from millrace.sources.files import file_inventory, read_files
from millrace.streaming.intake import LedgerListener, load_available, stream_files


@query(
    "file_union_lineage",
    f"""
    SELECT p_partkey, p_name, CASE WHEN p_size <= 25 THEN p_brand END AS p_brand, CAST(p_size AS BIGINT) AS p_size,
           p_retailprice,
           CASE WHEN p_size <= 25 THEN 'csv' ELSE 'tsv' END AS kind, {RUN_TIME_SQL} AS ingestion_time
    FROM part
    """,
)
def file_union_lineage(spark, sf_dir):
    part, folder = load(spark, sf_dir, "part"), new_folder(spark, "mixed-text")
    small = part.filter("p_size <= 25").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    large = part.filter("p_size > 25").select("p_size", "p_partkey", "p_retailprice", "p_name")
    small.write.option("header", True).csv(f"{folder}/a")
    large.write.options(header=True, sep="\t", extension="tsv").csv(f"{folder}/b")
    read = read_files(
        spark, f"{folder}/*", "*", options={"dtype": {"p_name": "str", "p_brand": "str"}}, lineage_time=RUN_TIME
    )
    return read.withColumn("kind", F.substring_index("source_file", ".", -1)).drop("source_file", "source_path")


@query(
    "file_layouts",
    """
    SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name END AS c_name, c_acctbal,
           CASE WHEN c_acctbal < 0 THEN c_mktsegment END AS c_mktsegment
    FROM customer
    """,
)
def file_layouts(spark, sf_dir):
    """Files of one kind whose headers differ in columns and order."""
    customer, folder = load(spark, sf_dir, "customer"), new_folder(spark, "layouts")
    customer.filter("c_acctbal >= 0").select("c_custkey", "c_name", "c_acctbal").write.option("header", True).csv(
        f"{folder}/a"
    )
    customer.filter("c_acctbal < 0").select("c_acctbal", "c_custkey", "c_mktsegment").write.option("header", True).csv(
        f"{folder}/b"
    )
    return read_files(spark, f"{folder}/*", "*.csv").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


# A document holds the rows of 500 consecutive unique keys.
_DOC_ROWS = 500


@query(
    "json_document_items",
    "SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part",
)
def json_document_items(spark, sf_dir):
    """Documents of three shapes: a list of objects, an object holding one, a bare object."""
    part, folder = load(spark, sf_dir, "part"), new_folder(spark, "json-docs")
    item = F.struct("p_partkey", "p_name", "p_size", "p_retailprice")
    docs = part.groupBy(F.expr(f"p_partkey div {_DOC_ROWS}").alias("doc")).agg(
        F.to_json(F.collect_list(item)).alias("items")
    )
    wrapped = F.format_string('{"note": "[{1}]", "empty": [], "codes": [1, 2], "items": %s, "more": [{"z": 1}]}', "items")
    text = F.when(F.col("doc") % 2 == 0, F.col("items")).otherwise(wrapped)
    docs.select("doc", text.alias("value")).write.partitionBy("doc").text(folder)
    return read_files(spark, f"{folder}/*", "*", file_type="json")


@query("json_scalar_list", "SELECT c_name AS data FROM customer")
def json_scalar_list(spark, sf_dir):
    customer, folder = load(spark, sf_dir, "customer"), new_folder(spark, "json-lists")
    docs = customer.groupBy(F.expr(f"c_custkey div {_DOC_ROWS}").alias("doc")).agg(
        F.to_json(F.collect_list("c_name")).alias("value")
    )
    docs.write.partitionBy("doc").text(folder)
    return read_files(spark, f"{folder}/*", "*", file_type="json")


@query(
    "json_lines",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def json_lines(spark, sf_dir):
    events, folder = load(spark, sf_dir, "events"), new_folder(spark, "json-lines")
    events.select("event_id", "user_id", "event_type", "value").write.json(folder)
    return read_files(spark, folder, "*.json", options={"lines": True})


@query(
    "xml_items",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS part_key, p_name AS name, CAST(p_size AS VARCHAR) AS size,
           p_brand AS brand FROM part
    """,
)
def xml_items(spark, sf_dir):
    """Elements named by path: attributes as ``<tag>_<attribute>``, children as text."""
    part, folder = load(spark, sf_dir, "part"), new_folder(spark, "xml")
    shaped = part.select(
        F.col("p_partkey").alias("_key"),
        "p_name",
        F.struct(F.col("p_size").alias("_VALUE"), F.lit("cm").alias("_unit")).alias("size"),
        F.array(F.lit("none"), F.col("p_brand")).alias("brand"),
    ).withColumnRenamed("p_name", "name")
    shaped.write.format("xml").options(rootTag="root", rowTag="part").save(folder)
    return read_files(spark, folder, "*", file_type="xml", options={"xpath": "./part"})


@query(
    "xml_root_children",
    "SELECT CAST(s_suppkey AS VARCHAR) AS k, s_name AS n, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier",
)
def xml_root_children(spark, sf_dir):
    """The default path: every child of the root, whatever its tag."""
    supplier, folder = load(spark, sf_dir, "supplier"), new_folder(spark, "xml-any")
    row = supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("n"), F.col("s_nationkey").alias("nation"))
    row.filter("nation < 12").write.format("xml").options(rootTag="root", rowTag="near").save(f"{folder}/a")
    row.filter("nation >= 12").write.format("xml").options(rootTag="root", rowTag="far").save(f"{folder}/b")
    return read_files(spark, f"{folder}/*", "*", file_type="xml")


@query(
    "columnar_round_trip",
    """
    SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice,
           CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
    FROM orders
    """,
)
def columnar_round_trip(spark, sf_dir):
    orders, folder = load(spark, sf_dir, "orders"), new_folder(spark, "columnar")
    columns = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"]
    orders.filter("o_orderstatus = 'O'").select(*columns).write.parquet(f"{folder}/a")
    orders.filter("o_orderstatus = 'P'").select(*columns).write.orc(f"{folder}/b")
    # An older layout without the last column, in the same folder as the first.
    orders.filter("o_orderstatus = 'F'").select(*columns[:-1]).write.mode("append").parquet(f"{folder}/a")
    return read_files(spark, f"{folder}/*").select(*columns)


@query(
    "corrupt_file_skip",
    "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer WHERE c_mktsegment <> 'MACHINERY'",
)
def corrupt_file_skip(spark, sf_dir):
    """One segment's files hold lines with a field too many; those files are dropped whole."""
    customer, folder = load(spark, sf_dir, "customer"), new_folder(spark, "corrupt")
    rows = customer.select("c_custkey", "c_name", "c_nationkey")
    rows.filter(customer.c_mktsegment != "MACHINERY").write.option("header", True).csv(f"{folder}/good")
    broken = rows.filter(customer.c_mktsegment == "MACHINERY").withColumn("c_name", F.concat("c_name", F.lit(",x")))
    broken.write.options(header=True, quote="\u0000").csv(f"{folder}/broken")
    return read_files(spark, f"{folder}/*", "*.csv", skip_errors=True)


@query(
    "delimited_comments",
    """
    SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment FROM customer
    """,
)
def delimited_comments(spark, sf_dir):
    """Two layouts, each file with comment lines and a blank one before its header, and comments between its lines."""
    customer, folder = load(spark, sf_dir, "customer"), new_folder(spark, "comments")
    columns = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    for part, kept in ((0, columns), (1, columns[2::-1])):
        # One group of consecutive keys is a file's text; lines are put together, so that their order holds.
        lines = customer.filter(F.col("c_custkey") % 2 == part).select(
            F.expr("c_custkey div 500").alias("block"), "c_custkey", F.concat_ws(";", *kept).alias("line"),
        ).groupBy("block").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "line"))).alias("rows"))
        body = F.array_join(F.transform("rows", lambda r: r["line"]), "\n# a remark; with; separators\n")
        text = F.concat(F.lit("#exported\n\n# for; review\n"), F.lit(";".join(kept) + "\n"), body)
        lines.select(text.alias("value"), "block").repartition("block").write.partitionBy("block").text(f"{folder}/{part}")
    return read_files(
        spark, f"{folder}/*/*", "*.txt", options={"delimiter": ";", "comment": "#", "dtype": {"c_name": "str", "c_mktsegment": "str"}}
    )


@query(
    "columnar_widening",
    """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line_no, CAST(l_quantity AS DOUBLE) AS quantity,
           CASE WHEN l_linenumber % 3 <> 2 THEN l_returnflag END AS l_returnflag
    FROM lineitem
    """,
)
def columnar_widening(spark, sf_dir):
    """Parquet and ORC files that hold a column as int, bigint or double, and of which some lack a column."""
    lineitem, folder = load(spark, sf_dir, "lineitem"), new_folder(spark, "widths")
    layouts = ((0, "parquet", "int", "int"), (1, "parquet", "bigint", "double"), (2, "parquet", "int", "bigint"), (0, "orc", "bigint", "int"), (1, "orc", "int", "double"))
    for part, fmt, line, quantity in layouts:
        mine = lineitem.filter((F.col("l_linenumber") % 3 == part) & ((F.col("l_orderkey") % 2 == 0) == (fmt == "parquet") if part < 2 else F.lit(True)))
        mine.select(
            "l_orderkey", F.col("l_linenumber").cast(line).alias("line_no"), F.col("l_quantity").cast(quantity).alias("quantity"),
            *(["l_returnflag"] if part < 2 else []),
        ).write.format(fmt).save(f"{folder}/{fmt}-{part}")
    return read_files(spark, f"{folder}/*")


@query("corrupt_columnar_skip", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment NOT IN ('MACHINERY', 'BUILDING')")
def corrupt_columnar_skip(spark, sf_dir):
    """Parquet and ORC files of which one segment's are damaged in the last row group, or stripe: those are dropped whole."""
    customer, folder = load(spark, sf_dir, "customer"), new_folder(spark, "damaged")
    for fmt, odd in (("parquet", 1), ("orc", 0)):
        mine = customer.filter(F.col("c_custkey") % 2 == odd).select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
        mine.write.options(**{"parquet.block.size": 4096, "parquet.block.size.row.check.min": 20}).format(fmt).partitionBy(
            "c_mktsegment").save(f"{folder}/{fmt}")
        for segment in ("MACHINERY", "BUILDING"):
            files = spark.read.format("binaryFile").load(f"{folder}/{fmt}/c_mktsegment={segment}").select("path")
            files.mapInArrow(damage(fmt), "path string").write.format("noop").mode("overwrite").save()
    return read_files(spark, f"{folder}/*/*", skip_errors=True)


@query(
    "file_inventory",
    "SELECT c_mktsegment AS segment, count(*) AS row_count FROM customer GROUP BY c_mktsegment",
)
def file_inventory_query(spark, sf_dir):
    """Inventory rows matched, by folder, name and size, with the files the rows of a scan come from."""
    folder = new_folder(spark, "inventory")
    load(spark, sf_dir, "customer").write.partitionBy("c_mktsegment").parquet(folder)
    listed = file_inventory(spark, f"{folder}/*", "*.parquet")
    scanned = (
        spark.read.parquet(folder)
        .groupBy(
            F.regexp_replace(F.regexp_replace("_metadata.file_path", "/[^/]*$", ""), "^file:/+", "/").alias("path"),
            F.col("_metadata.file_name").alias("filename"),
            F.col("_metadata.file_size").alias("size"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    matched = listed.join(scanned, ["path", "filename", "size"])
    return matched.groupBy(F.regexp_extract("path", "=([^/]*)$", 1).alias("segment")).agg(F.sum("n").alias("row_count"))


@query(
    "workbook_rows",
    "SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_acctbal < 0 THEN 'debt' END AS note FROM customer",
)
def workbook_rows(spark, sf_dir):
    """Workbooks of 500 consecutive customers each, read back by sheet name and header row."""
    folder = new_folder(spark, "workbooks")
    row = F.struct(
        "c_custkey", F.col("c_name"), F.col("c_acctbal").cast("string").alias("bal"),
        F.when(F.col("c_acctbal") < 0, "debt").alias("note"),
    )
    books = load(spark, sf_dir, "customer").groupBy(F.expr(f"c_custkey div {_DOC_ROWS}").alias("book")).agg(
        F.array_sort(F.collect_list(row)).alias("rows")
    )
    # Written by the tasks themselves; a task that runs again writes the same file again.
    books.mapInArrow(workbook_writer(folder), "path string").write.format("noop").mode("overwrite").save()
    return read_files(
        spark, folder, "*.xlsx",
        options={"sheet_name": "customers", "header": 0, "skiprows": 1, "dtype": {"c_name": "str", "note": "str"}},
    )


def _event_files(spark, sf_dir, folder):
    """Events as files in two rounds, the second with later file times; returns the cut between."""
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    events.filter("ts < '2024-01-15'").write.mode("append").parquet(folder)
    yield file_inventory(spark, folder, "*.parquet").agg(F.max("modified")).first()[0]
    time.sleep(1.1)
    events.filter("ts >= '2024-01-15'").write.mode("append").parquet(folder)
    yield None


@query(
    "incremental_files",
    "SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-15'",
)
def incremental_files(spark, sf_dir):
    """Only files newer than the last run's mark."""
    folder = new_folder(spark, "incremental")
    rounds = _event_files(spark, sf_dir, folder)
    cut = next(rounds)
    next(rounds)
    return read_files(spark, folder, "*.parquet", modified_after=cut)


@query(
    "stream_intake",
    "SELECT event_id, ts, user_id, event_type, value * 2 AS doubled FROM events WHERE event_type <> 'error'",
)
def stream_intake(spark, sf_dir):
    """The same folder taken in by two runs of an available-now stream."""
    folder, table = new_folder(spark, "intake"), f"{fresh_database(spark)}.events"
    mark = new_folder(spark, "intake-mark")
    rounds = _event_files(spark, sf_dir, folder)
    for _ in rounds:
        stream = stream_files(
            spark, folder, "parquet",
            "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double", "*.parquet",
        )
        load_available(
            stream, table, mark,
            lambda df: df.filter("event_type <> 'error'").select(
                "event_id", "ts", "user_id", "event_type", (F.col("value") * 2).alias("doubled")
            ),
        ).awaitTermination()
    return spark.table(table)


_EVENT_FIELDS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def _forget_commit(spark, checkpoint: str) -> None:
    """Make a checkpoint that of a run which crashed after storing its last batch and before saying so."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    newest = max((f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().isdigit()), key=lambda p: int(p.getName()))
    fs.delete(newest, False)


@query("stream_replay", "SELECT event_id, user_id, event_type FROM events")
def stream_replay(spark, sf_dir):
    """A batch that was stored but not committed is run again, without keys or a batch column: no row comes twice."""
    folder, table = new_folder(spark, "replay"), f"{fresh_database(spark)}.events"
    mark = new_folder(spark, "replay-mark")
    for _ in _event_files(spark, sf_dir, folder):
        for crashed in (True, False):
            stream = stream_files(spark, folder, "parquet", _EVENT_FIELDS, "*.parquet").select("event_id", "user_id", "event_type")
            load_available(stream, table, mark, partition_by=["event_type"]).awaitTermination()
            if crashed:
                _forget_commit(spark, mark)
    return spark.table(table)


@query(
    "stream_run_ledger",
    """
    SELECT 'events-intake' AS job_id, 'success' AS status, count(*) AS rows_processed,
           count(*) FILTER (event_type <> 'error') AS rows_loaded
    FROM events GROUP BY ts < TIMESTAMP '2024-01-15'
    """,
)
def stream_run_ledger(spark, sf_dir):
    """A stream's batches as runs in the ledger, with the rows taken in and those stored."""
    folder, database = new_folder(spark, "observed"), fresh_database(spark)
    mark = new_folder(spark, "observed-mark")
    listener = LedgerListener(spark, f"{database}.runs")
    spark.streams.addListener(listener)
    try:
        for _ in _event_files(spark, sf_dir, folder):
            stream = stream_files(spark, folder, "parquet", _EVENT_FIELDS, "*.parquet")
            load_available(
                stream, f"{database}.events", mark, lambda df: df.filter("event_type <> 'error'"), job_id="events-intake"
            ).awaitTermination()
        # Progress is told from a queue of its own.
        spark._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(listener)
    return spark.table(f"{database}.runs").select("job_id", "status", "rows_processed", "rows_loaded")


@query(
    "xml_nested_path",
    "SELECT CAST(s_suppkey AS VARCHAR) AS k, s_name AS n FROM supplier",
)
def xml_nested_path(spark, sf_dir):
    """The same tag under two parents, and a root tag that also occurs deeper: only elements at the path are rows."""
    supplier, folder = load(spark, sf_dir, "supplier"), new_folder(spark, "xml-nested")
    item = F.struct(F.col("s_suppkey").alias("k"), F.col("s_name").alias("n"))
    supplier.select(
        F.struct(item.alias("item")).alias("wanted"), F.struct(item.alias("item"), F.lit("x").alias("root")).alias("other")
    ).write.format("xml").options(rootTag="root", rowTag="row").save(folder)
    return read_files(spark, folder, "*", file_type="xml", options={"xpath": "/root/row/wanted/item"})
