"""Stored tables: create, append, replace, partition overwrite, merge, delete.

A table is a catalog table. Formats with their own row-level commands (``iceberg``,
``delta``) use them. Plain file tables (``parquet``, ``orc``) have none: replacing,
merging and deleting write the new state to a fresh folder and then point the table
at it, so a failed job leaves the old state in place and a job may read the table
it is writing. Nothing of the old state is dropped before the new one is in place:
a table that is set up anew takes the name in two renames, and partitions are
repointed from a list that is stored first. What a crash in between leaves is
finished, or undone, by the next access.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.merge import merge, new_rows, one_row_per_key
from millrace.operators.register import REGISTER_TABLE_DDL
from millrace.session import observed, settle, sized

ROW_LEVEL_FORMATS = ("iceberg", "delta")
REGISTER_PARTITIONS = ["days(transaction_date)"]

# Fixed value: the columns of a table created with neither schema nor data.
DEFAULT_TABLE_DDL = "source STRING, data_timestamp TIMESTAMP_NTZ, ingestion_timestamp TIMESTAMP_NTZ"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


_DAYS = re.compile(r"days\((\w+)\)")


def day_column(partition: str) -> tuple[str, str] | None:
    """For a ``days(x)`` partition: the column x, and the derived day column of a file table."""
    found = _DAYS.fullmatch(partition)
    return (found[1], f"{found[1]}_day") if found else None


def with_days(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Add the derived day columns a file table is partitioned by."""
    days = [d for d in map(day_column, partition_by) if d]
    return df.withColumns({day: F.col(f"`{ts}`").cast("date") for ts, day in days}) if days else df


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType | str | DataFrame | None = None,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
) -> bool:
    """Create the table (and its database) if absent; True if it was created.

    Columns come from a ``StructType``, a DDL text or the data about to be stored;
    without any of them the three default columns are used. A partition is a column
    or ``days(column)``; a plain file table has no day transform, so there the day
    becomes a column ``<column>_day`` of its own.
    """
    if table_exists(spark, table):
        return False
    if "." in table:
        create_database(spark, table.rsplit(".", 1)[0])
    if isinstance(schema, DataFrame):
        schema = schema.schema
    fields = T.StructType.fromDDL(schema or DEFAULT_TABLE_DDL) if not isinstance(schema, T.StructType) else schema
    columns = {f.name: f.dataType.simpleString() for f in fields.fields}
    days, where = [], ""
    if fmt not in ROW_LEVEL_FORMATS:
        days = [(day, ts) for ts, day in filter(None, map(day_column, partition_by or ()))]
        columns.update({day: "date" for day, _ in days})
        partition_by = [found[1] if (found := day_column(p)) else p for p in partition_by or ()]
        # A folder of its own: dropping or repointing the table never deletes a state.
        where = f" LOCATION '{_first_state(spark, table)}'"
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING {fmt}{parts}{where}{_properties({_DAYS_KEPT: json.dumps(days)} if days else {})}")
    return True


_DAYS_KEPT, _PENDING = "millrace.days", "millrace.pending"


def _properties(values: Mapping[str, str]) -> str:
    return f" TBLPROPERTIES ({', '.join(f'{_text(k)} = {_text(v)}' for k, v in values.items())})" if values else ""


def _text(value: str) -> str:
    """A SQL text literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _first_state(spark: SparkSession, table: str) -> str:
    database, _, name = table.rpartition(".")
    base = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri.rstrip("/")
    return f"{base}/{name}__states/__state-{uuid.uuid4().hex}"


def _stored_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def stored_days(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    """The table's derived day columns, each with the column it comes from."""
    return [tuple(x) for x in json.loads(_stored_properties(spark, table).get(_DAYS_KEPT, "[]"))]


def recover(spark: SparkSession, table: str) -> None:
    """Finish or undo a change of state that was cut short; does nothing otherwise."""
    old, following = f"{table}__old", f"{table}__next"
    if not table_exists(spark, table):
        if table_exists(spark, old):
            # Between the renames: the new state is complete if it is there.
            source = following if table_exists(spark, following) else old
            spark.sql(f"ALTER TABLE {source} RENAME TO {table}")
        else:
            return
    if table_exists(spark, old):
        spark.sql(f"DROP TABLE {old}")
    if table_exists(spark, following):
        spark.sql(f"DROP TABLE {following}")
    pending = _stored_properties(spark, table).get(_PENDING)
    if pending:
        _repoint(spark, table, pending)


def create_register_table(spark: SparkSession, table: str, fmt: str = "parquet") -> bool:
    """The fixed insider-trading table, partitioned by day of the transaction."""
    return create_table(spark, table, REGISTER_TABLE_DDL, REGISTER_PARTITIONS, fmt)


def load_register(df: DataFrame, table: str) -> int:
    """Append transformed register records; columns the table lacks are left out."""
    known = df.sparkSession.table(table).columns
    df = with_days(df, REGISTER_PARTITIONS)
    return append(df.select(*[c for c in df.columns if c in known]), table)


def _format(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Provider'").head(1)
    return rows[0]["data_type"].lower() if rows else "parquet"


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").head(1)
    return rows[0]["data_type"].rstrip("/")


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _aligned(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the table's columns in the table's order: absent ones NULL, unknown ones an error.

    Derived days are always those of the columns they come from.
    """
    target = df.sparkSession.table(table).schema
    df = _with_stored_days(df, table)
    unknown = sorted(set(df.columns) - set(target.names))
    if unknown:
        raise ValueError(f"table {table} has no columns {unknown}")
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def _with_stored_days(df: DataFrame, table: str) -> DataFrame:
    days = {day: ts for day, ts in stored_days(df.sparkSession, table) if ts in df.columns}
    return df.withColumns({day: F.col(f"`{ts}`").cast("date") for day, ts in days.items()}) if days else df


def _clustered(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Gather rows by output partition, so a day is a few files and not one per task.

    ``rebalance`` lets AQE split a day that holds most of the rows and join small ones.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def append(df: DataFrame, table: str) -> int:
    """Add rows; returns how many, counted during the write."""
    spark = df.sparkSession
    recover(spark, table)
    # Counted after the shuffle: a map task that runs again is not counted twice.
    rows, seen = _counted(_clustered(_aligned(df, table), _partition_columns(spark, table)))
    rows.write.insertInto(table)
    return observed(seen, "rows") or 0


def replace(df: DataFrame, table: str) -> int:
    """Make ``df`` the table's whole content; the table's columns stay as declared."""
    spark = df.sparkSession
    recover(spark, table)
    rows = _aligned(df, table)
    fmt = _format(spark, table)
    if fmt not in ROW_LEVEL_FORMATS:
        return _swap(rows, table, fmt)
    rows, seen = _counted(rows)
    rows.writeTo(table).overwrite(F.lit(True))
    return observed(seen, "rows") or 0


def _fresh_state(spark: SparkSession, table: str) -> str:
    current = _location(spark, table)
    base = current.rsplit("/", 1)[0] if "/__state-" in current else current + "__states"
    return f"{base}/__state-{uuid.uuid4().hex}"


def _swap(rows: DataFrame, table: str, fmt: str) -> int:
    """Write the new state beside the old one, then repoint the table; returns the rows written.

    The superseded folder is left to readers that still use it and to ``expire_states``.
    """
    spark = rows.sparkSession
    partition_by = _partition_columns(spark, table)
    fresh = _fresh_state(spark, table)
    counted, seen = _counted(_clustered(rows, partition_by))
    writer = counted.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(fresh)
    if partition_by:
        # Partitions carry their own locations, so the table is set up anew over the
        # written folder and takes the old one's name.
        following, old = f"{table}__next", f"{table}__old"
        spark.sql(f"CREATE TABLE {following} LIKE {table} USING {fmt} LOCATION '{fresh}'")
        kept = {k: v for k, v in _stored_properties(spark, table).items() if not k.startswith(("transient", "spark.", "view."))}
        if kept:
            spark.sql(f"ALTER TABLE {following} SET{_properties(kept)}")
        comment = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Comment'").head(1)
        if comment:
            spark.sql(f"COMMENT ON TABLE {following} IS {_text(comment[0]['data_type'])}")
        spark.sql(f"ALTER TABLE {following} RECOVER PARTITIONS")
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
        spark.sql(f"DROP TABLE {old}")
    else:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
    spark.catalog.refreshTable(table)
    return observed(seen, "rows") or 0


def expire_states(spark: SparkSession, table: str) -> list[str]:
    """Folders of states that neither the table nor a partition of it points at any more, for the owner to remove.

    They are only named: readers that began before the last change may still use them.
    """
    base = _location(spark, table).rsplit("/", 1)[0]
    used = {_location(spark, table)}
    if _partition_columns(spark, table):
        found = spark.table(table).select(F.regexp_extract("_metadata.file_path", r"^(.*/__state-[0-9a-f]+)", 1)).distinct()
        used |= {unquote(r[0]) for r in found.collect()}  # a row per state
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    there = [f.getPath().toString() for f in fs.listStatus(path)] if fs.exists(path) else []
    plain = lambda x: re.sub(r"^\w+:/+", "/", x)  # noqa: E731  a location may or may not name its file system
    kept = {plain(u) for u in used}
    return [f for f in there if "/__state-" in f and not f.endswith(("__pending", "__touched")) and plain(f) not in kept]


def write_table(df: DataFrame, table: str, mode: str = "append", partition_by=None, fmt: str = "parquet", **kw) -> int:
    """Store ``df`` by mode. Modes that differ when the table exists are decided before creating it."""
    spark = df.sparkSession
    recover(spark, table)
    existed = table_exists(spark, table)
    if mode == "ignore" and existed:
        return 0
    if mode in ("error", "errorifexists") and existed:
        raise ValueError(f"table {table} exists")
    if partition_by and fmt not in ROW_LEVEL_FORMATS:
        df = with_days(df, partition_by)
    create_table(spark, table, df, partition_by, fmt)
    if mode in ("append", "ignore", "error", "errorifexists"):
        return append(df, table)
    if mode in ("replace", "overwrite"):
        return replace(df, table)
    if mode == "overwrite_partition":
        return overwrite_partitions(df, table)
    if mode == "merge":
        return merge_into(df, table, **kw)
    raise ValueError(f"unknown write mode {mode!r}")


def overwrite_partitions(df: DataFrame, table: str) -> int:
    """Replace exactly the partitions that ``df`` has rows for."""
    spark = df.sparkSession
    recover(spark, table)
    rows = _aligned(df, table)
    if _format(spark, table) in ROW_LEVEL_FORMATS:
        rows, seen = _counted(rows)
        rows.writeTo(table).overwritePartitions()
        return observed(seen, "rows") or 0
    partition_by = _partition_columns(spark, table)
    if not partition_by:
        raise ValueError(f"table {table} has no partitions")
    return _rewrite_partitions(rows, table, _format(spark, table), partition_by)


# --- rewriting some partitions of a file table ----------------------------------------------

# Values up to this number are named in the filter of a scan.
MOST_NAMED = 1000


def _only_touched(target: DataFrame, touched: DataFrame, partition_by: list[str]) -> DataFrame:
    """The rows of the touched partitions, any number of them, NULL included.

    Few values of a partition column are named, so the scan leaves out other folders; beyond ``MOST_NAMED`` the join
    prunes them while it runs. Which combinations are meant is a semi join.
    """
    schema, bounds, same = target.schema, F.lit(True), F.lit(True)
    for c in partition_by:
        values = [r[0] for r in touched.select(F.col(c)).distinct().sort(F.asc_nulls_first(c)).limit(MOST_NAMED + 1).collect()]
        if len(values) <= MOST_NAMED:
            some = F.col(f"`{c}`").isin(*[F.lit(v).cast(schema[c].dataType) for v in values if v is not None])
            bounds = bounds & (some | F.col(f"`{c}`").isNull() if None in values else some)
        # Pruning at run time knows plain equality only.
        named = F.col(f"__{c}")
        same = same & (F.col(f"`{c}`").eqNullSafe(named) if None in values else F.col(f"`{c}`") == named)
    keys = touched.select(*[F.col(c).alias(f"__{c}") for c in partition_by])
    # A condition that always holds: Spark prunes at run time only by a side that has a filter.
    keys = keys.filter(F.xxhash64(*keys.columns) >= -(1 << 63))
    return target.filter(bounds).join(keys, same, "left_semi")


def _rewrite_partitions(
    rows: DataFrame, table: str, fmt: str, partition_by: list[str], touched: DataFrame | None = None
) -> int:
    """Make ``rows`` the whole content of the partitions they belong to and of those in ``touched``; returns the rows written.

    The new state goes to a fresh folder; then the table is told of it, and the partitions are repointed to what the
    folder holds, or dropped when no row of a touched one is left. Untouched partitions are not read.
    """
    spark = rows.sparkSession
    fresh = _fresh_state(spark, table)
    counted, seen = _counted(_clustered(rows, partition_by))
    counted.write.format(fmt).partitionBy(*partition_by).save(fresh)
    if touched is not None:
        touched.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in partition_by]).write.parquet(f"{fresh}__touched")
    values = {_PENDING: json.dumps({"state": fresh, "format": fmt, "touched": touched is not None})}
    spark.sql(f"ALTER TABLE {table} SET{_properties(values)}")
    _repoint(spark, table, values[_PENDING])
    return observed(seen, "rows") or 0


def _moves(spark: SparkSession, table: str, partition_by: list[str], pending: str) -> DataFrame:
    """Where each partition is to point: ``(partition columns as text, __folder)``, NULL for those to drop."""
    try:
        told = json.loads(pending)
    except ValueError:
        return spark.read.parquet(pending)  # a list, as it was stored before
    texts = [F.col(f"`{c}`").cast("string").alias(c) for c in partition_by]
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]*$", 1).alias("__folder")
    state = spark.read.schema(spark.table(table).schema).format(told["format"]).load(told["state"])
    moves = state.select(*texts, folder).distinct()
    if not told["touched"]:
        return moves
    gone = spark.read.parquet(f"{told['state']}__touched").withColumn("__folder", F.lit(None).cast("string"))
    return moves.unionByName(gone).groupBy(*partition_by).agg(F.max("__folder").alias("__folder"))


def _repoint(spark: SparkSession, table: str, pending: str) -> None:
    """Point partitions at a new state, as the table was told; doing it again changes nothing."""
    partition_by = _partition_columns(spark, table)
    there = {unquote(r[0]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    added, dropped = [], []
    for row in _moves(spark, table, partition_by, pending).toLocalIterator():  # partition metadata
        spec = ", ".join(f"`{c}` = {'NULL' if row[c] is None else _text(row[c])}" for c in partition_by)
        known = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if row[c] is None else row[c]}" for c in partition_by) in there
        where = None if row["__folder"] is None else _text(unquote(row["__folder"]))
        if where is None:
            dropped.append(f"PARTITION ({spec})")
        elif known:
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {where}")
        else:
            added.append(f"PARTITION ({spec}) LOCATION {where}")
    for i in range(0, len(added), 200):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added[i:i + 200])}")
    for i in range(0, len(dropped), 200):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(dropped[i:i + 200])}")
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{_PENDING}')")
    spark.catalog.refreshTable(table)


def merge_into(
    df: DataFrame,
    table: str,
    merge_keys: list[str],
    on_conflict: str = "update",
    sequence: str | None = None,
) -> int:
    """Upsert ``df`` into the table by key; returns the rows taken in (added, for ``nothing``).

    In a partitioned file table only the partitions that the batch touches are rewritten.
    """
    spark = df.sparkSession
    if not merge_keys:
        raise ValueError("merge needs keys")
    recover(spark, table)
    target = spark.table(table)
    # A merge reads its batch several times: what it takes in is computed and counted once.
    counted, seen = _counted(_with_stored_days(df, table))
    batch = settle(counted, "merge-batch")
    if on_conflict in ("nothing", "ignore"):
        # Existing rows stay as they are, so only new rows are written.
        return append(new_rows(target, batch, merge_keys, sequence), table)
    fmt = _format(spark, table)
    partition_by = _partition_columns(spark, table)
    if fmt in ROW_LEVEL_FORMATS:
        _native_merge(batch, table, merge_keys, sequence)
    elif not partition_by:
        _swap(_aligned(merge(target, batch, merge_keys, on_conflict, sequence), table), table, fmt)
    else:
        touched = settle(_merge_partitions(target, batch, merge_keys, partition_by), "touched")
        old = _only_touched(target, touched, partition_by)
        merged = _aligned(merge(old, batch, merge_keys, on_conflict, sequence), table)
        _rewrite_partitions(merged, table, fmt, partition_by, touched)
    return observed(seen, "rows") or 0


def _merge_partitions(target, batch, keys, partition_by) -> DataFrame:
    """Partitions a merge changes: those holding a key of the batch, and those it writes to.

    New rows of a batch without a partition column go to NULL, so that one counts, too.
    """
    keyed = batch.select(*keys)
    for k in keys:
        keyed = keyed.filter(F.col(f"`{k}`").isNotNull())
    hit = target.select(*dict.fromkeys([*keys, *partition_by])).join(
        sized(keyed.distinct(), "merge-keys"), keys, "left_semi"
    ).select(*partition_by)
    aimed = batch.select(*[
        (F.col(f"`{c}`") if c in batch.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in partition_by
    ])
    return hit.unionByName(aimed).distinct()


def _native_merge(df: DataFrame, table: str, keys: list[str], sequence: str | None) -> None:
    """Row-level merge by the table format. Needs the format's package on the session."""
    known = df.sparkSession.table(table).columns
    null_key = " OR ".join(f"`{k}` IS NULL" for k in keys)
    batch = one_row_per_key(df.filter(f"NOT ({null_key})"), keys, [sequence] if sequence else None)
    batch = batch.unionByName(df.filter(null_key)).select(*[c for c in df.columns if c in known])
    same = [F.col(f"t.{k}") == F.col(f"b.{k}") for k in keys]
    on = same[0]
    for cond in same[1:]:
        on = on & cond
    (
        batch.alias("b")
        .mergeInto(f"{table} AS t", on)
        .whenMatched()
        .update({c: F.col(f"b.{c}") for c in batch.columns if c not in keys})
        .whenNotMatched()
        .insert({c: F.col(f"b.{c}") for c in batch.columns})
        .merge()
    )


def delete_rows(
    spark: SparkSession, table: str, condition: str | None = None, params: Mapping[str, Any] | None = None
) -> int:
    """Delete the rows a condition with named binds holds for; all rows without one.

    Returns how many. The content is read once, to write the kept rows. A row for which the
    condition is NULL stays.
    """
    recover(spark, table)
    fmt = _format(spark, table)
    if fmt in ROW_LEVEL_FORMATS:
        where = f" WHERE {condition}" if condition is not None else ""
        doomed = spark.sql(f"SELECT count(*) FROM {table}{where}", args=dict(params or {})).first()[0]
        spark.sql(f"DELETE FROM {table}{where}", args=dict(params or {}))
        return doomed
    target = spark.table(table)
    if condition is None:
        gone = target.count()
        _swap(target.limit(0), table, fmt)
        return gone
    partition_by, touched = _partition_columns(spark, table), None
    if partition_by:
        doomed = spark.sql(f"SELECT * FROM {{t}} WHERE {condition}", args=dict(params or {}), t=target)
        touched = settle(doomed.select(*partition_by).distinct(), "touched")
        target = _only_touched(target, touched, partition_by)
    # Numbers of rows come from the files' footers: what is gone is what was there and has not been written again.
    before = target.count()
    kept = spark.sql(f"SELECT * FROM {{t}} WHERE NOT coalesce({condition}, false)", args=dict(params or {}), t=target)
    if touched is None:
        return before - _swap(kept, table, fmt)
    return before - _rewrite_partitions(kept, table, fmt, partition_by, touched)
