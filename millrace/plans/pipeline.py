"""A job as one declared plan: source → steps → checks → sink, with a ledger entry.

The spec is a mapping with the keys ``source``, ``transformer``, ``loader``,
``monitoring`` and ``metadata``. Sources, transformers and loaders are looked up by
name; names are case-insensitive and users may register their own.
"""

from __future__ import annotations

import copy
import os
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.coerce import DATE_FORMATS, convert_types, fill_missing
from millrace.functions.names import clean_column_names, rename_present
from millrace.operators.checks import is_valid, validate
from millrace.operators.register import (
    REGISTER_CRITICAL,
    REGISTER_REQUIRED,
    REGISTER_TYPES,
    default_window,
    search_register,
    transform_register,
)
from millrace.operators.steps import apply_steps
from millrace.plans.ledger import last_success, record_alerts, record_run, run_alerts
from millrace.session import observed, settle
from millrace.sinks import jdbc as jdbc_sink
from millrace.sinks.tables import stored_days, table_exists, write_table
from millrace.sources.files import read_files
from millrace.sources.html import read_items, read_table_pages
from millrace.sources.lists import read_listed_items, read_listed_tables
from millrace.sources.payloads import DEFAULT_LIMIT, explode_items, take_pages, with_items
from millrace.sources.tables import catalog_table, extract_table, jdbc_query, jdbc_table, run_sql

Source = Callable[[SparkSession, dict, datetime], DataFrame]
Transformer = Callable[[DataFrame, dict, datetime], DataFrame]
Loader = Callable[[DataFrame, dict], int]
Checks = Callable[[DataFrame, dict], DataFrame]  # a report as `validate` gives it


# --- spec helpers ---------------------------------------------------------------------------


def deep_merge(base: Mapping[str, Any], overrides: Mapping[str, Any]) -> dict[str, Any]:
    """A new spec with ``overrides`` merged in; the base is left as it was."""
    out = copy.deepcopy(dict(base))
    for key, value in overrides.items():
        if isinstance(value, Mapping) and isinstance(out.get(key), Mapping):
            out[key] = deep_merge(out[key], value)
        else:
            out[key] = copy.deepcopy(value)
    return out


_VARIABLE = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}")


def resolve_variables(value: Any, variables: Mapping[str, str] | None = None) -> Any:
    """Fill ``${NAME}`` and ``${NAME:-default}`` in all texts of a spec; an unset name is an error."""
    names = os.environ if variables is None else variables

    def fill(found: re.Match) -> str:
        name, default = found.groups()
        if name in names:
            return str(names[name])
        if default is None:
            raise KeyError(f"variable {name} is not set")
        return default

    if isinstance(value, str):
        return _VARIABLE.sub(fill, value)
    if isinstance(value, Mapping):
        return {k: resolve_variables(v, variables) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [resolve_variables(v, variables) for v in value]
    return value


def as_frame(spark: SparkSession, data: Any, schema: str | None = None) -> DataFrame:
    """A DataFrame as is; a list of dicts or one dict as rows, absent keys NULL; else an empty table."""
    if isinstance(data, DataFrame):
        return data
    rows = [data] if isinstance(data, Mapping) else data
    if not isinstance(rows, (list, tuple)) or not rows or not all(isinstance(r, Mapping) for r in rows):
        return spark.createDataFrame([], schema or T.StructType([]))
    names = list(dict.fromkeys(k for r in rows for k in r))
    if schema:
        names = T.StructType.fromDDL(schema).names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema or names)


# --- registries -----------------------------------------------------------------------------

_sources: dict[str, Source] = {}
_transformers: dict[str, Transformer] = {}
_checks: dict[str, Checks] = {}
_loaders: dict[str, Loader] = {}


def register_source(name: str, read: Source) -> None:
    _sources[name.lower()] = read


def register_transformer(name: str, transform: Transformer, checks: Checks | None = None) -> None:
    """``checks`` judges what the transformer made, in place of the checks that the spec declares."""
    _transformers[name.lower()] = transform
    _checks.pop(name.lower(), None)
    if checks is not None:
        _checks[name.lower()] = checks


def register_loader(name: str, load: Loader) -> None:
    _loaders[name.lower()] = load


def _named(registry: dict, kind: str, name: str):
    try:
        return registry[name.lower()]
    except KeyError:
        raise ValueError(f"unknown {kind} {name!r}; known: {sorted(registry)}") from None


# --- sources --------------------------------------------------------------------------------


def _file_source(file_type: str | None) -> Source:
    def read(spark: SparkSession, cfg: dict, run_time: datetime) -> DataFrame:
        after = None
        if cfg.get("incremental"):
            after = cfg.get("modified_after") or _last_start(spark, cfg, run_time)
        return read_files(
            spark,
            cfg["source_path"],
            cfg.get("file_pattern", "*"),
            cfg.get("file_type") or file_type,
            cfg.get("file_options"),
            cfg.get("encoding", "utf-8"),
            run_time if cfg.get("add_file_metadata") else None,
            cfg.get("skip_errors", False),
            after,
        )

    return read


def _last_start(spark: SparkSession, cfg: dict, run_time: datetime) -> datetime | None:
    """The start of the job's last success. Without one everything is read, unless the spec gives ``first_days``."""
    ledger = cfg.get("ledger")
    found = last_success(spark.table(ledger), cfg["job_id"]) if ledger and table_exists(spark, ledger) else None
    if found is None and cfg.get("first_days") is not None:
        return run_time - timedelta(days=cfg["first_days"])
    return found


def _database_source(spark: SparkSession, cfg: dict, run_time: datetime) -> DataFrame:
    url, properties = cfg.get("url"), cfg.get("properties")
    if "query" in cfg:
        if url:
            return jdbc_query(spark, url, cfg["query"], properties, cfg.get("query_params"))
        return run_sql(spark, cfg["query"], cfg.get("query_params"))
    if url:
        name = f"{cfg['schema']}.{cfg['table']}" if cfg.get("schema") else cfg["table"]
        table = jdbc_table(
            spark, url, name, cfg.get("key"), cfg.get("partitions"),
            fetch_rows=cfg.get("batch_size", 10_000), properties=properties,
        )
    else:
        table = catalog_table(spark, cfg["table"], cfg.get("schema"))
    return extract_table(table, cfg.get("columns"), cfg.get("where_clause"), cfg.get("where_params"))


def _bodies(spark: SparkSession, cfg: dict) -> DataFrame:
    """Landed bodies or pages: a catalog table, or a data source that fetches them.

    Fetched bodies are landed in the shared folder first, so that each is fetched once
    however often the plan reads it.
    """
    if cfg.get("format"):
        return settle(spark.read.format(cfg["format"]).options(**cfg.get("options", {})).load(), "landed")
    return spark.table(cfg["table"])


def _api_source(spark: SparkSession, cfg: dict, run_time: datetime) -> DataFrame:
    pages = with_items(_bodies(spark, cfg), cfg.get("body", "body"), cfg.get("data_key", "data"), cfg.get("extract"))
    feed, order = cfg.get("feed", "feed"), cfg.get("order", "page")
    kept = take_pages(
        pages, cfg.get("pagination_strategy", "none"), feed, order, cfg.get("body", "body"),
        cfg.get("limit", DEFAULT_LIMIT), cfg.get("cursor_path", "meta.next_cursor"),
        cfg.get("max_pages"),
    )
    return explode_items(kept, [], cfg["item_schema"]).drop("item_no")


def _scraper_source(spark: SparkSession, cfg: dict, run_time: datetime) -> DataFrame:
    """Records of all landed pages, or, with ``pagination``, of those on their list.

    A list begins where ``first_page`` holds: at ``base_url`` if that is given, else at page 1.
    """
    pages, keep = _bodies(spark, cfg), list(cfg.get("keep", []))
    extraction, paging, html = cfg.get("extraction"), cfg.get("pagination") or {}, cfg.get("html", "html")
    listed = {}
    if paging and paging.get("enabled", True):
        url, feed = cfg.get("url", "url"), cfg.get("feed", "feed")
        first = cfg.get("first_page") or (F.col(url) == cfg["base_url"] if cfg.get("base_url") else "page = 1")
        listed = {
            "first": F.expr(first) if isinstance(first, str) else first, "html": html, "url": url,
            "feed": feed if feed in pages.columns else None, "base_url": cfg.get("base_url"),
            "sequence": cfg.get("sequence"), "max_pages": paging.get("max_pages"),
        }
    if extraction:
        item, fields, table = extraction["item_xpath"], extraction["fields"], extraction.get("table_xpath")
        if listed:
            rows = read_listed_items(pages, item, fields, paging.get("next_page_xpath"), keep, table_path=table, **listed)
        else:
            rows = read_items(pages, item, fields, keep, html, table)
        return rows.drop("item_no", "place")
    if listed:
        rows = read_listed_tables(pages, list(cfg["columns"]), keep, page=cfg.get("page", "page"), **listed)
    else:
        rows = read_table_pages(pages, list(cfg["columns"]), keep, html)
    return rows.drop("row_no", "place")


for _name in ("file", "csv", "excel", "json", "xml", "parquet", "avro", "orc"):
    register_source(_name, _file_source(None if _name == "file" else _name))
for _name in ("database", "db", "postgresql", "mysql", "sqlite", "oracle", "mssql"):
    register_source(_name, _database_source)
for _name in ("api", "rest_api"):
    register_source(_name, _api_source)
for _name in ("web_scraper", "fsa_scraper"):
    register_source(_name, _scraper_source)


# --- transformers ---------------------------------------------------------------------------


def _base(df: DataFrame, cfg: dict, run_time: datetime) -> DataFrame:
    """Clean names if asked, convert types, treat blanks, then the declared steps."""
    if cfg.get("clean_column_names"):
        df = clean_column_names(df)
    if cfg.get("column_mapping"):
        df = rename_present(df, cfg["column_mapping"])
    formats = [cfg["date_format"], *DATE_FORMATS] if cfg.get("date_format") else DATE_FORMATS
    df = convert_types(
        df, cfg.get("date_columns", ()), cfg.get("numeric_columns", ()), cfg.get("boolean_columns", ()), formats
    )
    if cfg.get("handle_missing_values"):
        df = fill_missing(df, cfg["handle_missing_values"])
    return apply_steps(df, cfg.get("transformations", ()))


def _register(df: DataFrame, cfg: dict, run_time: datetime) -> DataFrame:
    """The register's records, searched if the spec says so; ``search_days`` is the window before the run."""
    out = transform_register(df, run_time)
    window = {k: cfg[k] for k in ("start", "end", "issuer", "person") if k in cfg}
    if cfg.get("search_days") is not None:
        start, end = default_window(run_time, cfg["search_days"])
        window = {"start": start, "end": end, **window}
    return search_register(out, **window) if window else out


def _register_checks(df: DataFrame, cfg: dict) -> DataFrame:
    return validate(df, REGISTER_REQUIRED, REGISTER_CRITICAL, REGISTER_TYPES)


register_transformer("base", _base)
register_transformer("fsa", _register, _register_checks)
register_transformer("swedish_fsa", _register, _register_checks)


# --- loaders --------------------------------------------------------------------------------


def _table_loader(fmt: str | None) -> Loader:
    def load(df: DataFrame, cfg: dict) -> int:
        table = ".".join(p for p in (cfg.get("catalog"), cfg.get("database"), cfg["table"]) if p)
        by, extra = cfg.get("partition_by"), {}
        if cfg.get("write_mode") == "merge":
            extra = {
                "merge_keys": cfg.get("merge_keys"),
                "on_conflict": cfg.get("on_conflict", "update"),
                "sequence": cfg.get("sequence"),
            }
        return write_table(
            df, table, cfg.get("write_mode", "append"), [by] if isinstance(by, str) else by,
            fmt or cfg.get("format", "parquet"), **extra,
        )

    return load


def _jdbc_loader(df: DataFrame, cfg: dict) -> int:
    table = f"{cfg['schema']}.{cfg['table']}" if cfg.get("schema") else cfg["table"]
    return jdbc_sink.load(
        df, cfg["url"], table, cfg.get("write_mode", "append"), cfg.get("merge_keys"),
        cfg.get("on_conflict", "update"), cfg.get("sequence"), cfg.get("batch_size", 10_000), cfg.get("properties"),
    )


def _graph_loader(df: DataFrame, cfg: dict) -> int:
    """Vertex or edge tables, stored like any other table."""
    from millrace.operators.graph import edges, vertex_label, vertices

    label = cfg.get("label") or vertex_label(cfg.get("database", "default"), cfg["table"])
    if cfg.get("data_type", "vertex") == "edge":
        shaped = edges(
            df, label, cfg["source_key"], cfg["target_key"], cfg.get("frequency", "SINGLE"), cfg.get("sort_keys")
        )
    else:
        shaped = vertices(df, label, cfg.get("primary_keys"))
    return _table_loader("parquet")(shaped, cfg)


register_loader("table", _table_loader(None))
for _name in ("iceberg", "delta"):
    register_loader(_name, _table_loader(_name))
register_loader("delta_lake", _table_loader("delta"))
for _name in ("postgres", "postgresql", "jdbc"):
    register_loader(_name, _jdbc_loader)
for _name in ("hugegraph", "graph"):
    register_loader(_name, _graph_loader)


# --- run ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class RunResult:
    status: str
    rows_processed: int
    rows_loaded: int
    error: str | None = None
    alerts: tuple[tuple[str, str], ...] = ()  # (rule, message)


def extract(spark: SparkSession, spec: Mapping[str, Any], run_time: datetime) -> DataFrame:
    source = dict(spec["source"])
    source.setdefault("job_id", spec.get("job_id", ""))
    return _named(_sources, "source", source["type"])(spark, source, run_time)


def transform(df: DataFrame, spec: Mapping[str, Any], run_time: datetime) -> DataFrame:
    cfg = dict(spec.get("transformer", {}))
    return _named(_transformers, "transformer", cfg.get("type", "base"))(df, cfg, run_time)


def _is_register(spec: Mapping[str, Any]) -> bool:
    return spec.get("transformer", {}).get("type", "base").lower() in ("fsa", "swedish_fsa")


def required_by(spec: Mapping[str, Any]) -> list[str]:
    return list(REGISTER_REQUIRED if _is_register(spec) else spec.get("transformer", {}).get("required_columns", ()))


def checks(df: DataFrame, spec: Mapping[str, Any]) -> DataFrame:
    """The check report of transformed data, as the spec's transformer declares it."""
    cfg = spec.get("transformer", {})
    own = _checks.get(cfg.get("type", "base").lower())
    if own is not None:
        return own(df, cfg)
    return validate(df, required_by(spec), cfg.get("critical_columns", ()), cfg.get("expected_types", {}))


def run(
    spark: SparkSession,
    spec: Mapping[str, Any],
    run_time: datetime,
    overrides: Mapping[str, Any] | None = None,
    ledger: str | None = None,
    now: Callable[[], datetime] | None = None,
) -> RunResult:
    """Run one job. Rows read and stored are counted during the write, in one pass.

    Structural checks (missing columns) come first and cost nothing; the write
    happens only if they pass and, with ``validate_schema``, the checks hold. What
    replaces stored rows is written only if there are new ones. A failure is recorded
    in the ledger and raised. ``monitoring`` of the spec says which alerts are wanted;
    those that fire are returned and kept beside the ledger, in ``<ledger>_alerts``.
    """
    spec = deep_merge(spec, overrides or {})
    spec = resolve_variables(spec)
    job_id = spec.get("job_id", "job")
    clock = now or (lambda: datetime.now(timezone.utc).replace(tzinfo=None))
    if ledger:
        spec["source"] = {**spec["source"], "ledger": spec["source"].get("ledger", ledger)}
    status, processed, loaded, error, failure, changed = "success", 0, 0, None, None, None
    try:
        raw = extract(spark, spec, run_time)
        if not raw.columns:
            status = "no_data"
        else:
            loader = dict(spec.get("loader", {}))
            loader.setdefault("table", f"data_{job_id}")
            missing = [c for c in required_by(spec) if c not in transform(raw, spec, run_time).columns]
            checked = not missing and spec.get("transformer", {}).get("validate_schema")
            looks = not missing and (checked or loader.get("write_mode") in ("merge", *_REPLACING))
            seen = None if looks and not _can_land(raw) else Observation()
            if seen is not None:
                raw = raw.observe(seen, F.count(F.lit(1)).alias("rows"))
            if looks and seen is not None:
                # More than one look at the rows: the source is read once, to land them. Else the count rides on the write.
                raw = settle(raw.toDF(*[f"c{i}" for i in range(len(raw.columns))]), "landed").toDF(*raw.columns)
            shaped = transform(raw, spec, run_time)
            if missing:
                status, error = "invalid", f"missing required columns: {missing}"
            elif loader.get("write_mode") in _REPLACING and shaped.isEmpty():
                status = "no_data"
            elif checked and not is_valid(checks(shaped, spec)):
                # The columns are there: no rows, or rows that the transformer's own checks refuse.
                status = "no_data" if shaped.isEmpty() else "invalid"
            else:
                changed = structure_change(shaped, loader)
                loaded = _named(_loaders, "loader", loader.get("type", "table"))(shaped, loader)
                processed = None if seen is None else observed(seen, "rows")
                processed = raw.count() if processed is None else processed
                status = "success" if processed else "no_data"
    except Exception as err:  # recorded, then raised
        status, error, failure = "failed", str(err), err
    fired = run_alerts(job_id, status, processed, error, changed, spec.get("monitoring", {}))
    if ledger:
        record_run(spark, ledger, job_id, run_time, clock(), status, processed, loaded, error)
        record_alerts(spark, f"{ledger}_alerts", job_id, run_time, fired)
    if failure:
        raise failure
    return RunResult(status, processed, loaded, error, tuple(fired))


def _can_land(df: DataFrame) -> bool:
    """Whether files can hold the columns: a column of nothing but NULL has no type to store."""
    return "void" not in df.schema.simpleString()


_REPLACING = ("replace", "overwrite", "overwrite_partition")


def structure_change(df: DataFrame, loader: Mapping[str, Any]) -> str | None:
    """How the columns about to be stored differ from the stored ones; None if they don't, or nothing is stored yet."""
    table = ".".join(p for p in (loader.get("catalog"), loader.get("database"), loader["table"]) if p)
    if loader.get("type", "table") not in ("table", "iceberg", "delta", "delta_lake") or not table_exists(df.sparkSession, table):
        return None
    days = {day for day, _ in stored_days(df.sparkSession, table)}
    stored = {f.name: f.dataType.simpleString() for f in df.sparkSession.table(table).schema.fields if f.name not in days}
    given = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    parts = [
        ("missing", sorted(set(stored) - set(given))), ("new", sorted(set(given) - set(stored))),
        ("of another type", sorted(c for c in stored if c in given and stored[c] != given[c])),
    ]
    return "; ".join(f"{what}: {', '.join(names)}" for what, names in parts if names) or None
