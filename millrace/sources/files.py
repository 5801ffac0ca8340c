"""File scans: delimited text, JSON, XML, Parquet, ORC, Avro, workbooks, mixed folders.

Files of one format are one scan. Formats are combined by column name, missing
columns become NULL. A file that cannot be parsed fails the read, or is dropped
whole with ``skip_errors``.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable, Mapping
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.coerce import NULL_WORDS, NUMBER_PATTERN, null_words_to_null, ntz, to_timestamp, utc_ntz
from millrace.session import settle, sized
from millrace.sources.opened import footers, header_lines, layouts, listed, openable, paths_of, some_of_each_layout
from millrace.sources.workbook import read_workbooks
from millrace.sources.xmltags import path_rows

# File type or extension, and the reader it selects.
FORMATS = {
    "csv": "delimited", "tsv": "delimited", "txt": "delimited",
    "json": "json", "jsonl": "json", "xml": "xml",
    "parquet": "parquet", "orc": "orc", "avro": "avro",
    "xlsx": "workbook", "excel": "workbook",
}
SEPARATORS = {"csv": ",", "tsv": "\t", "txt": ","}

# Declared read types and the Spark types they mean.
READ_TYPES = {
    "str": "string", "string": "string", "object": "string",
    "int": "bigint", "int64": "bigint", "int32": "bigint", "integer": "bigint",
    "float": "double", "float64": "double", "float32": "double", "double": "double",
    "bool": "boolean", "boolean": "boolean",
}

# Encodings as Python names them and as Spark names them.
CHARSETS = {"iso8859-1": "ISO-8859-1", "ascii": "US-ASCII", "utf_8_sig": "UTF-8", "utf-8-sig": "UTF-8"}

_PATH, _BAD, _RAW, _MARK = "__file_path", "__bad", "__raw_line", "\u0001"


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Name, folder, size and modification time (UTC) of the files, without reading them."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length", "modificationTime")
    )
    return listed.select(
        F.regexp_extract("path", r"([^/]*)$", 1).alias("filename"),
        _folder(F.col("path")).alias("path"),
        F.col("length").alias("size"),
        utc_ntz(F.col("modificationTime")).alias("modified"),
    )


def charset(encoding: str) -> str:
    name = codecs.lookup(encoding).name
    return CHARSETS.get(name, name)


def _folder(uri: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(uri, r"/[^/]*$", ""), r"^file:/+", "/")


def _types_present(spark: SparkSession, path: str, pattern: str, skip_errors: bool) -> tuple[list[str], bool]:
    """The distinct known extensions under ``path``, and whether there are others, which ``skip_errors`` passes over."""
    try:
        names = file_inventory(spark, path, pattern)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return [], False
        raise
    ext = F.lower(F.regexp_extract("filename", r"\.([^.]*)$", 1))
    known = F.when(ext.isin(*FORMATS), ext).otherwise(F.lit("?"))
    found = [r[0] for r in names.select(known.alias("ext")).distinct().sort("ext").collect()]
    if "?" in found and not skip_errors:
        raise ValueError(f"{path}/{pattern} holds files of unsupported type; narrow the pattern")
    return [x for x in found if x != "?"], "?" in found


def _glob_for(pattern: str, ext: str) -> str:
    """``pattern`` narrowed to one extension."""
    suffix = "." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ext)
    if pattern.endswith(".*"):
        return "{" + f"{pattern[:-2]}{suffix},{pattern[:-1]}*{suffix}" + "}"
    if pattern.endswith("*"):
        return pattern + suffix
    return pattern


def _scan(spark: SparkSession, pattern: str, modified_after: datetime | None, **options: Any):
    reader = spark.read.option("pathGlobFilter", pattern)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after.isoformat()).option("timeZone", "UTC")
    return reader.options(**options)


def read_files(
    spark: SparkSession,
    path: str,
    pattern: str = "*",
    file_type: str | None = None,
    options: Mapping[str, Any] | None = None,
    encoding: str = "utf-8",
    lineage_time: datetime | None = None,
    skip_errors: bool = False,
    modified_after: datetime | None = None,
) -> DataFrame:
    """Read a file, a folder with a name pattern, or a path that is itself a glob.

    ``lineage_time`` adds ``source_file``, ``source_path`` and ``ingestion_time``.
    ``modified_after`` keeps files strictly newer than that instant (UTC). No file
    gives an empty table without columns.
    """
    options = dict(options or {})
    present, others = None, False
    if file_type is None or file_type == "file":
        present, others = _types_present(spark, path, pattern, skip_errors)
    if present is None:
        file_type = file_type.lower()
        if file_type not in FORMATS:
            raise ValueError(f"unsupported file type {file_type!r}")
        scans = [(file_type, pattern)]
    else:
        scans = [(ext, _glob_for(pattern, ext) if len(present) > 1 or others else pattern) for ext in present]
    parts = []
    for kind, glob in scans:
        read = _READERS[FORMATS[kind]]
        try:
            part = read(spark, path, glob, kind, options, encoding, skip_errors, modified_after)
        except AnalysisException as err:
            # Nothing matched: there is no file to infer columns from.
            if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                continue
            raise
        if part.columns:
            parts.append(part)
    if not parts:
        return spark.createDataFrame([], T.StructType([]))
    combined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if lineage_time is not None:
        combined = combined.withColumns(
            {
                "source_file": F.regexp_extract(_PATH, r"([^/]*)$", 1),
                "source_path": _folder(F.col(_PATH)),
                "ingestion_time": ntz(lineage_time),
            }
        )
    return combined.drop(_PATH)


def _drop_bad_files(df: DataFrame, skip_errors: bool, what: str) -> DataFrame:
    """Apply the ``__bad`` row flag: drop the whole files it names, or fail the read."""
    if not skip_errors:
        message = F.concat(F.lit(f"cannot parse as {what}: "), F.col(_PATH))
        return df.filter(F.when(F.col(_BAD), F.raise_error(message).cast("boolean")).otherwise(True)).drop(_BAD)
    return _without_files(df, df.filter(_BAD).select(_PATH)).drop(_BAD)


def _without_files(df: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of all files but ``files``.

    One row per broken file: its true size decides the join, so the good rows are
    normally filtered in place by a broadcast and not shuffled by file.
    """
    return df.join(sized(files.distinct(), "bad-files"), _PATH, "left_anti")


# --- delimited text -------------------------------------------------------------------------


def _first_lines(spark, path, glob, encoding, modified_after, comment=None) -> DataFrame:
    """``(file, line)``: the first line of each file that is neither blank nor a comment.

    Tasks open the files and read up to that line. Where the file system is one that only Spark knows, the lines of
    every first split are read: they keep their order, and the split begins at byte 0.
    """
    files = listed(_scan(spark, glob, modified_after), path)
    if openable(files):
        return header_lines(files, encoding, comment).select(F.col("path").alias(_PATH), "line")
    lines = (
        _scan(spark, glob, modified_after, sep=_MARK, quote="", header=False, encoding=encoding)
        .schema("line string")
        .csv(path)
        .select(
            F.regexp_replace("line", "^\ufeff", "").alias("line"), F.col("_metadata.file_path").alias(_PATH),
            F.col("_metadata.file_block_start").alias("at"),
        )
        .filter("at = 0")
        .filter(~F.startswith("line", F.lit(comment)) if comment else F.lit(True))
        .withColumn("n", F.monotonically_increasing_id())
    )
    return lines.groupBy(_PATH).agg(F.min_by("line", "n").alias("line"))


def _layouts(spark, path, glob, sep, quote, encoding, modified_after, comment=None) -> DataFrame:
    """``(file, header)`` for every file, the header as a list of column names."""
    header = _first_lines(spark, path, glob, encoding, modified_after, comment)
    # A field is quoted, or runs up to the next separator.
    q, one = re.escape(quote or "\x00"), re.escape(sep)
    fields = F.regexp_extract_all("line", F.lit(f"(?:^|{one})({q}(?:[^{q}]|{q}{q})*{q}|[^{one}]*)"), F.lit(1))
    bare = F.transform(
        fields, lambda c: F.replace(F.regexp_replace(c, f"^{q}|{q}$", ""), F.lit(quote * 2), F.lit(quote)) if quote else c
    )
    return header.select(_PATH, bare.alias("names"))


def _numbered(names: list[str]) -> list[str]:
    """Repeated titles as ``a``, ``a.1``, ``a.2``."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        k = seen.get(n, 0)
        seen[n] = k + 1
        out.append(f"{n}.{k}" if k else n)
    return out


def _token_count(last: Column, width: int, sep: str, quote: str) -> Column:
    """Fields on a line that is shorter or longer than ``width``; longer counts as width + 1.

    A mark appended as one more field is found at its position if the line fits.
    """
    fields = ", ".join(f"c{i} string" for i in range(width))
    marked = F.from_csv(
        F.concat(F.col(_RAW), F.lit(sep + _MARK)), fields, {"sep": sep, "quote": quote, "mode": "PERMISSIVE"}
    )
    # Looked at through a one-element array, so the line is parsed once and not per field.
    places = F.transform(
        F.array(marked), lambda m: F.array_position(F.array(*[m[f"c{i}"] for i in range(width)]), _MARK)
    )
    at = F.element_at(places, 1)
    # The raw line is kept only where the count is off, so a filled last field means too many.
    return (
        F.when(F.col(_RAW).isNull(), F.lit(width))
        .when(last.isNotNull(), F.lit(width + 1))
        .otherwise(F.coalesce(F.nullif(at, F.lit(0)) - 1, F.lit(width + 1)))
    )


def _read_delimited(spark, path, glob, kind, options, encoding, skip_errors, modified_after) -> DataFrame:
    opts = dict(options)
    sep = opts.pop("delimiter", None) or opts.pop("sep", None) or SEPARATORS.get(kind, ",")
    encoding = charset(opts.pop("encoding", encoding))
    names = opts.pop("names", None)
    header = opts.pop("header", None if names else 0)
    if header not in (None, 0):
        raise ValueError("the header must be the first row, or absent")
    has_header = header is not None
    dtype = opts.pop("dtype", None) or {}
    parse_dates = opts.pop("parse_dates", None)
    date_formats = opts.pop("date_formats", None)
    usecols = opts.pop("usecols", None)
    quote = opts.pop("quotechar", '"')
    escape = opts.pop("escapechar", '"')
    comment = opts.pop("comment", None)
    words = set(NULL_WORDS if opts.pop("keep_default_na", True) else ())
    words |= set(opts.pop("na_values", None) or ())
    same_header = opts.pop("same_header", False)
    multi_line = opts.pop("multi_line", False)
    for ignored in ("low_memory", "infer_datetime_format", "engine"):
        opts.pop(ignored, None)
    if opts:
        raise ValueError(f"unknown delimited-text options {sorted(opts)}")
    common = dict(sep=sep, quote=quote, escape=escape, encoding=encoding, multiLine=multi_line)
    if comment:
        common["comment"] = comment

    layouts = None
    if names:
        columns = list(names)
    elif same_header or not has_header:
        first = _scan(spark, glob, modified_after, header=has_header, **common).csv(path)
        columns = first.columns if has_header else [str(i) for i in range(len(first.columns))]
    else:
        layouts = _layouts(spark, path, glob, sep, quote, encoding, modified_after, comment)
        distinct = layouts.groupBy("names").agg(F.min(_PATH).alias("p")).sort("p").select("names").collect()
        if not distinct:
            return spark.createDataFrame([], T.StructType([]))
        if len(distinct) == 1:
            columns, layouts = _numbered(distinct[0]["names"]), None
        elif any(len(set(row["names"])) < len(row["names"]) for row in distinct):
            raise ValueError("a header repeats a title, and the files have different headers")
        else:
            columns = list(dict.fromkeys(c for row in distinct for c in row["names"]))

    # Every column as text plus the raw line; the parser must see whole lines to
    # notice rows with too many fields, hence no column pruning inside it.
    width = len(columns) if layouts is None else max(len(r["names"]) for r in distinct)
    # With one header promised, the names are declared and Spark checks them in every file.
    promised = same_header and has_header
    positions = columns if promised else [f"c{i}" for i in range(width)]
    schema = ", ".join(f"`{p}` string" for p in positions) + f", `{_RAW}` string"
    rows = (
        _scan(
            spark, glob, modified_after, header=has_header, mode="PERMISSIVE",
            columnNameOfCorruptRecord=_RAW, columnPruning=False, enforceSchema=not promised, **common,
        )
        .schema(schema)
        .csv(path)
        .withColumn(_PATH, F.col("_metadata.file_path"))
    )
    n_fields = _token_count(F.col(f"`{positions[-1]}`"), width, sep, quote)
    if layouts is None:
        cells = {c: F.col(f"`{p}`") for c, p in zip(columns, positions)}
        too_many = n_fields > width
    else:
        rows = rows.join(sized(layouts, "layouts"), _PATH)
        values = F.array(*[F.col(p) for p in positions])
        cells = {
            c: F.try_element_at(values, F.nullif(F.array_position("names", c), F.lit(0)).cast("int"))
            for c in columns
        }
        too_many = n_fields > F.size("names")

    dates = list(parse_dates) if isinstance(parse_dates, (list, tuple)) else []
    declared = (
        {c: READ_TYPES[str(t).lower()] for c, t in dtype.items()}
        if isinstance(dtype, Mapping)
        else {c: READ_TYPES[str(dtype).lower()] for c in columns}
    )
    text = rows.select(
        *[null_words_to_null(cell, words).alias(c) for c, cell in cells.items()],
        _PATH,
        too_many.alias(_BAD),
    )
    misread = F.lit(False)
    for c, t in declared.items():
        if c in cells and t != "string":
            misread = misread | (F.col(f"`{c}`").isNotNull() & F.trim(f"`{c}`").try_cast(t).isNull())
    text = _drop_bad_files(text.withColumn(_BAD, F.col(_BAD) | misread), skip_errors, "delimited text")
    open_types = [c for c in columns if c not in declared and c not in dates]
    types = {**declared, **infer_text_types(text, open_types)}

    def typed(c: str) -> Column:
        col = F.col(f"`{c}`")
        if c in dates:
            return (to_timestamp(col, date_formats) if date_formats else to_timestamp(col)).alias(c)
        return col if types[c] == "string" else F.trim(col).cast(types[c]).alias(c)

    wanted = [c for c in columns if usecols is None or c in usecols]
    return text.select(*[typed(c) for c in wanted], _PATH)


def infer_text_types(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Types of text columns, from all values, in one aggregation over the data.

    bigint if every value is an integer that fits, double if every value is a
    number, boolean if every value is true or false, else string. A column without
    values is string. Declare types to save this pass.
    """
    if not columns:
        return {}
    aggs = []
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`")
        text = F.trim(col)
        whole = F.coalesce(text.rlike(r"^[+-]?\d+$") & text.try_cast("bigint").isNotNull(), F.lit(False))
        number = F.coalesce(text.rlike(NUMBER_PATTERN) & ~F.contains(text, F.lit(",")), F.lit(False))
        flag = F.coalesce(col.isin("True", "TRUE", "true", "False", "FALSE", "false"), F.lit(False))
        for kind, fits in (("bigint", whole), ("double", number), ("boolean", flag)):
            aggs.append(F.count_if(col.isNotNull() & ~fits).alias(f"{kind}_{i}"))
        aggs.append(F.count(col).alias(f"n_{i}"))
    row = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(columns):
        out[c] = "string"
        if row[f"n_{i}"]:
            out[c] = next((k for k in ("bigint", "double", "boolean") if row[f"{k}_{i}"] == 0), "string")
    return out


# --- JSON -----------------------------------------------------------------------------------


def _read_json(spark, path, glob, kind, options, encoding, skip_errors, modified_after) -> DataFrame:
    opts = dict(options)
    schema = opts.pop("schema", None)
    lines = opts.pop("lines", kind == "jsonl")
    opts.pop("orient", None)
    if opts:
        raise ValueError(f"unknown JSON options {sorted(opts)}")
    if lines:
        return _read_json_lines(spark, path, glob, schema, encoding, skip_errors, modified_after)
    return _read_json_documents(spark, path, glob, schema, skip_errors, modified_after)


def _read_json_lines(spark, path, glob, schema, encoding, skip_errors, modified_after) -> DataFrame:
    mode = "PERMISSIVE" if skip_errors else "FAILFAST"
    reader = _scan(spark, glob, modified_after, mode=mode, columnNameOfCorruptRecord=_RAW, encoding=charset(encoding))
    if schema is None:
        found = reader.json(path).schema
        schema = T.StructType([f for f in found.fields if f.name != _RAW])
    rows = reader.schema(_struct(schema)).json(path).withColumn(_PATH, F.col("_metadata.file_path"))
    if not skip_errors:
        return rows
    lines = _scan(spark, glob, modified_after).text(path).select("value", F.col("_metadata.file_path").alias(_PATH))
    broken = lines.filter((F.trim("value") != "") & F.try_parse_json("value").isNull())
    return _without_files(rows, broken.select(_PATH))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _is_list_of_objects(value: Column) -> Column:
    first = F.schema_of_variant(F.try_variant_get(value, "$[0]", "variant"))
    return F.coalesce(F.startswith(first, F.lit("OBJECT")), F.lit(False))


def _last_of_each(entries: Column) -> Column:
    """Members of an object, each name once: where it stood first, with its last value."""
    names = F.transform(entries, lambda e: e["key"])
    once = F.array_distinct(names)
    repeated = F.transform(
        once, lambda n: F.struct(n.alias("key"), F.element_at(F.filter(entries, lambda e: e["key"] == n), -1)["value"].alias("value"))
    )
    return F.when(F.size(once) == F.size(names), entries).otherwise(repeated)


def document_items(docs: DataFrame, doc: str) -> DataFrame:
    """JSON documents to one row per item: column ``doc`` becomes ``item``, a variant, and ``is_object``.

    A list of objects is its elements; another list is one value per element; an
    object is the elements of its first member, in document order, that is a list
    starting with an object, or else itself; a scalar is one value. A document is
    parsed once: an object to its members, which keeps their order, anything else to
    a variant. Of a repeated member the last value counts; within values that needs
    the session setting ``spark.sql.variant.allowDuplicateKeys``. A document that is
    no JSON is one row with ``item`` NULL and ``is_object`` NULL.
    """
    kept = [c for c in docs.columns if c != doc]
    text = F.col(doc)
    is_object = F.startswith(F.ltrim(text), F.lit("{"))
    no_json = F.array(F.struct(F.lit(None).cast("boolean").alias("is_object"), F.lit(None).cast("variant").alias("item")))

    def rows(flag: Column, items: Column) -> Column:
        return F.transform(items, lambda v: F.struct(flag.alias("is_object"), v.alias("item")))

    def of_object(entries: Column) -> Column:
        listed = F.try_element_at(F.filter(entries, lambda e: _is_list_of_objects(e["value"])), F.lit(1))["value"]
        whole = F.array(F.to_variant_object(F.map_from_entries(entries)))
        return rows(F.lit(True), _once(listed, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), whole)))

    def of_value(value: Column) -> Column:
        def of_list(items):
            return rows(F.forall(items, lambda v: F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))), items)

        listed = F.when(F.startswith(F.schema_of_variant(value), F.lit("ARRAY")), F.try_variant_get(value, "$", "array<variant>"))
        return _once(listed, lambda v: F.coalesce(of_list(v), rows(F.lit(False), F.array(value))))

    members = F.map_entries(F.from_json(text, "map<string,variant>"))
    found = F.when(
        is_object, _once(members, lambda m: F.when(m.isNotNull(), _once(_last_of_each(m), of_object)))
    ).otherwise(_once(F.try_parse_json(text), lambda v: F.when(v.isNotNull(), of_value(v))))
    # The outer form: for the other one a filter that parses again would be put before it.
    out = docs.select(*kept, F.explode_outer(F.coalesce(found, no_json)).alias("__row")).filter("__row IS NOT NULL")
    return out.select(*kept, "__row.is_object", "__row.item")


def infer_object_schema(df: DataFrame, column: str) -> T.StructType:
    """The schema of variants that are objects, from all rows, in one aggregation.

    Numbers with a fraction are double, members of several types are string.
    """
    found = df.agg(F.schema_of_variant_agg(column).alias("s")).first()["s"]
    if found is None or not found.startswith("OBJECT<"):
        return T.StructType([])
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", found)
    ddl = re.sub(r"DECIMAL\(\d+,\d+\)", "DOUBLE", ddl)
    ddl = re.sub(r"\b(VARIANT|VOID)(?=[,>])", "STRING", ddl).replace("OBJECT", "STRING")
    return T.DataType.fromDDL(ddl)


def _struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _member(item: Column, field: T.StructField) -> Column:
    """A member of a variant in its declared type; NULL where it is absent or does not fit."""
    if "'" not in field.name and "\\" not in field.name:
        return F.try_variant_get(item, f"$['{field.name}']", field.dataType.simpleString())
    return F.from_json(F.to_json(item), T.StructType([field]))[field.name]


_REPEATS = "spark.sql.variant.allowDuplicateKeys"


def _read_json_documents(spark, path, glob, schema, skip_errors, modified_after) -> DataFrame:
    docs = _scan(spark, glob, modified_after, wholetext=True).text(path).select(
        F.trim("value").alias("doc"), F.col("_metadata.file_path").alias(_PATH)
    )
    before = spark.conf.get(_REPEATS, None)
    spark.conf.set(_REPEATS, "true")
    try:
        # Written once parsed: types, scalars and rows are all taken from the variants.
        parsed = settle(document_items(docs, "doc").withColumn(_BAD, F.col("is_object").isNull()), "items")
    finally:
        spark.conf.unset(_REPEATS) if before is None else spark.conf.set(_REPEATS, before)
    items = _drop_bad_files(parsed, skip_errors, "JSON")
    objects = items.filter("is_object")
    if schema is None:
        fields = infer_object_schema(objects, "item")
        with_scalars = not items.filter("not is_object").isEmpty()
    else:
        fields = _struct(schema)
        with_scalars = "data" in fields.names
    item = F.when(F.col("is_object"), F.col("item"))
    out = {f.name: _member(item, f) for f in fields.fields}
    if with_scalars:
        value = F.col("item")
        text = F.coalesce(F.try_variant_get(value, "$", "string"), F.when(~F.is_variant_null(value), F.to_json(value)))
        data = F.when(~F.col("is_object"), text)
        out["data"] = F.coalesce(data, out["data"].cast("string")) if "data" in out else data
    return items.select(*[c.alias(n) for n, c in out.items()], _PATH)


# --- XML ------------------------------------------------------------------------------------


def _read_xml(spark, path, glob, kind, options, encoding, skip_errors, modified_after) -> DataFrame:
    """Elements at a path, found in one streaming pass over each document; their names are those that occur."""
    opts = dict(options)
    xpath = opts.pop("xpath", "/root/*")
    schema = opts.pop("schema", None)
    if opts:
        raise ValueError(f"unknown XML options {sorted(opts)}")
    files = _scan(spark, glob, modified_after).format("binaryFile").load(path)
    files = files.select(F.col("_metadata.file_path").alias("path"), "content")
    parsed = settle(
        files.mapInArrow(path_rows(xpath, charset(encoding)), "path string, rows array<map<string,string>>, error string"), "xml"
    ).withColumnRenamed("path", _PATH)
    broken = parsed.filter(F.col("error").isNotNull()).select(_PATH)
    if not skip_errors:
        first = parsed.filter(F.col("error").isNotNull()).select(_PATH, "error").head(1)
        if first:
            raise ValueError(f"{first[0][0]} is not well formed: {first[0]['error']}")
    rows = parsed.select(F.explode("rows").alias("row"), _PATH)
    if skip_errors:
        rows = _without_files(rows, broken)
    if schema is not None:
        fields = _struct(schema).fields
        return rows.select(*[F.try_element_at("row", F.lit(f.name)).cast(f.dataType).alias(f.name) for f in fields], _PATH)
    # As many names as the vocabulary has, however many elements.
    names = [r[0] for r in rows.select(F.explode(F.map_keys("row"))).distinct().sort("col").collect()]
    if not names:
        return spark.createDataFrame([], T.StructType([]))
    return rows.select(*[F.try_element_at("row", F.lit(n)).alias(n) for n in names], _PATH)


# --- columnar and workbook ------------------------------------------------------------------


# Numeric types from narrow to wide; a column of several takes the widest.
_WIDTHS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def wider(name: str, types: set[str]) -> str:
    """The type that holds values of all these types: the wider number, timestamp over date, text for scalars of other kinds."""
    if len(types) == 1:
        return next(iter(types))
    if types <= set(_WIDTHS):
        widest = max(types, key=_WIDTHS.index)
        return "double" if widest == "float" and types & {"int", "bigint"} else widest
    decimals = [T.DataType.fromDDL(t) for t in types if t.startswith("decimal")]
    if decimals and all(t.startswith("decimal") or t in _WIDTHS for t in types):
        if types & {"float", "double"}:
            return "double"
        digits = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
        whole = max([d.precision - d.scale for d in decimals] + [digits[t] for t in types if t in digits])
        scale = max(d.scale for d in decimals)
        return f"decimal({whole + scale},{scale})" if whole + scale <= 38 else "double"
    if types <= {"date", "timestamp", "timestamp_ntz"}:
        return "timestamp" if "timestamp" in types else "timestamp_ntz"
    nested = sorted(t for t in types if t.startswith(("struct", "array", "map", "binary", "variant")))
    if nested:
        raise ValueError(f"column {name} has types that do not combine: {sorted(types)}")
    return "string"


def _widened(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts under one schema, each column in the type that holds its types."""
    types: dict[str, set[str]] = {}
    for part in parts:
        for field in part.schema.fields:
            types.setdefault(field.name, set()).add(field.dataType.simpleString())
    target = {name: wider(name, found) for name, found in types.items()}

    def cast(part: DataFrame) -> DataFrame:
        own = dict(part.dtypes)
        return part.select(*[
            F.col(f"`{c}`") if own[c] == target[c] else F.col(f"`{c}`").cast(target[c]).alias(c) for c in part.columns
        ])

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(cast, parts))


def _broken(seen: DataFrame, lenient: list[DataFrame]) -> DataFrame:
    """Files without a footer, and those that scans which pass over broken ones read fewer rows of than their footers name."""
    counts = []
    for rows in lenient:
        columns = [F.col(f"`{c}`") for c in rows.columns if c != _PATH]
        # Every column is looked at, so that all of them are decoded; maps have no hash of their own.
        value = F.to_json(F.struct(*columns)) if "map<" in rows.schema.simpleString() else F.struct(*columns)
        counts.append(rows.groupBy(_PATH).agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(value)).alias("h")))
    read = reduce(DataFrame.unionByName, counts)
    short = F.col("n").isNull() | F.col("h").isNull() | (F.col("n") < F.col("rows"))
    found = seen.join(read, seen["path"] == read[_PATH], "left").filter(F.col("error").isNotNull() | ((F.col("rows") > 0) & short))
    return found.select(F.col("path").alias(_PATH))


# Broken files up to this number are left out of the listing by name.
MOST_NAMED = 500


def _columnar(fmt: str) -> Callable[..., DataFrame]:
    def read(spark, path, glob, kind, options, encoding, skip_errors, modified_after) -> DataFrame:
        """One scan with Spark's merged schema; where types differ between files, one scan for each layout, widened.

        With ``skip_errors`` all files are read once before, and those that give fewer rows than their footers name are
        left out whole: by name in the listing, which keeps the scan strict, or, beyond ``MOST_NAMED`` of them, by a
        join behind a scan that passes over what is broken. Avro, and files that only Spark's readers can open, are
        left to ``ignoreCorruptFiles``.
        """
        opts = dict(options)
        schema = opts.pop("schema", None)
        merge = opts.pop("merge_schema", True)
        if opts:
            raise ValueError(f"unknown {fmt} options {sorted(opts)}")

        def scan(paths, given=None, ignore=False):
            reader = _scan(spark, glob, modified_after, mergeSchema=merge, ignoreCorruptFiles=ignore).format(fmt)
            reader = reader if given is None else reader.schema(_struct(given))
            return reader.load(paths).withColumn(_PATH, F.col("_metadata.file_path"))

        def first_readable(paths):
            """A file whose footer Spark reads, too; others of its layout may be damaged there."""
            for p in paths[:-1]:
                try:
                    scan([p])
                    return p
                except Exception:  # noqa: S112  the last one says what is wrong
                    continue
            return paths[-1]

        files = listed(_scan(spark, glob, modified_after), path)
        if fmt == "avro" or not openable(files):
            return scan(path, schema, skip_errors)
        if not skip_errors:
            try:
                return scan(path, schema)
            except Exception as err:
                if "CANNOT_MERGE_SCHEMA" not in str(err):
                    raise
            return _widened([scan(paths_of(group)) for group in layouts(settle(footers(files, fmt), "footers"))])
        seen = settle(footers(files, fmt), "footers")
        opened = seen.filter("error IS NULL")
        parts = [(path, schema)]
        if schema is None:
            some = some_of_each_layout(opened)
            if not some:
                return spark.createDataFrame([], T.StructType([]))
            try:
                parts = [(path, scan([first_readable(paths) for paths in some]).drop(_PATH).schema)]
            except Exception as err:
                if "CANNOT_MERGE_SCHEMA" not in str(err):
                    raise
                parts = [
                    (paths_of(group), scan([first_readable(paths) for paths in some_of_each_layout(group)]).drop(_PATH).schema)
                    for group in layouts(opened)
                ]
        bad = settle(_broken(seen, [scan(*p, True) for p in parts]), "broken")
        named = [r[0] for r in bad.limit(MOST_NAMED + 1).collect()]

        def whole(part):
            if len(named) > MOST_NAMED:
                return _without_files(scan(*part, True), bad)
            return scan(*part).filter(~F.col(_PATH).isin(named)) if named else scan(*part)

        return _widened([whole(p) for p in parts]) if len(parts) > 1 else whole(parts[0])

    return read


def _read_workbook(spark, path, glob, kind, options, encoding, skip_errors, modified_after) -> DataFrame:
    opts = dict(options)
    args = {k: opts.pop(k) for k in ("sheet_name", "header", "skiprows", "columns") if k in opts}
    types = opts.pop("dtype", None)
    if opts:
        raise ValueError(f"unknown workbook options {sorted(opts)}")
    files = _scan(spark, glob, modified_after).format("binaryFile").load(path)
    rows = read_workbooks(files, **args).withColumnRenamed("path", _PATH)
    rows = rows.withColumn(_BAD, F.col("error").isNotNull()).drop("error")
    cells = _drop_bad_files(rows, skip_errors, "a workbook").filter("cells is not null")
    names = args.get("columns")
    if names is None:
        names = _workbook_columns(cells)
    text = cells.select(*[F.try_element_at("cells", F.lit(c)).alias(c) for c in names], _PATH)
    declared = {c: READ_TYPES[str(t).lower()] for c, t in (types or {}).items()}
    types = {**infer_text_types(text, [c for c in names if c not in declared]), **declared}
    return text.select(
        *[F.col(f"`{c}`") if types[c] == "string" else F.trim(f"`{c}`").cast(types[c]).alias(c) for c in names],
        _PATH,
    )


def _workbook_columns(cells: DataFrame) -> list[str]:
    """Distinct header names in sheet order; as small as the widest set of sheets."""
    seen = (
        cells.select(F.posexplode("names").alias("at", "name"))
        .groupBy("name")
        .agg(F.min("at").alias("at"))
        .sort("at", "name")
    )
    return [r["name"] for r in seen.collect()]


_READERS: dict[str, Callable[..., DataFrame]] = {
    "delimited": _read_delimited,
    "json": _read_json,
    "xml": _read_xml,
    "parquet": _columnar("parquet"),
    "orc": _columnar("orc"),
    "avro": _columnar("avro"),
    "workbook": _read_workbook,
}
