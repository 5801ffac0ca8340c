"""Facts about files that tasks find out by opening them: header lines and column layouts.

The list of files comes from Spark's listing (names only, no content); a task opens its files with Arrow's file
systems and reads the bytes it needs: a header up to its line end, a footer, or one row group at a time. Each gives a
small table by file. ``openable`` says whether Arrow knows the path's file system; where it doesn't, callers fall back
on what Spark's own readers offer.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 64 * 1024
# A line without an end is no header: reading stops there and says so.
LINE_BYTES = 64 * 1024 * 1024


def listed(reader, path: str) -> DataFrame:
    """``(path, length)`` of the files a reader finds, the path as other scans' metadata have it."""
    return reader.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"), "length")


def openable(files: DataFrame) -> bool:
    """Whether tasks can open these files, judged by the first one of the listing; True without files."""
    from pyarrow.fs import FileSystem

    names = files._jdf.inputFiles()
    try:
        return not len(names) or FileSystem.from_uri(names[0]) is not None
    except (OSError, ValueError, pa.ArrowException):
        return False


def _opened(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


# --- headers ----------------------------------------------------------------------------------------------------


def first_line(read: Callable[[int], bytes], encoding: str, comment: str | None) -> tuple[str | None, int]:
    """The first line that is neither blank nor a comment, and the bytes read to see it; None if there is none."""
    import codecs

    decode = codecs.getincrementaldecoder("utf-8-sig" if codecs.lookup(encoding).name == "utf-8" else encoding)()
    text, size = "", 0
    while True:
        block = read(BLOCK_BYTES)
        size += len(block)
        text += decode.decode(block, final=not block)
        # Without universal newlines a lone carriage return ends a line, too; the last piece may go on.
        lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        for line in lines[:-1] if block else lines:
            if line.strip() and not (comment and line.startswith(comment)):
                return line, size
        if not block:
            return None, size
        text = lines[-1]
        if len(text) > LINE_BYTES:
            raise ValueError(f"a header line of more than {LINE_BYTES} characters")


def header_lines(files: DataFrame, encoding: str, comment: str | None = None) -> DataFrame:
    """``(path, line, bytes_read)`` of each file with a line; compressed files are known by their extension."""

    def work(batches):
        for batch in batches:
            out = []
            for uri in batch.column(0).to_pylist():
                fs, path = _opened(uri)
                with fs.open_input_stream(path, compression="detect", buffer_size=None) as stream:
                    out.append((uri, *first_line(stream.read, encoding, comment)))
            kinds = (pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["path", "line", "bytes_read"]
            )

    lines = files.select("path").mapInArrow(work, "path string, line string, bytes_read bigint")
    return lines.filter("line IS NOT NULL")


# --- columnar files ---------------------------------------------------------------------------------------------


def _footer(uri: str, fmt: str):
    """Schema and number of rows."""
    fs, path = _opened(uri)
    with fs.open_input_file(path) as file:
        if fmt == "parquet":
            import pyarrow.parquet as pq

            meta = pq.read_metadata(file)
            return meta.schema.to_arrow_schema(), meta.num_rows
        from pyarrow import orc

        found = orc.ORCFile(file)
        return found.schema, found.nrows


def footers(files: DataFrame, fmt: str) -> DataFrame:
    """``(path, columns, rows, error)``: column name to type, number of rows, and why there is no footer."""

    def work(batches):
        for batch in batches:
            out = []
            for uri in batch.column(0).to_pylist():
                try:
                    schema, rows = _footer(uri, fmt)
                    out.append((uri, [(f.name, str(f.type)) for f in schema], rows, None))
                except (OSError, ValueError, pa.ArrowException) as err:
                    out.append((uri, [], 0, str(err)))
            kinds = (pa.string(), pa.map_(pa.string(), pa.string()), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["path", "columns", "rows", "error"]
            )

    return files.select("path").mapInArrow(work, "path string, columns map<string,string>, rows bigint, error string")


def some_of_each_layout(seen: DataFrame) -> list[list[str]]:
    """Up to four paths for each set of columns and types: as many lists as there are layouts, however many files."""
    mixed = F.xxhash64("path")
    found = seen.groupBy(F.to_json("columns").alias("layout")).agg(
        F.array_distinct(F.array(F.min("path"), F.max("path"), F.min_by("path", mixed), F.max_by("path", mixed))).alias("paths")
    )
    return sorted(r["paths"] for r in found.select("paths").collect())


def layouts(seen: DataFrame) -> list[DataFrame]:
    """Rows of a table of footers, grouped by the types of those columns whose types differ between files.

    Files that only lack columns are one group. To the driver come the distinct layouts.
    """
    kinds = seen.select(F.explode("columns").alias("name", "type")).groupBy("name").agg(F.collect_set("type").alias("types"))
    differing = sorted(r["name"] for r in kinds.filter(F.size("types") > 1).collect())
    key = F.to_json(F.map_filter("columns", lambda name, _: name.isin(differing)))
    keyed = seen.withColumn("key", key)
    keys = sorted(r["key"] for r in keyed.select("key").distinct().collect())
    return [keyed.filter(F.col("key") == k).drop("key") for k in keys]


def paths_of(seen: DataFrame) -> list[str]:
    """The files of one group, for a scan of just these; Spark's own listing holds them on the driver, too."""
    return sorted(r["path"] for r in seen.select("path").collect())
