"""Damaging columnar files inside tasks, as input for the queries that leave broken files out."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def damage(fmt: str):
    """A map function that overwrites the first column of the last row group, or the end of the last stripe."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import BufferReader, orc
        from pyarrow import parquet as pq
        from pyarrow.fs import FileSystem

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = FileSystem.from_uri(uri)
                with fs.open_input_stream(path) as file:
                    data = bytearray(file.read())
                if fmt == "parquet":
                    meta = pq.read_metadata(BufferReader(bytes(data)))
                    column = meta.row_group(meta.num_row_groups - 1).column(0)
                    at = column.dictionary_page_offset or column.data_page_offset
                else:
                    # The end of the content is the last stripe's own footer.
                    at = orc.ORCFile(BufferReader(bytes(data))).content_length - 64
                data[at:at + 64] = b"\xff" * 64
                with fs.open_output_stream(path) as file:
                    file.write(bytes(data))
            yield batch

    return work
