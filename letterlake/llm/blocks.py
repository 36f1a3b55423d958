"""Texts in blocks: rows packed into one compressed value for some million characters, stored in buckets.

What a block asks for returns to it by its number, and the texts themselves never travel.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as compute
from pyspark import TaskContext
from pyspark.sql import DataFrame

from letterlake.session import scratch_path


def packed(schema: pa.Schema, text: str, size: int, level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ``schema`` as (block, rows); a block ends with the row that brings its texts to ``size``."""

    def row(number: int, pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=level))) as stream:
            for piece in pieces:
                stream.write_batch(piece)
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "rows"])

    def length(texts: pa.Array) -> pa.Array:
        return compute.utf8_length(texts) if pa.types.is_string(texts.type) else compute.binary_length(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, pieces, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            batch = pa.RecordBatch.from_arrays([column.cast(kind) for column, kind in zip(batch.columns, schema.types, strict=True)], schema=schema)
            # An empty text takes room too.
            sizes = np.cumsum(length(batch.column(text)).to_numpy().astype(np.int64) + 4)
            at = 0
            while at < len(sizes):
                before = int(sizes[at - 1]) if at else 0
                end = min(int(np.searchsorted(sizes, before + size - held)) + 1, len(sizes))
                pieces.append(batch.slice(at, end - at))
                held += int(sizes[end - 1]) - before
                at = end
                if held >= size:
                    yield row(number, pieces)
                    number, pieces, held = number + 1, [], 0
        if pieces:
            yield row(number, pieces)

    return run


def opened(value: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(value.as_py()).read_all()


def bucketed(rows: DataFrame, schema: pa.Schema, text: str, size: int, level: int = 9) -> str:
    """The name of an external table (block, rows) in the shared folder, in as many buckets as a shuffle has partitions.

    Only a table of the catalog has buckets; dropped from there, its files stay.
    """
    spark, name = rows.sparkSession, f"text_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = rows.select(*schema.names).mapInArrow(packed(schema, text, size, level), "block bigint, rows binary")
    blocks.write.bucketBy(buckets, "block").option("path", scratch_path(spark, "text-blocks")).saveAsTable(name)
    return name
