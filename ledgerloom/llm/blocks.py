"""Blocks of whole rows, and questions that blocks put to hash partitions.

A block is one row that holds about ``size`` bytes of consecutive documents. Blocks
are written once, bucketed by their number, so that answers can be joined to them
without moving text again. What a block asks is already merged within it, so a
key that stands in every document is asked once a block, not once a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerloom.llm.store import save_bucketed
from ledgerloom.llm.words import slices


#: The most buckets that Spark lets a table have.
MOST_BUCKETS = 100_000


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long") + 16), F.lit(0))).first()[0]


def write_packed(docs: DataFrame, pack: Callable[[pa.RecordBatch], list[pa.Array]], fields: T.StructType, size: int = 2 << 20, per_bucket: int = 8 << 20) -> tuple[DataFrame, int]:
    """One row for each block of about ``size`` bytes of text, with its number ``block`` and what ``pack`` makes of it; and the
    total bytes of text. Past 800 GB a bucket, which is a task's work, holds more blocks; a block and what it asks do not grow."""
    total = text_bytes(docs)
    buckets = max(1, min(MOST_BUCKETS, -(-total // per_bucket)))
    names = ["block", *fields.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for b in slices(whole, "text", size):
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *pack(b)], names)
                number += 1

    blocks = docs.mapInArrow(run, T.StructType([T.StructField("block", T.LongType()), *fields]))
    return save_bucketed(blocks, buckets, "block"), total


def write_blocks(docs: DataFrame, size: int = 2 << 20, per_bucket: int = 8 << 20) -> tuple[DataFrame, int]:
    """(block, rows) with all columns of ``docs`` in ``rows``, and the total bytes of text."""
    names = docs.columns

    def pack(b: pa.RecordBatch) -> list[pa.Array]:
        return [pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), pa.StructArray.from_arrays(b.columns, names))]

    rows = T.ArrayType(T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema]))
    return write_packed(docs, pack, T.StructType([T.StructField("rows", rows)]), size, per_bucket)


def rows_of(table: pa.Table) -> pa.RecordBatch:
    """The rows of the one block in a group's table."""
    flat = table.column("rows").combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return pa.RecordBatch.from_struct_array(flat.flatten())


def nullable(kind: T.DataType) -> T.DataType:
    """A type in which everything may be null, as rows have it that come back from a block."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType))
    return kind


def as_declared(columns: list[pa.Array], schema: T.StructType) -> list[pa.Array]:
    """Columns with the Arrow types that Spark asks for: timestamps come with the session's time zone, and are asked for in UTC."""
    wanted = to_arrow_schema(schema).types
    return [c if c.type == t else c.cast(t) for c, t in zip(columns, wanted, strict=True)]
