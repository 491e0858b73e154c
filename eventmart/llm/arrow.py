"""Run a function over the texts of a DataFrame, in Arrow pieces of bounded size."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of text handled at once. A longer text is a piece of its own.
PIECE_BYTES = 2 << 20

Results = dict[str, object]


def release() -> None:
    """Give freed memory back to the system. Python workers live on between tasks, and share an executor's
    memory with its JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def kept_columns(frame: DataFrame, results: list[str], keep: list[str] | None = None) -> list[str]:
    """Columns of `frame` that go along: those of `keep` (default all) that no result replaces.

    Names are compared without regard to case, as Spark does.
    """
    replaced = {name.lower() for name in results}
    wanted = frame.columns if keep is None else keep
    return [c for c in wanted if c.lower() not in replaced]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each value begins and the last one ends. Null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, values = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]] if values is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `size` bytes of text."""
    _, offsets = utf8(batch.column(text))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + size, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def map_texts(
    docs: DataFrame,
    text: str,
    results: T.StructType,
    make: Callable[[], Callable[[pa.Array, pa.RecordBatch], Results]],
    keep: list[str] | None = None,
    also: dict | None = None,
    size: int = PIECE_BYTES,
) -> DataFrame:
    """`docs` with result columns, one row for each of its rows.

    `make()` is called in each task and returns a function of (texts, batch) that gives each result
    column as a list or array. Its batch has the columns of `also` (name: Column) beside the kept ones.
    """
    columns = kept_columns(docs, results.fieldNames(), keep)
    also = also or {}
    source = docs.select(
        *[F.col(f"`{c}`") for c in columns],
        *[c.alias(f"_also_{k}") for k, c in also.items()],
        F.col(f"`{text}`").cast("string").alias("_text_"),
    )
    schema = T.StructType([docs.schema[c] for c in columns] + list(results.fields))
    kinds = [_arrow_type(f.dataType) for f in results.fields]
    names = results.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for piece in pieces(batch, "_text_", size):
                found = work(piece.column("_text_"), piece)
                made = [pa.array(found[n], kind) for n, kind in zip(names, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*piece.columns[: len(columns)], *made], [*columns, *names])
            release()

    return source.mapInArrow(run, schema)


def emit(docs: DataFrame, text: str, schema: T.StructType, make, columns: dict | None = None, size: int = PIECE_BYTES):
    """Any number of rows for each piece: `make()` returns a function of (texts, batch) that gives columns.

    It may have an attribute `last`, called without arguments at the end of the task.
    """
    source = docs.select(
        *[c.alias(f"_also_{k}") for k, c in (columns or {}).items()],
        F.col(f"`{text}`").cast("string").alias("_text_"),
    )
    names = schema.fieldNames()
    kinds = [_arrow_type(f.dataType) for f in schema.fields]

    def batch_of(found: Results) -> pa.RecordBatch:
        made = [pa.array(found[n], kind) for n, kind in zip(names, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(made, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for piece in pieces(batch, "_text_", size):
                found = work(piece.column("_text_"), piece)
                if found is not None:
                    yield batch_of(found)
            release()
        if hasattr(work, "last"):
            found = work.last()
            if found is not None:
                yield batch_of(found)

    return source.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, _arrow_type(f.dataType)) for f in kind.fields])
    return {
        T.LongType: pa.int64(),
        T.IntegerType: pa.int32(),
        T.DoubleType: pa.float64(),
        T.BooleanType: pa.bool_(),
        T.StringType: pa.string(),
        T.BinaryType: pa.binary(),
    }[type(kind)]
