"""Small helpers shared by the operators: column names, checkpoints, Arrow columns."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlight.session import checkpointed

__all__ = ["binary_column", "buffers", "checkpointed", "give_back", "packed", "private", "replaced", "shuffle_partitions", "slices", "tidy"]


def private(name: str) -> str:
    """A column name that no user table has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def replaced(df: DataFrame, added: list[T.StructField]) -> T.StructType:
    """The schema of ``df`` and the added fields; columns of the same names, in any case, are left out."""
    names = {field.name.lower() for field in added}
    return T.StructType([*(field for field in df.schema.fields if field.name.lower() not in names), *added])


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks, and what they keep counts for the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function over batches that gives its memory back at the end of the task."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            give_back()

    return whole


def binary_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text or binary column as large binary, nulls as empty."""
    column = batch.column(name)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    return column.cast(pa.large_binary())


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large binary array without nulls, the offsets counted from its first byte."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, count=column.offset + len(column) + 1)[column.offset:]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8)
    return whole[ends[0]:ends[-1]], ends - ends[0]


def slices(batch: pa.RecordBatch, name: str, target_bytes: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Consecutive rows of a batch with about ``target_bytes`` of the named column each, one row at least."""
    column = binary_column(batch, name)
    if len(column) == 0:
        return
    _, ends = buffers(column)
    begin = 0
    while begin < len(column):
        end = int(np.searchsorted(ends, ends[begin] + target_bytes, side="right")) - 1
        end = min(max(end, begin + 1), len(column))
        yield batch.slice(begin, end - begin), column.slice(begin, end - begin)
        begin = end


def packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary array whose i-th value holds the raw bytes of values[ends[i]:ends[i + 1]]."""
    values = np.ascontiguousarray(values)
    offsets = (np.asarray(ends, np.int64) * values.itemsize)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())]
    ).cast(pa.binary())
