"""Slices: stored blocks of neighbouring documents, read several times and addressed by row.

A slice holds the keys and whole texts of some documents as one compressed value, and has an id. Stored in the shared
checkpoint folder, slices are the same however often they are read, so (slice, position) names a row even where keys repeat or
are null; later steps send small messages to slices instead of moving texts about.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import binary_column, buffers, checkpointed, tidy

SLICE_BYTES = 4 << 20
#: A row's number is its slice's id times this plus its position; a slice's id is its partition times SLICES plus a counter.
ROWS, SLICES = 1 << 24, 1 << 18
#: Stands for a null key; it sorts before every other key.
NO_KEY = np.iinfo(np.int64).min
NO_TEXT = "__no_text"


class Slice:
    """Keys (64-bit integers), the bytes of the texts data[ends[i]:ends[i + 1]], and other columns as an Arrow stream."""

    def __init__(self, keys: np.ndarray, ends: np.ndarray, data: np.ndarray, rest: bytes = b""):
        self.keys, self.ends, self.data, self.rest = keys, ends, data, rest

    def pack(self, level: int = 1) -> bytes:
        head = np.array([len(self.keys), len(self.rest)], "<i8").tobytes()
        return zstandard.ZstdCompressor(level=level).compress(b"".join([head, self.keys.tobytes(), self.ends.tobytes(), self.rest, self.data.tobytes()]))

    @staticmethod
    def unpack(packed: bytes) -> Slice:
        raw = zstandard.ZstdDecompressor().decompress(packed)
        n, rest = np.frombuffer(raw, "<i8", 2).tolist()
        begin = 16 * (n + 1) + 8
        return Slice(
            np.frombuffer(raw, "<i8", n, 16), np.frombuffer(raw, "<i8", n + 1, 16 + 8 * n), np.frombuffer(raw, np.uint8, offset=begin + rest),
            raw[begin:begin + rest],
        )

    def columns(self) -> pa.Table:
        """The other columns (and a column that tells which texts are null, under NO_TEXT)."""
        return pa.ipc.open_stream(self.rest).read_all()

    def table(self, text: str) -> pa.Table:
        """The rows as they were: the other columns and the text."""
        texts = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self.keys), [None, pa.py_buffer(self.ends.tobytes()), pa.py_buffer(self.data.tobytes())]
        ).cast(pa.large_string())
        columns = self.columns()
        texts = pc.if_else(columns[NO_TEXT].combine_chunks(), pa.scalar(None, pa.large_string()), texts)
        return columns.drop_columns([NO_TEXT]).append_column(text, texts.cast(pa.string()))

    def parts(self, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(position of the first text, bytes, ends) of consecutive texts with about so many bytes."""
        begin, n = 0, len(self.keys)
        while begin < n:
            end = min(n, max(begin + 1, int(np.searchsorted(self.ends, self.ends[begin] + size, side="right")) - 1))
            yield begin, self.data[self.ends[begin]:self.ends[end]], self.ends[begin:end + 1] - self.ends[begin]
            begin = end


def slices_of(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SLICE_BYTES, level: int = 1, rest: bool = False) -> DataFrame:
    """slice, packed: all documents, stored; with ``rest`` the other columns too. No shuffle."""
    others = [name for name in docs.columns if name != text] if rest else []
    source = docs.select(
        F.col(key).cast("long").alias("__key"), F.col(text).cast("string").alias("__text"), *(F.col(f"`{name}`") for name in others)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bytes_held, made = [], 0, 0
        part = TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            nonlocal held, bytes_held, made
            keys = np.concatenate([k for k, _, _, _ in held])
            ends = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(e) for _, e, _, _ in held]))])
            sink = pa.BufferOutputStream()
            if rest:
                with pa.ipc.new_stream(sink, held[0][3].schema) as stream:
                    for _, _, _, rows in held:
                        stream.write_batch(rows)
            packed = Slice(keys, ends.astype(np.int64), np.concatenate([d for _, _, d, _ in held]), sink.getvalue().to_pybytes()).pack(level)
            out = pa.RecordBatch.from_arrays([pa.array([part * SLICES + made], pa.int64()), pa.array([packed], pa.binary())], ["slice", "packed"])
            held, bytes_held, made = [], 0, made + 1
            return out

        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = batch.column("__key").fill_null(int(NO_KEY)).to_numpy(zero_copy_only=False)
            data, ends = buffers(binary_column(batch, "__text"))
            columns = batch.select(others).append_column(NO_TEXT, batch.column("__text").is_null()) if rest else None
            begin = 0
            while begin < len(keys):
                room = max(size - bytes_held, 1)
                end = min(len(keys), max(begin + 1, int(np.searchsorted(ends, ends[begin] + room, side="right")) - 1))
                rows = columns.slice(begin, end - begin) if rest else None
                held.append((keys[begin:end].copy(), ends[begin:end + 1].copy(), data[ends[begin]:ends[end]].copy(), rows))
                bytes_held += int(ends[end] - ends[begin]) + 8 * (end - begin)
                begin = end
                if bytes_held >= size:
                    yield flush()
        if held:
            yield flush()

    return checkpointed(source.mapInArrow(tidy(run), "slice long, packed binary"))


def each_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Slice]]:
    for batch in batches:
        for name, packed in zip(batch.column("slice").to_pylist(), batch.column("packed")):
            yield name, Slice.unpack(packed.as_buffer())


def split(values: np.ndarray, bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts by bucket, ends of the buckets in it)."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def arrays(column: pa.ChunkedArray | pa.Array, dtype: str) -> list[np.ndarray]:
    return [np.frombuffer(value.as_buffer(), dtype) for value in column]


def columns_of(rows: np.ndarray) -> bytes:
    """A structured array column by column, integers as narrow as their range allows."""
    out = [np.array([len(rows)], "<u4").tobytes()]
    for name in rows.dtype.names:
        values = rows[name]
        least = values.min() if len(values) else values.dtype.type(0)
        span = int(values.max()) - int(least) if len(values) else 0
        width = next(w for w in (1, 2, 4, 8) if span < 1 << 8 * w)
        shifted = (values - least) if values.dtype.kind == "u" else (values.view("<u8") - least.view("<u8"))
        out += [np.array([width], "u1").tobytes(), np.array([int(least)]).astype("<i8" if values.dtype.kind == "i" else "<u8").tobytes(), shifted.astype(f"<u{width}").tobytes()]
    return b"".join(out)


def rows_of(packed, dtype: np.dtype) -> np.ndarray:
    n = int(np.frombuffer(packed, "<u4", 1)[0])
    out, at = np.zeros(n, dtype), 4
    for name in dtype.names:
        width = int(np.frombuffer(packed, "u1", 1, at)[0])
        least = np.frombuffer(packed, "<u8", 1, at + 1)[0]
        values = np.frombuffer(packed, f"<u{width}", n, at + 9).astype("<u8") + least
        out[name] = values.view("<i8") if dtype[name].kind == "i" else values
        at += 9 + width * n
    return out
