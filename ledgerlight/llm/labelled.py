"""Labelled rows with the statistics of their whole texts, and exact figures of all of them: sums and ranks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm import textstats
from ledgerlight.llm.common import buffers, checkpointed, slices, tidy

SLICE_BYTES = 1 << 20
#: Bits of a value that one pass of `order_statistics` settles; groups of tasks that `added` adds up first.
BITS, GROUPS = 13, 16

RATIOS = [
    "symbols", "symbol_words", "dup_lines", "repeats", "upper", "loud", "bars", "digits", "next_same", "letters", "word_length",
    "other", "punctuation", "word_again", "long_words", "short_words", "line_words", "words",
]
COUNTED = len(textstats.COUNTS)
NAMES = [*textstats.COUNTS, *RATIOS]


def ratio_matrix(stats: dict[str, np.ndarray]) -> np.ndarray:
    ratios = textstats.ratios(stats)
    return np.stack([np.asarray(ratios[name], np.float64) for name in RATIOS], axis=1)


def matrix_of(column: pa.Array, width: int = len(NAMES)) -> np.ndarray:
    """A column of equally long lists of numbers, one row each."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def lists_of(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(matrix, np.float64).ravel()))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text", where: Column | None = None) -> DataFrame:
    """key, label 0 or 1, values (as in NAMES) of every labelled document, kept in the shared folder.

    Labels other than 0 and 1 and null keys are left out; a key with several labels counts with the smallest, and one of several documents with
    that whose text has the smallest hash. Texts are not moved: their statistics, about 200 bytes a document, meet the labels by key,
    each task sends one document of a key.
    """
    wanted = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("key IS NOT NULL AND label IN (0, 1)")
    wanted = wanted.where(where) if where is not None else wanted
    wanted = wanted.groupBy("key").agg(F.min("label").alias("label"))
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("key IS NOT NULL").withColumn("hash", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, content in slices(batch, "text", SLICE_BYTES):
                stats = textstats.statistics(*buffers(content))
                numbers = np.concatenate([np.stack([stats[name].astype(np.float64) for name in textstats.COUNTS], axis=1), ratio_matrix(stats)], axis=1)
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("hash"), lists_of(numbers)], ["key", "hash", "values"])

    kind = texts.schema["key"].dataType.simpleString()
    each = texts.mapInArrow(tidy(run), f"key {kind}, hash long, values array<double>")
    each = each.groupBy("key").agg(F.min(F.struct("hash", "values")).alias("best")).join(wanted, "key")
    each = each.groupBy("key").agg(F.min(F.struct("best.hash", "label", "best.values")).alias("best"))
    return checkpointed(each.select("key", "best.label", "best.values"))


def labelled_ratios(
    docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text", where: Column | None = None,
) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(ratios, label, counts) of the labelled documents in the order of their keys as text, of tables that fit the driver; the fits use
    `labelled_rows`."""
    found = labelled_rows(docs, labels, label, key, text, where).withColumn("key", F.col("key").cast("string")).toArrow().sort_by("key").combine_chunks()
    matrix = matrix_of(found["values"].combine_chunks()) if len(found) else np.zeros((0, len(NAMES)))
    return matrix[:, COUNTED:], found["label"].to_numpy(), {name: matrix[:, i].astype(np.int64) for i, name in enumerate(textstats.COUNTS)}


def added(rows: DataFrame, function: Callable[[pa.RecordBatch], np.ndarray], width: int, place: str | None = None) -> np.ndarray:
    """The sum over all rows of the vectors that ``function`` makes of batches; a task or, by the column ``place``, a row sends one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for i in range(batch.num_rows if place else 1):
                mine = batch.slice(i, 1) if place else batch
                total += function(mine)
                if place:
                    yield sent(mine.column(place)[0].as_py(), total)
                    total = np.zeros(width)
        if not place:
            yield sent(TaskContext.get().partitionId(), total)

    def sent(at: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at % GROUPS], pa.int32()), pa.array([at], pa.int64()), lists_of(total[None])], ["group", "place", "sums"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("place").combine_chunks()  # the same order of adding whichever message came first
        return pa.table({"group": table["group"][:1], "sums": lists_of(matrix_of(table["sums"].combine_chunks(), width).sum(axis=0)[None])})

    sums = rows.mapInArrow(run, "group int, place long, sums array<double>").groupBy("group").applyInArrow(add, "group int, sums array<double>")
    return np.sum([np.zeros(width), *(row["sums"] for row in sorted(sums.collect(), key=lambda row: row["group"]))], axis=0)


def _ordered(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the values, without a difference between the two zeros."""
    bits = (np.ascontiguousarray(values, np.float64) + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def _unordered(numbers: np.ndarray) -> np.ndarray:
    return np.where(numbers >> np.uint64(63), numbers & np.uint64((1 << 63) - 1), ~numbers).view(np.float64)


def order_statistics(rows: DataFrame, function: Callable[[pa.RecordBatch], np.ndarray], ranks: list[int]) -> np.ndarray:
    """For each column of the matrices that ``function`` makes of batches, the value with this rank (from 0) among all rows.

    Each pass counts the next BITS bits of the values that agree with what is known of the wanted one, so a task sends at most 2 ** BITS
    counts for each column.
    """
    found, left = np.zeros(len(ranks), np.uint64), np.array(ranks)
    shift = 64
    while shift:
        bits = min(BITS, shift)
        known, shift = shift, shift - bits

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros((len(ranks), 1 << bits), np.int64)
            for batch in batches:
                numbers = _ordered(function(batch))
                for i in range(len(ranks)):
                    mine = numbers[:, i] if known == 64 else numbers[numbers[:, i] >> np.uint64(known) == found[i] >> np.uint64(known), i]
                    counts[i] += np.bincount((mine >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
            column, digit = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int32()), pa.array(digit, pa.int32()), pa.array(counts[column, digit])], ["column", "digit", "n"])

        table = rows.mapInArrow(run, "column int, digit int, n long").groupBy("column", "digit").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros((len(ranks), 1 << bits), np.int64)
        counts[table["column"].to_numpy(), table["digit"].to_numpy()] = table["n"].to_numpy()
        for i, upto in enumerate(np.cumsum(counts, axis=1)):
            digit = int(np.searchsorted(upto, left[i], side="right"))
            left[i] -= upto[digit - 1] if digit else 0
            found[i] |= np.uint64(digit << shift)
    return _unordered(found)
