"""Contiguous shards of nearly equal byte size, cut from global prefix sums.

Rows are put into one global order (by the hash of the text, then by key: equal texts stand next to each other). Each
partition sums up its own rows; the totals of the partitions, one row each, give every partition's offset, and offset
plus local sum is a row's global prefix sum. The order is cut at equal targets. A cut that falls into a group of equal
texts moves to the nearer end of that group if that is within MOVE_PERCENT of a shard; else the group is cut at the target. So a
shard's bytes differ from its equal part by twice that percentage and one row at most.

Defined cases: a null text has the size of an empty one; null keys come first; repeated rows are kept, each with a slot of
its own; an empty table gives an empty result; fewer rows than shards leave some shards empty. Only the key and numbers made
from the text are carried, so further columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import checkpointed

#: Bytes that each row counts besides its text.
ROW_BYTES = 8
#: How far a cut may move to keep equal texts together, in percent of a shard's equal part.
MOVE_PERCENT = 1


def with_prefix_sums(sizes: DataFrame) -> DataFrame:
    """Columns key, size, crc, hash and the global sums before each row: ``before`` in bytes, ``row`` in rows."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total, rows = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            ends = pc.cumulative_sum(batch.column("size"), start=total)
            before = pc.subtract(ends, batch.column("size"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * n, pa.int32()), before, pa.array(range(rows, rows + n), pa.int64())],
                [*batch.schema.names, "part", "before", "row"],
            )
            total, rows = ends[n - 1].as_py(), rows + n

    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in sizes.schema)}, part int, before long, row long"
    ordered = sizes.repartitionByRange("hash", "key").sortWithinPartitions("hash", "key")
    summed = checkpointed(ordered.mapInArrow(local, schema))
    totals = summed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).orderBy("part").collect()
    offsets, at, rows = [], 0, 0
    for total in totals:  # one row for each partition
        offsets.append((total.part, at, rows))
        at, rows = at + total.bytes, rows + total.rows
    frame = sizes.sparkSession.createDataFrame(offsets, "part int, bytes_before long, rows_before long")
    return summed.join(F.broadcast(frame), "part").select(
        "key", "size", "crc", "hash",
        (F.col("before") + F.col("bytes_before")).alias("before"), (F.col("row") + F.col("rows_before")).alias("row"),
    )


def cuts(prefix: DataFrame, shards: int) -> list[int]:
    """The byte positions at which the shards 1, 2, ... begin."""
    total = prefix.agg(F.max(F.col("before") + F.col("size"))).first()[0] or 0
    step = lambda position: F.floor(position * F.lit(shards) / F.lit(max(total, 1)))
    crossing = prefix.where(step(F.col("before")) != step(F.col("before") + F.col("size"))).select("hash").distinct()
    # each of these groups holds a cut, so there are fewer of them than shards
    groups = (
        prefix.join(F.broadcast(crossing), "hash").groupBy("hash")
        .agg(F.min("before").alias("begin"), F.max(F.col("before") + F.col("size")).alias("end")).collect()
    )
    out = []
    for shard in range(1, shards):
        cut = -(-total * shard // shards)
        for group in groups:
            if group.begin < cut < group.end:
                near = group.begin if cut - group.begin <= group.end - cut else group.end
                cut = near if abs(near - cut) * shards * 100 <= MOVE_PERCENT * total else cut
                break
        out.append(max(cut, out[-1]) if out else cut)
    return out


def shard_by_bytes(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, shard (0 ... shards - 1) and slot (0, 1, ... within the shard) of every row."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    sizes = docs.select(
        F.col(key).alias("key"), (F.octet_length(content).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(content.cast("binary")).alias("crc"), F.xxhash64(content).alias("hash"),
    )
    prefix = with_prefix_sums(sizes)
    bounds = F.array(*(F.lit(cut).cast("long") for cut in cuts(prefix, shards))) if shards > 1 else F.array().cast("array<bigint>")
    placed = prefix.withColumn("shard", F.size(F.filter(bounds, lambda cut: cut <= F.col("before"))))
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))  # one row for each shard
    return placed.join(F.broadcast(first), "shard").select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("row") - F.col("first")).alias("slot")
    )
