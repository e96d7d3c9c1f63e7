"""Quality rules: exact statistics of whole texts, simple base rules, and an isolation forest over the statistics.

The forest sees the statistics themselves, as shares that don't depend on a text's length. Trees split samples of rows, drawn for each
tree from all labelled rows, at random and without their labels; documents that few splits isolate are anomalous. Labels set the cut only, between the mean path lengths of
usual and anomalous documents: the share of bad rows caught less LOST_WEIGHT times the share of good rows lost is largest.

Defined cases: a null or empty text has no words and fails the base rules; without good or bad labelled rows nothing counts as
anomalous; repeated rows are judged alike; an empty table gives an empty result; other columns are ignored. One document is one
unit of work: its words are held as numbers, about 30 bytes for each byte of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm import labelled, textstats
from ledgerlight.llm import wordvec as W
from ledgerlight.llm.common import buffers, checkpointed, slices, tidy

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
TREES, TREE_ROWS, DEPTH, SEED = 200, 256, 8, 7
#: How many times the share of good rows lost counts against the share of bad rows caught.
LOST_WEIGHT = 10
SLICE_BYTES = 1 << 20
#: Rows that trees are drawn for at a time.
DRAWN_ROWS = 2048


def expected_path(rows: int) -> float:
    """Mean length of an unsuccessful search in a random tree of so many rows."""
    return 0.0 if rows <= 1 else 2 * (np.log(rows - 1) + np.euler_gamma) - 2 * (rows - 1) / rows


@dataclass(frozen=True)
class Forest:
    """Trees as arrays (tree, node): the feature (-1 at a leaf), the split value, the children, the path length at a leaf."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray
    cut: float

    def path_lengths(self, ratios: np.ndarray) -> np.ndarray:
        total = np.zeros(len(ratios))
        rows = np.arange(len(ratios))
        for tree in range(len(self.feature)):
            at = np.zeros(len(ratios), np.int64)
            for _ in range(DEPTH):
                feature = self.feature[tree, at]
                goes = np.where(ratios[rows, np.maximum(feature, 0)] <= self.value[tree, at], self.left[tree, at], self.right[tree, at])
                at = np.where(feature >= 0, goes, at)
            total += self.length[tree, at]
        return total / max(len(self.feature), 1)

    def anomalous(self, lengths: np.ndarray) -> np.ndarray:
        return lengths < self.cut


def base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def grow(rows: np.ndarray, rng: np.random.Generator) -> list[tuple[int, float, int, int, float]]:
    """The nodes of one tree: random feature, random value between its smallest and largest."""
    nodes: list[tuple[int, float, int, int, float]] = []

    def node(some: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append((-1, 0.0, 0, 0, depth + expected_path(len(some))))
        low, high = (some.min(axis=0), some.max(axis=0)) if len(some) else (np.zeros(0), np.zeros(0))
        splits = np.flatnonzero(low < high)
        if depth < DEPTH and len(some) > 1 and len(splits):
            feature = int(rng.choice(splits))
            value = float(rng.uniform(low[feature], high[feature]))
            goes = some[:, feature] <= value
            left = node(some[goes], depth + 1)
            nodes[at] = (feature, value, left, node(some[~goes], depth + 1), 0.0)
        return at

    node(rows, 0)
    return nodes


def calibrated_cut(lengths: np.ndarray, good: np.ndarray) -> float:
    """The path length below which a document is anomalous; 0 if no cut is worth it."""
    if good.all() or not good.any():
        return 0.0
    kept, caught = np.sort(lengths[good]), np.sort(lengths[~good])
    values = np.unique(lengths)
    candidates = (values[1:] + values[:-1]) / 2
    lost = np.searchsorted(kept, candidates) / len(kept)
    found = np.searchsorted(caught, candidates) / len(caught)
    gain = found - LOST_WEIGHT * lost
    if not len(gain) or gain.max() <= 0:
        return 0.0
    return float(candidates[np.flatnonzero(gain == gain.max())[0]])


def _packed_trees(trees: list[list[tuple[int, float, int, int, float]]], cut: float = 0.0) -> Forest:
    width = max(map(len, trees), default=1)
    parts = [np.array([[n[i] for n in tree] + [0] * (width - len(tree)) for tree in trees]).reshape(len(trees), width) for i in range(5)]
    return Forest(parts[0].astype(int), parts[1].astype(float), parts[2].astype(int), parts[3].astype(int), parts[4].astype(float), cut)


def fit(ratios: np.ndarray, good: np.ndarray, passed: np.ndarray) -> Forest:
    """`fit_forest` on rows in memory: trees from rows without their labels, and the cut from labelled ones; only rows that pass the base
    rules count."""
    ratios, good = ratios[passed], good[passed].astype(bool)
    rng = np.random.default_rng(SEED)
    trees = [grow(ratios[rng.choice(len(ratios), min(TREE_ROWS, len(ratios)), replace=False)], rng) for _ in range(TREES if len(ratios) else 0)]
    forest = _packed_trees(trees)
    return replace(forest, cut=calibrated_cut(forest.path_lengths(ratios), good))


def _trees(rows: DataFrame, n: int) -> list[list[tuple[int, float, int, int, float]]]:
    """The nodes of each tree, grown from the rows with its TREE_ROWS smallest hashes among all ``n`` rows of (hash, values).

    Only rows whose hash is below twice the expected border are sent; each tree is grown by one task.
    """
    share = min(1.0, 2 * TREE_ROWS / n)
    border = np.uint64(min(int(share * 2 ** 64), 2 ** 64 - 1))
    salts = W.mix(np.arange(SEED, SEED + TREES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, DRAWN_ROWS):
                part = batch.slice(begin, DRAWN_ROWS)
                hashes = W.mix(part.column("hash").to_numpy().view(np.uint64)[:, None] ^ salts)
                row, tree = np.nonzero(hashes <= border)
                order = (hashes[row, tree] >> np.uint64(1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), pa.array(order), part.column("values").take(pa.array(row))], ["tree", "order", "values"])

    def grown(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        tree, matrix = table["tree"][0].as_py(), labelled.matrix_of(table["values"].combine_chunks())[:, labelled.COUNTED:]
        chosen = matrix[np.lexsort([*matrix.T, table["order"].to_numpy()])[:TREE_ROWS]]
        nodes = grow(chosen, np.random.default_rng([SEED, tree]))
        columns = [pa.array([list(part)], pa.list_(kind)) for part, kind in zip(zip(*nodes), (pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64()))]
        return pa.table([pa.array([tree], pa.int32()), *columns], ["tree", "feature", "value", "left", "right", "length"])

    drawn = rows.select("hash", "values").mapInArrow(draw, "tree int, order long, values array<double>")
    found = drawn.groupBy("tree").applyInArrow(grown, "tree int, feature array<int>, value array<double>, left array<int>, right array<int>, length array<double>")
    # TREES rows of at most 2 ** (DEPTH + 1) nodes
    return [list(zip(row.feature, row.value, row.left, row.right, row.length)) for row in sorted(found.collect(), key=lambda row: row.tree)]


def _cut(rows: DataFrame, forest: Forest) -> float:
    """`calibrated_cut` over all rows of (label, values): the rows of smaller path lengths are counted over ranges of lengths, one for each task."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(forest)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = shared.value.path_lengths(labelled.matrix_of(batch.column("values"))[:, labelled.COUNTED:])
            yield pa.RecordBatch.from_arrays([pa.array(lengths), batch.column("label")], ["length", "label"])

    lengths = rows.select("label", "values").mapInArrow(measure, "length double, label int")
    counts = lengths.groupBy("length").agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"))
    ranges = checkpointed(counts.repartitionByRange("length").withColumn("part", F.spark_partition_id()))
    # one row for each task
    parts = ranges.groupBy("part").agg(F.min("length").alias("first"), F.sum("good").alias("good"), F.sum("bad").alias("bad")).sort("first").collect()
    good, bad = sum(part.good for part in parts), sum(part.bad for part in parts)
    if not good or not bad:
        return 0.0
    starts, upto = [], [0, 0]
    for part, after in zip(parts, [*parts[1:], None]):
        starts.append((part.part, upto[0], upto[1], after.first if after else None))
        upto = [upto[0] + part.good, upto[1] + part.bad]
    starts = spark.createDataFrame(starts, "part int, good_before long, bad_before long, after double")
    within = Window.partitionBy("part").orderBy("length")
    sums = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gaps = ranges.join(F.broadcast(starts), "part").select(
        (F.col("good_before") + F.sum("good").over(sums)).alias("lost"), (F.col("bad_before") + F.sum("bad").over(sums)).alias("caught"),
        "length", F.coalesce(F.lead("length").over(within), "after").alias("next"),
    ).where("next IS NOT NULL")
    middle = (F.col("next") + F.col("length")) / 2
    candidate = F.when(middle > F.col("length"), middle).otherwise(F.col("next"))
    gain = F.col("caught") / F.lit(float(bad)) - LOST_WEIGHT * (F.col("lost") / F.lit(float(good)))
    best = gaps.agg(F.max(F.struct(gain.alias("gain"), (-candidate).alias("cut"))).alias("best")).first().best
    return -best.cut if best is not None and best.gain > 0 else 0.0


def fit_forest(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Forest:
    """Trees from rows drawn of all labelled documents without their labels, and the cut from the labels of all; only documents that pass the
    base rules count."""
    found = labelled.labelled_rows(docs, labels, label, key, text)
    counts = [F.element_at("values", labelled.NAMES.index(name) + 1) for name in ("n_words", "n_repeat_words")]
    rows = found.where(~base_failed(*counts)).withColumn("hash", F.xxhash64("key"))
    forest = _packed_trees(_trees(rows, n) if (n := rows.count()) else [])
    return replace(forest, cut=_cut(rows, forest))


def judge(docs: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, the five counts, base_failed, path_length, anomalous, kept of every document; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField(key, source.schema["key"].dataType), *(T.StructField(name, T.LongType()) for name in textstats.COUNTS),
        T.StructField("base_failed", T.BooleanType()), T.StructField("path_length", T.DoubleType()),
        T.StructField("anomalous", T.BooleanType()), T.StructField("kept", T.BooleanType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows, texts in slices(batch, "text", SLICE_BYTES):
                stats = textstats.statistics(*buffers(texts))
                failed = base_failed(stats["n_words"], stats["n_repeat_words"])
                lengths = model.path_lengths(labelled.ratio_matrix(stats))
                odd = model.anomalous(lengths)
                counts = [pa.array(stats[name].astype(np.int64)) for name in textstats.COUNTS]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("key"), *counts, *map(pa.array, (failed, lengths, odd, ~(failed | odd)))], schema.fieldNames()
                )

    return source.mapInArrow(tidy(run), schema)
