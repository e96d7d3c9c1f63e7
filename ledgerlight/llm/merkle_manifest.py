"""Merkle manifest of a dataset: 16-ary trees by source, a tree over their roots, and proofs expanded from octopus multiproofs.

Every row is a leaf, the hash of its length-prefixed fields. The leaves of a source, in the order of their keys, are the bottom of
its tree; each run of 16 consecutive nodes (the last may be shorter, even a single one) is hashed into one node of the next level,
until one is left, the subroot. The subroots, in the order of their sources, are the bottom of the top tree, whose last node is the root.

Texts are hashed where they are read; only digests are sorted. Leaves get their place from a range sort and the row counts of its
partitions. Levels are built one by one, each a sixteenth of the one below. Then the sorted leaves are cut into partitions of
consecutive ones. Each asks for the smallest set of nodes that it can't derive from its own leaves (the octopus of its paths:
the members of the runs on the way up that none of its leaves is below), gets them in one join, derives the shared interior nodes
once, and expands the proof of each leaf. A message is one node for one partition of leaves, however large a source is.

Defined cases: a null field counts as ``-``; an empty text differs from a null one; null keys come first, leaves of equal keys are
ordered by their digest, and repeated rows are leaves of their own; null sources form one source, the first; an empty table gives
an empty result; a dataset of one leaf has that leaf as subroot and root and an empty proof. Only the named columns are read, under names of
their own, so further columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.llm.common import checkpointed, shuffle_partitions

#: Nodes of one run, and hexadecimal digits of a digest.
WIDTH, DIGITS = 16, 64
#: Tree number of the tree over the subroots; sources have 0, 1, ...
TOP = -1
#: Least and most leaves of a partition that expands proofs together.
LEAST, MOST = 256, 8192

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(content: str) -> str:
    return hashlib.sha256(content.encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """The hash of the fields, each as its length in bytes, a colon and its value."""
    texts = [field.cast("string") for field in fields]
    parts = [F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def octopus(leaves: np.ndarray, n: int) -> list[np.ndarray]:
    """For each level of a tree of ``n`` leaves, the nodes that proofs of ``leaves`` (distinct, ascending) need and can't derive."""
    missing = []
    while n > 1:
        runs = np.unique(leaves // WIDTH)
        members = (runs[:, None] * WIDTH + np.arange(WIDTH)).ravel()
        missing.append(np.setdiff1d(members[members < n], leaves, assume_unique=True))
        leaves, n = runs, -(-n // WIDTH)
    return missing


def fold(leaf: str, proof: str, places: list[tuple[int, int]]) -> str:
    """The root that a leaf and its siblings lead to; ``places`` are (place, number of nodes) in the source's tree and in the top tree."""
    taken = 0
    for place, n in places:
        while n > 1:
            first = place // WIDTH * WIDTH
            others = (min(WIDTH, n - first) - 1) * DIGITS
            before = (place - first) * DIGITS
            siblings = proof[taken:taken + others]
            leaf = digest(siblings[:before] + leaf + siblings[before:])
            taken, place, n = taken + others, place // WIDTH, -(-n // WIDTH)
    return leaf


class Expansion:
    """The runs of one tree above some of its leaves: derived from them and the fetched nodes, level by level."""

    def __init__(self, leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int):
        self.levels, level = [], 0
        while n > 1:
            nodes = dict(leaves)
            runs, above = {}, {}
            for run in {place // WIDTH for place in leaves}:
                members = range(run * WIDTH, min(n, (run + 1) * WIDTH))
                runs[run] = "".join(nodes[place] if place in nodes else fetched[level, place] for place in members)
                above[run] = digest(runs[run])
            self.levels.append(runs)
            leaves, n, level = above, -(-n // WIDTH), level + 1
        (self.root,) = set(leaves.values())
        self.above: dict[int, str] = {}

    def _upper(self, run: int) -> str:
        """The siblings above a run of leaves, the same for all of them."""
        if run not in self.above:
            self.above[run] = "".join(self._siblings(level, run // WIDTH ** (level - 1)) for level in range(1, len(self.levels)))
        return self.above[run]

    def _siblings(self, level: int, place: int) -> str:
        run, at = self.levels[level][place // WIDTH], place % WIDTH * DIGITS
        return run[:at] + run[at + DIGITS:]

    def proof(self, place: int) -> str:
        return self._siblings(0, place) + self._upper(place // WIDTH) if self.levels else ""


@dataclass(frozen=True)
class Manifest:
    """leaves: row (global number), tree, place (in the tree), n (leaves of the tree), key, leaf, presented; nodes: tree, level, place,
    digest, n (nodes of the level); the number of sources, of leaves, and the root (None for an empty dataset)."""

    leaves: DataFrame
    nodes: DataFrame
    sources: int
    rows: int
    root: str | None


def _placed(leaves: DataFrame) -> DataFrame:
    """Leaves with their places, from a range sort and counts of its partitions; no source is held in one task."""
    ordered = leaves.repartitionByRange("source", "key", "leaf").sortWithinPartitions("source", "key", "leaf")
    numbered = checkpointed(ordered.withColumn("id", F.monotonically_increasing_id())).select(
        "*", F.shiftright("id", 33).cast("int").alias("part"), F.col("id").bitwiseAND(F.lit((1 << 33) - 1)).alias("at"),
    )
    pieces = checkpointed(numbered.groupBy("part", "source").agg(F.count("*").alias("n"), F.min("at").alias("first")))
    # a source has at most one piece in each partition of the sort
    source, before = Window.partitionBy("source"), Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"), F.sum("n").over(source).alias("total"), F.min("part").over(source).alias("opens"),
    )
    # one row for each partition of the sort: rows and new sources of the partitions before
    parts = pieces.groupBy("part").agg(F.sum("n").alias("rows"), F.count_if(F.col("part") == F.col("opens")).alias("new"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = checkpointed(parts.select(
        "part", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("rows_ahead"), F.coalesce(F.sum("new").over(ahead), F.lit(0)).alias("sources_ahead"),
    ))
    opening = pieces.where("part = opens").select(
        "source", "part", (F.row_number().over(Window.partitionBy("part").orderBy("source")) - 1).alias("nth"),
    ).join(parts, "part").select(F.col("source").alias("of"), (F.col("sources_ahead") + F.col("nth")).alias("tree"))
    known = pieces.join(opening, F.col("source").eqNullSafe(F.col("of"))).join(parts.select("part", "rows_ahead"), "part").select(
        F.col("part").alias("in"), "of", "tree", "total", (F.col("earlier") - F.col("first")).alias("shift"), "rows_ahead",
    )
    return numbered.join(known, (F.col("part") == F.col("in")) & F.col("source").eqNullSafe(F.col("of"))).select(
        (F.col("at") + F.col("rows_ahead")).alias("row"), "tree", (F.col("at") + F.col("shift")).alias("place"), F.col("total").alias("n"),
        "key", "leaf", "presented",
    )


def _climb(bottom: DataFrame, most: int) -> list[DataFrame]:
    """The levels above ``bottom`` (tree, level, place, digest, n) of trees with up to ``most`` nodes there."""
    levels = [bottom]
    while most > 1:
        runs = levels[-1].where("n > 1").groupBy("tree", F.expr(f"place div {WIDTH}").alias("run"), "n", "level").agg(
            F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("members")  # a run, 16 at most
        )
        content = F.array_join(F.transform("members", lambda member: member["digest"]), "")
        levels.append(checkpointed(runs.select(
            "tree", (F.col("level") + 1).alias("level"), F.col("run").alias("place"), F.sha2(content.cast("binary"), 256).alias("digest"),
            F.expr(f"(n + {WIDTH - 1}) div {WIDTH}").alias("n"),
        )))
        most = -(-most // WIDTH)
    return levels


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", source: str = "source", presented: dict[str, Column] | None = None) -> Manifest:
    """The manifest of all rows. ``presented`` names fields with the values that are held against it later, where they differ."""
    own = [F.col(field) for field in fields]
    shown = [(presented or {}).get(field, F.col(field)) for field in fields]
    leaf = leaf_digest(own)
    leaves = checkpointed(_placed(docs.select(
        F.col(source).cast("string").alias("source"), F.col(key).alias("key"), leaf.alias("leaf"), (leaf_digest(shown) if presented else leaf).alias("presented"),
    )))
    size = leaves.agg(F.max("n").alias("n"), F.max("tree").alias("tree"), F.count("*").alias("rows")).first()
    levels = _climb(leaves.select("tree", F.lit(0).alias("level"), "place", F.col("leaf").alias("digest"), "n"), size.n or 0)
    sources = size.tree + 1 if size.rows else 0
    subroots = _union(levels).where("n = 1").select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("place"), "digest", F.lit(sources).cast("long").alias("n"),
    )
    levels += _climb(checkpointed(subroots), sources)
    nodes = _union(levels)
    top = nodes.where(f"tree = {TOP} AND n = 1").select("digest").first()
    return Manifest(leaves, nodes, sources, size.rows, top.digest if top else None)


def _requests(leaves: DataFrame, sources: int) -> DataFrame:
    """block, tree, level, place of all nodes that a block of leaves is missing."""
    ranges = leaves.groupBy("block", "tree", "n").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    blocks = ranges.groupBy("block").agg(F.collect_list(F.struct("tree", "n", "first", "last")).alias("pieces"))  # a block's sources, no more than its leaves

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pieces in zip(batch.column("block").to_pylist(), batch.column("pieces").to_pylist()):
                asked = [(piece["tree"], octopus(np.arange(piece["first"], piece["last"] + 1), piece["n"])) for piece in pieces]
                asked.append((TOP, octopus(np.unique([piece["tree"] for piece in pieces]), sources)))
                rows = [(tree, level, places) for tree, levels in asked for level, places in enumerate(levels) if len(places)]
                if rows:
                    sizes = [len(places) for _, _, places in rows]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(sum(sizes), block)), pa.array(np.repeat([tree for tree, _, _ in rows], sizes).astype(np.int64)),
                        pa.array(np.repeat([level for _, level, _ in rows], sizes).astype(np.int32)), pa.array(np.concatenate([p for _, _, p in rows]).astype(np.int64)),
                    ], ["block", "tree", "level", "place"])

    return blocks.mapInArrow(run, "block long, tree long, level int, place long")


def prove(manifest: Manifest, key: str = "doc_id") -> DataFrame:
    """key, leaf, subroot, root, proof (the siblings' digests, level by level up to the root), place, n_leaves, source_place, n_sources, and
    folded_root, which the presented leaf and the proof lead to."""
    rows, sources = manifest.rows, manifest.sources
    size = min(MOST, max(LEAST, rows // (4 * shuffle_partitions(manifest.leaves.sparkSession))))
    leaves = manifest.leaves.withColumn("block", F.expr(f"row div {size}"))
    fetched = _requests(leaves, sources).join(manifest.nodes.drop("n"), ["tree", "level", "place"])
    key_type = leaves.schema["key"].dataType.simpleString()

    def expand(mine: pa.Table, others: pa.Table) -> pa.Table:
        if mine.num_rows == 0:
            return pa.table({"key": mine["key"], **{name: pa.array([], kind) for name, kind in out.items()}})
        nodes: dict[int, dict[tuple[int, int], str]] = {}
        for tree, level, place, node in zip(*(others[name].to_pylist() for name in ("tree", "level", "place", "digest"))):
            nodes.setdefault(tree, {})[level, place] = node
        trees, places, counts, digests, shown = (mine[name].to_pylist() for name in ("tree", "place", "n", "leaf", "presented"))
        known: dict[int, tuple[dict[int, str], int]] = {}
        for tree, place, n, leaf in zip(trees, places, counts, digests):
            known.setdefault(tree, ({}, n))[0][place] = leaf
        expanded = {tree: Expansion(own, nodes.get(tree, {}), n) for tree, (own, n) in known.items()}
        top = Expansion({tree: expansion.root for tree, expansion in expanded.items()}, nodes.get(TOP, {}), sources)
        proofs = [expanded[tree].proof(place) + top.proof(tree) for tree, place in zip(trees, places)]
        folded = [fold(leaf, proof, [(place, n), (tree, sources)]) for leaf, proof, place, n, tree in zip(shown, proofs, places, counts, trees)]
        values = [digests, [expanded[tree].root for tree in trees], [top.root] * len(trees), proofs, places, counts, trees, [sources] * len(trees), folded]
        return pa.table({"key": mine["key"], **{name: pa.array(column, kind) for (name, kind), column in zip(out.items(), values)}})

    text, number = pa.string(), pa.int64()
    out = {
        "leaf": text, "subroot": text, "root": text, "proof": text, "place": number, "n_leaves": number, "source_place": number, "n_sources": number,
        "folded_root": text,
    }
    schema = f"key {key_type}, leaf string, subroot string, root string, proof string, place long, n_leaves long, source_place long, n_sources long, folded_root string"
    proved = leaves.groupBy("block").cogroup(fetched.groupBy("block")).applyInArrow(expand, schema)
    return proved.withColumnRenamed("key", key)
