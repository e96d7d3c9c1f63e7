"""N-gram Jaccard join by signature trees, exact at a similarity of 0.8, with the components of its links.

1. Every document becomes the set of its word windows; equal sets are one vertex.
2. Half of all windows, chosen by hash, are counted over all documents. A set with more windows that occur nowhere else than its
   overlap may miss has no partner. This bound is exact, and it leaves out most documents before anything large is moved.
3. The rest count their windows again, now among themselves, and send those of an exact prefix filter, the rarest first; vertices that share
   one form candidate groups.
4. Inside a group a signature tree is built: each node holds the OR of its sets' bitmaps, their sizes' range and the slack between set
   size and bitmap. The tree is traversed against itself; a pair of nodes is dropped if its largest possible overlap is too small, or if
   all its sets are linked already. What remains at the leaves is compared exactly.
5. Groups larger than GROUP_WINDOWS are cut into blocks and every pair of blocks is a task of its own, so that no group has to fit
   into one; links are then joined to components.

Defined cases: a text without words has an empty set and is linked with nothing; texts with fewer words than a window have one
element, all their words; repeated rows and equal texts are linked; null keys are allowed and never are a component's
smallest key unless nothing else is in it; an empty table gives an empty result; other columns are ignored. A document's set has to fit
into memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm import wordvec as W
from ledgerlight.llm.common import checkpointed, packed, shuffle_partitions, tidy
from ledgerlight.llm.components import components
from ledgerlight.llm.textslices import NO_KEY, ROWS, Slice, arrays, each_slice, slices_of, split

WINDOW = 5
PART_BYTES = 1 << 20
#: Bits of a set's signature, sets of a leaf, children of a node.
BITS, LEAF, FAN = 2048, 16, 8
#: Windows of a group that one task handles; larger groups are cut into blocks of half of it.
GROUP_WINDOWS = 4_000_000


def linked(overlap, a, b):
    """Whether 100 * intersection >= 80 * union, from the sizes."""
    return 9 * overlap >= 4 * (a + b)


def window_sets(data: np.ndarray, ends: np.ndarray, size: int = WINDOW) -> list[np.ndarray]:
    """The sorted distinct window names of each text."""
    words = W.Words(data, ends, lower=True)
    windows, inside = words.windows(size)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    for count in range(1, size):
        of = short[words.counts[short] == count]
        if len(of):
            at = words.first[of]
            name = np.zeros(len(of), np.uint64)
            for j in range(count):
                name += words.hashes[at + j] * np.uint64(pow(W._BASE, 2 * j + 1, 1 << 64))
            windows[at], inside[at] = W.mix(name + np.uint64(count)), True
    return [np.unique(windows[a:b][inside[a:b]]) for a, b in zip(words.first[:-1], words.first[1:])]


def fingerprints(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of each set, the sets' tokens standing one after the other."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = []
    for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        sums = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(W.mix(tokens ^ np.uint64(seed)), out=sums[1:])
        out.append(W.mix(sums[ends[1:]] - sums[ends[:-1]] + sizes.astype(np.uint64)))
    return out[0], out[1]


def _count_requests(slices: DataFrame, buckets: int, window: int) -> DataFrame:
    """bucket, slice, tokens, rows: sampled tokens by bucket, and (bucket >= buckets) one message on the rows of each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, part in each_slice(batches):
            sets = [s for _, data, ends in part.parts(PART_BYTES) for s in window_sets(data, ends, window)]
            sizes = np.array([len(s) for s in sets], np.int64)
            tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            one, two = fingerprints(tokens, sizes)
            sampled = (tokens & np.uint64(1)) == 0
            rows = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)[sampled]
            sampled_sizes = np.bincount(rows, minlength=len(sets))
            some = tokens[sampled]
            order, ends = split(some, ((some >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32), buckets)
            low, rows = (some >> np.uint64(1)).astype(np.uint32)[order], rows[order]
            narrow = "<u2" if len(sets) < 1 << 16 else "<u4"
            about = np.stack([part.keys, sizes, sampled_sizes, one.view(np.int64), two.view(np.int64)])
            full = np.flatnonzero(np.diff(ends))
            yield pa.RecordBatch.from_arrays([
                pa.array([*full.tolist(), buckets + name % buckets], pa.int32()), pa.array([name] * (len(full) + 1), pa.int64()),
                pa.array([*(low[ends[b]:ends[b + 1]].tobytes() for b in full), about.tobytes()], pa.binary()),
                pa.array([*(rows[ends[b]:ends[b + 1]].astype(narrow).tobytes() for b in full), None], pa.binary()),
            ], ["bucket", "slice", "tokens", "rows"])

    return slices.mapInArrow(tidy(run), "bucket int, slice long, tokens binary, rows binary")


def _shared_counts(table: pa.Table) -> pa.Table:
    """For each slice of a bucket: which of its rows have how many tokens that occur elsewhere too; other messages pass."""
    names = table["slice"].to_numpy()
    if table["rows"].null_count:
        return pa.table({"slice": table["slice"], "rows": pa.nulls(len(names), pa.binary()), "counts": table["tokens"]})
    tokens = arrays(table["tokens"], "<u4")
    sizes = np.array([len(t) for t in tokens])
    rows = [
        np.frombuffer(value.as_buffer(), "<u2" if value.as_buffer().size == 2 * n else "<u4").astype(np.uint32)
        for value, n in zip(table["rows"], sizes)
    ]
    every = np.concatenate(tokens)
    order = np.argsort(every)
    ordered = every[order]
    same = np.zeros(len(every) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(every), bool)
    twice[order] = same[1:] | same[:-1]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = [np.unique(r[twice[a:b]], return_counts=True) for r, a, b in zip(rows, ends[:-1], ends[1:])]
    return pa.table({
        "slice": pa.array(names, pa.int64()), "rows": pa.array([r.astype("<u4").tobytes() for r, _ in out], pa.binary()),
        "counts": pa.array([c.astype("<u4").tobytes() for _, c in out], pa.binary()),
    })


def _members(table: pa.Table) -> pa.Table:
    """The rows of one slice: key, size, fingerprints, and whether a partner is possible."""
    about, shared = None, []
    for rows, counts in zip(table["rows"], table["counts"]):
        if rows.is_valid:
            shared.append((np.frombuffer(rows.as_buffer(), "<u4"), np.frombuffer(counts.as_buffer(), "<u4")))
        else:
            about = np.frombuffer(counts.as_buffer(), "<i8").reshape(5, -1)
    key, size, sampled, one, two = about
    found = np.zeros(len(key), np.int64)
    for rows, counts in shared:
        found[rows] += counts
    name = table["slice"][0].as_py()
    return pa.table({
        "uid": pa.array(name * ROWS + np.arange(len(key))), "key": pa.array(key, mask=key == NO_KEY), "n": size, "one": one, "two": two,
        "open": (size > 0) & (sampled - found <= size // 5),
    })


def _sets(slices: DataFrame, reps: DataFrame, window: int) -> DataFrame:
    """slice, uids, sizes, tokens: the sets of the vertices' representatives, one row for each slice that has some."""

    def run(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        uids, out = [], []
        if len(texts) and len(wanted):
            part = Slice.unpack(texts["packed"][0].as_buffer())
            name = texts["slice"][0].as_py()
            rows = np.sort(wanted["uid"].to_numpy() - name * ROWS)
            for first, data, ends in part.parts(PART_BYTES):
                mine = rows[(rows >= first) & (rows < first + len(ends) - 1)] - first
                if len(mine) == 0:
                    continue
                chosen = np.concatenate([data[ends[r]:ends[r + 1]] for r in mine])
                new_ends = np.concatenate([[0], np.cumsum(ends[mine + 1] - ends[mine])])
                uids.append(name * ROWS + first + mine)
                out.extend(window_sets(chosen, new_ends, window))
        if not out:
            return pa.table({"slice": pa.nulls(0, pa.int64()), **{n: pa.nulls(0, pa.binary()) for n in ("uids", "sizes", "tokens")}})
        return pa.table({
            "slice": pa.array([name], pa.int64()), "uids": pa.array([np.concatenate(uids).astype("<i8").tobytes()], pa.binary()),
            "sizes": pa.array([np.array([len(s) for s in out], "<i8").tobytes()], pa.binary()),
            "tokens": pa.array([np.concatenate(out).tobytes()], pa.binary()),
        })

    wanted = reps.select("uid", F.floor(F.col("uid") / ROWS).alias("slice"))
    return slices.groupBy("slice").cogroup(wanted.groupBy("slice")).applyInArrow(run, "slice long, uids binary, sizes binary, tokens binary")


def _single_sets(sets: DataFrame) -> DataFrame:
    """uid, tokens: one row for each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uids, sizes, tokens in zip(*(arrays(batch.column(n), d) for n, d in (("uids", "<i8"), ("sizes", "<i8"), ("tokens", "<u8")))):
                yield pa.RecordBatch.from_arrays([pa.array(uids), packed(tokens, np.concatenate([[0], np.cumsum(sizes)]))], ["uid", "tokens"])

    return sets.mapInArrow(run, "uid long, tokens binary")


def _frequencies(sets: DataFrame, buckets: int) -> DataFrame:
    """slice, bucket, counts: in how many of the sets each distinct token of a slice occurs."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, tokens in zip(batch.column("slice").to_pylist(), arrays(batch.column("tokens"), "<u8")):
                tokens, counts = np.unique(tokens, return_counts=True)
                order, ends = split(tokens, (W.mix(tokens) % np.uint64(buckets)).astype(np.int32), buckets)
                tokens, counts = tokens[order], counts[order].astype("<u4")
                full = np.flatnonzero(np.diff(ends))
                yield pa.RecordBatch.from_arrays([
                    pa.array(full, pa.int32()), pa.array([name] * len(full), pa.int64()),
                    pa.array([tokens[ends[b]:ends[b + 1]].tobytes() for b in full], pa.binary()),
                    pa.array([counts[ends[b]:ends[b + 1]].tobytes() for b in full], pa.binary()),
                ], ["bucket", "slice", "tokens", "counts"])

    def answer(table: pa.Table) -> pa.Table:
        tokens = arrays(table["tokens"], "<u8")
        names, index = np.unique(np.concatenate(tokens), return_inverse=True)
        counts = np.concatenate(arrays(table["counts"], "<u4"))
        totals = np.minimum(np.bincount(index, weights=counts, minlength=len(names)), 2**32 - 1).astype("<u4")
        ends = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        return pa.table({
            "slice": table["slice"], "bucket": table["bucket"],
            "counts": pa.array([totals[index[a:b]].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
        })

    asked = sets.mapInArrow(ask, "bucket int, slice long, tokens binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(answer, "slice long, bucket int, counts binary")


def _prefix_edges(sets: DataFrame, buckets: int) -> DataFrame:
    """a, b: every vertex and the smallest vertex that shares one of its prefix tokens.

    A prefix holds the rarest tokens of a set, as many as a partner may miss and one more; tokens of one set only are not sent.
    """

    def send(rows: pa.Table, answers: pa.Table) -> pa.Table:
        out = {"bucket": [], "tokens": [], "uids": []}
        if len(rows) and len(answers):
            uids, sizes, tokens = (arrays(rows[n], d)[0] for n, d in (("uids", "<i8"), ("sizes", "<i8"), ("tokens", "<u8")))
            names = np.unique(tokens)
            order, ends = split(names, (W.mix(names) % np.uint64(buckets)).astype(np.int32), buckets)
            totals = np.zeros(len(names), np.uint32)
            for bucket, counts in zip(answers["bucket"].to_pylist(), arrays(answers["counts"], "<u4")):
                totals[order[ends[bucket]:ends[bucket + 1]]] = counts
            counts = totals[np.searchsorted(names, tokens)]
            of = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((tokens, counts, of))
            rank = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            sent = order[(rank <= sizes[of] // 5) & (counts[order] > 1)]
            tokens, uids = tokens[sent], uids[of[sent]]
            order, ends = split(tokens, (W.mix(tokens) % np.uint64(buckets)).astype(np.int32), buckets)
            tokens, uids = tokens[order], uids[order]
            for bucket in np.flatnonzero(np.diff(ends)):
                out["bucket"].append(int(bucket))
                out["tokens"].append(tokens[ends[bucket]:ends[bucket + 1]].tobytes())
                out["uids"].append(uids[ends[bucket]:ends[bucket + 1]].tobytes())
        return pa.table({"bucket": pa.array(out["bucket"], pa.int32()), "tokens": pa.array(out["tokens"], pa.binary()), "uids": pa.array(out["uids"], pa.binary())})

    def meet(table: pa.Table) -> pa.Table:
        tokens, uids = np.concatenate(arrays(table["tokens"], "<u8")), np.concatenate(arrays(table["uids"], "<i8"))
        order = np.lexsort((uids, tokens))
        tokens, uids = tokens[order], uids[order]
        first = np.concatenate([[True], tokens[1:] != tokens[:-1]])
        least = uids[np.flatnonzero(first)[np.cumsum(first) - 1]]
        edges = np.unique(np.stack([uids, least])[:, uids != least], axis=1)
        return pa.table({"a": edges[0], "b": edges[1]})

    answers = _frequencies(sets, buckets)
    sent = sets.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(send, "bucket int, tokens binary, uids binary")
    return sent.groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


class Tree:
    """Levels of nodes over sets in a fixed order; node i of a level covers FAN (at the lowest: LEAF) neighbours of the next."""

    def __init__(self, sets: list[np.ndarray], bitmaps: np.ndarray):
        sizes = np.array([len(s) for s in sets], np.int64)
        slack = sizes - np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)
        spans = np.arange(len(sets) + 1)
        self.levels = [(bitmaps, sizes, sizes, slack, spans)]
        width = LEAF
        while len(self.levels[-1][0]) > 1:
            bits, least, most, slacks, spans = self.levels[-1]
            at = np.arange(0, len(bits), width)
            self.levels.append((
                np.bitwise_or.reduceat(bits, at, axis=0), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at),
                np.maximum.reduceat(slacks, at), np.append(spans[at], spans[-1]),
            ))
            width = FAN


def bitmaps_of(sets: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(sets), BITS), bool)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    out[rows, (np.concatenate(sets) >> np.uint64(40)).astype(np.int64) % BITS] = True
    return np.packbits(out, axis=1).view(np.uint64)


def possible(bits_a, least_a, most_a, slack_a, bits_b, least_b, most_b, slack_b):
    """Whether some set of a node can be linked to some set of another, from the largest possible overlap."""
    common = np.bitwise_count(bits_a & bits_b).sum(axis=-1, dtype=np.int64)
    most = np.minimum(common + np.minimum(slack_a, slack_b), np.minimum(most_a, most_b))
    return linked(most, least_a, least_b) & (5 * most_a >= 4 * least_b) & (5 * most_b >= 4 * least_a)


def without_partner(sets: list[np.ndarray]) -> np.ndarray:
    """Which sets have too many tokens that no other of the sets has; repeated until none is left."""
    alive = np.arange(len(sets))
    while len(alive):
        tokens = np.concatenate([sets[i] for i in alive])
        sizes = np.array([len(sets[i]) for i in alive])
        _, inverse, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        alone = np.add.reduceat((counts[inverse] == 1).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
        stays = alone <= sizes // 5
        if stays.all():
            break
        alive = alive[stays]
    out = np.ones(len(sets), bool)
    out[alive] = False
    return out


def tree_join(sets: list[np.ndarray], block: np.ndarray | None = None) -> np.ndarray:
    """A label for each set: sets that are joined by links have the same (the least position). Links inside one block are left out
    where ``block`` tells two blocks apart (they are found by another task)."""
    labels = np.arange(len(sets))
    alive = np.flatnonzero(~without_partner(sets))
    if len(alive) < 2:
        return labels
    alive = alive[np.lexsort((alive, [int(sets[i][0]) for i in alive], [int(sets[i][1 % len(sets[i])]) for i in alive]))]
    some = [sets[i] for i in alive]
    own = np.arange(len(some))
    side = block[alive] if block is not None else None

    def compare(i: int, j: int) -> None:
        a, b = some[i], some[j]
        if own[i] != own[j] and linked(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b)):
            low, high = sorted((own[i], own[j]))
            own[own == high] = low

    if side is None:
        for i in range(1, len(some)):  # neighbours in the order of their smallest tokens are mostly alike
            if 5 * min(len(some[i]), len(some[i - 1])) >= 4 * max(len(some[i]), len(some[i - 1])):
                compare(i - 1, i)
    tree = Tree(some, bitmaps_of(some))
    stack = [(len(tree.levels) - 1, 0, 0)]
    while stack:
        level, a, b = stack.pop()
        bits, least, most, slack, spans = tree.levels[level]
        mine, theirs = slice(spans[a], spans[a + 1]), slice(spans[b], spans[b + 1])
        one, two = own[mine], own[theirs]
        if one[0] == two[0] and (one == one[0]).all() and (two == one[0]).all():
            continue
        if level == 0:
            if a != b and (side is None or side[a] != side[b]):
                compare(a, b)
            continue
        width = LEAF if level == 1 else FAN
        below = tree.levels[level - 1]
        left = np.arange(a * width, min((a + 1) * width, len(below[0])))
        right = left if a == b else np.arange(b * width, min((b + 1) * width, len(below[0])))
        x, y = np.meshgrid(left, right, indexing="ij")
        pairs = x <= y if a == b else np.ones(x.shape, bool)
        if level == 1:
            pairs &= (x != y) & (own[x] != own[y])
        x, y = x[pairs], y[pairs]
        fits = possible(*(v[x] for v in below[:4]), *(v[y] for v in below[:4]))
        stack.extend((level - 1, int(i), int(j)) for i, j in zip(x[fits], y[fits]))
    for label in np.unique(own):
        together = alive[own == label]
        labels[together] = together.min()
    return labels


def _links(table: pa.Table) -> pa.Table:
    """a, b: a spanning forest of the links inside each group of the table, or across two blocks of one group."""
    roots, uids = table["root"].to_numpy(), table["uid"].to_numpy()
    sets = arrays(table["tokens"], "<u8")
    block = table["block"].to_numpy()
    order = np.lexsort((uids, roots))
    a, b = [], []
    begins = np.flatnonzero(np.concatenate([[True], roots[order][1:] != roots[order][:-1]])) if len(order) else []
    for begin, end in zip(begins, [*begins[1:], len(order)]):
        of = order[begin:end]
        halves = block[of] if table["left"][0].as_py() != table["right"][0].as_py() else None
        labels = tree_join([sets[i] for i in of], halves)
        moved = np.flatnonzero(labels != np.arange(len(of)))
        a.append(uids[of[moved]])
        b.append(uids[of[labels[moved]]])
    return pa.table({"a": np.concatenate(a) if a else np.zeros(0, np.int64), "b": np.concatenate(b) if b else np.zeros(0, np.int64)})


def _grouped(sets: DataFrame, groups: DataFrame, roots: DataFrame) -> DataFrame:
    """uid, root, tokens and the task (home, left, right): small groups share a home, blocks of large ones meet in pairs."""
    placed = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    joined = sets.join(placed.withColumnRenamed("node", "uid"), "uid").join(groups, "root")
    blocks = F.col("blocks")
    block = F.pmod(F.xxhash64("uid"), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), (blocks - 1).cast("int")), lambda other: F.struct(
        F.least(other, F.col("block")).alias("left"), F.greatest(other, F.col("block")).alias("right"),
    ))
    return joined.withColumn("block", block).select(
        "uid", "root", "tokens", "block", F.when(blocks > 1, F.col("root")).otherwise(F.col("home")).alias("home"), F.explode(pairs).alias("pair"),
    ).select("uid", "root", "tokens", "block", "home", "pair.left", "pair.right")


def _joined(slices: DataFrame, window: int) -> DataFrame:
    """uid, key, n, component (smallest key) and keeper (uid of a row with that key) of every row."""
    buckets = 4 * shuffle_partitions(slices.sparkSession)
    answered = _count_requests(slices, buckets, window).groupBy("bucket").applyInArrow(_shared_counts, "slice long, rows binary, counts binary")
    members = checkpointed(answered.groupBy("slice").applyInArrow(_members, "uid long, key long, n long, one long, two long, open boolean"))
    opened = members.where("open")
    first = F.struct(F.col("key").isNull().alias("no_key"), "key", "uid")
    vertices = checkpointed(opened.groupBy("one", "two").agg(F.min(first).alias("rep"), F.max("n").alias("n")).select("one", "two", "n", "rep", "rep.uid"))
    sets = checkpointed(_sets(slices, vertices, window))
    roots = components(_prefix_edges(sets, buckets))
    sizes = vertices.select("uid", "n").join(roots.withColumnRenamed("node", "uid"), "uid")
    heads = vertices.select(F.col("uid").alias("root"), "n").join(roots.select("root").distinct(), "root")
    groups = checkpointed(sizes.select("root", "n").unionByName(heads.select("root", "n")).groupBy("root").agg(F.sum("n").alias("windows")))
    total = groups.agg(F.sum("windows")).first()[0] or 0
    homes = max(1, -(-2 * total // GROUP_WINDOWS), min(buckets, total // 50_000))
    groups = groups.select(
        "root", F.pmod(F.xxhash64("root"), F.lit(homes)).alias("home"),
        F.when(F.col("windows") <= GROUP_WINDOWS, 1).otherwise(F.ceil(F.col("windows") * 2 / GROUP_WINDOWS)).alias("blocks"),
    )
    tasks = _grouped(_single_sets(sets), groups, roots)
    links = tasks.groupBy("home", "left", "right").applyInArrow(_links, "a long, b long")
    joined = components(links)
    found = vertices.join(joined.withColumnRenamed("node", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    least = found.groupBy("root").agg(F.min("rep").alias("least"))
    classes = found.join(least, "root").select("one", "two", F.col("least.key").alias("component"), F.col("least.uid").alias("keeper"))
    closed = members.where("NOT open").select("uid", "key", "n", F.col("key").alias("component"), F.col("uid").alias("keeper"))
    return opened.join(classes, ["one", "two"]).select("uid", "key", "n", "component", "keeper").unionByName(closed)


def join_components(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """key, n_shingles, component_id of every row: the size of its set and the smallest key that links lead to."""
    return _joined(slices_of(docs, key, text, level=3), window).select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row of each component, one with its smallest key; rows that are linked with nothing stay. All columns stay as they are."""
    slices = slices_of(docs, key, text, level=3, rest=True)
    kept = _joined(slices, window).where("uid = keeper").select("uid", F.floor(F.col("uid") / ROWS).alias("slice"))
    names = docs.columns

    def run(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        part = Slice.unpack(texts["packed"][0].as_buffer())
        rows = pa.array(np.sort(wanted["uid"].to_numpy() - texts["slice"][0].as_py() * ROWS))
        return part.table(text).select(names).take(rows)

    return slices.groupBy("slice").cogroup(kept.groupBy("slice")).applyInArrow(run, docs.schema)
