"""Benchmark decontamination: item-sized windows of documents within a small edit distance of a benchmark item.

Texts are sequences of lower-cased words. A random walk embeds a sequence: at each step the word under the pointer is the embedding's
next symbol, and a random bit of that word says whether the pointer moves on. Sequences that differ by few edits
walk together again soon after each, so their embeddings differ in few places, and a few sampled symbols often agree. Each repetition has a walk and
sample of its own and looks at its own part of the item; a document window that agrees with an item in all sampled symbols of one
repetition is a candidate. For each length of items, the number of repetitions is raised until the share of edited items found, measured on
random edits at the largest allowed distance, reaches the target. Candidates are verified by their exact edit distance.

Items of lengths for which MOST_REPETITIONS don't reach the target are found without loss: such an item is cut into one piece more than
edits are allowed, so every window within the distance holds a piece unchanged. Windows around equal pieces that have too few of
the item's words are dropped before verification.

The walks of all word positions of a document run side by side and stop as soon as the symbols so far fit no item, which
gives the same candidates as full walks. Items are broadcast in blocks of at most BLOCK_BYTES; there is no shuffle.

Defined cases: items of fewer than MIN_WORDS words allow no edit and are found word for word; null items and those without words are found
nowhere; items with equal texts are each reported; a null or empty document has no windows; repeated rows are reported each; empty tables give an empty result; other columns are
ignored. A document's words have to fit into memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlight.llm import wordvec as W
from ledgerlight.llm.common import buffers, private, slices, tidy

#: Shorter items are found word for word only.
MIN_WORDS = 5
#: An item is found where 100 * edits <= EDIT_PERCENT * words.
EDIT_PERCENT = 20
TARGET_RECALL = 0.99
MOST_REPETITIONS, TRIALS, SEED = 64, 400, 17
#: Steps at which symbols are sampled lie below these, for items of at least so many words.
REACH = {12: 10, 5: 4}
SAMPLES = 6
#: Words that a repetition's place in an item may move.
MOVES = (0, 1, -1, 2, -2, 3, -3, 4, -4)
BLOCK_BYTES = 32 << 20
SLICE_BYTES = 1 << 20
TABLE = 1 << 18
#: Words of the edited items of one length, beyond which fewer than TRIALS (but at least LEAST_TRIALS) are made.
TRIAL_WORDS, LEAST_TRIALS = 1 << 18, 100
#: Candidates that are looked at side by side.
SIDE_BY_SIDE = 1 << 13


def allowed(words: int) -> int:
    return EDIT_PERCENT * words // 100


def names_of(texts: list[bytes]) -> list[np.ndarray]:
    """The words' names of each text."""
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    words = W.Words(np.frombuffer(b"".join(texts), np.uint8), ends, lower=True)
    return [words.hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:])]


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(least edit distance between the item and a run of the text's words, end of the first such run), bit-parallel."""
    n = len(item)
    where: dict[int, int] = {}
    for i, name in enumerate(item.tolist()):
        where[name] = where.get(name, 0) | 1 << i
    full, last = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best, at = n, 0
    for j, name in enumerate(text.tolist()):
        equal = where.get(name, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | (full & ~(horizontal | plus)), plus & horizontal
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up, down = up << 1, down << 1
        plus, minus = (down | (full & ~(vertical | up))) & full, up & vertical & full
        if score < best:
            best, at = score, j + 1
    return best, at


@dataclass(frozen=True)
class Repetition:
    """A walk's random bits and sampled steps, each item's offset, the items by key (sorted), and a table of bits for each sample: a byte
    for each would make an index of 200 items 100 MB large, which every Python worker holds."""

    seed: np.uint64
    steps: tuple[int, ...]
    items: np.ndarray
    offsets: np.ndarray
    keys: np.ndarray
    tables: tuple[np.ndarray, ...]


def packed_table(keys: np.ndarray) -> np.ndarray:
    """TABLE bits, one set for each key."""
    table = np.zeros(TABLE, bool)
    table[(keys & np.uint64(TABLE - 1)).astype(np.int64)] = True
    return np.packbits(table, bitorder="little")


def fits(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys have their bit set."""
    slot = keys & np.uint64(TABLE - 1)
    return (table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & np.uint8(1)).view(bool)


def walk(names: np.ndarray, at: np.ndarray, stop: np.ndarray, seed: np.uint64, steps: tuple[int, ...], tables: tuple[np.ndarray, ...] | None):
    """(positions that are left, their keys): the sampled symbols of the walks from ``at``, pruned by the tables."""
    left, pointer = np.arange(len(at)), at.copy()
    key = W.mix(names[pointer])
    if tables is not None:
        keep = fits(tables[0], key)
        left, pointer, key = left[keep], pointer[keep], key[keep]
    for step in range(1, steps[-1] + 1):
        symbol = names[pointer]
        pointer = pointer + (W.mix(symbol ^ W.mix(np.full(1, seed + np.uint64(step), np.uint64))) & np.uint64(1)).astype(np.int64)
        inside = pointer < stop[left]
        if not inside.all():
            left, pointer, key = left[inside], pointer[inside], key[inside]
        if step in steps:
            key = W.mix(key * np.uint64(31) + names[pointer])
            if tables is not None:
                keep = fits(tables[steps.index(step)], key)
                left, pointer, key = left[keep], pointer[keep], key[keep]
    return left, key


def visited(names: np.ndarray, at: np.ndarray, stop: np.ndarray, seed: np.uint64, steps: tuple[int, ...]) -> np.ndarray:
    """How many different words the samples of each walk see; 0 for walks that leave their text."""
    pointer, seen, last = at.copy(), np.ones(len(at), np.int64), at.copy()
    for step in range(1, steps[-1] + 1):
        here = np.minimum(pointer, len(names) - 1)
        pointer = pointer + (W.mix(names[here] ^ W.mix(np.full(1, seed + np.uint64(step), np.uint64))) & np.uint64(1)).astype(np.int64)
        if step in steps:
            seen += pointer != last
            last = pointer.copy()
    return np.where(pointer < stop, seen, 0)


def bands(lengths: np.ndarray) -> np.ndarray:
    """Lengths that are measured together: each by itself below 64 words, then 16 to a doubling."""
    shift = np.where(lengths < 64, 0, np.log2(np.maximum(lengths, 1)).astype(np.int64) - 4)
    return lengths >> shift << shift


def grams(names: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    key = W.mix(names[at])
    for i in range(1, width):
        key = W.mix(key * np.uint64(31) + names[at + i])
    return key


class Pieces:
    """Items by consecutive pieces, one more than edits are allowed: a window within the distance holds one of them unchanged, moved
    by no more words than edits are allowed."""

    def __init__(self, items: np.ndarray, names: list[np.ndarray]):
        cuts: dict[int, list[tuple[int, int]]] = {}
        for item in items.tolist():
            n, parts = len(names[item]), allowed(len(names[item])) + 1
            for i in range(parts):
                cuts.setdefault(n * (i + 1) // parts - n * i // parts, []).append((item, n * i // parts))
        self.widths = []
        for width, found in sorted(cuts.items()):
            item, offset = (np.array(x, np.int64) for x in zip(*found))
            keys = grams(np.concatenate([names[i][o:o + width] for i, o in found]), np.arange(len(found)) * width, width)
            starts = np.zeros(TABLE, bool)
            starts[(W.mix(np.array([names[i][o] for i, o in found], np.uint64)) & np.uint64(TABLE - 1)).astype(np.int64)] = True
            order = np.argsort(keys, kind="stable")
            self.widths.append((width, starts, keys[order], item[order], offset[order]))
        self.lengths = np.array([len(n) for n in names], np.int64)
        self.room = EDIT_PERCENT * self.lengths // 100
        pairs = [self._pair(np.full(len(names[i]), i), names[i]) for i in items.tolist()]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64)

    @staticmethod
    def _pair(items: np.ndarray, names: np.ndarray) -> np.ndarray:
        return W.mix(names ^ W.mix(items.astype(np.uint64)))

    def candidates(self, names: np.ndarray, stop: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(item, begin of the window) of windows with a piece of the item and enough of its words."""
        if not self.widths or len(names) == 0:
            return
        slot = (W.mix(names) & np.uint64(TABLE - 1)).astype(np.int64)
        for width, starts, keys, items, offsets in self.widths:
            at = np.flatnonzero(starts[slot])
            at = at[at + width <= stop[at]]
            got = grams(names, at, width)
            low, high = np.searchsorted(keys, got, "left"), np.searchsorted(keys, got, "right")
            at, low, counts = at[high > low], low[high > low], (high - low)[high > low]
            ends = np.cumsum(counts)
            # some positions at a time, so that a common piece of many items doesn't make large arrays
            cut = 0
            while cut < len(at):
                end = max(cut + 1, int(np.searchsorted(ends, (ends[cut - 1] if cut else 0) + SIDE_BY_SIDE, "right")))
                some = counts[cut:end]
                entry = np.repeat(low[cut:end] - (np.cumsum(some) - some), some) + np.arange(some.sum())
                yield self._likely(names, stop, items[entry], np.repeat(at[cut:end], some), offsets[entry])
                cut = end

    def _likely(self, names: np.ndarray, stop: np.ndarray, items: np.ndarray, at: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begins, length, room = at - offsets, self.lengths[items], self.room[items]
        # where no edit is allowed the piece is the item, and one place in a text is enough
        whole = np.flatnonzero(room == 0)
        _, first = np.unique(np.stack([stop[at[whole]], items[whole]]), axis=1, return_index=True)
        some = np.flatnonzero(room > 0)
        present = np.zeros(len(some), np.int64)
        mine, text, reach = items[some], stop[at[some]], length[some] + room[some]
        for step in range(-int(room.max(initial=0)), int(reach.max(initial=0))):
            place = begins[some] + step
            safe = np.clip(place, 0, len(names) - 1)
            inside = np.flatnonzero((place == safe) & (stop[safe] == text) & (step >= -room[some]) & (step < reach))
            pair = self._pair(mine[inside], names[safe[inside]])
            found = self.pairs[np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)] == pair
            present[inside] += found
        kept = np.concatenate([whole[first], some[present >= length[some] - room[some]]])
        return items[kept], begins[kept]


class Index:
    """Repetitions over some items; ``keys`` are the items' own ids, ``names`` their words.

    ``reached`` tells for each band of lengths the repetitions and the share of edited items that they find; 0 repetitions: found by pieces.
    """

    def __init__(self, keys: list, names: list[np.ndarray]):
        self.keys, self.names = keys, names
        lengths = np.array([len(n) for n in names], np.int64)
        self.flat = np.concatenate(names) if names else np.zeros(0, np.uint64)
        self.first = np.concatenate([[0], np.cumsum(lengths)])
        self.repetitions: list[Repetition] = []
        self.reached: dict[int, tuple[int, float]] = {}
        most, exact = np.inf, [np.flatnonzero((lengths > 0) & (lengths < min(REACH)))]
        for least, reach in sorted(REACH.items(), reverse=True):
            mine = np.flatnonzero((lengths >= least) & (lengths < most))
            most = least
            if len(mine):
                exact.append(self._add(mine, lengths, reach))
        self.pieces = Pieces(np.concatenate(exact), names)
        self.starts: np.ndarray = np.zeros(TABLE, np.uint64)
        for r, repetition in enumerate(self.repetitions):
            self.starts[np.unpackbits(repetition.tables[0], bitorder="little").view(bool)] |= np.uint64(1) << np.uint64(r % 64)

    def _add(self, mine: np.ndarray, lengths: np.ndarray, reach: int) -> np.ndarray:
        """Repetitions for the items ``mine`` until enough edited items of each length are found; the items for which that fails."""
        rng = np.random.default_rng(SEED + reach)
        band, of = np.unique(bands(lengths[mine]), return_inverse=True)
        edited, item, kind = [], [], []
        for b, length in enumerate(band.tolist()):
            for i in rng.choice(np.flatnonzero(of == b), min(TRIALS, max(LEAST_TRIALS, TRIAL_WORDS // length))):
                edited.append(self._edited(self.names[mine[i]], rng))
                item.append(i)
                kind.append(b)
        item, kind, sizes = np.array(item), np.array(kind), np.array([len(e) for e in edited])
        flat, trial = np.concatenate(edited), np.repeat(np.arange(len(edited)), sizes)
        ends = np.cumsum(sizes)
        place = np.arange(len(flat))
        found, needed = np.zeros(len(edited), bool), np.zeros(len(band), np.int64)
        order = rng.permutation(MOST_REPETITIONS)
        made = []
        for r in range(MOST_REPETITIONS):
            seed = np.uint64(rng.integers(1, 2**62))
            steps = (0, *sorted(rng.choice(np.arange(1, reach + 1), min(SAMPLES - 1, reach), replace=False).tolist()))
            # near the repetition's part of the item, the place whose samples see most words: a walk that stands still tells little
            room = lengths[mine] - steps[-1] - 1
            offsets = (room * (order[r] + 0.5) / MOST_REPETITIONS).astype(np.int64)
            tries = np.stack([np.clip(offsets + move, 0, np.maximum(room, 0)) for move in MOVES])
            seen = np.stack([visited(self.flat, self.first[mine] + t, self.first[mine + 1], seed, steps) for t in tries])
            offsets = tries[seen.argmax(axis=0), np.arange(len(mine))]
            at = self.first[mine] + offsets
            # every walk ends within its item, so there is one key for each
            _, keys = walk(self.flat, at, self.first[mine + 1], seed, steps, None)
            made.append((seed, steps, offsets, keys))
            # places of edited items that begin like their item's walk, no further away than edits move them
            place = place[~(found | (needed > 0)[kind])[trial[place]]]
            owner = item[trial[place]]
            moved = np.abs(place - (ends - sizes)[trial[place]] - offsets[owner])
            start = place[(flat[place] == self.flat[at[owner]]) & (moved <= EDIT_PERCENT * lengths[mine[owner]] // 100)]
            left, got = walk(flat, start, ends[trial[start]], seed, steps, None)
            hit = trial[start[left]]
            found[hit[got == keys[item[hit]]]] = True
            share = np.bincount(kind, weights=found) / np.bincount(kind)
            needed[(needed == 0) & (share >= TARGET_RECALL)] = r + 1
            if needed.all():
                break
        self.reached |= {length: (n, float(x) if n else 1.0) for length, n, x in zip(band.tolist(), needed.tolist(), share)}
        for r, (seed, steps, offsets, keys) in enumerate(made):
            some = np.flatnonzero(needed[of] > r)
            if len(some) == 0:
                break
            by_key = some[np.argsort(keys[some], kind="stable")]
            tables = self._tables(self.first[mine[some]] + offsets[some], self.first[mine[some] + 1], seed, steps)
            self.repetitions.append(Repetition(seed, steps, mine[by_key], offsets[by_key], keys[by_key], tables))
        return mine[needed[of] == 0]

    def _tables(self, at: np.ndarray, stop: np.ndarray, seed: np.uint64, steps: tuple[int, ...]) -> tuple[np.ndarray, ...]:
        out = []
        for n in range(1, len(steps) + 1):
            _, keys = walk(self.flat, at, stop, seed, steps[:n], None)
            out.append(packed_table(keys))
        return tuple(out)

    @staticmethod
    def _edited(names: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """The item after as many random edits as are allowed, at different words."""
        out = [[name] for name in names.tolist()]
        for i in rng.choice(len(out), allowed(len(out)), replace=False):
            new = int(rng.integers(1, 2**62))
            out[i] = [[new], [], [out[i][0], new]][rng.integers(3)]
        return np.array([x for part in out for x in part], np.uint64)

    def candidates(self, names: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, begin of the window) of all word positions that agree with an item; stop: the end of each position's text."""
        fits = self.starts[(W.mix(names) & np.uint64(TABLE - 1)).astype(np.int64)] if len(names) else np.zeros(0, np.uint64)
        some = np.flatnonzero(fits)
        fits = fits[some]
        items, begins = [], []
        for r, repetition in enumerate(self.repetitions):
            at = some[(fits >> np.uint64(r % 64)) & np.uint64(1) == 1]
            left, keys = walk(names, at, stop[at], repetition.seed, repetition.steps, repetition.tables)
            low, high = np.searchsorted(repetition.keys, keys, "left"), np.searchsorted(repetition.keys, keys, "right")
            counts = high - low
            entry = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            items.append(repetition.items[entry])
            begins.append(np.repeat(at[left], counts) - repetition.offsets[entry])
        for more, at in self.pieces.candidates(names, stop):
            items.append(more)
            begins.append(at)
        if not items:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(items), np.concatenate(begins)

    def matches(self, words: W.Words) -> list[tuple[int, int, int, int]]:
        """(text, item, edit distance, word after the window) of the best window of each item in each text that has one."""
        stop = np.repeat(words.first[1:], words.counts)
        items, begins = self.candidates(words.hashes, stop)
        if len(items) == 0:
            return []
        best: dict[tuple[int, int], tuple[int, int]] = {}
        done = set()
        text = words.text
        for item, begin in sorted(set(zip(items.tolist(), begins.tolist()))):
            n = len(self.names[item])
            room = allowed(n)
            if (item, begin // (room + 1)) in done:
                continue
            done.add((item, begin // (room + 1)))
            # the stretch that agreed lies in one text; the window is looked for around it
            for t in {int(text[min(max(p, 0), len(stop) - 1)]) for p in (begin, begin + n // 2, begin + n - 1)}:
                low = max(int(words.first[t]), begin - 2 * room - 1)
                high = min(int(words.first[t + 1]), begin + n + 2 * room + 1)
                near = set(words.hashes[low:high].tolist())
                if sum(name in near for name in self.names[item].tolist()) < n - room:
                    continue  # every word that is missing costs an edit
                distance, end = edit_distance(self.names[item], words.hashes[low:high])
                if distance <= room:
                    key = (t, item)
                    best[key] = min(best.get(key, (n + 1, 0)), (distance, low + end - int(words.first[t])))
        return [(t, item, distance, end) for (t, item), (distance, end) in sorted(best.items())]


def indexes(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[Index]:
    """One index for each block of items; blocks are cut by hash so that each has a bounded size."""
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * total // BLOCK_BYTES))
    for block in range(blocks):
        mine = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()  # at most about BLOCK_BYTES
        mine.sort(key=lambda row: (row["item"] is None, row["item"] if row["item"] is not None else 0, row["text"]))
        names = names_of([row["text"].encode() for row in mine])
        kept = [i for i, n in enumerate(names) if len(n)]
        if kept:
            yield Index([mine[i]["item"] for i in kept], [names[i] for i in kept])


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """key, item, distance, n_words (of the item), end_word: one row for each document and item found in it, best window."""
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("key", source.schema["key"].dataType), T.StructField("item", benchmark.schema[item].dataType),
        T.StructField("distance", T.IntegerType()), T.StructField("n_words", T.IntegerType()), T.StructField("end_word", T.LongType()),
    ])
    kind = to_arrow_type(schema["item"].dataType)
    out = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            found = shared.value
            for batch in batches:
                for rows, texts in slices(batch, "text", SLICE_BYTES):
                    hits = found.matches(W.Words(*buffers(texts), lower=True))
                    yield pa.RecordBatch.from_arrays([
                        rows.column("key").take(pa.array([t for t, _, _, _ in hits], pa.int64())),
                        pa.array([found.keys[i] for _, i, _, _ in hits], kind), pa.array([d for _, _, d, _ in hits], pa.int32()),
                        pa.array([len(found.names[i]) for _, i, _, _ in hits], pa.int32()), pa.array([e for _, _, _, e in hits], pa.int64()),
                    ], schema.fieldNames())

        out = out.unionByName(source.mapInArrow(tidy(run), schema))
    return out.withColumnsRenamed({"key": key, "item": item})


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents in which no item is found, all their columns unchanged."""
    for index in indexes(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        name = private("text")
        source = docs.withColumn(name, F.col(text).cast("string"))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name, kept=docs.columns) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, texts in slices(batch, name, SLICE_BYTES):
                    leaks = {t for t, _, _, _ in shared.value.matches(W.Words(*buffers(texts), lower=True))}
                    yield rows.select(kept).take(pa.array([i for i in range(rows.num_rows) if i not in leaks], pa.int64()))

        docs = source.mapInArrow(tidy(run), docs.schema)
    return docs
