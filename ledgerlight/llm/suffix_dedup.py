"""Suffix-array dedup: bytes that repeat an earlier string of a given length, found as maximal repeat groups.

1. Every string of ``size`` bytes has an anchor, the leftmost of the smallest hashes of the short windows in it. Equal strings have
   equal anchors at equal offsets. Neighbouring strings with one anchor form a segment; segments go to the bucket of their anchor's hash.
   Of equal segments of a slice only the first is sent; the others are known to repeat it.
2. Segments with equal content (64 bits of content hash besides the anchor) are one class; its first occurrence stands for it.
3. Where an anchor has several classes, the content of these first occurrences is fetched, and an enhanced suffix array of the
   segments is built: suffixes sorted by doubled ranks, common prefixes read from the ranks. Its interval tree is scanned with a stack; intervals
   whose suffixes differ to the left (or begin a segment) are maximal repeat groups, with all their occurrences. A suffix repeats the
   smallest occurrence of the deepest interval in which an earlier one exists. Where an anchor has more than HOT_CLASSES classes, the
   strings of ``size`` bytes in their first occurrences are named by hash instead, and each name's places go to the bucket of that name,
   the smallest one of each slice only: the places after the smallest of all repeat it. So no task holds the content of a hot anchor.
4. The covered bytes of both steps are sent to the slices that hold the texts, joined there and removed.

Order: smaller key, then earlier start. Defined cases: a null or empty text has no bytes and nothing to remove; texts shorter than
``size`` keep all; null keys come before all others; rows of one key count as one document, so equal starts in two of them don't
repeat each other; an empty table gives an empty result. Texts of any length are scanned in pieces of CHUNK bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm import wordvec as W
from ledgerlight.llm.common import checkpointed, give_back, replaced, shuffle_partitions, tidy
from ledgerlight.llm.textslices import NO_KEY, Slice, columns_of, each_slice, rows_of, slices_of, split

SIZE = 100
#: Bytes of the window whose hash makes an anchor.
ANCHOR = 32
CHUNK = 1 << 20
#: Bytes of segments for which one suffix array is built; anchors are never split.
ARRAY_BYTES = 1 << 21
#: Classes of one anchor beyond which their strings are dealt out one by one.
HOT_CLASSES = 1 << 13
#: In the place of a bucket: the strings of the segment are wanted. Segments whose strings are named side by side.
BY_STRING, SIDE_BY_SIDE = 0xFFFFFFFF, 1 << 12

SEGMENT = np.dtype([("anchor", "<u4"), ("name", "<u8"), ("key", "<i8"), ("start", "<u4"), ("row", "<u4"), ("length", "u1")])
SPAN = np.dtype([("row", "<u4"), ("start", "<u4"), ("length", "u1")])
FETCH = np.dtype([("row", "<u4"), ("start", "<u4"), ("length", "u1"), ("anchor", "<u4"), ("bucket", "<u4")])


STRING = np.dtype([("anchor", "<u4"), ("name", "<u8"), ("key", "<i8"), ("start", "<u4"), ("row", "<u4")])


def later(rows: np.ndarray) -> np.ndarray:
    """Which rows have one of the same anchor and name at a smaller place (key, start)."""
    out = np.zeros(len(rows), bool)
    if len(rows):
        order = np.lexsort((rows["start"], rows["key"], rows["name"], rows["anchor"]))
        some = rows[order]
        new = np.concatenate([[True], (some["anchor"][1:] != some["anchor"][:-1]) | (some["name"][1:] != some["name"][:-1])])
        first = some[np.flatnonzero(new)[np.cumsum(new) - 1]]
        out[order] = (some["key"] != first["key"]) | (some["start"] != first["start"])
    return out


def spans_of(rows: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    out = np.zeros(len(rows), SPAN)
    out["row"], out["start"], out["length"] = rows["row"], rows["start"], length
    return out


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of keys[i:i + width], for every i that has so many."""
    reach, now = 1, keys
    while 2 * reach <= width:
        now = np.minimum(now[:-reach], now[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(now[:len(now) - rest], now[rest:]) if rest else now


def segments(part: Slice, size: int, anchor: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, content hash, row, start, length) of the segments of a slice, some bytes at a time."""
    data, ends = part.data, part.ends
    width = size - anchor + 1
    low = np.uint64((1 << 21) - 1)
    for begin in range(0, len(data), CHUNK):
        stop = min(len(data), begin + CHUNK + size - 1)
        if stop - begin < size:
            break
        rolling = W.Rolling(data[begin:stop])
        grams = rolling.windows(anchor)
        chosen = (_least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), width) & low).astype(np.int64)
        first = int(np.searchsorted(ends, begin, side="right")) - 1
        last = int(np.searchsorted(ends, begin + len(chosen), side="left"))
        borders = np.arange(first, last)
        lows = np.maximum(ends[borders] - begin, 0)
        highs = np.minimum(ends[borders + 1] - begin - size + 1, len(chosen))
        full = highs > lows
        borders, lows, highs = borders[full], lows[full], highs[full]
        if len(borders) == 0:
            continue
        inside = np.zeros(len(chosen) + 1, np.int8)
        np.add.at(inside, lows, 1)
        np.add.at(inside, highs, -1)
        at = np.flatnonzero(np.cumsum(inside[:-1]))
        opens = np.ones(len(at), bool)
        opens[1:] = (chosen[at[1:]] != chosen[at[:-1]]) | (at[1:] != at[:-1] + 1)
        opens[np.searchsorted(at, lows)] = True
        heads = np.flatnonzero(opens)
        b = at[heads]
        e = at[np.append(heads[1:], len(at)) - 1] + size
        names = rolling.names(b, e)
        row = borders[np.searchsorted(lows, b, side="right") - 1]
        yield grams[chosen[b]], names, row, b + begin - ends[row], e - b


def _send_segments(slices: DataFrame, buckets: int, size: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, part in each_slice(batches):
            found = list(segments(part, size, anchor))
            if not found:
                continue
            grams, names, row, start, length = (np.concatenate(x) for x in zip(*found))
            out = np.zeros(len(grams), SEGMENT)
            out["anchor"], out["name"], out["row"] = grams & np.uint64(0xFFFFFFFF), names, row
            out["start"], out["length"], out["key"] = start, length, part.keys[row]
            # only names that come twice can repeat within the slice
            by_name = np.sort(names)
            twice = by_name[1:][by_name[1:] == by_name[:-1]]
            some = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, names), len(twice) - 1)] == names) if len(twice) else np.zeros(0, np.int64)
            known = np.zeros(len(out), bool)
            known[some] = later(out[some])
            local = out[known]
            out, grams = out[~known], grams[~known]
            order, ends = split(grams, ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32), buckets)
            out = out[order]
            full = np.flatnonzero(np.diff(ends))
            yield pa.RecordBatch.from_arrays([
                pa.array([*full, name % buckets], pa.int32()), pa.array([name] * (len(full) + 1), pa.int64()),
                pa.array([*(columns_of(out[ends[b]:ends[b + 1]]) for b in full), None], pa.binary()),
                pa.array([None] * len(full) + [columns_of(spans_of(local, local["length"]))], pa.binary()),
            ], ["bucket", "slice", "segments", "spans"])

    return slices.mapInArrow(tidy(run), "bucket int, slice long, segments binary, spans binary")


def _classes_of(hot: int | None):
    """``_classes`` with the most classes of an anchor whose content goes to one bucket, None for any number."""
    return lambda table: _classes(table, hot)


def _classes(table: pa.Table, hot: int | None) -> pa.Table:
    """For each slice of a bucket: spans that repeat an earlier equal segment, and first occurrences whose content is needed."""
    local = table.filter(pc.is_valid(table["spans"]))
    local = pa.table({"slice": local["slice"], "spans": local["spans"], "fetch": pa.array([columns_of(np.zeros(0, FETCH))] * len(local), pa.binary())})
    bucket = table["bucket"][0].as_py()
    table = table.filter(pc.is_valid(table["segments"]))
    if len(table) == 0:
        return local
    names = table["slice"].to_numpy()
    parts = [rows_of(x.as_buffer(), SEGMENT) for x in table["segments"]]
    rows = np.concatenate(parts)
    of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order = np.argsort(rows["anchor"])
    anchors = rows["anchor"][order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = anchors[1:] == anchors[:-1]
    order = order[same[1:] | same[:-1]]
    rows, of = rows[order], of[order]
    order = np.lexsort((rows["start"], rows["key"], rows["name"], rows["anchor"]))
    rows, of = rows[order], of[order]
    spans = fetch = apart = np.zeros(0, bool)
    if len(rows):
        new_anchor = np.concatenate([[True], rows["anchor"][1:] != rows["anchor"][:-1]])
        new_class = new_anchor | np.concatenate([[True], rows["name"][1:] != rows["name"][:-1]])
        first = np.flatnonzero(new_class)[np.cumsum(new_class) - 1]
        spans = (rows["key"] != rows["key"][first]) | (rows["start"] != rows["start"][first])
        of_anchor = np.cumsum(new_anchor) - 1
        several = np.bincount(of_anchor, weights=new_class)[of_anchor]
        fetch = new_class & (several > 1)
        apart = several > (np.inf if hot is None else hot)
    out = {"slice": [], "spans": [], "fetch": []}
    by_slice = np.argsort(of, kind="stable")
    rows, spans, fetch, apart = rows[by_slice], spans[by_slice], fetch[by_slice], apart[by_slice]
    borders = np.searchsorted(of[by_slice], np.arange(len(names) + 1))
    for name, begin, end in zip(names, borders[:-1], borders[1:]):
        covered, needed = rows[begin:end][spans[begin:end]], rows[begin:end][fetch[begin:end]]
        if len(covered) == 0 and len(needed) == 0:
            continue
        wanted = np.zeros(len(needed), FETCH)
        for field in ("row", "start", "length", "anchor"):
            wanted[field] = needed[field]
        wanted["bucket"] = np.where(apart[begin:end][fetch[begin:end]], BY_STRING, bucket)
        out["slice"].append(name)
        out["spans"].append(columns_of(spans_of(covered, covered["length"])))
        out["fetch"].append(columns_of(wanted))
    found = pa.table({"slice": pa.array(out["slice"], pa.int64()), "spans": pa.array(out["spans"], pa.binary()), "fetch": pa.array(out["fetch"], pa.binary())})
    return pa.concat_tables([local, found])


CONTENT = np.dtype([("anchor", "<u4"), ("key", "<i8"), ("start", "<u4"), ("row", "<u4"), ("length", "u1")])


def strings(part: Slice, rows: np.ndarray, size: int) -> np.ndarray:
    """All strings of ``size`` bytes in the segments, with their places."""
    out = [np.zeros(0, STRING)]
    for i in range(0, len(rows), SIDE_BY_SIDE):
        some = rows[i:i + SIDE_BY_SIDE]
        lengths = some["length"].astype(np.int64)
        begins = np.cumsum(lengths) - lengths
        rolling = W.Rolling(part.data[np.repeat(part.ends[some["row"]] + some["start"] - begins, lengths) + np.arange(lengths.sum())])
        counts = lengths - size + 1
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.repeat(begins, counts) + offset
        found = np.zeros(len(at), STRING)
        found["name"] = rolling.names(at, at + size)
        found["anchor"], found["row"], found["start"] = np.repeat(some["anchor"], counts), np.repeat(some["row"], counts), np.repeat(some["start"], counts) + offset
        found["key"] = part.keys[found["row"]]
        out.append(found)
    return np.concatenate(out)


ANSWER = "bucket int, slice long, segments binary, content binary, strings binary, spans binary"


def _fetch_of(size: int, buckets: int):
    def run(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        """By bucket, the content of the wanted segments of one slice, or the names and places of their strings."""
        out = {"bucket": [], "segments": [], "content": [], "strings": [], "spans": []}

        def add(bucket: int, segments: bytes | None = None, content: bytes | None = None, strings: bytes | None = None, spans: bytes | None = None) -> None:
            for name, value in zip(out, (bucket, segments, content, strings, spans)):
                out[name].append(value)

        if len(texts) and len(wanted):
            rows = np.concatenate([rows_of(x.as_buffer(), FETCH) for x in wanted["fetch"]])
            part = Slice.unpack(texts["packed"][0].as_buffer())
            rows = rows[np.lexsort((rows["start"], rows["row"], rows["anchor"], rows["bucket"]))]
            apart = int(np.searchsorted(rows["bucket"], BY_STRING))
            if apart < len(rows):
                named = strings(part, rows[apart:], size)
                rows = rows[:apart]
                known = later(named)
                add(texts["slice"][0].as_py() % buckets, spans=columns_of(spans_of(named[known], size)))
                named = named[~known]
                order, ends = split(named, (W.mix(named["name"]) % np.uint64(buckets)).astype(np.int32), buckets)
                named = named[order]
                for b in np.flatnonzero(np.diff(ends)).tolist():
                    add(b, strings=columns_of(named[ends[b]:ends[b + 1]]))
            at = part.ends[rows["row"]] + rows["start"]
            borders = np.append(np.flatnonzero(np.concatenate([[True], rows["bucket"][1:] != rows["bucket"][:-1]])), len(rows)) if len(rows) else []
            for begin, end in zip(borders[:-1], borders[1:]):
                some = rows[begin:end]
                about = np.zeros(len(some), CONTENT)
                for field in ("anchor", "start", "row", "length"):
                    about[field] = some[field]
                about["key"] = part.keys[some["row"]]
                content = b"".join(part.data[a:a + n].tobytes() for a, n in zip(at[begin:end], some["length"].tolist()))
                add(int(some["bucket"][0]), columns_of(about), content)
        slices = [texts["slice"][0].as_py()] * len(out["bucket"]) if len(texts) else []
        return pa.table({
            "bucket": pa.array(out["bucket"], pa.int32()), "slice": pa.array(slices, pa.int64()),
            **{name: pa.array(out[name], pa.binary()) for name in ("segments", "content", "strings", "spans")},
        })

    return run


class SuffixArray:
    """Enhanced suffix array of segments: the suffixes of at least ``size`` bytes in order, and their common prefixes."""

    def __init__(self, content: np.ndarray, lengths: np.ndarray, size: int):
        ends = np.cumsum(lengths + 1)
        text = np.zeros(int(ends[-1]) + 2 * 256 + 8, np.uint16)
        begins = ends - lengths - 1
        keep = np.ones(int(ends[-1]), bool)
        keep[ends - 1] = False
        text[:int(ends[-1])][keep] = content.astype(np.uint16) + 1
        n = int(ends[-1])
        symbols = text.astype(np.uint64)
        ranks = {1: text, 2: symbols[:-1] << np.uint64(16) | symbols[1:]}
        key = ranks[2][:-2] << np.uint64(32) | ranks[2][2:]
        step = 4
        while True:
            values, rank = np.unique(key, return_inverse=True)
            ranks[step] = rank.astype(np.uint32)
            if step >= 128:
                break
            key = ranks[step][:-step].astype(np.uint64) << np.uint64(32) | ranks[step][step:]
            step *= 2
        segment = np.repeat(np.arange(len(lengths)), np.maximum(lengths - size + 1, 0))
        counts = np.maximum(lengths - size + 1, 0)
        offset = np.arange(len(segment)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = begins[segment] + offset
        wide = ranks[128]
        order = np.lexsort((wide[np.minimum(at + 128, len(wide) - 1)], wide[at]))
        self.segment, self.offset = segment[order], offset[order]
        at = at[order]
        room = lengths[self.segment] - self.offset
        common = np.zeros(max(len(at) - 1, 0), np.int64)
        for step in (128, 64, 32, 16, 8, 4, 2, 1):
            x, y = at[:-1] + common, at[1:] + common
            reach = len(ranks[step]) - 1
            equal = ranks[step][np.minimum(x, reach)] == ranks[step][np.minimum(y, reach)]
            common += np.where(equal, step, 0)
        self.lcp = np.minimum(common, np.minimum(room[:-1], room[1:])) if len(at) else common
        # the byte to the left; before a segment's first byte nothing is known, so it differs from all others
        self.left = np.where(self.offset == 0, 0, text[at - 1])


def interval_tree(array: SuffixArray, place: np.ndarray, size: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(for each suffix the length it shares with an earlier place, 0 if none; maximal repeat groups (length, first, last suffix)).

    ``place`` orders the suffixes' occurrences. Runs whose suffixes all follow one byte are left out: the run one byte to
    the left covers them.
    """
    shared = np.zeros(len(array.segment), np.int64)
    groups: list[tuple[int, int, int]] = []
    deep = array.lcp >= size
    if not deep.any():
        return shared, groups
    edge = np.diff(np.concatenate([[0], deep.astype(np.int8), [0]]))
    lows, highs = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # runs don't overlap: every other piece between their borders is a run
    borders = np.stack([lows, highs + 1], axis=1).ravel()
    padded = np.append(array.left, array.left[-1:])
    least, most = np.minimum.reduceat(padded, borders)[::2], np.maximum.reduceat(padded, borders)[::2]
    wanted = (least != most) | (least == 0)
    lcp, left = array.lcp, array.left
    for begin, end in zip(lows[wanted].tolist(), highs[wanted].tolist()):
        # stack of open intervals: common prefix, first suffix, suffix of the smallest place, byte to the left or None if several
        stack = [[0, begin, begin, None]]
        for i in range(begin, end + 1):
            mine = place[i]
            leaf = [i, int(left[i]) or None]
            depth = int(lcp[i]) if i < end else 0
            opened, head, byte = i, leaf[0], leaf[1]
            top = stack[-1]
            if top[0] > 0 and i > begin:
                # the suffix belongs to the interval on top, whose prefix is at least that of the last pair
                if place[top[2]] <= mine:
                    if place[top[2]] < mine:
                        shared[i] = max(shared[i], top[0])
                else:
                    shared[top[2]] = max(shared[top[2]], top[0])
                    top[2] = i
                top[3] = top[3] if top[3] == byte else None
            while stack[-1][0] > depth:
                length, opened, head, byte = stack.pop()
                if byte is None:
                    groups.append((length, opened, i))
                parent = stack[-1]
                if parent[0] >= depth and parent[0] > 0:
                    a, b = parent[2], head
                    if place[a] <= place[b]:
                        if place[a] < place[b]:
                            shared[b] = max(shared[b], parent[0])
                    else:
                        shared[a] = max(shared[a], parent[0])
                        parent[2] = b
                    parent[3] = parent[3] if parent[3] == byte else None
            if stack[-1][0] < depth:
                stack.append([depth, opened, head, byte])
    return shared, groups


def _repeats(table: pa.Table, size: int):
    """Suffix arrays of a bucket, some anchors at a time: (slice of each segment, segments, array, shared lengths, groups)."""
    table = table.filter(pc.is_valid(table["segments"]))
    if len(table) == 0:
        return
    parts = [rows_of(x.as_buffer(), CONTENT) for x in table["segments"]]
    rows = np.concatenate(parts)
    of = np.repeat(table["slice"].to_numpy(), [len(p) for p in parts])
    content = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in table["content"]])
    begins = np.cumsum(rows["length"].astype(np.int64)) - rows["length"]
    order = np.argsort(rows["anchor"], kind="stable")
    anchors = rows["anchor"][order]
    sizes = np.cumsum(rows["length"][order].astype(np.int64))
    at = 0
    while at < len(order):
        end = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + ARRAY_BYTES, side="right"))
        end = min(max(end, at + 1), len(order))
        end = int(np.searchsorted(anchors, anchors[end - 1], side="right"))
        some = order[at:end]
        at = end
        lengths = rows["length"][some].astype(np.int64)
        pick = np.repeat(begins[some] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        array = SuffixArray(content[pick], lengths, size)
        mine = rows[some]
        start = mine["start"][array.segment].astype(np.int64) + array.offset
        key = mine["key"][array.segment]
        by_place = np.lexsort((start, key))
        place = np.zeros(len(start), np.int64)
        if len(start):
            place[by_place] = np.cumsum(np.concatenate([[True], (np.diff(key[by_place]) != 0) | (np.diff(start[by_place]) != 0)]))
        yield of[some], mine, array, start, *interval_tree(array, place, size)
        del array
        give_back()


def _repeat_spans(size: int):
    def run(table: pa.Table) -> pa.Table:
        found: dict[int, list[np.ndarray]] = {}
        for of, rows, array, start, shared, _ in _repeats(table, size):
            hit = np.flatnonzero(shared)
            spans = np.zeros(len(hit), SPAN)
            spans["row"], spans["start"], spans["length"] = rows["row"][array.segment[hit]], start[hit], shared[hit]
            names = of[array.segment[hit]]
            for name in np.unique(names):
                found.setdefault(int(name), []).append(spans[names == name])
        named = table.filter(pc.is_valid(table["strings"]))
        if len(named):
            parts = [rows_of(x.as_buffer(), STRING) for x in named["strings"]]
            repeated = np.split(later(np.concatenate(parts)), np.cumsum([len(p) for p in parts])[:-1])
            for name, part, known in zip(named["slice"].to_pylist(), parts, repeated):
                if known.any():
                    found.setdefault(name, []).append(spans_of(part[known], size))
        local = table.filter(pc.is_valid(table["spans"]))
        for name, spans in zip(local["slice"].to_pylist(), local["spans"]):
            found.setdefault(name, []).append(rows_of(spans.as_buffer(), SPAN))
        return pa.table({
            "slice": pa.array(list(found), pa.int64()), "spans": pa.array([columns_of(np.concatenate(x)) for x in found.values()], pa.binary()),
        })

    return run


#: A group's string in the segment of one class's first occurrence, and a segment with its class.
OCCURRENCE = "group string, length long, slice long, row long, begin long, offset long"
MEMBER = "slice long, row long, begin long, bytes long, key long, anchor long, name long"


def _repeat_groups(size: int):
    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        out = [pa.table({"group": pa.array([], pa.string()), **{name: pa.array([], pa.int64()) for name in ("length", "slice", "row", "begin", "offset")}})]
        for batch, (of, rows, array, _, _, groups) in enumerate(_repeats(table, size)):
            if not groups:
                continue
            length, first, last = np.array(groups).T
            count = last - first + 1
            number = np.repeat(np.arange(len(groups)), count)
            suffix = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
            segment = array.segment[suffix]
            name = pc.binary_join_element_wise(f"{bucket}-{batch}", pa.array(number).cast(pa.string()), "-")
            numbers = (length[number], of[segment], rows["row"][segment], rows["start"][segment], array.offset[suffix])
            out.append(pa.table({"group": name, **{
                field: pa.array(values.astype(np.int64)) for field, values in zip(("length", "slice", "row", "begin", "offset"), numbers)
            }}))
        return pa.concat_tables(out)

    return run


def _members(slices: DataFrame, size: int, anchor: int) -> DataFrame:
    """All segments with their classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, part in each_slice(batches):
            for grams, names, row, start, length in segments(part, size, anchor):
                keys = part.keys[row]
                columns = [np.full(len(row), name), row, start, length]
                yield pa.RecordBatch.from_arrays([
                    *(pa.array(column.astype(np.int64)) for column in columns), pa.array(keys, mask=keys == NO_KEY),
                    pa.array((grams & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(names.view(np.int64)),
                ], ["slice", "row", "begin", "bytes", "key", "anchor", "name"])

    return slices.mapInArrow(tidy(run), MEMBER)


def _steps(slices: DataFrame, size: int, anchor: int, hot: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(spans of repeated classes with what to fetch, content of the classes that share an anchor, or strings where they are more than ``hot``)."""
    buckets = 4 * shuffle_partitions(slices.sparkSession)
    sent = _send_segments(slices, buckets, size, anchor)
    classes = checkpointed(sent.groupBy("bucket").applyInArrow(_classes_of(hot), "slice long, spans binary, fetch binary"))
    content = slices.groupBy("slice").cogroup(classes.select("slice", "fetch").groupBy("slice")).applyInArrow(
        _fetch_of(size, buckets), ANSWER
    )
    return classes, content


def repeat_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, anchor: int = ANCHOR) -> DataFrame:
    """group, length, key, start: the maximal repeat groups, one row for each occurrence in any document.

    A group's string is maximal within segments of at most 2 * size - anchor bytes; longer repeats are runs of groups with shifted
    starts. Every string of ``size`` bytes that comes more than once lies in a group together with all of its occurrences, those in exact
    copies too. Groups are found among classes of equal segments and then joined with the classes' members; a class with several
    members is a group itself where no larger one has its string. Aggregates and joins split hot classes.
    """
    slices = slices_of(docs, key, text)
    _, content = _steps(slices, size, anchor)
    found = checkpointed(content.groupBy("bucket").applyInArrow(_repeat_groups(size), OCCURRENCE))
    members = checkpointed(_members(slices, size, anchor))
    place, kind = ["slice", "row", "begin"], ["anchor", "name"]
    of_class = found.join(members.select(*place, "bytes", *kind), place)
    covered = of_class.where("offset = 0 AND length = bytes").select(*kind).distinct()
    several = members.groupBy(*kind).agg(F.count("*").alias("n")).where("n > 1").join(covered, kind, "left_anti").select(*kind)
    alone = members.join(several, kind).select(
        F.concat_ws("-", F.lit("class"), *kind).alias("group"), F.col("bytes").alias("length"), "key", F.col("begin").alias("start"),
    )
    spread = of_class.select("group", "length", "offset", *kind).join(members.select(*kind, "key", "begin"), kind).select(
        "group", "length", "key", (F.col("begin") + F.col("offset")).alias("start"),
    )
    return spread.unionByName(alone).withColumnRenamed("key", key)


def whole_characters(kept: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends) of the texts kept[ends[i]:ends[i + 1]], in the given rows without the bytes of characters that were cut in two."""
    sizes, parts, at = np.diff(ends), [], 0
    for row in rows.tolist():
        text = kept[ends[row]:ends[row + 1]].tobytes().decode("utf-8", "ignore").encode()
        parts += [kept[at:ends[row]], np.frombuffer(text, np.uint8)]
        at, sizes[row] = ends[row + 1], len(text)
    return np.concatenate([*parts, kept[at:]]), np.concatenate([[0], np.cumsum(sizes)])


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, anchor: int = ANCHOR, rest: bool = False, prefix: str = "",
    characters: bool = False,
) -> DataFrame:
    """key, n_bytes, n_removed, spans (start, length of each maximal removed run), kept (the remaining bytes) of every row.

    With ``rest`` the other columns of the rows come first; one that has the name of a result is replaced by it. ``prefix`` is put
    before the names of the results. With ``characters`` the bytes of characters that were cut in two are left out of kept (in the same
    task: a function of its own over kept would need a second Python worker beside it).
    """
    if not 0 < anchor <= size or 2 * size - anchor > 255:
        raise ValueError("anchor must be at most size, and segments of 2 * size - anchor bytes at most 255")
    slices = slices_of(docs, key, text, level=3, rest=rest)
    classes, content = _steps(slices, size, anchor, HOT_CLASSES)
    more = content.groupBy("bucket").applyInArrow(_repeat_spans(size), "slice long, spans binary")
    spans = classes.select("slice", "spans").unionByName(more)
    run = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
    kinds = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "spans": T.ArrayType(run), "kept": T.BinaryType()}
    added = [T.StructField(prefix + name, kind) for name, kind in kinds.items()]
    others = replaced(docs.drop(text), added).fields[:-len(added)] if rest else [T.StructField(key, T.LongType())]

    def cut(texts: pa.Table, covered: pa.Table) -> pa.Table:
        part = Slice.unpack(texts["packed"][0].as_buffer())
        ends, data = part.ends, part.data
        found = np.concatenate([np.zeros(0, SPAN), *(rows_of(packed.as_buffer(), SPAN) for packed in covered["spans"])])
        begin = ends[found["row"]] + found["start"]
        change = np.bincount(begin, minlength=len(data) + 1) - np.bincount(begin + found["length"], minlength=len(data) + 1)
        gone = np.cumsum(change[:-1]) > 0
        removed = np.diff(np.searchsorted(np.flatnonzero(gone), ends))
        begins, stops, first = W.runs(gone.view(np.uint8), ends, np.array([True] + [False] * 255))
        row = np.repeat(np.arange(len(part.keys)), np.diff(first))
        kept = data[~gone]
        kept_ends = np.concatenate([[0], np.cumsum(np.diff(ends) - removed)])
        if characters:
            kept, kept_ends = whole_characters(kept, kept_ends, np.flatnonzero(removed))
        lists = pa.ListArray.from_arrays(
            pa.array(first, pa.int32()), pa.StructArray.from_arrays([pa.array(begins - ends[row]), pa.array(stops - begins)], ["start", "length"])
        )
        columns = part.columns().select([f.name for f in others]).columns if rest else [pa.array(part.keys, mask=part.keys == NO_KEY)]
        del change, gone, found, begin
        give_back()
        texts_kept = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(part.keys), [None, pa.py_buffer(kept_ends.astype(np.int64).tobytes()), pa.py_buffer(kept.tobytes())]
        ).cast(pa.binary())
        return pa.Table.from_arrays(
            [*columns, pa.array(np.diff(ends)), pa.array(removed.astype(np.int64)), lists, texts_kept],
            [*(f.name for f in others), *(f.name for f in added)],
        )

    return slices.groupBy("slice").cogroup(spans.groupBy("slice")).applyInArrow(cut, T.StructType([*others, *added]))
