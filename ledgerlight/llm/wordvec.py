"""Words, lines and windows of many texts at once, as numpy arrays over the bytes of an Arrow column.

A word is a run of bytes other than 0x20 and 0x09-0x0D; it never crosses from one text into the next. Words and other spans are named by
64 bits: blocks of 8 bytes, each mixed with its place in the span, are added up with the length and mixed again. Strings of up to 8 bytes and one
length can't share a name; others do with a chance of about 2^-64 a pair, unless they are made with the constants below in mind. Windows at
every byte are named by two polynomials modulo the prime 2^31 - 1 with fixed random bases: two different windows of n bytes share a name for
at most n of the bases each, a chance of (n / 2^31)^2 over the choice of the bases.
"""

from __future__ import annotations

import numpy as np

#: Spans are named together up to so many blocks of 8 bytes.
BLOCK = 1 << 17
#: Most bytes of one ``Rolling``.
ROLLING = (1 << 20) + (1 << 12)

_BASE = 0x9E3779B97F4A7C15
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_PRIME = np.uint64((1 << 31) - 1)
#: Fixed random bases and values of the bytes.
_BASES = (1_160_269_963, 871_244_813)
_VALUES = np.random.default_rng(20240229).integers(1, int(_PRIME), (2, 256), dtype=np.uint64)
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rest(x: np.ndarray) -> np.ndarray:
    """x modulo 2^31 - 1."""
    x = (x & _PRIME) + (x >> np.uint64(31))
    x = (x & _PRIME) + (x >> np.uint64(31))
    return np.where(x >= _PRIME, x - _PRIME, x)


def _powers() -> list[tuple[np.ndarray, np.ndarray]]:
    """For each base its powers and those of its inverse."""
    def series(base: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < ROLLING + 1:
            out = np.concatenate([out, _rest(out * np.uint64(pow(base, len(out), int(_PRIME))))])
        return out[:ROLLING + 1].astype(np.uint32)

    if not _POWERS:
        _POWERS.extend((series(base), series(pow(base, -1, int(_PRIME)))) for base in _BASES)
    return _POWERS


class Rolling:
    """Names of the windows data[begin:stop] of up to ROLLING bytes, from prefix sums."""

    def __init__(self, data: np.ndarray):
        if len(data) > ROLLING:
            raise ValueError(f"{len(data)} bytes are more than {ROLLING}")
        self.sums = []
        for values, (powers, _) in zip(_VALUES, _powers()):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_rest(values[data] * powers[:len(data)]), out=sums[1:])
            self.sums.append(_rest(sums))

    def _name(self, ends: list[np.ndarray], starts: list[np.ndarray], inverses: list[np.ndarray], lengths: np.ndarray | int) -> np.ndarray:
        high, low = (_rest((end + _PRIME - start) * inverse) for end, start, inverse in zip(ends, starts, inverses))
        return mix((high << np.uint64(32) | low) + np.asarray(lengths).astype(np.uint64) * np.uint64(_BASE))

    def names(self, begins: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return self._name([s[stops] for s in self.sums], [s[begins] for s in self.sums], [inverse[begins] for _, inverse in _powers()], stops - begins)

    def windows(self, size: int) -> np.ndarray:
        """The names of all windows of ``size`` bytes, in order."""
        n = len(self.sums[0]) - size
        return self._name([s[size:] for s in self.sums], [s[:n] for s in self.sums], [inverse[:n] for _, inverse in _powers()], size)


def span_hashes(data: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit names of the byte strings data[begins[i]:stops[i]]."""
    out = np.zeros(len(begins), np.uint64)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    at_each_byte = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))
    sizes = stops - begins
    blocks = np.maximum(sizes + 7 >> 3, 1)
    ends = np.cumsum(blocks)
    first = 0
    while first < len(begins):
        before = int(ends[first] - blocks[first])
        last = max(first + 1, int(np.searchsorted(ends, before + BLOCK, side="right")))
        count, start = blocks[first:last], ends[first:last] - blocks[first:last] - before
        place = np.arange(int(ends[last - 1]) - before) - np.repeat(start, count)
        at = np.repeat(begins[first:last], count) + 8 * place
        bytes_left = np.minimum(np.repeat(stops[first:last], count) - at, 8)
        values = at_each_byte[at] & _MASKS[bytes_left]
        mixed = mix(values ^ mix((place.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE)))
        out[first:last] = mix(np.add.reduceat(mixed, start) + sizes[first:last].astype(np.uint64) * np.uint64(_BASE))
        first = last
    return out


def runs(data: np.ndarray, ends: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begins, stops, counts before each text and in all) of the runs of bytes that are no separators."""
    inside = ~separators[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    borders = ends[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    opens[borders] = inside[borders]
    closes[borders - 1] = inside[borders - 1]
    begins = np.flatnonzero(opens)
    return begins, np.flatnonzero(closes) + 1, np.searchsorted(begins, ends)


class Words:
    """The words of the texts data[ends[i]:ends[i + 1]]: hashes in order, and each text's first in ``first``."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, lower: bool = False):
        if lower:
            data = LOWER[data]
        self.data, self.ends = data, ends
        self.begins, self.stops, self.first = runs(data, ends, WHITE)
        self.hashes = span_hashes(data, self.begins, self.stops)
        self.counts = np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the window that begins at each word, whether it lies within its text)."""
        n = len(self.hashes)
        out = np.zeros(n, np.uint64)
        for j in range(size):
            if j < n:
                out[:n - j] += self.hashes[j:] * np.uint64(pow(_BASE, 2 * j + 1, 1 << 64))
        inside = np.arange(n) + size <= np.repeat(self.first[1:], self.counts)
        return mix(out + np.uint64(size)), inside


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[i]:first[i + 1]]."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def within_text(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Names of (text, hash), so that one sort finds repeats inside texts."""
    return mix(hashes ^ mix(text.astype(np.uint64) + np.uint64(1)))
