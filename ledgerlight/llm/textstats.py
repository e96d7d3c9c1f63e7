"""Statistics of whole texts in numpy: the counts of the quality rules and further ratios, one row for each text."""

from __future__ import annotations

import numpy as np

from ledgerlight.llm import wordvec as W

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTER = UPPER.copy()
LETTER[97:123] = True
LETTER[128:] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
CONTINUES = np.zeros(256, bool)
CONTINUES[128:192] = True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[list(b"!?.,;:")] = True
LOUD = np.zeros(256, bool)
LOUD[list(b"!?")] = True
OTHER = np.zeros(256, bool)
OTHER[list(b"|/\\_=+~^@[]{}()\"'`-")] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeats(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which values occur twice or more, which are all but one of their equals)."""
    order = np.argsort(names)
    ordered = names[order]
    same = np.zeros(len(names) + 1, bool)
    if len(names):
        same[1:-1] = ordered[1:] == ordered[:-1]
    twice, again = np.zeros(len(names), bool), np.zeros(len(names), bool)
    twice[order] = same[:-1] | same[1:]
    again[order] = same[:-1]
    return twice, again


def statistics(data: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Counts (exact integers) of each text, and what the ratios need besides."""
    words = W.Words(data, ends)
    of = words.text
    in_bytes = lambda mask: np.diff(np.searchsorted(np.flatnonzero(mask[data]), ends))
    sizes = np.diff(ends)
    windows, inside = words.windows(3)
    twice, _ = repeats(W.within_text(windows[inside], of[inside]))
    covered = np.zeros(len(windows) + 2, bool)
    at = np.flatnonzero(inside)[twice]
    for step in range(3):
        covered[at + step] = True
    begins, stops, first = W.runs(data, ends, W.NEWLINE)
    words_before = np.searchsorted(words.begins, np.concatenate([begins, stops]))
    worded = words_before[len(begins):] > words_before[:len(begins)]
    line_text = np.repeat(np.arange(len(ends) - 1), np.diff(first))[worded]
    _, again = repeats(W.within_text(W.span_hashes(data, begins, stops)[worded], line_text))
    texts = len(ends) - 1
    _, word_again = repeats(W.within_text(words.hashes, of))
    next_same = np.zeros(len(of), bool)
    if len(of) > 1:
        next_same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (of[1:] == of[:-1])
    lengths = words.stops - words.begins
    return {
        "n_words": words.counts,
        "word_chars": sizes - in_bytes(W.WHITE | CONTINUES),
        "n_symbols": in_bytes(SYMBOLS),
        "n_dup_lines": np.bincount(line_text[again], minlength=texts),
        "n_repeat_words": W.per_text(covered[:len(of)], words.first),
        "lines": np.bincount(line_text, minlength=texts),
        "upper": in_bytes(UPPER),
        "letters": sizes - in_bytes(~LETTER | CONTINUES),
        "digits": in_bytes(DIGIT),
        "punctuation": in_bytes(PUNCTUATION),
        "loud": in_bytes(LOUD),
        "other": in_bytes(OTHER),
        "word_again": W.per_text(word_again, words.first),
        "next_same": W.per_text(next_same, words.first),
        "long_words": W.per_text(lengths > 24, words.first),
        "short_words": W.per_text(lengths <= 3, words.first),
        "symbol_words": W.per_text(SYMBOLS[data[words.stops - 1]] if len(of) else next_same, words.first),
        "bars": in_bytes(np.arange(256) == 0x7C),
    }


def ratios(stats: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Numbers that don't depend on a text's length, between about 0 and 1 or logarithms."""
    words = np.maximum(stats["n_words"], 1)
    chars = np.maximum(stats["word_chars"], 1)
    lines = np.maximum(stats["lines"], 1)
    return {
        "symbols": stats["n_symbols"] / chars,
        "symbol_words": stats["symbol_words"] / words,
        "dup_lines": stats["n_dup_lines"] / lines,
        "repeats": stats["n_repeat_words"] / words,
        "upper": stats["upper"] / chars,
        "loud": stats["loud"] / words,
        "bars": stats["bars"] / words,
        "digits": stats["digits"] / chars,
        "next_same": stats["next_same"] / words,
        "letters": stats["letters"] / chars,
        "word_length": np.log(chars / words + 0.1),
        "other": stats["other"] / chars,
        "punctuation": stats["punctuation"] / words,
        "word_again": stats["word_again"] / words,
        "long_words": stats["long_words"] / words,
        "short_words": stats["short_words"] / words,
        "line_words": np.log1p(words / lines),
        "words": np.log1p(stats["n_words"]),
    }
