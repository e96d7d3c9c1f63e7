"""Phrase collocations by best-first branch and bound over phrases of growing length.

A phrase of 2 to 4 words scores floor(SCALE * a / (l + r)) at its worst cut: a counts its occurrences, l and r those of the part
before and behind the cut. Counts only fall as a phrase grows, so a node p bounds everything that grows from it: a phrase that begins with
p scores at most SCALE * f(p) / (f(first word of p) + f(p)), and one that ends with p the same with its last word. A wave takes a threshold for
each language, expands the nodes whose bound reaches it to the right or to the left, and so finds every phrase with a score at the threshold or
above, all its parts, and all phrases that hold it. A language is settled once enough phrases survive at or above its threshold, ties
included; the others go on with a lower one, and end with 0, where every node is expanded. The first threshold is the score of a language's
2 * TOP best pair; each wave takes WIDER times as many pairs.

One pass over the texts counts words, one the pairs of frequent words (the bound of a single word never rules it out), and each wave takes
one for phrases of three words and one for four. Tasks count the phrases of a few MB of text by exact word numbers; Spark adds the counts up by
language and phrase, combined before the shuffle. What is to be counted is told to the tasks by bit sets of fixed size over hashes of
phrases: a false bit costs a needless count, never a wrong result, since the same phrase always meets the same bit.

Defined cases: a null text is an empty one; a null language counts as ``und``; texts without words count nothing, and a language without
candidates gives no row; repeated rows count each; a phrase never crosses a piece or a text; other columns are ignored; texts of any
length are counted in blocks that end with a piece. Scores are exact: products are decimals of up to 38 digits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.llm import wordvec as W
from ledgerlight.llm.common import binary_column, buffers, checkpointed, tidy

#: Fixed values of the task: longest phrase, least count, scale of scores, share of a longer phrase that drops a shorter one, rows for a language.
LONGEST, LEAST, SCALE, SHARE, TOP = 4, 30, 2_000_000, 80, 2_000
WIDER = 4
BLOCK_BYTES = 3 << 20
#: Bits of a set (8 MB) and the factors that make one number of the hashes of a language and up to LONGEST words.
BITS = 1 << 26
FACTORS = (1, 524_287, 720_901, 869_059, 1_000_003)

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
SEPARATOR = BREAK.copy()
SEPARATOR[[0x20, 0x09]] = True


_CRC_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC_TABLE = np.where(_CRC_TABLE & 1, (_CRC_TABLE >> 1) ^ np.uint32(0xEDB88320), _CRC_TABLE >> 1).astype(np.uint32)
#: Words of more bytes than this get their checksum one by one.
SHORT = 32


def crc32(words: pa.Array) -> np.ndarray:
    """The CRC-32 of each word, byte by byte over all words at once."""
    data, ends = buffers(words)
    sizes = np.diff(ends)
    out = np.full(len(words), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-sizes, kind="stable")
    begins, falling = ends[:-1][order], -sizes[order]
    sums = out[order]
    for place in range(min(SHORT, int(sizes.max(initial=0)))):
        n = int(np.searchsorted(falling, -place, side="left"))  # words of over ``place`` bytes
        sums[:n] = _CRC_TABLE[(sums[:n] ^ data[begins[:n] + place]) & 0xFF] ^ (sums[:n] >> 8)
    out[order] = ~sums
    for i in np.flatnonzero(sizes > SHORT):
        out[i] = zlib.crc32(data[ends[i]:ends[i + 1]])
    return out.astype(np.int64)


class BitSet:
    """A set of hashes with a fixed size; it may hold more than was put in, never less."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        return (self.bits[hashes >> 3] >> (hashes & 7).astype(np.uint8)) & 1 == 1

    @staticmethod
    def of(phrases: DataFrame, words: list[Column]) -> BitSet:
        """Of the phrases' languages and words; 2,048 rows of 4 KB at most reach the driver."""
        parts = [F.col("lang"), *words]
        total = sum((F.crc32(part.cast("binary")) * factor for part, factor in zip(parts, FACTORS)), F.lit(0).cast("long"))
        # the bitmap functions number positions from 1
        hashes = phrases.select((F.pmod(total, F.lit(BITS)) + 1).alias("hash"))
        rows = hashes.groupBy(F.bitmap_bucket_number("hash").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("hash")).alias("bits")).collect()
        bits = np.zeros(BITS // 8, np.uint8)
        for row in rows:
            part = np.frombuffer(row.bits, np.uint8)
            bits[(row.bucket - 1) * len(part):row.bucket * len(part)] = part
        return BitSet(bits)


class Block:
    """The words of some pieces: numbers of words and languages in order, and whether the next word follows in the same piece."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, langs: np.ndarray):
        data = W.LOWER[data]
        begins, stops, first = W.runs(data, ends, SEPARATOR)
        text = np.repeat(np.arange(len(langs)), np.diff(first))
        piece = np.cumsum(BREAK[data], dtype=np.int32)[begins] if len(begins) else begins
        self.follows = np.zeros(len(begins), bool)
        self.follows[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        offsets = np.concatenate([[0], np.cumsum(stops - begins)])
        content = data[~SEPARATOR[data]].tobytes()
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(content)])
        encoded = words.dictionary_encode()
        self.words, self.numbers = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.langs = langs[text]

    @cached_property
    def crc(self) -> np.ndarray:
        return crc32(self.words)

    def starts(self, size: int) -> np.ndarray:
        """Where a phrase of so many words begins."""
        n = len(self.numbers)
        ok = np.ones(n, bool)
        for step in range(size - 1):
            ok[:n - step] &= self.follows[step:]
            ok[n - step:] = False
        return np.flatnonzero(ok)

    def hashes(self, at: np.ndarray, size: int, lang_crc: np.ndarray) -> np.ndarray:
        out = lang_crc[self.langs[at]]
        for step in range(size):
            out = out + self.crc[self.numbers[at + step]] * FACTORS[step + 1]
        return out % BITS

    def counted(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first occurrence, number of occurrences) of each distinct phrase that begins at one of ``at``."""
        many = max(len(self.words), 1)
        key = self.langs[at] * many + self.numbers[at]
        for step in range(1, size):
            if len(key) and int(key.max()) >= (1 << 62) // many:
                key = np.unique(key, return_inverse=True)[1]
            key = key * many + self.numbers[at + step]
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        return at[first], counts

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        columns = [self.words.take(pa.array(self.numbers[at + step])) for step in range(size)]
        return pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string()).cast(pa.string())


def _piece_end(data: np.ndarray, ends: np.ndarray, at: int) -> int:
    """The end of the first text or piece that ends at ``at`` or behind it, else the end of all."""
    if at >= ends[-1]:
        return int(ends[-1])
    text_end = int(ends[np.searchsorted(ends, at)])
    for begin in range(at - 1, text_end, 1 << 16):
        found = np.flatnonzero(BREAK[data[begin:min(begin + (1 << 16), text_end)]])
        if len(found):
            return begin + int(found[0]) + 1
    return text_end


def blocks(data: np.ndarray, ends: np.ndarray, langs: np.ndarray, size: int | None = None) -> Iterator[Block]:
    """Blocks of about ``size`` bytes that end with a text or a piece."""
    size, begin = size or BLOCK_BYTES, int(ends[0])
    while begin < ends[-1]:
        end = _piece_end(data, ends, begin + size)
        first, last = int(np.searchsorted(ends, begin, side="right")) - 1, int(np.searchsorted(ends, end, side="left"))
        own = np.clip(ends[first:last + 1], begin, end) - begin
        yield Block(data[begin:end], own, langs[first:last])
        begin = end


def _counts(texts: DataFrame, size: int, wanted: list[tuple[int, dict[int, BitSet]]]) -> DataFrame:
    """lang, phrase, f of the phrases of ``size`` words with LEAST occurrences or more. A phrase is counted if, for each (width,
    sets by place) of ``wanted``, one of its parts of so many words is in the set of the part's place."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            coded = batch.column("lang").dictionary_encode()
            names = coded.dictionary
            lang_crc = np.array([zlib.crc32(name.encode()) for name in names.to_pylist()], np.int64)
            langs = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            for block in blocks(*buffers(binary_column(batch, "text")), langs):
                at = block.starts(size)
                for width, either in shared.value:
                    ok = np.zeros(len(at), bool)
                    for place, bits in either.items():
                        ok |= bits.has(block.hashes(at + place, width, lang_crc))
                    at = at[ok]
                if size == 1:  # and the number of all words of a language, under no phrase
                    some, counts = np.unique(block.langs, return_counts=True)
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(some)), pa.nulls(len(some), pa.string()), pa.array(counts)], ["lang", "phrase", "f"])
                first, counts = block.counted(at, size)
                if len(first):
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(block.langs[first])), block.phrases(first, size), pa.array(counts)], ["lang", "phrase", "f"])

    counted = texts.mapInArrow(tidy(run), "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return checkpointed(counted.where(f"f >= {LEAST} OR phrase IS NULL"))


def wide(number: Column, digits: int = 20) -> Column:
    return number.cast(f"decimal({digits},0)")


def ratio(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(SCALE * a / (l + r)), exact."""
    return F.expr(f"CAST({SCALE} AS DECIMAL(7,0)) * CAST({a} AS DECIMAL(19,0)) div (CAST({l} AS DECIMAL(19,0)) + CAST({r} AS DECIMAL(19,0)))")


def words_of(phrase: str, first: int, size: int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first + 1, size), " ")


def _with_counts(phrases: DataFrame, known: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add the counts (lang, phrase, f) of parts of the phrases; phrases without one of them go."""
    for name, part in columns.items():
        counts = known.select("lang", F.col("phrase").alias("part"), F.col("f").alias(name))
        phrases = phrases.withColumn("part", part).join(counts, ["lang", "part"]).drop("part")
    return phrases


def _scored(counted: DataFrame, size: int, known: dict[int, DataFrame]) -> DataFrame:
    """lang, phrase, size, a, l, r, score of the worst cut, and the bounds of growth to the right and to the left."""
    out = counted.withColumnRenamed("f", "a")
    for k in range(1, size):
        out = _with_counts(out, known[k], {f"l{k}": words_of("phrase", 0, k)})
        out = _with_counts(out, known[size - k], {f"r{k}": words_of("phrase", k, size - k)})
    cuts = F.array(*(F.struct(ratio("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, size)))
    return out.withColumn("cut", F.array_min(cuts)).select(
        "lang", "phrase", F.lit(size).alias("size"), "a", "cut.l", "cut.r", "cut.score",
        ratio("a", "l1", "a").alias("right"), ratio("a", f"r{size - 1}", "a").alias("left"),
    )


def _thresholds(pairs: DataFrame, open_langs: DataFrame, many: int) -> DataFrame:
    """lang, t: the score of the ``many``-th best pair of each open language, 0 where there are fewer."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"))
    best = pairs.select("lang", "score").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= many)
    least = best.groupBy("lang").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    return open_langs.join(least, "lang", "left").select("lang", F.when(F.col("n") >= many, F.col("least")).otherwise(F.lit(0)).alias("t"))


def _flagged(nodes: DataFrame, thresholds: DataFrame, size: int) -> tuple[BitSet, BitSet]:
    """The nodes to grow to the right and to the left."""
    parts = F.split("phrase", " ")
    words = [F.get(parts, i) for i in range(size)]
    judged = nodes.join(thresholds, "lang")
    return BitSet.of(judged.where("right >= t"), words), BitSet.of(judged.where("left >= t"), words)


def _survivors(candidates: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Candidates at or above their language's threshold that lie in no longer one with SHARE percent of their occurrences."""
    longer = candidates.where("size > 2").select("lang", F.explode(F.array(
        words_of("phrase", 0, F.col("size") - 1), words_of("phrase", 1, F.col("size") - 1),
    )).alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(thresholds, "lang").where("score >= t").join(longer, ["lang", "phrase"], "left")
    return kept.where(F.coalesce(wide(F.col("longer")) * 100 < wide(F.col("a")) * SHARE, F.lit(True)))


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` surviving phrases of each language."""
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    words = _counts(texts, 1, [])
    totals = words.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    words = words.where("phrase IS NOT NULL")
    frequent = BitSet.of(words, [F.col("phrase")])
    counted = {1: words, 2: _counts(texts, 2, [(1, {0: frequent}), (1, {1: frequent})])}
    pairs = checkpointed(_scored(counted[2], 2, counted))
    frequent_pairs = BitSet.of(pairs, [F.get(F.split("phrase", " "), i) for i in range(2)])
    known_pairs = lambda size: [(2, {place: frequent_pairs}) for place in range(size - 1)]

    open_langs, many, found = checkpointed(pairs.select("lang").distinct()), 2 * top, None
    while open_langs.limit(1).count():
        thresholds = checkpointed(_thresholds(pairs, open_langs, many))
        levels = [pairs.join(thresholds.select("lang"), "lang", "left_semi")]
        for size in range(3, LONGEST + 1):
            right, left = _flagged(levels[-1], thresholds, size - 1)
            counted[size] = _counts(texts, size, [*known_pairs(size), (size - 1, {0: right, 1: left})])
            # phrases whose parts were not counted are below the threshold, but may hold a shorter one
            scored = _scored(counted[size], size, counted).select("lang", "phrase", "size", "l", "r", "score", "right", "left")
            levels.append(checkpointed(
                counted[size].join(thresholds.select("lang"), "lang", "left_semi").join(scored, ["lang", "phrase"], "left").select(
                    "lang", "phrase", F.lit(size).alias("size"), F.col("f").alias("a"), "l", "r", F.coalesce("score", F.lit(-1)).alias("score"), "right", "left",
                )
            ))
        candidates = levels[0]
        for level in levels[1:]:
            candidates = candidates.unionByName(level)
        survivors = checkpointed(_survivors(candidates, thresholds).select("lang", "phrase", "a", "l", "r", "score"))
        settled = thresholds.join(survivors.groupBy("lang").agg(F.count("*").alias("kept")), "lang", "left").select(
            "lang", (F.coalesce("kept", F.lit(0)) >= top).alias("full"), (F.col("t") == 0).alias("whole"),
        )
        done = checkpointed(settled.where("full OR whole").select("lang"))
        results = survivors.join(done, "lang", "left_semi")
        found = results if found is None else found.unionByName(results)
        open_langs = checkpointed(open_langs.join(done, "lang", "left_anti"))
        many *= WIDER
    if found is None:
        found = pairs.select("lang", "phrase", "a", "l", "r", "score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
