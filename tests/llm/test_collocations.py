import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import collocations
from ledgerlight.llm.collocations import BITS, FACTORS, BitSet, blocks, mine

SCHEMA = "doc_id long, text string, lang string, phrase string, f long, n string, part string"


def direct(docs, top, least=30):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything."""
    counts, out = {}, []
    for text, lang in docs:
        mine_ = counts.setdefault("und" if lang is None else lang, Counter())
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            for k in range(1, 5):
                mine_.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        n = sum(c for phrase, c in f.items() if len(phrase) == 1)
        candidates = {p for p, c in f.items() if len(p) > 1 and c >= least}
        longest = {}
        for p in candidates:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longest[p[i:i + k]] = max(longest.get(p[i:i + k], 0), f[p])
        rows = []
        for p in candidates:
            if 100 * longest.get(p, 0) >= 80 * f[p]:
                continue
            score, k = min((2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def mined(spark, docs, top, parts=3):
    rows = [(i, text, lang, "x", 7, None, "y") for i, (text, lang) in enumerate(docs)]
    got = mine(spark.createDataFrame(rows, SCHEMA).repartition(parts), top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(row) for row in got.collect())


def made_texts(seed=1):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(40)]
    planted = ["new york", "the quick brown fox", "Éa ça va", "a a a", "of the zug", "x1 x2 x3 x4 x5 x6"]
    docs = []
    for i in range(700):
        words = []
        for _ in range(rng.randrange(0, 60)):
            words.append(rng.choice(planted) if rng.random() < 0.15 else common[int(rng.paretovariate(0.7)) % 40].upper() if rng.random() < 0.1 else common[int(rng.paretovariate(0.7)) % 40])
            words.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\r\n", "\x0b", "\xa0", "\x1f"]))
        docs.append(("".join(words), rng.choice(["en", "en", "en", "de", None, "und", "", "ß"])))
    return docs + [(None, "en"), ("", None), (" ,. ", "fr"), ("new york " * 40, "es")] + [("same text again and again", "it")] * 35


@pytest.mark.parametrize("top", [1, 5, 20, 2000])
def test_equals_a_full_count(spark, top):
    docs = made_texts()
    assert mined(spark, docs, top) == direct(docs, top)


def test_waves_go_on_until_enough_survive(spark, monkeypatch):
    # 42 pairs with the highest score are dropped for 14 phrases of four words, so the first threshold leaves too few
    docs = [(f"p{i} q{i} r{i} s{i}", "en") for i in range(14)] * 40 + made_texts(2)
    asked = []
    monkeypatch.setattr(collocations, "_thresholds", lambda pairs, langs, many, real=collocations._thresholds: asked.append(many) or real(pairs, langs, many))
    got = mined(spark, docs, 20)
    assert got == direct(docs, 20) and len(asked) > 1 and asked[0] == 40
    monkeypatch.setattr(collocations, "WIDER", 2)
    assert mined(spark, docs, 20) == got


def test_long_texts_in_small_blocks(spark):
    text = made_texts(3)[5][0] * 50
    ends, data = np.array([0, len(text.encode()), len(text.encode())]), np.frombuffer(text.encode(), np.uint8)
    whole = Counter()
    for size in (100, 10_000, 1 << 30):
        counts = Counter()
        for block in blocks(data, ends, np.array([0, 1]), size):
            at, n = block.counted(block.starts(3), 3)
            counts.update(dict(zip(block.phrases(at, 3).to_pylist(), n.tolist())))
        assert counts and counts == (whole or counts)
        whole = counts


def test_bits_are_those_of_the_tasks(spark):
    phrases = spark.createDataFrame([("en", "a b"), ("ß", "é x"), ("", "zz a")], "lang string, phrase string")
    bits = BitSet.of(phrases, [F.get(F.split("phrase", " "), i) for i in range(2)])
    crc = lambda text: zlib.crc32(text.encode())
    hashes = [(crc(lang) * FACTORS[0] + crc(a) * FACTORS[1] + crc(b) * FACTORS[2]) % BITS for lang, a, b in (("en", "a", "b"), ("ß", "é", "x"), ("", "zz", "a"), ("en", "b", "a"))]
    assert bits.has(np.array(hashes)).tolist() == [True, True, True, False]
    assert int(np.unpackbits(bits.bits).sum()) == 3


def test_checksums():
    words = [b"", b"a", "é".encode(), b"x" * 31, b"y" * 32, b"z" * 33, b"w" * 5000, *(str(i).encode() for i in range(300))]
    assert collocations.crc32(pa.array(words, pa.large_binary())).tolist() == [zlib.crc32(word) for word in words]
    assert collocations.crc32(pa.array([], pa.large_binary())).tolist() == []


def test_empty_table_and_no_candidates(spark):
    assert mined(spark, [], 5) == []
    assert mined(spark, [(None, None), ("a b c", "en")], 5) == []


def test_products_over_64_bits(spark):
    rows = spark.createDataFrame([(9_000_000_000_000_000, 9_000_000_000_000_001, 9_000_000_000_000_000)], "a long, l long, r long")
    assert rows.select(collocations.ratio("a", "l", "r").alias("x")).first().x == 2_000_000 * 9_000_000_000_000_000 // 18_000_000_000_000_001
