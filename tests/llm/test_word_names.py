"""Strings that fall together under a polynomial modulo a power of two stay apart in every operator that names words or windows by hash."""

import numpy as np
import pytest

from ledgerlight.llm import decontaminate, jaccard_join, labelled, language_model, quality_rank, suffix_dedup, textstats, wordvec

SIZES = [64, 128, 256, 512, 1024, 2048]


def pair(size):
    """The Thue-Morse word of so many letters and its complement."""
    word = ""
    for i in range(size):
        word += "ab"[bin(i).count("1") % 2]
    return word, word.translate(str.maketrans("ab", "ba"))


def arrays(*texts):
    parts = [text.encode() for text in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


@pytest.mark.parametrize("size", SIZES)
def test_words_lines_and_windows(size):
    one, other = pair(size)
    words = wordvec.Words(*arrays(f"{one} {other}", f"x{one}y x{other}y"))
    assert len(set(words.hashes.tolist())) == 4
    different = [bin(int(words.hashes[0] ^ words.hashes[1])).count("1"), bin(int(words.hashes[2] ^ words.hashes[3])).count("1")]
    assert min(different) > 10  # not only in the high bits
    data, _ = arrays(one + other)
    rolling = wordvec.Rolling(data)
    names = rolling.names(np.array([0, size]), np.array([size, 2 * size]))
    assert names[0] != names[1] and (names[0] ^ names[1]) & np.uint64(0xFFFFFFFF)
    assert (rolling.windows(size)[[0, size]] == names).all()
    stats = textstats.statistics(*arrays(f"{one}\n{other}\n", f"{one}\n{one}\n"))
    assert stats["n_dup_lines"].tolist() == [0, 1]


def test_names_depend_on_the_bytes_alone():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    begins = np.sort(rng.integers(0, 4900, 3000))
    stops = np.minimum(begins + rng.integers(0, 40, 3000), 5000)
    by_text = {}
    for begin, stop, name in zip(begins, stops, wordvec.span_hashes(data, begins, stops)):
        assert by_text.setdefault(data[begin:stop].tobytes(), name) == name
    assert len(set(by_text.values())) == len(by_text)
    rolling = wordvec.Rolling(data)
    assert len(set(rolling.windows(12).tolist())) == len({data[i:i + 12].tobytes() for i in range(4989)})
    shifted = wordvec.Rolling(data[700:])
    assert (shifted.windows(12)[:50] == rolling.windows(12)[700:750]).all()


@pytest.mark.parametrize("size", [64, 1024])
def test_operators(spark, size):
    one, other = pair(size)
    docs = spark.createDataFrame([(1, one), (2, other), (3, other), (4, f"{one}\n{other}")], "doc_id long, text string")
    joined = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_components(docs).collect()}
    assert joined == {1: (1, 1), 2: (1, 2), 3: (1, 2), 4: (1, 4)}
    scored = {r.doc_id: r for r in language_model.score_texts(docs.where("doc_id < 4"), lambda keys: keys != 1).collect()}
    assert (scored[1].n_known, scored[2].n_known) == (1, 2)
    items = spark.createDataFrame([(7, f"{one} b c d e f")], "item_id long, text string")
    texts = spark.createDataFrame([(1, f"{one} b c d e f"), (2, f"{other} b c d e f")], "doc_id long, text string")
    assert [(r.doc_id, r.distance) for r in decontaminate.find_leaks(texts, items).collect()] == [(1, 0), (2, 1)][:1 + (decontaminate.allowed(6) > 0)]
    if size >= suffix_dedup.SIZE:
        removed = {r[0]: r.n_removed for r in suffix_dedup.remove_repeats(docs.where("doc_id < 4")).collect()}
        want, seen = {}, set()
        for key, text in ((1, one), (2, other), (3, other)):
            gone = bytearray(len(text))
            for i in range(len(text) - 99):
                if text[i:i + 100] in seen:
                    gone[i:i + 100] = b"\1" * 100
                seen.add(text[i:i + 100])
            want[key] = sum(gone)
        assert removed == want


@pytest.mark.parametrize("kind", ["int", "smallint", "string", "bigint"])
def test_item_and_document_keys_of_any_type(spark, kind):
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame([("1", text), ("2", "other words"), (None, text)], "doc_id string, text string").selectExpr(f"CAST(doc_id AS {kind}) AS doc_id", "text")
    items = spark.createDataFrame([("5", text), (None, "nine " + text)], "item_id string, text string").selectExpr(f"CAST(item_id AS {kind}) AS item_id", "text")
    got = decontaminate.find_leaks(docs, items)
    assert {field.name: field.dataType.simpleString() for field in got.schema}["item_id"] == kind
    exact = {(str(r.doc_id), str(r.item_id)) for r in got.where("distance = 0").collect()}
    assert exact == {("1", "5"), ("None", "5")}
    assert [r.text for r in decontaminate.without_leaks(docs, items).collect()] == ["other words"]


def test_a_labelled_key_of_very_many_documents(spark):
    docs = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7L ELSE id END AS doc_id", "concat('word ', id, ' more words') AS text").repartition(6)
    labels = spark.createDataFrame([(7, 1), (10, 0), (11, 1)], "doc_id long, quality int")
    found = docs.join(labels, "doc_id")
    assert found.count() > 1000
    matrix, label, counts = labelled.labelled_ratios(docs, labels, "quality")
    assert matrix.shape[0] == 3 and sorted(label.tolist()) == [0, 1, 1]
    again = labelled.labelled_ratios(docs.repartition(2), labels, "quality")
    assert (again[0] == matrix).all() and all((again[2][name] == counts[name]).all() for name in counts)
    assert quality_rank.fit_ranker(docs, labels) is not None
