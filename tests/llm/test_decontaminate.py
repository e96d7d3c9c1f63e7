import random

import numpy as np
import pytest

from ledgerlight.llm import decontaminate as D
from ledgerlight.llm import queries as Q


def plain_distance(item, text):
    """Least edit distance between the item and a run of the text's words, by the table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def lower(text):
    return (text or "").encode()


def expected(docs, items):
    names = D.names_of([lower(t) for _, t in items])
    out = []
    for key, text in docs:
        words = D.names_of([lower(text)])[0]
        for (item, _), name in zip(items, names):
            if len(name) >= D.MIN_WORDS:
                distance, _ = D.edit_distance(name, words)
                if 100 * distance <= D.EDIT_PERCENT * len(name):
                    out.append((key, item, distance))
    return sorted(out)


def found(df):
    return sorted((r.doc_id, r.item_id, r.distance) for r in df.collect())


def test_edit_distance_equals_the_table():
    random.seed(2)
    for _ in range(300):
        item = [random.randrange(4) for _ in range(random.randrange(1, 70))]
        text = [random.randrange(4) for _ in range(random.randrange(0, 90))]
        distance, end = D.edit_distance(np.array(item, np.uint64), np.array(text, np.uint64))
        assert distance == plain_distance(item, text)
        assert plain_distance(item, text[:end]) == distance


def test_whole_table_equals_a_full_search(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in Q.table(spark, folder, "documents").collect()]
    items = [(r.item_id, r.text) for r in Q.table(spark, folder, "benchmark").collect()]
    wanted = expected(docs, items)
    assert wanted and found(Q.QUERIES["op6_decontamination"](spark, folder)) == wanted
    clean = D.without_leaks(Q.table(spark, folder, "documents"), Q.table(spark, folder, "benchmark"))
    assert sorted(r.doc_id for r in clean.collect()) == sorted({k for k, _ in docs} - {k for k, _, _ in wanted})


@pytest.fixture(scope="module")
def edited():
    """Items, and documents that hold one each with as many edits as are allowed."""
    random.seed(3)
    words = [f"w{i}" for i in range(5000)]
    items = [(i, " ".join(random.choices(words, k=random.randrange(5, 60)))) for i in range(150)] + [(900, "too short to tell"), (901, None), (902, "")]
    docs = []
    for i, text in items[:150]:
        parts = [[w] for w in text.split()]
        for at in random.sample(range(len(parts)), D.allowed(len(parts))):
            parts[at] = random.choice([["other"], [], [parts[at][0], "more"]])
        middle = [w for p in parts for w in p]
        docs.append((1000 + i, " ".join(random.choices(words, k=random.randrange(40)) + middle + random.choices(words, k=random.randrange(40)))))
    return items, docs


def test_recall_at_the_largest_distance(spark, edited, monkeypatch):
    items, docs = edited
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in docs], "doc_id long, text string, item int, distance string").repartition(3)
    got, wanted = found(D.find_leaks(df, benchmark)), expected(docs, items)
    assert set(got) <= set(wanted) and len(got) >= 0.9 * len(wanted) >= 130
    monkeypatch.setattr(D, "BLOCK_BYTES", 20_000)
    assert len(list(D.indexes(benchmark))) > 1
    assert set(found(D.find_leaks(df, benchmark))) <= set(wanted)


@pytest.mark.parametrize("length", [5, 6, 7, 9, 10, 14, 15, 16, 30, 100])
def test_recall_of_each_length(length):
    random.seed(length)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [random.choices(vocabulary, k=length) for _ in range(200)]
    texts = []
    for words in items:
        parts = [[w] for w in words]
        for at in random.sample(range(length), D.allowed(length)):
            parts[at] = random.choice([["other"], [], [parts[at][0], "more"]])
        texts.append(" ".join(random.choices(vocabulary, k=9) + [w for p in parts for w in p] + random.choices(vocabulary, k=9)).encode())
    index = D.Index(list(range(200)), D.names_of([" ".join(words).encode() for words in items]))
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    hits = {(t, i) for t, i, _, _ in index.matches(D.W.Words(np.frombuffer(b"".join(texts), np.uint8), ends, lower=True))}
    share = sum((i, i) in hits for i in range(200)) / 200
    repetitions, reached = index.reached[int(D.bands(np.array([length]))[0])]
    assert reached >= D.TARGET_RECALL and (share == 1 if repetitions == 0 else share >= 0.96)


def test_short_items_in_every_edit_and_word_for_word(spark):
    items = [(1, "a b c d e"), (2, "one two three"), (3, "single"), (4, "... ?"), (5, "a a a a a a")]
    windows = ["x b c d e", "b c d e", "a x c d e", "a b c d x", "a b c x d e", "b a c d e", "a a x a a a", "a b a b a b", "x one Two three y", "one two x three", "SINGLE", ""]
    docs = [(i, f"p q {window} r s") for i, window in enumerate(windows)]
    names = D.names_of([lower(t) for _, t in items])
    wanted = []
    for key, text in docs:
        for (item, _), name in zip(items, names):
            distance = plain_distance(name.tolist(), D.names_of([lower(text)])[0].tolist())
            if len(name) and distance <= D.allowed(len(name)):
                wanted.append((key, item, distance))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = found(D.find_leaks(df, benchmark))
    assert got == sorted(wanted) and {i for _, i, _ in got} >= {1, 2, 3, 5}


def test_nulls_empty_tables_and_repeated_rows(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen"
    items = spark.createDataFrame([(1, text), (2, text), (3, "a b c d e"), (4, None), (None, text.upper())], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "x " + text), (1, "x " + text), (None, text), (3, None), (4, ""), (5, "a b c d"), (6, "z " * 50000 + "A b c d E"), (7, "one two")],
        "doc_id long, text string",
    )
    got = [(r.doc_id, r.item_id) for r in D.find_leaks(docs, items).collect()]
    assert sorted(got, key=str) == sorted([(k, i) for k in (1, 1, None) for i in (1, 2, None)] + [(6, 3), (5, 3)], key=str)
    assert sorted(r.doc_id for r in D.without_leaks(docs, items).collect()) == [3, 4, 7]
    assert found(D.find_leaks(docs.limit(0), items)) == [] and found(D.find_leaks(docs, items.limit(0))) == []
    assert D.without_leaks(docs, items.limit(0)).count() == 8


def test_an_index_has_a_bit_for_each_place_of_its_tables():
    random.seed(5)
    words = [f"w{i}" for i in range(3000)]
    index = D.Index(list(range(50)), D.names_of([" ".join(random.choices(words, k=random.randrange(20, 40))).encode() for _ in range(50)]))
    assert index.repetitions and all(t.nbytes == D.TABLE // 8 for r in index.repetitions for t in r.tables)
    keys = np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64)
    others = np.arange(D.TABLE, dtype=np.uint64)
    assert np.array_equal(D.fits(D.packed_table(keys), others), np.isin(others, keys % np.uint64(D.TABLE)))
    assert D.fits(D.packed_table(keys), keys).all() and len(D.fits(D.packed_table(keys), keys[:0])) == 0
