import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlight.llm import labelled, quality_rank, quality_rules, textstats, wordvec
from ledgerlight.llm import queries as Q

FOLDER = "/root/testdata/sf0.01"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)]


CASES = [
    None, "", " \n\t ", "a", "a b a b a b a", "x y z x y z q", "é ü \x85a\n\né ü \x85a\n  \n", "a\nb\na \na", "##** a|b <>&%$", "w" * 3000 + " " + "w" * 3000,
    ("line " * 400 + "\n") * 3, "one two three " * 500, "東京 " * 70,
]


@pytest.fixture(scope="module")
def judged(spark):
    return Q.QUERIES["op7_quality_rules"](spark, FOLDER).collect()


def test_counts_equal_a_direct_count(spark, judged, monkeypatch):
    texts = {row.doc_id: row.text for row in Q.table(spark, FOLDER, "documents").collect()}
    assert sorted(row.doc_id for row in judged) == sorted(texts)
    for row in judged:
        assert [row[name] for name in textstats.COUNTS] == brute(texts[row.doc_id])
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(CASES)], "doc_id long, text string, kept int, n_words string")
    rows = quality_rules.judge(docs, quality_rules.fit(np.zeros((0, len(labelled.RATIOS))), np.zeros(0), np.zeros(0, bool))).collect()
    for row in rows:
        assert [row[name] for name in textstats.COUNTS] == brute(CASES[row.doc_id]), CASES[row.doc_id]
        assert row.kept == (not row.base_failed)


def test_rejected_are_the_bad_ones(spark, judged):
    labels = {row.doc_id: row.quality for row in Q.table(spark, FOLDER, "labels").collect()}
    rows = [row for row in judged if row.doc_id in labels and not row.base_failed]
    assert all(row.kept != row.anomalous for row in rows)
    bad, good = [row.kept for row in rows if not labels[row.doc_id]], [row.kept for row in rows if labels[row.doc_id]]
    assert sum(bad) <= 0.05 * len(bad) and sum(good) >= 0.98 * len(good)


def test_path_lengths_equal_a_walk_and_labels_only_set_the_cut():
    rng = np.random.default_rng(8)
    ratios = np.abs(rng.normal(size=(700, len(labelled.RATIOS))))
    ratios[:40, 3] += 6
    good, passed = np.arange(700) >= 40, np.ones(700, bool)
    forest = quality_rules.fit(ratios, good, passed)
    other = quality_rules.fit(ratios, rng.random(700) < 0.5, passed)
    assert all((getattr(forest, name) == getattr(other, name)).all() for name in ("feature", "value", "left", "right", "length"))
    lengths = forest.path_lengths(ratios)
    for i in range(0, 700, 23):
        total = 0.0
        for tree in range(len(forest.feature)):
            at, depth = 0, 0
            while forest.feature[tree, at] >= 0:
                side = forest.left if ratios[i, forest.feature[tree, at]] <= forest.value[tree, at] else forest.right
                at, depth = side[tree, at], depth + 1
            total += forest.length[tree, at]
            assert depth <= forest.length[tree, at] <= depth + quality_rules.expected_path(quality_rules.TREE_ROWS)
        assert abs(total / len(forest.feature) - lengths[i]) < 1e-9
    assert lengths[:40].mean() < lengths[40:].mean() and (forest.anomalous(lengths) == (lengths < forest.cut)).all()
    # the cut is the best of all that lie between two lengths
    gain = lambda cut: (lengths[:40] < cut).mean() - quality_rules.LOST_WEIGHT * (lengths[40:] < cut).mean()
    values = np.unique(lengths)
    assert gain(forest.cut) == max([0, *(gain(c) for c in (values[1:] + values[:-1]) / 2)])


def test_words_in_small_blocks_have_the_same_names(monkeypatch):
    data = np.frombuffer((" ".join(f"w{i % 37}" for i in range(500)) + " " + "x" * 2000 + " tail").encode(), np.uint8)
    ends = np.array([0, 700, 700, len(data)])
    whole = wordvec.Words(data, ends)
    monkeypatch.setattr(wordvec, "BLOCK", 64)
    assert (wordvec.Words(data, ends).hashes == whole.hashes).all()
    assert len(set(whole.hashes[:100].tolist())) < 40


def test_held_out_quality(spark):
    rows = Q.QUERIES["op9_quality_classifier"](spark, FOLDER).collect()
    labels = {row.doc_id: row.quality for row in Q.table(spark, FOLDER, "labels").collect()}
    assert len(rows) == 1000
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows)
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in rows)
    out = [row for row in rows if row.held_out and row.doc_id in labels]
    assert sum(row.predicted == labels[row.doc_id] for row in out) >= 0.95 * len(out)


def test_empty_tables_null_keys_and_one_label(spark):
    docs = spark.createDataFrame([(None, None, "a"), (1, "", "b"), (1, "a b", "c"), (1, "a b", "c")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1), (1, 0), (None, 0), (2, None), (3, 7)], "doc_id long, quality int")
    for labels in (none, one):
        assert [row.score for row in quality_rank.score(docs, quality_rank.fit_ranker(docs, labels)).collect()] == [0.5] * 4
        assert quality_rules.judge(docs, quality_rules.fit_forest(docs, labels)).count() == 4
    assert quality_rank.score(docs.limit(0), None).collect() == []
    kept = quality_rank.score(docs, None, keep=True)
    assert kept.columns == ["doc_id", "text", "score", "predicted"] and {row.score for row in kept.collect()} == {0.5}
