import random
import re

import numpy as np
import pytest

from ledgerlight.llm import jaccard_join as J
from ledgerlight.llm import queries as Q


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    """Size and component of each row, over an inverted index."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    index = {}
    for i, s in enumerate(sets):
        for t in s:
            index.setdefault(t, []).append(i)
    for i, s in enumerate(sets):
        common = {}
        for t in s:
            for j in index[t]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((key, len(sets[i]), least.get(find(i))) for i, (key, _) in enumerate(rows)), key=str)


def got(spark, rows):
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, n int, uid string").repartition(3)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.join_components(df).collect()), key=str)


def made(n, seed):
    random.seed(seed)
    words = [f"w{i}" for i in range(300)]
    passage = random.choices(words, k=60)
    rows = []
    for i in range(n):
        if rows and random.random() < 0.6:
            text = random.choice(rows)[1].split(" ")
            for _ in range(random.randrange(6)):
                at = random.randrange(len(text) + 1)
                text[at:at + random.randrange(2)] = random.choices(words, k=random.randrange(3))
            text = text or ["w"]
        else:
            text = random.choices(words, k=random.randrange(1, 120))
            if random.random() < 0.4:
                text[len(text) // 2:len(text) // 2] = passage
        rows.append((i * 3 + 1, " ".join(text)))
    return rows


def test_whole_table_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in Q.table(spark, folder, "documents").select("doc_id", "text").collect()]
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in Q.QUERIES["op5_jaccard_join"](spark, folder).collect()), key=str)
    assert found == brute(rows)


def test_chains_passages_and_blocks(spark, monkeypatch):
    rows = made(260, 5)
    wanted = brute(rows)
    assert len({c for _, _, c in wanted}) < 240
    assert got(spark, rows) == wanted
    monkeypatch.setattr(J, "GROUP_WINDOWS", 600)
    assert got(spark, rows) == wanted


def test_nulls_empty_short_long_and_repeated(spark):
    rows = [
        (None, None), (None, "a b c d e f"), (5, "A b C d e f"), (4, ""), (4, " \n"), (7, "x y"), (9, "X Y"), (9, "X Y"), (11, "one"),
        (12, "w " * 30000), (13, "w " * 20000), (14, " ".join(map(str, range(30000)))), (15, " ".join(map(str, range(29000)))),
    ]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


@pytest.mark.parametrize("seed", range(4))
def test_tree_join_equals_all_pairs(seed):
    sets = [np.array(sorted(hash(t) & (2**64 - 1) for t in shingles(text)), np.uint64) for _, text in made(150, seed)]
    labels = J.tree_join(sets)
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if J.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j])) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert labels.tolist() == root
