import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import merkle_manifest
from ledgerlight.llm.merkle_manifest import FIELDS, TOP, fold, octopus

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, key string, leaf string, place string, tree string, block string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def direct_leaf(row, text=None):
    values = [*row[:4], row[4] if text is None else text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def direct_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 16]) for i in range(0, len(last), 16)])
    return levels


def siblings(levels, place):
    out = []
    for level in levels[:-1]:
        first = place // 16 * 16
        out += [node for i, node in enumerate(level[first:first + 16], first) if i != place]
        place //= 16
    return "".join(out)


def direct(rows, shown):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in sources:
        mine = sorted((r for r in rows if r[1] == source), key=lambda r: (r[0] is not None, r[0] or 0, direct_leaf(r)))
        trees.append((mine, direct_levels([direct_leaf(r) for r in mine])))
    top = direct_levels([levels[-1][0] for _, levels in trees])
    out = []
    for at, (mine, levels) in enumerate(trees):
        for place, row in enumerate(mine):
            proof = siblings(levels, place) + siblings(top, at)
            folded = fold(direct_leaf(row, shown(row)), proof, [(place, len(mine)), (at, len(trees))])
            out.append((row[0], direct_leaf(row), levels[-1][0], top[-1][0], proof, folded))
    return sorted(out, key=str)


def shown(row):
    tampered = row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
    return "".join(c.lower() if c.isascii() else c for c in row[4]) if tampered else row[4]


def proved(spark, rows, parts=5):
    docs = spark.createDataFrame([(*row, "x", None, "y", "z", "0") for row in rows], SCHEMA).repartition(parts)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(tampered, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    return merkle_manifest.prove(merkle_manifest.build(docs, presented={"text": text}))


@pytest.mark.parametrize("least", [256, 7])
def test_equals_a_direct_version(spark, monkeypatch, least):
    monkeypatch.setattr(merkle_manifest, "LEAST", least)
    rng = random.Random(3)
    texts = [None, "", "Ä ÖBC\n", "lower case only", "Word " * 3000, "A\0B 🙂"]
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(600)]  # a hot source of 38 runs in three levels
    rows += [(rng.choice([None, 5, 5, i]), rng.choice([None, "", "b", "é", f"s{i % 40}"]), rng.choice([None, "", "de"]), rng.choice([None, 3]), rng.choice(texts)) for i in range(300)]
    rows += rows[:3] + rows[-3:]  # repeated rows
    got = proved(spark, rows).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.folded_root) for r in got), key=str) == direct(rows, shown)
    wrong = {r.doc_id for r in got if r.folded_root != r.root}
    assert wrong and all(zlib.crc32(str(i).encode()) % 5 == 0 for i in wrong)
    for row in got[:50]:
        assert fold(row.leaf, row.proof, [(row.place, row.n_leaves), (row.source_place, row.n_sources)]) == row.root


@pytest.mark.parametrize("sizes", [[], [1], [2], [1, 1], [16], [17], [257, 1]])
def test_few_leaves(spark, sizes):
    rows = [(i, f"s{at}", "en", 1, "Text") for at, n in enumerate(sizes) for i in range(n)]
    got = proved(spark, rows).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.folded_root) for r in got), key=str) == direct(rows, shown)


def test_the_octopus_is_minimal():
    rng = np.random.default_rng(1)
    for n in (1, 2, 16, 17, 300, 5000):
        for share in (1, max(1, n // 7), n):
            leaves = np.sort(rng.choice(n, share, replace=False))
            missing = octopus(leaves, n)
            have, size = set(leaves.tolist()), n
            for level in missing:
                runs = {i // 16 for i in have}
                wanted = {i for run in runs for i in range(run * 16, min(size, run * 16 + 16))}
                assert set(level.tolist()) == wanted - have
                have, size = runs, -(-size // 16)
            assert size == 1


def test_any_change_breaks_the_proof(spark):
    rows = [(i, f"s{i % 3}", "en", 1, "Text") for i in range(100)]
    docs = spark.createDataFrame([(*row, "x", None, "y", "z", "0") for row in rows], SCHEMA)
    for field in FIELDS:
        other = F.when(F.col("doc_id") % 2 == 0, F.lit(None)).otherwise(F.col(field))
        got = merkle_manifest.prove(merkle_manifest.build(docs, presented={field: other})).select("doc_id", "folded_root", "root").collect()
        assert {r.doc_id for r in got if r.folded_root != r.root} == {i for i in range(100) if i % 2 == 0}


def test_a_large_source_asks_for_few_nodes(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'hot' AS source", "'en' AS lang", "1L AS n_chars", "'t' AS text")
    manifest = merkle_manifest.build(docs)
    leaves = manifest.leaves.withColumn("block", F.expr("row div 1024"))
    asked = merkle_manifest._requests(leaves, manifest.sources).groupBy("block").count().collect()
    assert len(asked) == 20 and max(r["count"] for r in asked) <= 4 * 15 * 2
    assert manifest.nodes.where(f"tree = {TOP}").count() == 1
