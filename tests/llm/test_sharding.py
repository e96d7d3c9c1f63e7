import zlib
from collections import defaultdict

import pytest

from ledgerlight.llm import queries as Q
from ledgerlight.llm.sharding import shard_by_bytes

SCHEMA = "doc_id long, text string, shard string, hash string, size string"


def shards_of(spark, texts, shards, ids=None):
    rows = [(ids[i] if ids else i, text, "x", None, "y") for i, text in enumerate(texts)]
    got = shard_by_bytes(spark.createDataFrame(rows, SCHEMA).repartition(3), shards).collect()
    assert len(got) == len(texts)
    by = defaultdict(list)
    for row in got:
        by[row["shard"]].append(row)
    for rows_ in by.values():
        assert sorted(r.slot for r in rows_) == list(range(len(rows_)))
    return got, by


def test_sizes_slots_and_groups(spark):
    texts = [f"text {i} " * (i % 7 + 1) for i in range(800)] + ["copy of one text"] * 9 + [None, ""]
    got, by = shards_of(spark, texts, 24)
    total = sum(len((t or "").encode()) + 8 for t in texts)
    for row in got:
        text = (texts[row.doc_id] or "").encode()
        assert (row["size"], row.text_crc32) == (len(text) + 8, zlib.crc32(text))
    assert set(by) == set(range(24))
    # a cut moves by half a group of equal texts at most
    assert all(abs(sum(r["size"] for r in rows) - total / 24) <= 9 * 24 for rows in by.values())
    assert len({row["shard"] for row in got if 800 <= row.doc_id < 809}) == 1


def test_a_group_larger_than_a_shard_is_cut(spark):
    got, by = shards_of(spark, ["same"] * 500 + [f"t{i}" for i in range(500)], 10)
    sizes = [sum(r["size"] for r in by[s]) for s in range(10)]
    assert max(sizes) - min(sizes) <= 24
    assert len({row["shard"] for row in got if row.doc_id < 500}) >= 5


def test_empty_few_null_and_repeated_rows(spark):
    assert shards_of(spark, [], 24)[0] == []
    shards_of(spark, ["a", "b"], 24)
    shards_of(spark, ["a", "a", None], 4, ids=[None, None, 1])
    assert {row["shard"] for row in shards_of(spark, ["a", "b"], 1)[0]} == {0}


@pytest.mark.parametrize("shards", [2, 5])
def test_order_is_contiguous(spark, shards):
    _, by = shards_of(spark, [f"{i}" * (i % 40) for i in range(300)], shards)
    assert max(map(len, by.values())) < 300


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_on_the_whole_table(spark, folder):
    docs = Q.table(spark, folder, "documents").collect()
    got = Q.QUERIES["op8_sharding"](spark, folder).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in docs}
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs) and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    total, largest, by = 0, 0, defaultdict(list)
    for row in got:
        text = texts[row.doc_id]
        assert (row["size"], row.text_crc32) == (len(text) + 8, zlib.crc32(text))
        by[row.shard].append(row)
        total, largest = total + row["size"], max(largest, row["size"])
    assert set(by) <= set(range(24))
    for rows in by.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        assert abs(sum(r["size"] for r in rows) - total / 24) <= 0.02 * total / 24 + largest
    # one order: shards follow each other, and equal texts are split by a cut at most, never scattered
    groups = defaultdict(list)
    for row in got:
        groups[texts[row.doc_id]].append((row.shard, row.slot))
    ends = {shard: len(rows) for shard, rows in by.items()}
    for places in groups.values():
        places.sort()
        for (shard, slot), (next_shard, next_slot) in zip(places, places[1:]):
            assert (next_shard, next_slot) == (shard, slot + 1) or next_slot == 0 and slot == ends[shard] - 1


def test_balance_with_groups_just_below_a_shard(spark):
    texts = [f"{group} " + "x" * 990 for group in "abc" for _ in range(22)] + [f"{i:06d} " + "y" * (i % 90) for i in range(9000)]
    sizes = [len(t) + 8 for t in texts]
    _, by = shards_of(spark, texts, 24)
    equal = sum(sizes) / 24
    assert all(abs(sum(r["size"] for r in rows) - equal) <= 0.02 * equal + max(sizes) for rows in by.values())
