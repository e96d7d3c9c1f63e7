import hashlib
import random

import numpy as np
import pytest

from ledgerlight.llm import queries as Q
from ledgerlight.llm import suffix_dedup as S


def covered(rows, size):
    """Which bytes of each row are to go: every string of the given size at its first place, directly."""
    first = {}
    for key, text in rows:
        order = (key is not None, key or 0)
        for i in range(len(text) - size + 1):
            s = text[i:i + size]
            first[s] = min(first.get(s, (order, i)), (order, i))
    out = []
    for key, text in rows:
        order = (key is not None, key or 0)
        gone = bytearray(len(text))
        for i in range(len(text) - size + 1):
            if first[text[i:i + size]] < (order, i):
                gone[i:i + size] = b"\1" * size
        out.append(bytes(gone))
    return out


def expected(rows, size):
    out = []
    for (key, text), gone in zip(rows, covered(rows, size)):
        kept = bytes(b for b, g in zip(text, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r[0], r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect()), key=str)


def test_whole_table_equals_a_direct_search(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, (r.text or "").encode()) for r in Q.table(spark, folder, "documents").collect()]
    found = sorted((tuple(r) for r in Q.QUERIES["op2_suffix_dedup"](spark, folder).collect()), key=str)
    wanted = expected(rows, 100)
    assert found == wanted and sum(r[2] for r in wanted) > 1000


def made(n, seed, size):
    random.seed(seed)
    text = lambda k: "".join(random.choices("abé ", k=k))
    passages = [text(random.randrange(size, 4 * size)) for _ in range(6)] + ["ab" * 2 * size, "a" * 3 * size]
    rows = []
    for i in range(n):
        parts = [random.choice([text(random.randrange(2 * size)), random.choice(passages), random.choice(passages)[random.randrange(size):]]) for _ in range(random.randrange(5))]
        if rows and random.random() < 0.3:
            parts.append(random.choice(rows)[1])
        rows.append((random.choice([i, i, n - i, None]) if i % 17 == 0 else 2 * n + (i * 7) % n, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed, size, anchor, chunk", [(1, 20, 6, 1 << 20), (2, 30, 10, 97), (3, 100, 32, 1 << 20)])
def test_random_texts(spark, monkeypatch, seed, size, anchor, chunk):
    monkeypatch.setattr(S, "CHUNK", chunk)
    monkeypatch.setattr(S, "ARRAY_BYTES", 3000)
    rows = made(90, seed, size)
    keys = [k for k, _ in rows if k is not None]
    rows = [(k, t) for k, t in rows if k is None or keys.count(k) == 1]
    rows = [(k, t) for i, (k, t) in enumerate(rows) if k is not None or all(x[0] is not None for x in rows[:i])]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, kept int").repartition(3)
    wanted = expected([(k, t.encode()) for k, t in rows], size)
    assert sum(r[2] for r in wanted) > 0
    assert result(S.remove_repeats(df, size=size, anchor=anchor)) == wanted


@pytest.mark.parametrize("seed, size, anchor", [(5, 20, 6), (6, 100, 32)])
def test_hot_anchors_dealt_by_string(spark, monkeypatch, seed, size, anchor):
    monkeypatch.setattr(S, "HOT_CLASSES", 2)
    rows = [(i, t) for i, (_, t) in enumerate(made(90, seed, size))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = expected([(k, t.encode()) for k, t in rows], size)
    assert sum(r[2] for r in wanted) > 0 and result(S.remove_repeats(df, size=size, anchor=anchor)) == wanted


def test_messages_dont_grow_with_copies_and_hot_anchors_are_split(spark):
    random.seed(8)
    text = lambda k: "".join(random.choices("abcdefgh", k=k))
    one, shared = text(1000), text(150)
    sent = {}
    for copies in (1, 40):
        slices = S.slices_of(spark.createDataFrame([(i, one) for i in range(copies)], "doc_id long, text string").coalesce(1))
        packed = [r.segments for r in S._send_segments(slices, 4, 100, 32).where("segments IS NOT NULL").collect()]
        sent[copies] = sum(len(S.rows_of(bytes(x), S.SEGMENT)) for x in packed)
    assert sent[1] == sent[40]
    slices = S.slices_of(spark.createDataFrame([(i, text(200) + shared + text(200)) for i in range(60)], "doc_id long, text string").coalesce(1))
    found = S._steps(slices, 100, 32, 20)[1].collect()
    whole = [np.unique(S.rows_of(bytes(r.segments), S.CONTENT)["anchor"], return_counts=True)[1].max() for r in found if r.segments is not None]
    assert max(whole, default=0) <= 20 and len({r.bucket for r in found if r.strings is not None}) > 3


def test_nulls_empty_tables_repeated_rows_and_other_columns(spark):
    schema = "doc_id long, text string, lang string, slice int"
    assert S.remove_repeats(spark.createDataFrame([], schema), rest=True).collect() == []
    long = "".join(map(str, range(200)))
    rows = [(1, long, "x", None), (1, long, "y", 2), (2, long, None, 3), (3, None, None, None), (None, "", None, None)]
    got = S.remove_repeats(spark.createDataFrame(rows, schema), rest=True).collect()
    assert got[0].asDict().keys() == {"doc_id", "lang", "slice", "n_bytes", "n_removed", "spans", "kept"}
    assert sorted((r.doc_id or 0, r.lang or "", r.n_removed, bytes(r.kept).decode()) for r in got) == [
        (0, "", 0, ""), (1, "x", 0, long), (1, "y", 0, long), (2, "", len(long), ""), (3, "", 0, ""),
    ]


def test_groups_are_maximal_and_whole(spark):
    random.seed(4)
    text = lambda k: "".join(random.choices("abcdefgh", k=k))
    shared = text(130)
    rows = [(i, text(300) + shared + text(300)) for i in range(5)]
    groups = {}
    for r in S.repeat_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        groups.setdefault((r.group, r.length), []).append((r.doc_id, r.start))
    assert any(len(places) == 5 for places in groups.values())
    for (_, length), places in groups.items():
        assert len({rows[d][1][s:s + length] for d, s in places}) == 1 and length >= 100


def test_groups_hold_every_occurrence(spark):
    """Against all places of all repeated strings: exact copies, near copies, shared passages, repeats inside one text."""
    random.seed(12)
    words = [random.choice("abcdefgh") * random.randrange(1, 4) + str(i) for i in range(60)]
    make = lambda n: " ".join(random.choices(words, k=n))
    whole, passage, edited = make(120), make(40), make(90)
    texts = [whole] * 4 + [make(20) + " " + passage + " " + make(20) for _ in range(4)] + [passage + passage, edited, edited[:200] + "X" + edited[201:], "ab" * 150, None, "", make(10)]
    rows = [(None if i == 3 else i, text) for i, text in enumerate(texts)]
    groups = {}
    for r in S.repeat_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        groups.setdefault((r.group, r.length), []).append((r.doc_id, r.start))
    text_of = dict(rows)
    strings = {}
    for (_, length), places in groups.items():
        (string,) = {text_of[d][s:s + length] for d, s in places}
        assert length >= 100 and len(set(places)) == len(places) > 1
        # no occurrence is missing
        wanted = {(d, i) for d, t in rows if t for i in range(len(t) - length + 1) if t[i:i + length] == string}
        assert set(places) == wanted
        strings.setdefault(string, 0)
        strings[string] += 1
    assert max(strings.values()) == 1  # and no group comes twice
    # every repeated string of 100 bytes lies in a group with all of its places
    places = {}
    for d, t in rows:
        for i in range(len(t or "") - 99):
            places.setdefault(t[i:i + 100], set()).add((d, i))
    for string, where in places.items():
        if len(where) > 1:
            assert any(string in other and {(d, s + other.index(string)) for d, s in groups_of} >= where for other, groups_of in (
                (text_of[ps[0][0]][ps[0][1]:ps[0][1] + length], ps) for (_, length), ps in groups.items()
            )), string


def test_interval_tree_against_all_pairs():
    random.seed(9)
    for _ in range(30):
        parts = ["".join(random.choices("ab", k=random.randrange(8, 30))) for _ in range(12)]
        content = np.frombuffer("".join(parts).encode(), np.uint8)
        lengths = np.array([len(p) for p in parts])
        array = S.SuffixArray(content, lengths, 6)
        at = [(int(s), int(o)) for s, o in zip(array.segment, array.offset)]
        suffixes = [parts[s][o:] for s, o in at]
        assert suffixes == sorted(suffixes, key=lambda x: x)
        place = np.array([1000 * s + o for s, o in at])
        shared, groups = S.interval_tree(array, place, 6)
        prefix = lambda x, y: next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
        reach = {}
        for i, x in enumerate(suffixes):
            best = max((prefix(x, y) for j, y in enumerate(suffixes) if place[j] < place[i]), default=0)
            reach[at[i]] = best if best >= 6 else 0
        # every byte that an earlier place repeats is covered
        def bytes_of(lengths_by_place):
            return {(s, b) for (s, o), n in lengths_by_place.items() for b in range(o, o + n)}
        assert bytes_of(dict(zip(at, shared.tolist()))) == bytes_of(reach)
        for length, first, last in groups:
            some = suffixes[first:last + 1]
            assert len({x[:length] for x in some}) == 1 and len({x[length:length + 1] for x in some}) > 1 or min(map(len, some)) == length


def test_cut_characters_go_in_the_given_rows_only():
    rows = [b"\xc3", b"", "aé東".encode()[:-1], b"\x82b\xf0\x9f", "é🙂".encode(), b"\xa9"]
    kept, ends = np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])
    for some in ([], [0], [2, 3], [1, 4, 5], range(6)):
        data, at = S.whole_characters(kept, ends, np.array(some, np.int64))
        wanted = [row.decode("utf-8", "ignore").encode() if i in some else row for i, row in enumerate(rows)]
        assert [data[a:b].tobytes() for a, b in zip(at[:-1], at[1:])] == wanted
