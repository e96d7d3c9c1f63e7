import hashlib
import random
import time

import pytest

from ledgerlight.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = ["<", "|", "<|", "<|im_end|>", "<|im_sep|>", "<||", "\n", "\\", "\\n", "\\b", "im_start|>", "a", "é", "$1", ""]
ROLES = ["user", "assistant", "assistant", "a\nb\\", "<|im_end|>", ""]


def back(spark, rows):
    df = C.loss_texts(C.read_conversations(C.format_conversations(spark.createDataFrame(rows, SCHEMA))))
    return {row.conv_id: row for row in df.collect()}


def test_reading_back_gives_the_turns(spark):
    random.seed(1)
    text = lambda: "".join(random.choices(PIECES, k=random.randrange(7)))
    conversations = [[(random.choice(ROLES), text()) for _ in range(random.randint(1, 6))] for _ in range(400)]
    rows = [(c, i, role, text) for c, turns in enumerate(conversations) for i, (role, text) in enumerate(turns)]
    got = back(spark, rows[::-1])
    for c, turns in enumerate(conversations):
        assert [(t.role, t.text) for t in got[c].turns] == turns
        assert got[c].loss_texts == [text for role, text in turns if role == "assistant"]


def test_merged_block_and_mask(spark):
    got = back(spark, [(1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, "assistant", "<|c")])[1]
    assert got.formatted == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_sep|><||c<|im_end|>\n"
    assert [got.formatted[s.start:s.start + s.length] for s in got.loss_spans] == ["b", "<||c"]


def test_nulls_ties_and_empty_table(spark):
    got = back(spark, [(None, None, None, None), (2, 1, "user", "b"), (2, 1, "user", "a"), (2, 1, "user", "a"), (2, None, "user", None)])
    assert [(t.role, t.text) for t in got[None].turns] == [("", "")]
    assert [t.text for t in got[2].turns] == ["", "a", "a", "b"]
    assert back(spark, []) == {}


def test_query_needs_no_python(spark):
    from ledgerlight.llm.queries import QUERIES

    df = QUERIES["op4_chat_format"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    text = "<|im_end|><|im_start|>assistant ok"
    row = df.where("conv_id = -1").first()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (row.n_turns, row.loss_chars) == (2, len(text))


@pytest.mark.parametrize("text", ["<" * 40000, "|" * 40000 + "<|im_end|>" * 4000])
def test_long_texts(spark, text):
    assert back(spark, [(1, 1, "assistant", text)])[1].loss_texts == [text]


def test_a_conversation_of_very_many_turns(spark):
    many = 50_000
    turns = spark.range(many).selectExpr(
        "1L AS conv_id", "id AS turn", "CASE WHEN id % 3 = 0 THEN 'user' ELSE 'assistant' END AS role", "concat('<| turn é🙂 ', id, repeat(' word', CAST(id % 20 AS INT))) AS text",
    )
    out = C.loss_texts(C.read_conversations(C.format_conversations(turns)))
    begun = time.time()
    row = out.first()
    assert time.time() - begun < 60  # a few seconds where nothing else runs
    texts = [f"<| turn é🙂 {i}{' word' * (i % 20)}" for i in range(many)]
    assert [t.text for t in row.turns] == texts
    assert row.loss_texts == [text for i, text in enumerate(texts) if i % 3]


@pytest.mark.parametrize("group, piece", [(1, 1), (2, 3), (3, 7), (128, 8192)])
def test_groups_and_pieces_do_not_show(spark, monkeypatch, group, piece):
    monkeypatch.setattr(C, "GROUP", group)
    monkeypatch.setattr(C, "PIECE", piece)
    rows = [(c, i, role, text) for c in range(5) for i, (role, text) in enumerate([("user", "aé"), ("assistant", ""), ("assistant", "x🙂yz<|"), ("user", None), ("assistant", "end")][:c + 1])]
    got = back(spark, rows)
    for c in range(5):
        assert got[c].loss_texts == ["", "x🙂yz<|", "end"][:[0, 1, 2, 2, 3][c]]
        assert [t.text for t in got[c].turns] == ["aé", "", "x🙂yz<|", "", "end"][:c + 1]
