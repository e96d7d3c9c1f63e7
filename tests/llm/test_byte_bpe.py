import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerlight.llm import byte_bpe
from ledgerlight.llm import queries as Q

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary(spark):
    return Q.bpe_vocabulary(spark)


TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b\n\nc\t", "it's 12 o'clock <|endoftext|> <unk> <s>", "naïve Übermaß ñandú 東京 🙂🙂  x y",
    "\x00\x01\x1c\x1d\x85 \x1f", "A" * 5000, "ab" * 3000 + " " + "!" * 4000, "\n" * 700 + " " * 700, "▁x ▁ Ġx Ċ", "word " * 9000, "́́ é",
]


def ids_of(rows):
    return {row.doc_id: np.frombuffer(row.ids, "<u4").tolist() for row in rows}


def test_ids_equal_the_library_and_decode_to_the_text(spark, reference, vocabulary):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    encoded = byte_bpe.encode(docs, vocabulary, keep=False)
    rows = byte_bpe.decode(encoded, vocabulary).collect()
    for row in rows:
        text = TEXTS[row.doc_id] or ""
        assert np.frombuffer(row.ids, "<u4").tolist() == reference.encode_ordinary(text), text[:40]
        assert row.n_tokens == len(row.ids) // 4
        assert bytes(row.decoded) == text.encode()


def test_blocks_of_a_long_text_and_a_full_memory_change_nothing(reference, vocabulary, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_CHARS", 50)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 7)
    encoder = byte_bpe.Encoder(vocabulary)
    for text in [t for t in TEXTS if t] + ["one two three four five six seven eight nine ten " * 30, "a  b " * 80]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_whole_table_against_the_library(spark, reference):
    folder = "/root/testdata/sf0.001"
    got = {row.doc_id: row for row in Q.QUERIES["op1_byte_bpe"](spark, folder).collect()}
    docs = Q.table(spark, folder, "documents").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids = np.array(reference.encode_ordinary(doc.text or ""), "<u4").tobytes()
        assert got[doc.doc_id].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert got[doc.doc_id].decoded_sha256 == hashlib.sha256((doc.text or "").encode()).hexdigest()


def test_empty_table_repeated_rows_and_other_columns(spark, vocabulary):
    schema = "doc_id long, text string, model string, n string"
    assert byte_bpe.encode(spark.createDataFrame([], schema), vocabulary).collect() == []
    twice = spark.createDataFrame([(1, "a b", None, "x"), (1, "a b", None, "x"), (None, None, None, None)], schema)
    assert sorted(len(row.ids) for row in byte_bpe.encode(twice, vocabulary).collect()) == [0, 8, 8]
    clash = byte_bpe.encode(twice.withColumn("IDS", F.lit(1)).withColumn("n_tokens", F.lit("x")), vocabulary)
    assert clash.columns == ["doc_id", "text", "model", "n", "n_tokens", "ids"] and max(row.n_tokens for row in clash.collect()) == 2
    with pytest.raises(ValueError):
        byte_bpe.parse_ranks(["YQ== 0"])
