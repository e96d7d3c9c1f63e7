"""Byte-level BPE: a sentencepiece model written from a rank file, encoding and decoding of whole texts.

The model is serialised by hand from the vocabulary: every token's bytes are mapped to printable characters, one
character a byte, the score of a piece is its negative rank, and nothing is normalised. Merging by highest score is
then merging by lowest rank. Texts are cut by a pre-token pattern and each match is encoded alone.

Defined cases: a null or empty text has no ids and decodes to no bytes; every other text, of any length, is encoded whole
and block by block; repeated rows give repeated results; rows are neither merged nor reordered. Other columns keep their values, but
one that has the name of a result (in any case) is replaced by it; the names of the results are parameters.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlight.llm.common import replaced, slices, tidy

#: Texts that are held as Python objects at once, in bytes; longer ones are encoded in pieces of BLOCK_CHARS.
SLICE_BYTES = 2 << 20
BLOCK_CHARS = 4 << 20
#: Encoded words that a Python worker remembers; the memory is emptied when it is full.
REMEMBERED = 250_000
#: A rank file larger than this isn't broadcast.
MAX_MODEL_BYTES = 64 << 20


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it has a visible one, else one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def parse_ranks(lines: Iterable[str]) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ... without a gap")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"single bytes without a rank: {missing[:5]}")
    return ranks


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The rank file at a path that Spark, or else the driver alone, can open."""
    try:
        with open(path, encoding="ascii") as lines:
            return parse_ranks(lines)
    except FileNotFoundError:
        return parse_ranks(row.value for row in spark.read.text(path).toLocalIterator())


def _varint(value: int) -> bytes:
    out = bytearray()
    value &= (1 << 64) - 1
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def _field(number: int, value: bytes | float | int) -> bytes:
    """One protocol buffer field: bytes with their length, a float as 4 bytes, an int as varint."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece model whose piece ids are the ranks; one more piece is the unknown one."""
    characters = byte_characters()
    model = bytearray()
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        piece = "".join(characters[b] for b in token).encode()
        model += _field(1, _field(1, piece) + _field(2, -float(rank)) + _field(3, 1))
    model += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(ranks) + 1) + _field(40, len(ranks)) + b"".join(_field(n, -1) for n in (41, 42, 43))
    normalizer = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return bytes(model + _field(2, trainer) + _field(3, normalizer))


@dataclass(frozen=True)
class Vocabulary:
    """What the tasks need: the serialised model, the tokens' bytes by rank, the pre-token pattern."""

    model: bytes
    tokens: tuple[bytes, ...]
    pattern: str

    @staticmethod
    def of(ranks: dict[bytes, int], pattern: str) -> Vocabulary:
        return Vocabulary(sentencepiece_model(ranks), tuple(sorted(ranks, key=ranks.__getitem__)), pattern)


class Encoder:
    """Encodes texts to little-endian 32-bit ids and remembers words.

    A lone space between two characters that are no white space always begins a pre-token, so texts are cut there and
    what lies between is looked up whole. Texts with neighbouring white space are cut by the pattern.
    """

    def __init__(self, vocabulary: Vocabulary):
        import regex
        import sentencepiece

        self._processor = sentencepiece.SentencePieceProcessor(model_proto=vocabulary.model)
        self._pretokens = regex.compile(vocabulary.pattern)
        self._double_space = regex.compile(r"\s\s")
        self._map = {b: c for b, c in enumerate(byte_characters())}
        self._whole = {token: rank for rank, token in enumerate(vocabulary.tokens)}
        self._known: dict[str, bytes] = {}

    def _encode_pretokens(self, pretokens: list[str]) -> list[bytes]:
        """The packed ids of each pre-token: its own rank if it is a token, else what merging gives."""
        raw = [pretoken.encode() for pretoken in pretokens]
        ranks = list(map(self._whole.get, raw))
        mapped = [r.decode("latin-1").translate(self._map) for r, rank in zip(raw, ranks) if rank is None]
        merged = iter(self._processor.encode(mapped, out_type=int, num_threads=1) if mapped else [])
        return [next(merged) if rank is None else (rank,) for rank in ranks]

    def _learn(self, words: Iterable[str]) -> None:
        known, words = self._known, set(words)
        new = [word for word in words if word not in known]
        if not new:
            return
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(words)
        split = list(map(self._pretokens.findall, new))
        encoded = self._encode_pretokens(list(chain.from_iterable(split)))
        at = 0
        for word, pretokens in zip(new, split):
            n = len(pretokens)
            ids = encoded[at] if n == 1 else list(chain.from_iterable(encoded[at:at + n]))
            known[word] = struct.pack(f"<{len(ids)}I", *ids)
            at += n

    def _blocks(self, text: str) -> Iterator[list[str]]:
        """The words of a text, a bounded number of characters at a time."""
        if self._double_space.search(text):
            block, held = [], 0
            for match in self._pretokens.finditer(text):
                block.append(match.group())
                held += len(block[-1])
                if held >= BLOCK_CHARS:
                    yield block
                    block, held = [], 0
            yield block
            return
        begin = 0
        while begin < len(text):
            end = text.find(" ", begin + BLOCK_CHARS)
            words = text[begin:end if end >= 0 else len(text)].split(" ")
            words[1:] = [" " + word for word in words[1:]]
            yield words
            begin = end if end >= 0 else len(text)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text. New words of neighbouring texts are learned together."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def settle() -> None:
            self._learn(chain.from_iterable(words for _, words in waiting))
            for i, words in waiting:
                out[i].append(b"".join(map(self._known.__getitem__, words)))

        for i, text in enumerate(texts):
            for words in self._blocks(text):
                for begin in range(0, len(words), REMEMBERED):
                    some = words[begin:begin + REMEMBERED]
                    if held + len(some) > REMEMBERED:
                        settle()
                        waiting, held = [], 0
                    waiting.append((i, some))
                    held += len(some)
        settle()
        return list(map(b"".join, out))


def _shared(df: DataFrame, vocabulary: Vocabulary):
    if len(vocabulary.model) > MAX_MODEL_BYTES:
        raise ValueError("the vocabulary is too large to broadcast")
    return df.sparkSession.sparkContext.broadcast(vocabulary)


def text_of(ids: bytes, tokens: tuple[bytes, ...]) -> bytes:
    """The bytes that packed ids stand for."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(
    df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", count: str = "n_tokens", keep: bool = True, decoded: str | None = None,
) -> DataFrame:
    """Add the ids of each whole text (binary, unsigned little-endian 32-bit) and their number.

    ``keep=False`` leaves the text itself out; ``decoded`` names a further column for the bytes that the ids decode to, for
    checks in the same pass. No shuffle: rows stay in their partitions.
    """
    shared = _shared(df, vocabulary)
    added = [T.StructField(count, T.LongType()), T.StructField(ids, T.BinaryType())] + ([T.StructField(decoded, T.BinaryType())] if decoded else [])
    schema = replaced(df if keep else df.drop(text), added)
    kept = schema.fieldNames()[:-len(added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tokens = Encoder(shared.value), shared.value.tokens
        for batch in batches:
            for rows, texts in slices(batch, text, SLICE_BYTES):
                out = encoder.encode_all([raw.as_py().decode("utf-8", "replace") for raw in texts])
                columns = [*(rows.column(name) for name in kept), pa.array([len(x) // 4 for x in out], pa.int64()), pa.array(out, pa.binary())]
                if decoded:
                    columns.append(pa.array([text_of(x, tokens) for x in out], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return df.mapInArrow(tidy(run), schema)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "decoded", keep: bool = True) -> DataFrame:
    """Add the bytes that the packed ids stand for. An id outside the vocabulary is an error."""
    shared = _shared(df, vocabulary)
    schema = replaced(df if keep else df.drop(ids), [T.StructField(out, T.BinaryType())])
    kept = schema.fieldNames()[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value.tokens
        for batch in batches:
            for rows, column in slices(batch, ids, SLICE_BYTES):
                texts = [text_of(x.as_py(), tokens) for x in column]
                yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in kept), pa.array(texts, pa.binary())], [*kept, out])

    return df.mapInArrow(tidy(run), schema)
