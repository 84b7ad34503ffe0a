"""Byte-level BPE: a rank vocabulary as a sentencepiece model.

The vocabulary (token bytes and ranks, as in a ``.tiktoken`` file) is written straight into the
wire format of a sentencepiece BPE model: every byte becomes one character (U+0100 + byte), every
token one piece with the score ``-rank``, normalisation is the identity, and no space is added,
removed or escaped. Merging by the highest score, leftmost first, is then merging by the lowest
rank. Text is cut into pre-tokens by the vocabulary's pattern, and each distinct pre-token is
encoded once per cache filling; decoding maps ids back to the bytes of their tokens.

Null text counts as empty: no ids, empty bytes. Repeated rows give repeated results, an empty
table an empty result; other columns of the input are dropped unless named in ``keep``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from versus.llm import arrays
from versus.llm.common import table

CACHE = 400_000  # distinct pre-tokens kept by a worker; beyond that the cache starts anew

# The characters of Unicode's White_Space property, as the inside of a class.
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: float | bytes) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def _mapped(token: bytes) -> str:
    return "".join(chr(0x100 + b) for b in token)


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, in the order of their ranks, which must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [ranks[i] for i in range(len(ranks))]


def model_bytes(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model; token i is piece i, the unknown piece comes last."""
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = _field(1, _mapped(token).encode()) + _field(2, float(-rank)) + _field(3, 1)
        out += _field(1, piece)
    out += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    # model_type BPE, vocab_size, hard_vocab_limit off, unk_id, no bos, eos, pad
    none = (1 << 64) - 1
    out += _field(
        2,
        _field(3, 2) + _field(4, len(tokens) + 1) + _field(33, 0)
        + _field(40, len(tokens)) + _field(41, none) + _field(42, none) + _field(43, none),
    )
    # name, no charsmap, no dummy prefix, spaces neither removed nor escaped
    out += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(out)


def _spaces_written_out(pattern: str) -> str:
    """White space as a written-out class: libraries differ on U+001C to U+001F."""
    pattern = pattern.replace(r"[^\s", f"[^{_SPACE}")
    return pattern.replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")


def _latin_pattern(pattern: str) -> str:
    """The same pattern for texts of characters below U+0100, in the syntax of ``re``."""
    import regex

    chars = [chr(i) for i in range(256)]
    letters, numbers = (
        "".join(re.escape(c) for c in chars if regex.match(rf"\p{{{name}}}", c)) for name in "LN"
    )
    pattern = _spaces_written_out(pattern)
    pattern = pattern.replace(r"\p{L}\p{N}]", f"{letters}{numbers}]")
    return pattern.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")


class PreTokenEncoder:
    """Encodes texts pre-token by pre-token, remembering the ids of those seen before.

    ``encode_new`` turns distinct pre-tokens into lists of ids. At most ``cache`` pre-tokens are
    remembered; then the first learned quarter, which holds the frequent ones, is kept.
    """

    def __init__(self, pattern: str, encode_new: Callable[[list[str]], list[list[int]]],
                 cache: int = CACHE):
        import regex

        self.find = regex.compile(_spaces_written_out(pattern)).findall
        self.find_latin = re.compile(_latin_pattern(pattern)).findall
        self.encode_new = encode_new
        self.limit = cache
        self.cache: dict[str, bytes] = {}

    def _learn(self, needed: set[str]) -> None:
        new = list(needed.difference(self.cache))
        if len(self.cache) + len(new) > self.limit:
            self.cache = dict(islice(self.cache.items(), self.limit // 4))
            new = list(needed.difference(self.cache))
        for part, ids in zip(new, self.encode_new(new) if new else (), strict=True):
            self.cache[part] = struct.pack(f"<{len(ids)}I", *ids)

    def _split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
            return self.find_latin(text)
        except UnicodeEncodeError:
            return self.find(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        parts = [self._split(text) for text in texts]
        self._learn(set(chain.from_iterable(parts)))
        known = self.cache.__getitem__
        return [b"".join(map(known, p)) for p in parts]


class Codec(PreTokenEncoder):
    """Encodes and decodes texts with the sentencepiece form of a rank vocabulary."""

    def __init__(self, tokens: list[bytes], pattern: str, cache: int = CACHE):
        import sentencepiece

        super().__init__(pattern, self._encode_new, cache)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(tokens))
        self.unknown = len(tokens)
        lengths = np.array([len(t) for t in tokens], np.int64)
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def _encode_new(self, parts: list[str]) -> list[list[int]]:
        # 0xFF is in no UTF-8 text: it separates the pre-tokens while all bytes are mapped at once.
        joined = np.frombuffer(b"\xff".join(p.encode() for p in parts), np.uint8)
        mapped = (joined.astype("<u2") + np.uint16(0x100)).tobytes().decode("utf-16-le")
        found = self.pieces.encode(mapped.split("\u01ff"), num_threads=1)
        if any(self.unknown in ids for ids in found):
            raise ValueError("the vocabulary lacks a byte of the text")
        return found

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the tokens, one after the other."""
        ids = np.frombuffer(ids, "<u4")
        n = self.lengths[ids]
        ends = np.cumsum(n)
        if not len(ids):
            return b""
        return self.bytes[np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends + n, n)].tobytes()


_codecs: dict[tuple, Codec] = {}  # by worker process: the cache lives on between tasks


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(read_ranks(path), pattern)
    return _codecs[path, pattern]


_SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id, the number of ids and the digests of the ids and of
    the bytes decoded from them; with ``with_ids`` also the ids (binary) and the decoded bytes.

    No shuffle: the vocabulary (fixed, about 1 MB) travels as a file of the session.
    """
    spark = docs.sparkSession
    name = _send(spark, vocabulary)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, {_SCHEMA}" + (
        ", ids binary, decoded binary" if with_ids else ""
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(SparkFiles.get(name), pattern)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for start, stop in arrays.slices(batch.column(1), 2 << 20):
                texts = batch.column(1).slice(start, stop - start).to_pylist()
                for ids in coder.encode([text or "" for text in texts]):
                    back = coder.decode(ids)
                    found = (len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                             hashlib.sha256(back).hexdigest(), ids, back)
                    for column, value in zip(rows if with_ids else rows[:3], found, strict=False):
                        column.append(value)
            columns = [
                batch.column(0),
                pa.array(rows[0], pa.int64()),
                pa.array(rows[1], pa.string()),
                pa.array(rows[2], pa.string()),
            ]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array(rows[3], pa.binary()), pa.array(rows[4], pa.binary())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _send(spark: SparkSession, path: str) -> str:
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
