"""Byte-level BPE: encode in linear time by backtracking over longest matches, and decode.

A text is cut into pieces by the tokenizer's pattern. A piece that is a token is that token.
Any other piece is read as Latin-1, so that one character is one byte, and an Aho-Corasick
automaton over all tokens gives the longest token that starts at each byte. From left to right
the longest one is tried, then its shorter prefixes; a token may follow another only if the two,
merged by rank on their own, stay these two tokens. When nothing fits, the last token is taken
back and its end is marked as a dead end. A merge across a border depends on the two tokens at
that border alone, so a sequence whose neighbours all agree is the one that merging by rank
gives; each byte position dies at most once, hence linear time. Whether two tokens agree is
found once, by undoing their merges at the border, and is kept.

Defined cases: NULL counts as empty and gives no tokens. Special tokens are ordinary text. Texts
of any length are encoded whole. Other columns of the table stay as they are, in Spark.

The ranks file is read on the driver from a path the caller gives and sent to the executors; its
size is that of a vocabulary (below 1 MB here), whatever the data.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from wardlight.llm.common import each_text, small_batches

#: Bounds of the memos of one worker, in entries.
PIECES_KEPT = 250_000
PAIRS_KEPT = 300_000


class _Pieces(dict):
    """Piece -> packed ids; what was used lately is kept, in two generations."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = self.encode(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= 64:
            if len(self) >= PIECES_KEPT:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.sizes = [len(t) for t in self.tokens]
        self.split = regex.compile(pattern).findall
        self.matcher = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.matcher.add_word(token.decode("latin-1"), rank)
        self.matcher.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.shorter: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.packed = _Pieces(self.piece)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.packed.__getitem__, self.split(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))

    def piece(self, data: bytes) -> bytes:
        rank = self.ranks.get(data)
        ids = [rank] if rank is not None else self.backtrack(data)
        return struct.pack(f"<{len(ids)}I", *ids)

    def backtrack(self, data: bytes) -> list[int]:
        n, sizes, pairs, agrees = len(data), self.sizes, self.pairs, self.agrees
        longest = [0] * n
        for end, rank in self.matcher.iter(data.decode("latin-1")):
            longest[end - sizes[rank] + 1] = rank  # ends come in order, so the longest is the last
        open_at = bytearray(b"\x01") * (n + 1)
        ids, at, last, token = [], 0, -1, longest[0]
        while True:
            end = at + sizes[token]
            fits = open_at[end]
            if fits:
                key = last << 32 | token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= PAIRS_KEPT:
                        pairs.clear()
                    fits = pairs[key] = agrees(last, token)
            if fits:
                ids.append(token)
                if end == n:
                    return ids
                at, last, token = end, token, longest[end]
                continue
            token = self.prefix(token)
            if token < 0:
                open_at[at] = 0
                token = ids.pop()
                at -= sizes[token]
                last = ids[-1] if ids else -1

    def agrees(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both by rank leaves these two; -1 is the start of a piece.

        Merges are undone from the last one on, always the one of higher rank at the border. A
        pair across the border would have been merged if its rank came before the merge undone;
        of equal ranks the one further left comes first.
        """
        if self.parts(right) is None:
            return False
        before = 1 << 40
        while left >= 0:
            if self.ranks.get(self.tokens[left] + self.tokens[right], 1 << 40) < before:
                return False
            of_left = left if self.sizes[left] > 1 else -1
            of_right = right if self.sizes[right] > 1 else -1
            if of_left < 0 and of_right < 0:
                break
            if of_left > of_right:
                before, left = left, self.parts(left)[1]
            else:
                before, right = right + 1, self.parts(right)[0]
        return True

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens of the last merge; None if merging never gives this token."""
        if token not in self.halves:
            data = self.tokens[token]
            halves = self.merged(data, 2) if len(data) > 1 else [token, token]
            sound = len(halves) == 2 and (len(data) == 1 or self.ranks.get(data) == token)
            self.halves[token] = (halves[0], halves[1]) if sound else None
        return self.halves[token]

    def prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of this one, or -1."""
        known = self.shorter.get(token)
        if known is None:
            data = self.tokens[token]
            fits = (self.ranks[data[:k]] for k in range(len(data) - 1, 0, -1) if data[:k] in self.ranks)
            known = self.shorter[token] = next(fits, -1)
        return known

    def merged(self, data: bytes, until: int = 1) -> list[int]:
        """Merging by rank as defined, for the few bytes of a token, until so many are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > until:
            ranked = [(self.ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranked)
            if rank == 1 << 40:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]


_CODECS: dict[str, ByteBpe] = {}


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}


def codec(content: bytes, pattern: str) -> ByteBpe:
    """The codec of this worker for a ranks file; built once."""
    key = hashlib.sha256(content + pattern.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = ByteBpe(read_ranks(content), pattern)
    return _CODECS[key]


class Tokenizer:
    """Column functions for one vocabulary: ``encode``, ``decode``, ``round_trip`` and ``count``."""

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str):
        small_batches(spark)
        with open(ranks_path, "rb") as file:
            content = spark.sparkContext.broadcast(file.read())

        @F.arrow_udf("binary")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            bpe = codec(content.value, pattern)
            for texts in batches:
                yield pa.array([bpe.encode(t) for t in each_text(texts)], pa.binary())

        @F.arrow_udf("binary")
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            bpe = codec(content.value, pattern)
            for packed in batches:
                yield pa.array([bpe.decode(x or b"") for x in packed.to_pylist()], pa.binary())

        @F.arrow_udf("struct<ids: binary, decoded: binary>")
        def round_trip(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            bpe = codec(content.value, pattern)
            for texts in batches:
                ids = [bpe.encode(t) for t in each_text(texts)]
                columns = [pa.array(ids, pa.binary()), pa.array(map(bpe.decode, ids), pa.binary())]
                yield pa.StructArray.from_arrays(columns, ["ids", "decoded"])

        @F.arrow_udf("long")
        def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            bpe = codec(content.value, pattern)
            for texts in batches:
                yield pa.array([len(bpe.encode(t)) // 4 for t in each_text(texts)], pa.int64())

        self._encode, self._decode, self._round_trip, self._count = encode, decode, round_trip, count

    def encode(self, text: str | Column) -> Column:
        """Ids of a text, packed as little-endian unsigned 32-bit integers."""
        return self._encode(text)

    def decode(self, packed: str | Column) -> Column:
        """The bytes that the ids stand for."""
        return self._decode(packed)

    def round_trip(self, text: str | Column) -> Column:
        """A struct of the ids of a text and the bytes that these ids stand for, in one pass."""
        return self._round_trip(text)

    def count(self, text: str | Column) -> Column:
        """How many tokens a text has."""
        return self._count(text)


def public_tokenizer(spark: SparkSession, name: str = "byte_bpe_multi_50k.tiktoken") -> Tokenizer:
    """A public vocabulary by the name of its ranks file."""
    return Tokenizer(spark, public_tokenizers.path(name), public_tokenizers.PATTERN)
