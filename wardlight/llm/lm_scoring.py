"""Stupid-backoff scores of documents, by joins of n-gram counts with the n-grams of blocks of documents.

Words are what ASCII white space separates, with A-Z lower-cased. An n-gram of any order, the
empty one included (its count is the number of all words), is known by a 64-bit hash.

1. Rows are dealt into blocks of about ``BLOCK_BYTES`` of text, each shuffled once to its block.
2. A block counts its n-grams of all orders and sends every distinct one, with its count, to the
   part of the count table that its hash names. This is one exchange for all orders, combined
   before it: an n-gram that every document holds is one row a block.
3. A part adds the counts up and answers each block with the totals, in the order it asked, so
   that answers carry no hashes.
4. A block meets its answers (a co-grouped join with the same exchange of texts), takes each
   document's own occurrences off, so that no document vouches for itself, and sums per document:

    S(w | context) = count(context w) / count(context)   if the n-gram occurs in other documents,
                     0.4 * S(w | shorter context)        otherwise;
    S(w)           = count(w) / all words                (0.5 stands for a count of 0).

The result is the sum of logarithms over the words after the first, and its mean;
``first_word=True`` scores the first word too, by its share of all words.

Defined cases: every row is a document of its own; rows that share an id, or have none, are scored
apart and count for each other. NULL, empty and (without ``first_word``) one-word texts have no
scored words, sum 0 and mean NULL. Texts are read whole, a longer one than a block in one piece.
Other columns play no part. An empty table gives an empty result.

Nothing depends on the order of rows within a block or a part, so a task that runs again gives
the same answer. Blocks are dealt by a hash of id and text: only rows alike in both always share one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import ROWS_PER_SLICE, whole_text

ORDER = 2  # longest n-gram
BACKOFF = 0.4
NONE_SEEN = 0.5  # stands for a count of 0, so that its logarithm exists
BLOCK_BYTES = 8 << 20
EMPTY = np.uint64(0)  # hash of the empty n-gram; no other has it
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)

ASKED = "part int, block int, keys binary, counts binary"
ASKED_SCHEMA = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
ANSWER = "part int, block int, totals binary"
ANSWER_SCHEMA = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("totals", pa.binary())])


def packed(counts: np.ndarray) -> bytes:
    """Counts as bytes, all lowest ones first: small numbers leave runs of zeros to the compression."""
    return counts.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()


class Block:
    """The n-grams of some texts: per word its document, place and, for each order, the n-gram that ends there."""

    def __init__(self, texts: Iterator[bytes], order: int):
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        parts, sizes = [], []
        for text in texts:
            words = text.lower().split()  # of bytes: A-Z and ASCII white space only
            sizes.append(len(words))
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        words = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), np.uint64, len(numbers))
        self.sizes = np.array(sizes, np.int64)
        self.document = np.repeat(np.arange(len(sizes)), self.sizes)
        self.place = np.arange(len(words)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.keys = [np.maximum(hashes, 1)[words]]
        for k in range(2, order + 1):
            longer = np.zeros(len(words), np.uint64)
            x = self.keys[-1][:-1] * STEP + self.keys[0][1:] + np.uint64(k)
            x = (x ^ (x >> np.uint64(31))) * MIX
            longer[1:] = np.maximum(x ^ (x >> np.uint64(29)), 1)
            self.keys.append(longer)

    def ends(self, k: int) -> np.ndarray:
        """Where an n-gram of ``k`` words ends."""
        return np.flatnonzero(self.place >= k - 1)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """All n-grams of the block in order of hash, the empty one first, and their counts."""
        every = [keys[self.ends(k)] for k, keys in enumerate(self.keys, 1)]
        keys, counts = np.unique(np.concatenate(every), return_counts=True)
        return np.append(EMPTY, keys), np.append(self.sizes.sum(), counts)

    def elsewhere(self, k: int, keys: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """Per word, how often the n-gram of ``k`` words that ends there occurs in other documents."""
        ends = self.ends(k)
        which = np.searchsorted(keys, self.keys[k - 1][ends])
        _, mine, own = np.unique(self.document[ends] * len(keys) + which, return_inverse=True, return_counts=True)
        out = np.zeros(len(self.place), np.int64)
        out[ends] = totals[which] - own[mine]
        return out

    def scores(self, totals: np.ndarray, first_word: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per document: words scored, words backed off, sum of logarithms."""
        keys, _ = self.distinct()
        if len(keys) != len(totals):
            raise ValueError("a block and its answers do not belong together")
        logs, backs = np.zeros(len(self.place)), np.zeros(len(self.place), np.int64)
        todo = self.place >= (0 if first_word else 1)
        scored = todo.copy()
        counts = self.elsewhere(len(self.keys), keys, totals)
        for k in range(len(self.keys), 1, -1):
            shorter = self.elsewhere(k - 1, keys, totals)
            asked = todo & (self.place >= k - 1)
            seen = np.flatnonzero(asked & (counts > 0))
            logs[seen] = np.log(counts[seen]) - np.log(np.maximum(shorter[seen - 1], NONE_SEEN))
            todo[seen] = False
            backs += asked & todo
            counts = shorter
        left = np.flatnonzero(todo)
        others = np.maximum(totals[0] - self.sizes, 1)[self.document[left]]
        logs[left] = np.log(np.maximum(counts[left], NONE_SEEN)) - np.log(others)
        logs += backs * np.log(BACKOFF)
        n = len(self.sizes)
        return tuple(
            np.bincount(self.document[scored], values[scored], n).astype(kind)
            for values, kind in ((np.ones(len(logs)), int), (backs > 0, int), (logs, float))
        )


def block_of(rows: pa.Table, order: int) -> Block:
    column = rows["text"].cast(pa.large_binary())
    pieces = (column.slice(at, ROWS_PER_SLICE) for at in range(0, len(column), ROWS_PER_SLICE))
    return Block((text for piece in pieces for text in piece.to_pylist()), order)


def score(
    docs: DataFrame, id_col: str = "doc_id", order: int = ORDER, first_word: bool = False, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per row: ``id``, n_words, n_scored, n_backed_off, log_score and mean_log_score."""
    rows = docs.select(F.col(id_col).alias("id"), whole_text().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = size // block_bytes + 1
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int")
    placed = rows.withColumn("block", block).repartition(blocks, "block")

    def ask(rows: pa.Table) -> pa.Table:
        keys, counts = block_of(rows, order).distinct()
        part = ((keys >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
        cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(keys))
        spans = [slice(a, b) for a, b in zip(cuts, cuts[1:])]
        columns = (
            part[cuts[:-1]].astype(np.int32),
            np.full(len(spans), rows["block"][0].as_py(), np.int32),
            [keys[s].tobytes() for s in spans],
            [packed(counts[s]) for s in spans],
        )
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ASKED_SCHEMA)], schema=ASKED_SCHEMA)

    def answer(asked: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k.as_buffer(), np.uint64) for k in asked["keys"]]
        counts = np.concatenate([unpacked(c.as_buffer()) for c in asked["counts"]])
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.zeros(which.max() + 1, np.int64)
        np.add.at(totals, which, counts)
        pieces = np.split(totals[which], np.cumsum([len(k) for k in keys])[:-1])
        columns = [asked["part"], asked["block"], pa.chunked_array([[packed(t) for t in pieces]], pa.binary())]
        return pa.Table.from_arrays(columns, schema=ANSWER_SCHEMA)

    def meet(rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = block_of(rows, order)
        totals = [unpacked(t.as_buffer()) for t in answers.sort_by("part")["totals"]]
        scored, backed, logs = block.scores(np.concatenate(totals), first_word)
        return pa.table(
            {
                "id": rows["id"],
                "n_words": block.sizes,
                "n_scored": scored,
                "n_backed_off": backed,
                "log_score": logs,
            }
        )

    asked = placed.groupBy("block").applyInArrow(ask, ASKED)
    answers = asked.repartition(blocks, "part").groupBy("part").applyInArrow(answer, ANSWER)
    id_type = rows.schema["id"].dataType.simpleString()
    scores = placed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        meet, f"id {id_type}, n_words bigint, n_scored bigint, n_backed_off bigint, log_score double"
    )
    return scores.withColumn("mean_log_score", F.when(F.col("n_scored") > 0, F.col("log_score") / F.col("n_scored")))
