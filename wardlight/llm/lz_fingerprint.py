"""Document fingerprints from Lempel-Ziv phrases, compared as minimum-hash signatures.

A text's UTF-8 bytes are parsed from left to right into phrases: each phrase is the shortest run
that is not in the text's dictionary yet, and joins it (LZ78). The set of phrases stands for
what a compressor has learned from the text. Each phrase has a content hash; the fingerprint is
the ``SIZE`` smallest hashes, so the share of common ones among the smallest of the union
estimates the Jaccard likeness of the phrase sets. Sets below ``SIZE`` are compared exactly.

Defined cases: NULL counts as empty. The empty text has the empty fingerprint, likeness 1 with
itself and 0 with any other. Equal texts have equal fingerprints. Texts are parsed whole. For
neighbours, rows are ordered by id, then text hash; NULL ids come last; a lone row is its own
neighbour; an empty table gives an empty result. Other columns are not passed on.

Neighbours are found without a global window: ids are cut into ranges at approximate quantiles
(a bounded list), each text is shuffled once to its range, and the first row of every range is
also sent to the range before it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import each_text, slices, small_batches, texts_of, whole_text

SIZE = 256
RANGES = 512  # id ranges at least; bounds the list of quantiles and of first rows
FACTOR, ROOT = 0x9E3779B97F4A7C15, 7


class Phrases:
    """The dictionary of a text so far: a trie from node and byte to node, in order of insertion.

    Nodes are multiples of 256, so that node and byte make one key; phrase i (from 1 on) is node 256 i.
    """

    __slots__ = ("trie", "node")

    def __init__(self, trie: dict[int, int] | None = None, node: int = 0):
        self.trie, self.node = trie or {}, node

    def copy(self) -> Phrases:
        return Phrases(self.trie.copy(), self.node)

    def read(self, data: bytes) -> Phrases:
        trie, node = self.trie, self.node
        find, new = trie.get, (len(trie) + 1) << 8
        for byte in data:
            after = find(node | byte)
            if after is None:
                trie[node | byte] = new
                new += 256
                node = 0
            else:
                node = after
        self.node = node
        return self

    def hashes(self) -> np.ndarray:
        """Content hash of each phrase: that of the phrase without its last byte, times FACTOR, plus the byte + 1.

        Every phrase starts as such a step from its parent; steps are joined with those of the
        ancestor until all start at the root, so the rounds are the logarithm of the longest phrase.
        """
        keys = np.fromiter(self.trie, np.int64, len(self.trie))
        ancestor = np.append(0, keys >> 8)
        add = np.append(0, (keys & 255) + 1).astype(np.uint64)
        times = np.full(len(add), FACTOR, np.uint64)
        times[0] = 1
        while ancestor.any():
            add += times * add[ancestor]
            times *= times[ancestor]
            ancestor = ancestor[ancestor]
        return (add + times * np.uint64(ROOT))[1:]

    def signature(self) -> np.ndarray:
        """The smallest phrase hashes, well mixed, as 32-bit numbers in order."""
        x = self.hashes()
        for shift, factor in ((31, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
        return np.unique((x >> np.uint64(32)).astype(np.uint32))[:SIZE]


def as_string(signature: np.ndarray) -> str:
    return base64.b64encode(signature.astype(">u4").tobytes()).decode()


def from_string(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard likeness of two phrase sets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    smallest = np.union1d(a, b)[:SIZE]
    return float(np.isin(smallest, a).__and__(np.isin(smallest, b)).sum() / len(smallest))


def fingerprint(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Arrow function: texts to fingerprint strings, for ``F.arrow_udf(fingerprint, 'string')``."""
    for column in texts:
        yield pa.array([as_string(Phrases().read(t.encode()).signature()) for t in each_text(column)], pa.string())


PAIRS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
PAIR_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [("near_edited", pa.float64()), ("near_next", pa.float64())]
)


class Document:
    """A text read once; the state at its middle serves the edited text too."""

    __slots__ = ("id", "n", "half", "head", "middle", "signature")

    def __init__(self, id: int | None, text: str):
        self.id, self.n, self.half = id, len(text), len(text) // 2
        self.head = text[: self.n - self.half].encode()
        whole = Phrases().read(self.head)
        self.middle = whole.copy()
        self.signature = whole.read(text[self.n - self.half :].encode()).signature()

    def beside(self, text: str, signature: np.ndarray) -> tuple:
        """Result row, given the next document."""
        tail = text[: self.half].encode()
        edited = self.middle.read(tail).signature()
        return (
            self.id,
            self.n,
            hashlib.sha256(self.head + tail).hexdigest(),
            as_string(self.signature),
            as_string(edited),
            likeness(self.signature, edited),
            likeness(self.signature, signature),
        )


def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (after, id, text) in order of range, ``after``, id: each row meets the next one.

    ``after`` marks the row that was sent along from the next range; it ends its range.
    """
    waiting: Document | None = None
    for batch in slices(batches):
        out = []
        rows = zip(batch["after"].to_pylist(), batch["id"].to_pylist(), texts_of(batch["text"]))
        for after, id, text in rows:
            if after and waiting is None:
                continue  # the same row once more
            here = Document(id, text)
            if waiting is not None:
                out.append(waiting.beside(text, here.signature))
            waiting = None if after else here
        if out:
            arrays = [pa.array(column, field.type) for column, field in zip(zip(*out), PAIR_SCHEMA)]
            yield pa.RecordBatch.from_arrays(arrays, schema=PAIR_SCHEMA)


def with_next(docs: DataFrame, id_col: str = "doc_id", ranges: int = RANGES) -> DataFrame:
    """Fingerprints of each text and its edited form, with their likeness and that to the next text.

    The edited text has its last half (rounded down) replaced by as many first characters of the
    next document, in order of id; the first document follows the last.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ranges = max(ranges, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text().alias("text"))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("id", shares, 20_000).alias("cuts")).first()["cuts"] or []
    cuts = np.unique(np.array(cuts, np.int64))

    @F.arrow_udf("int")
    def range_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ids in batches:
            place = np.searchsorted(cuts, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right")
            yield pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), len(cuts) + 1, place), pa.int32())

    placed = rows.select("id", "text", range_of("id").alias("range"), F.xxhash64("text").alias("hash"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("first")
    firsts = sorted(placed.groupBy("range").agg(first).collect(), key=lambda r: r["range"])
    sent = [(r["first"]["id"], r["first"]["hash"], firsts[i - 1]["range"]) for i, r in enumerate(firsts)]
    to = spark.createDataFrame(sent, "__id long, __hash long, __range int")
    along = placed.join(
        F.broadcast(to), F.col("id").eqNullSafe(F.col("__id")) & (F.col("hash") == F.col("__hash"))
    ).select("id", "text", F.col("__range").alias("range"), "hash", F.lit(1).alias("after"))
    ordered = (
        placed.withColumn("after", F.lit(0))
        .unionByName(along)
        .repartition("range")
        .sortWithinPartitions("range", "after", F.col("id").asc_nulls_last(), "hash")
    )
    return ordered.select("after", "id", "text").mapInArrow(walk, PAIRS)
