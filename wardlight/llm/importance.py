"""Target-distribution importance resampling over hashed n-grams.

Features of a text are its runs of ``low`` to ``high`` consecutive words, joined by one space; a
feature's bucket is its CRC-32 modulo ``BUCKETS``. A bucket's gain is the log ratio of its share in
the target texts to its share in the documents, a document's weight the mean gain of its features.
With a Gumbel number from a seeded digest added, the highest scores are a draw without replacement
in proportion to the weights.

CRCs of substrings: each text, its words joined by one space, is scanned once, and the running CRC
is stored at every start and end of a word. CRC-32 is linear over GF(2): the running CRC at the end
of an n-gram is that at its start, moved over as many zero bytes as the n-gram has, XORed with the
n-gram's own CRC. So ``end ^ moved(start, length)`` is the CRC of any n-gram, whatever its length;
moving is four table look-ups for lengths below 256 and four more per further binary digit.

Counts are added up per task and then per bucket, so the shuffle has a row per task and bucket; the
gains, one number per bucket, are the only thing broadcast. The draw: scores are whole numbers, so a
histogram gives the least score that can be drawn; only rows from there on are sorted, by range, and
numbered by their place in their range.

Defined cases: NULL and empty texts have no words, no features and weight 0. A NULL id is the empty
string in the digest and comes after all others in ties. Repeated rows are drawn and ranked one by
one. An empty table gives an empty result, and an empty target gains from the smoothing alone. No
other columns are passed on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlight.llm.common import cut_lineage, each_text, small_batches, texts_of, whole_text
from wardlight.llm.common import slices as row_slices
from wardlight.llm.decontaminate import words_of
from wardlight.llm.fill_middle import seeded_numbers

LOW, HIGH = 1, 1
BUCKETS = 10_000
SEED = "2024"
LEAST_WORDS = 20
PERCENT = 10
POLYNOMIAL = 0xEDB88320
NEAR = 256  # lengths with a table of their own


def _byte_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(POLYNOMIAL), c >> 1).astype(np.uint32)
    return c


class Shifts:
    """Moves CRCs over zero bytes: a linear map, so four tables of 256 values per length."""

    def __init__(self):
        step = _byte_table()
        tables = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
        at = np.stack(tables)
        near = [at]
        for _ in range(NEAR):
            at = step[at & 255] ^ (at >> np.uint32(8))
            near.append(at)
        self.near = np.stack(near[:NEAR])
        self.far = [near[NEAR]]  # by NEAR, 2 * NEAR, 4 * NEAR, ...

    def moved(self, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        parts = [(crcs >> np.uint32(8 * k)) & np.uint32(255) for k in range(4)]
        rest = lengths % NEAR
        out = self.near[rest, 0, parts[0]]
        for k in (1, 2, 3):
            out ^= self.near[rest, k, parts[k]]
        many, j = lengths // NEAR, 0
        while many.any():
            if j == len(self.far):
                self.far.append(_through(self.far[-1], self.far[-1]))
            odd = np.flatnonzero(many & 1)
            out[odd] = _through(self.far[j], out[odd])
            many, j = many >> 1, j + 1
        return out


def _through(table: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    out = table[0][crcs & 255]
    for k in (1, 2, 3):
        out = out ^ table[k][(crcs >> np.uint32(8 * k)) & np.uint32(255)]
    return out


_SHIFTS: list[Shifts] = []


def _shifts() -> Shifts:
    if not _SHIFTS:
        _SHIFTS.append(Shifts())
    return _SHIFTS[0]


def ngram_crcs(texts: list[str], low: int = LOW, high: int = HIGH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRCs of all n-grams of some texts, the number of n-grams of each text, and its words."""
    starts, ends, sizes, counts = [], [], [], []
    for text in texts:
        words = words_of(text)
        crc = 0
        for w in words:
            starts.append(crc)
            crc = crc32(w, crc)
            ends.append(crc)
            crc = crc32(b" ", crc)
        sizes += map(len, words)
        counts.append(len(words))
    start, end = np.array(starts, np.uint32), np.array(ends, np.uint32)
    n_words, after = np.array(counts, np.int64), np.cumsum(np.array(sizes, np.int64) + 1)
    before = after - np.array(sizes, np.int64) - 1  # offsets of words, each with one separator
    of = np.repeat(np.arange(len(texts)), n_words)
    found, owner = [], []
    for n in range(low, high + 1):
        first = np.arange(max(0, len(of) - n + 1))
        first = first[of[first] == of[first + n - 1]]
        last = first + n - 1
        found.append(end[last] ^ _shifts().moved(start[first], after[last] - 1 - before[first]))
        owner.append(of[first])
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order], np.bincount(owners, minlength=len(texts)), n_words


def bucket_counts(df: DataFrame, low: int = LOW, high: int = HIGH, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)`` over all features of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in row_slices(batches):
            crcs, _, _ = ngram_crcs(texts_of(batch.column(0)), low, high)
            total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], ["bucket", "n"])

    small_batches(df.sparkSession)
    parts = df.select(whole_text().alias("text")).mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, low: int = LOW, high: int = HIGH, buckets: int = BUCKETS) -> np.ndarray:
    """A whole number per bucket: a thousand times the log ratio of smoothed shares, floored."""
    tables = []
    for df in (docs, target):
        table = np.zeros(buckets, np.int64)
        for r in bucket_counts(df, low, high, buckets).collect():  # at most a row per bucket
            table[r.bucket] = r.n
        tables.append(table.tolist())
    raw, wanted = tables
    s_all, t_all = float(sum(raw) + buckets), float(sum(wanted) + buckets)
    ratios = ((t + 1) * s_all / ((s + 1) * t_all) for s, t in zip(raw, wanted))
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def weigh(text: Column, gain: np.ndarray, low: int = LOW, high: int = HIGH) -> Column:
    """``struct<n_words, n_features, weight>``; the weight is the floored mean of the gains."""

    @F.arrow_udf("struct<n_words: long, n_features: long, weight: long>")
    def weights(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            for part in row_slices([pa.RecordBatch.from_arrays([texts], ["text"])]):
                crcs, n, words = ngram_crcs(texts_of(part.column(0)), low, high)
                upto = np.append(0, np.cumsum(gain[crcs % np.uint32(len(gain))]))
                last = np.cumsum(n)
                sums = upto[last] - upto[last - n]
                rows.append((words, n, np.floor_divide(sums, np.maximum(n, 1))))
            columns = [np.concatenate(x) for x in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 3
            yield pa.StructArray.from_arrays(
                [pa.array(x, pa.int64()) for x in columns], ["n_words", "n_features", "weight"]
            )

    return weights(text)


def gumbel(h: Column) -> Column:
    """A thousand times a Gumbel number, floored, from 32 uniform bits."""
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def draw(scored: DataFrame, eligible: Column, percent: int = PERCENT) -> DataFrame:
    """Rows with ``rank`` 1, 2, .. by score and then id among the drawn, else NULL.

    ``scored`` is a written table of doc_id and score (and more). So many per cent of the eligible
    rows, rounded down, are drawn.
    """
    fit = scored.filter(eligible)
    # A score is a mean log ratio plus a Gumbel number of 32 bits, in thousandths: some 100,000 values at most.
    histogram = fit.groupBy("score").agg(F.count(F.lit(1)).alias("n")).toArrow().to_pydict()
    scores, n = np.array(histogram["score"], np.int64), np.array(histogram["n"], np.int64)
    wanted = int(n.sum()) * percent // 100
    order = np.argsort(-scores)
    reached = np.flatnonzero(np.cumsum(n[order]) >= wanted)
    least = int(scores[order][reached[0]]) if wanted else None
    none = F.lit(None).cast("long")
    if least is None:
        return scored.withColumn("rank", none)
    near = F.coalesce(eligible & (F.col("score") >= least), F.lit(False))
    salt = F.xxhash64(F.monotonically_increasing_id())  # rows alike in score and id may be many
    by = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("__salt")]
    ordered = scored.filter(near).withColumn("__salt", salt).repartitionByRange(*by).sortWithinPartitions(*by)
    placed = cut_lineage(ordered.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)  # the id holds the partition and, in 33 bits, the place within it
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))  # a row per partition
    upto = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__before"))
    rank = F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1
    drawn = (
        placed.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")
        .select(*scored.columns, F.when(rank <= wanted, rank).cast("long").alias("rank"))
    )
    return drawn.unionByName(scored.filter(~near).withColumn("rank", none))


def resample(
    docs: DataFrame,
    target: DataFrame,
    low: int = LOW,
    high: int = HIGH,
    buckets: int = BUCKETS,
    seed: str = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (NULL if not drawn) of every document."""
    small_batches(docs.sparkSession)
    gain = gains(docs, target, low, high, buckets)
    (h,) = seeded_numbers(F.col("doc_id"), seed, 1)
    rows = docs.select("doc_id", h.alias("__h"), weigh(whole_text(), gain, low, high).alias("__w"))
    scored = rows.select(
        "doc_id",
        *(F.col(f"__w.{c}").alias(c) for c in ("n_words", "n_features", "weight")),
        (F.col("__w.weight") + gumbel(F.col("__h"))).alias("score"),
    )
    return draw(cut_lineage(scored), F.col("n_words") >= least_words, percent)
