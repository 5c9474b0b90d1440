"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are all words of the whole text, lower-cased, known by a 64-bit hash. None is chosen, dropped
or capped. A term's weight is

    (1 + log(count in the text)) * idf * (LEAST_SHARE + chi / (chi + HALF_CHI)),

with document frequencies counted over all documents and chi the chi-squared of the word's presence
against the label in the examples: a word that tells nothing about the label still counts, a word
that does counts up to some twenty times as much. A word that no sample row has cannot be shared
with an example; it counts towards the length of its vector as a word of document frequency 0.

Fitting takes a bounded sample of labelled texts (``TOXIC_ROWS`` and ``CLEAN_ROWS``, by hash order,
each distinct text once). Three in four become examples, the others calibrate.

The index keeps the examples in blocks of ``BLOCK`` similar ones and, per term, the largest
weight in each block that has it. The ``COMMON``
terms with most postings have these as a matrix, and what they add up to is a least cosine of every
example. With the maxima of all other terms added it bounds every block, and the blocks that can reach
the k-th best least cosine are scored. Where the other terms have about as many maxima as postings, their
postings are read at once. Both ways the k nearest are exact (of equally near ones the first in index
order count). Each votes for its label
with weight 1 / (distance + 0.05); the prior votes with a small weight, and a logistic curve, fitted on
the calibration rows weighted to the label shares of all labelled rows, turns the vote into a
probability. The neighbours are the evidence.

Defined cases: NULL counts as empty; a text without words, or without any word of an example, has
no neighbours and gets the probability of the prior's vote. Without labels of both kinds every
score is the share of label 1 (0 without labels). Labels that are NULL are left out; of several
labels for one id the largest counts. Of labelled rows with equal texts the largest label counts, with the
least id that has it. Repeated rows get equal scores. Other columns play no part;
only the text is an input of a score. An empty table gives an empty result.

Bounded by the sample: the words of TOXIC_ROWS + CLEAN_ROWS texts, of which the driver takes the distinct
hashes and the examples as term numbers and counts, and the broadcast model holds sparse vectors. The
calibration rows stay on the executors. Every document is read once to count and once to be scored, in blocks
of some texts whose words are counted by one sort.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlight.llm.common import cut_lineage, each_text, give_back_memory, small_batches, whole_text

TOXIC_ROWS, CLEAN_ROWS = 3_000, 6_000
SAMPLE_BUCKETS = 64  # in which the samples of all tasks are reduced first
LEAST_SHARE, HALF_CHI = 0.05, 50.0
NEIGHBOURS = 15
BLOCK = 32
COMMON = 512  # terms whose postings are a matrix
WORTH_BOUNDING = 3  # postings a block and term from which blocks are bounded before they are read
QUERIES = 128  # that multiply it at once
WORDS_KEPT = 200_000
BLOCK_TEXTS, BLOCK_CHARS = 256, 1_000_000  # of a block of texts that are counted at once
FEW = 16  # characters to blank one by one
PRIOR_WEIGHT = 0.5
FOLDS = 5  # fold 0 is held out, the last one calibrates

WORD = re.compile(r"[^\W\d_]+")
COUNTED = pa.struct({"hashes": pa.list_(pa.int64()), "counts": pa.list_(pa.int32())})
RESULT = "struct<score: double, evidence: array<struct<doc_id: bigint, similarity: double, toxic: int>>>"


def fold_of(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


#: Lower-cases A-Z and blanks all other ASCII characters but letters; bytes of longer characters stay.
LETTERS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
ASCII = bytes(range(128))


@lru_cache(1 << 16)
def is_letter(character: str) -> bool:
    return WORD.fullmatch(character) is not None


def words_of(text: str) -> list[bytes]:
    """What ``WORD`` finds in the lower-cased text, as UTF-8."""
    if text.isascii():
        return text.encode().translate(LETTERS).split()
    text = text.lower()
    raw = text.encode()
    others = [c for c in set(raw.translate(None, ASCII).decode()) if not is_letter(c)]
    if len(others) > FEW:
        return [word.encode() for word in WORD.findall(text)]
    for c in others:
        raw = raw.replace(c.encode(), b" ")
    return raw.translate(LETTERS).split()


def blocks_of(texts: Iterable[str]) -> Iterator[list[str]]:
    """The texts in lists of bounded length."""
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if len(block) == BLOCK_TEXTS or size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


class Numbers(dict):
    """Word -> a running number, and the hash of each; bounded memory, as numbers hold for one block of texts."""

    def __init__(self) -> None:
        self.fresh: list[bytes] = []
        self.hashes = np.zeros(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        self.fresh.append(word)
        return found

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the text, number of the word and count, for all distinct words of each text."""
        if len(self) >= WORDS_KEPT:
            self.clear()
            self.hashes = self.hashes[:0]
        words = [words_of(t) for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        numbers = np.fromiter(map(self.__getitem__, chain.from_iterable(words)), np.int64, sizes.sum())
        self.learn(np.fromiter(map(xxhash.xxh64_intdigest, self.fresh), np.uint64, len(self.fresh)))
        self.fresh.clear()
        keys, counts = np.unique(np.repeat(np.arange(len(words)) << 32, sizes) | numbers, return_counts=True)
        return keys >> 32, keys & 0xFFFFFFFF, counts

    def learn(self, hashes: np.ndarray) -> None:
        """Take up the hashes of the words that are new."""
        self.hashes = np.append(self.hashes, hashes)


class TermNumbers(Numbers):
    """The same with the term of each number among some sorted hashes (-1: none)."""

    def __init__(self, words: np.ndarray) -> None:
        super().__init__()
        self.words, self.terms = words, np.zeros(0, np.int32)

    def learn(self, hashes: np.ndarray) -> None:
        terms = np.full(len(hashes), -1, np.int32)
        at, known = places_in(self.words, hashes)
        terms[known] = at
        self.terms = np.append(self.terms[: len(self) - len(hashes)], terms)


@dataclass
class BlockMaxIndex:
    """Unit vectors in blocks, as postings by term and block, with the largest weight of each term in each block.

    A span is the postings of one term in one block. The ``COMMON`` terms with the most postings have
    theirs as columns of a matrix, which many queries multiply at once.
    """

    rows: np.ndarray  # example of every posting, in order of term, block, example
    weights: np.ndarray
    span_ends: np.ndarray  # postings before each span, and all
    span_blocks: np.ndarray
    span_maxima: np.ndarray
    term_starts: np.ndarray  # spans of term t: term_starts[t] to term_starts[t + 1]
    column: np.ndarray  # of each term in the matrix, or -1
    matrix: np.ndarray  # weights of common terms by example
    n: int

    @staticmethod
    def build(vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> tuple[BlockMaxIndex, np.ndarray]:
        """The index and the order of the examples in it: by heaviest terms, so blocks are alike."""
        heavy = [tuple(t[np.argsort(-w, kind="stable")][:4].tolist()) for t, w in vectors]
        order = np.array(sorted(range(len(vectors)), key=lambda i: (heavy[i], i)), np.int64)
        sizes = np.array([len(vectors[i][0]) for i in order], np.int64)
        terms = np.concatenate([vectors[i][0] for i in order] or [np.zeros(0, np.int32)]).astype(np.int32)
        weights = np.concatenate([vectors[i][1] for i in order] or [np.zeros(0)])
        rows = np.repeat(np.arange(len(order), dtype=np.int32), sizes)
        del vectors, heavy  # what nobody else holds is free now, and each array is replaced in turn
        uses = np.bincount(terms, minlength=n_terms)
        common = np.sort(np.argsort(-uses, kind="stable")[:COMMON])
        column = np.full(n_terms, -1, np.int32)
        column[common] = np.arange(len(common))
        dense = column[terms] >= 0
        matrix = np.zeros((len(common), len(order)))
        matrix[column[terms[dense]], rows[dense]] = weights[dense]
        weights = weights[~dense]
        rows = rows[~dense]
        terms = terms[~dense]
        by_term = np.argsort(terms, kind="stable")
        weights = weights[by_term]
        rows = rows[by_term]
        terms = terms[by_term]
        del by_term, dense
        n_blocks = max(-(-len(order) // BLOCK), 1)
        keys = terms.astype(np.int64) * n_blocks + rows // BLOCK  # in order
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        keys = keys[starts]
        maxima = np.maximum.reduceat(weights, starts) if len(keys) else np.zeros(0)
        term_starts = np.searchsorted(keys // n_blocks, np.arange(n_terms + 1)).astype(np.int32)
        span_ends = np.append(starts, len(rows)).astype(np.int32)
        blocks = (keys % n_blocks).astype(np.int32)
        return BlockMaxIndex(
            rows, weights, span_ends, blocks, maxima, term_starts, column, matrix, len(order)
        ), order

    def sums_of(self, first_span: np.ndarray, end_span: np.ndarray, factors: np.ndarray) -> np.ndarray:
        """What some runs of spans, each times its factor, add to the cosine of every example."""
        starts = self.span_ends[first_span]
        sizes = self.span_ends[end_span] - starts
        at = np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
        return np.bincount(self.rows[at], self.weights[at] * np.repeat(factors, sizes), self.n)

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query, places and cosines of the k nearest with a positive cosine."""
        for begin in range(0, len(queries), QUERIES):
            some = queries[begin : begin + QUERIES]
            factors = np.zeros((len(some), len(self.matrix)))
            for i, (terms, weights) in enumerate(some):
                at = self.column[terms]
                factors[i, at[at >= 0]] = weights[at >= 0]
            for (terms, weights), so_far in zip(some, factors @ self.matrix):
                yield self.nearest_of(terms, weights, so_far, k)

    def nearest_of(
        self, terms: np.ndarray, weights: np.ndarray, sums: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The same for one query, given what the common terms add to every cosine."""
        first_span, end_span = self.term_starts[terms], self.term_starts[terms + 1]
        some = end_span > first_span
        first_span, end_span, weights = first_span[some], end_span[some], weights[some]
        counts = end_span - first_span
        n_spans, n_postings = counts.sum(), (self.span_ends[end_span] - self.span_ends[first_span]).sum()
        open_ones = None
        if n_postings >= WORTH_BOUNDING * n_spans > 0:
            spans = np.arange(n_spans) + np.repeat(first_span - np.cumsum(counts) + counts, counts)
            factors, blocks = np.repeat(weights, counts), self.span_blocks[spans]
            rest = np.bincount(blocks, factors * self.span_maxima[spans], -(-self.n // BLOCK))
            bounds = np.maximum.reduceat(sums, np.arange(0, self.n, BLOCK)) + rest
            # the sums so far are least cosines: no other block holds anything as near as their k-th
            least = np.partition(sums, -k)[-k] if len(sums) >= k else 0.0
            open_ones = bounds >= least - 1e-8
        if open_ones is None or 2 * open_ones.sum() > len(open_ones):  # whole terms are quicker to read than spans
            sums = sums + self.sums_of(first_span, end_span, weights)
        else:
            kept = open_ones[blocks]
            sums = sums + self.sums_of(spans[kept], spans[kept] + 1, factors[kept])
        least = np.partition(sums, -k)[-k] if len(sums) > k else 0.0
        among = np.flatnonzero(sums > max(least - 2e-9, 0.0))
        cosines = sums[among].round(9)  # the order of additions does not decide
        first = np.lexsort((among, -cosines))[:k]
        first = first[cosines[first] > 0]
        return among[first], cosines[first]


@dataclass
class Model:
    words: np.ndarray  # sorted hashes of all words of the sample; places in it are terms
    scale: np.ndarray  # idf times the word's share, per term; at the end (-1) that of a word that the sample lacks
    index: BlockMaxIndex
    labels: np.ndarray
    ids: np.ndarray
    prior: float

    def vectors(
        self, n: int, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Terms and weights of ``n`` texts, each of length 1, without the words that the sample lacks (term -1).

        Given are the text, in order, the term and the count of each word.
        """
        weights = np.log(counts)
        weights += 1
        weights *= self.scale[terms]
        weights /= np.maximum(np.sqrt(np.bincount(rows, weights * weights, n)), 1e-300)[rows]
        known = terms >= 0
        if not known.all():
            rows, terms, weights = rows[known], terms[known], weights[known]
        ends = np.searchsorted(rows, np.arange(n + 1, dtype=rows.dtype)).tolist()
        return [(terms[a:b], weights[a:b]) for a, b in zip(ends, ends[1:])]

    def votes(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Per vector its vote, and places and cosines of its neighbours."""
        if not self.index.n:
            return [(self.prior, np.zeros(0, np.int64), np.zeros(0))] * len(vectors)
        found = []
        for places, cosines in self.index.nearest(vectors, NEIGHBOURS):
            power = 1 / (np.maximum(1 - cosines, 0) + 0.05)
            share = (power @ self.labels[places] + PRIOR_WEIGHT * self.prior) / (power.sum() + PRIOR_WEIGHT)
            found.append((float(share) if len(places) else self.prior, places, cosines))
        return found


@dataclass
class Fitted:
    """A model that all tasks hold, and the curve from vote to probability."""

    model: Broadcast
    prior: float
    curve: tuple[float, float] | None

    def probabilities(self, shares: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(shares), self.prior)
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a * logit(shares) + b, -30, 30)))


def logit(p: float | np.ndarray) -> float | np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def places_in(words: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of those hashes that are among the sorted ``words``, and which ones these are."""
    at = np.searchsorted(words, hashes)
    known = words[np.minimum(at, len(words) - 1)] == hashes if len(words) else np.zeros(len(hashes), bool)
    return at[known], known


def sample_of(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Distinct labelled texts outside fold 0 (id, toxic, fold, text), bounded, and the number of labels of each kind.

    Texts are told apart by digest; whole texts are read for the rows that are taken only.
    """
    marks = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .withColumn("fold", fold_of(F.col("id")))
        .filter("fold != 0")
    )
    n_of = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    texts = docs.select(F.col("doc_id").alias("id"), whole_text().alias("text"))
    digest = F.md5(F.col("text").cast("binary")).alias("digest")
    of_text = texts.select("id", digest).join(marks, "id").groupBy("digest")
    rows = of_text.agg(F.max(F.struct("toxic", (-F.col("id")).alias("minus"), "fold")).alias("m")).select(
        "digest", "m.toxic", "m.fold", (-F.col("m.minus")).alias("id")
    )
    limit = F.when(F.col("toxic") == 1, TOXIC_ROWS).otherwise(CLEAN_ROWS)
    rows = rows.withColumn("order", F.xxhash64(F.lit("sample"), "digest"))
    rows = rows.withColumn("bucket", F.pmod("order", F.lit(SAMPLE_BUCKETS)))
    for keys in (["toxic", "bucket"], ["toxic"]):
        first = Window.partitionBy(*keys).orderBy("order", "digest")
        most = max(TOXIC_ROWS, CLEAN_ROWS)  # a constant, so that tasks keep their first rows only
        rows = rows.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= most)
    picked = cut_lineage(rows.filter(F.col("at") <= limit).select("id", "digest", "toxic", "fold"))
    found = texts.select("id", "text", digest).join(F.broadcast(picked), ["id", "digest"])
    return found.dropDuplicates(["digest"]).select("id", "toxic", "fold", "text"), n_of


def word_counts(rows: DataFrame) -> DataFrame:
    """The rows with hashes and counts of their words in place of their text."""

    @F.arrow_udf("struct<hashes: array<bigint>, counts: array<int>>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Numbers()
        for texts in batches:
            found = []
            for block in blocks_of(each_text(texts)):
                at, numbers, counts = known.counts(block)
                hashes = known.hashes[numbers]
                order = np.lexsort((hashes, at))
                ends = np.searchsorted(at, np.arange(len(block) + 1)).astype(np.int32)
                columns = (hashes[order].view(np.int64), counts[order].astype(np.int32))
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(c)) for c in columns]
                found.append(pa.StructArray.from_arrays(lists, ["hashes", "counts"]))
            yield pa.concat_arrays(found) if found else pa.array([], COUNTED)

    return rows.select("id", "toxic", "fold", count("text").alias("w")).select("id", "toxic", "fold", "w.*")


def distinct_words(counted: DataFrame) -> np.ndarray:
    """All hashes, in order."""
    hashes = counted.select(F.explode("hashes").alias("hash")).distinct().toArrow()["hash"]
    return np.sort(hashes.to_numpy().astype(np.int64).view(np.uint64))


def with_terms(counted: DataFrame, sent: Broadcast) -> DataFrame:
    """The rows with terms in place of the hashes."""

    @F.arrow_udf("array<int>")
    def terms(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for hashes in batches:
            at, found = flat(hashes)
            ends = np.searchsorted(at, np.arange(len(hashes) + 1, dtype=np.int32)).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(terms_of(sent.value, found)))

    return counted.select("id", "toxic", "fold", terms("hashes").alias("terms"), "counts")


def terms_of(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of hashes that are all among the words."""
    return np.searchsorted(words, hashes.view(np.uint64)).astype(np.int32)


def flat(column: pa.ListArray | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each element of some lists, and all elements."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), lists.flatten().to_numpy(zero_copy_only=False)


def fit(docs: DataFrame, labels: DataFrame) -> Fitted:
    """A model from the labelled rows of ``docs`` that are not in fold 0."""
    small_batches(docs.sparkSession)
    sample, n_of = sample_of(docs, labels)
    total = sum(n_of.values())
    prior = n_of.get(1, 0) / total if total else 0.0
    counted = cut_lineage(word_counts(sample))
    words = distinct_words(counted)
    sent = docs.sparkSession.sparkContext.broadcast(words)
    idf, unknown = idf_of(docs, sent)
    examples = with_terms(counted.filter(F.col("fold") != FOLDS - 1), sent)
    model = model_of(examples, words, idf, unknown, prior)
    fitted = Fitted(docs.sparkSession.sparkContext.broadcast(model), prior, None)
    n = model.index.n
    del model, words, idf
    give_back_memory()
    if n:
        fitted.curve = curve_of(counted.filter(F.col("fold") == FOLDS - 1), fitted.model, n_of)
    return fitted


def model_of(examples: DataFrame, words: np.ndarray, idf: np.ndarray, unknown: float, prior: float) -> Model:
    found = examples.select("id", "toxic", "terms", "counts").toArrow()
    ids, labels = (found[c].to_numpy() for c in ("id", "toxic"))
    (rows, terms), (_, counts) = flat(found["terms"]), flat(found["counts"])
    del found
    scale = np.append(idf * (LEAST_SHARE + label_share(len(words), rows, terms, labels)), unknown * LEAST_SHARE)
    model = Model(words, scale, None, None, None, prior)
    vectors = dict(enumerate(model.vectors(len(ids), rows, terms, counts)))
    del rows, terms, counts
    by_id = np.argsort(ids, kind="stable")
    model.index, places = BlockMaxIndex.build([vectors.pop(i) for i in by_id], len(words))
    model.labels = labels[by_id][places].astype(np.float64)
    model.ids = ids[by_id][places].astype(np.int64)
    return model


def label_share(n_words: int, rows: np.ndarray, terms: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Per word, 0 to 1: how much its presence in an example depends on the label."""
    n, t = len(labels), int(labels.sum())
    if not 0 < t < n:
        return np.zeros(n_words)
    df = np.bincount(terms, minlength=n_words).astype(np.float64)  # the words of a row are distinct
    both = np.bincount(terms[labels[rows] == 1], minlength=n_words)
    spread = df * (n - df) * t * (n - t)
    chi = np.where(spread > 0, (both * n - df * t) ** 2 * n / np.maximum(spread, 1), 0.0)
    return chi / (chi + HALF_CHI)


def curve_of(counted: DataFrame, sent: Broadcast, n_of: dict[int, int]) -> tuple[float, float] | None:
    """A logistic curve from vote to probability, by Newton steps with a small penalty."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            (at, hashes), (_, counts) = flat(batch["hashes"]), flat(batch["counts"])
            votes = m.votes(m.vectors(batch.num_rows, at, terms_of(m.words, hashes), counts))
            shares = pa.array([v[0] for v in votes], pa.float64())
            yield pa.RecordBatch.from_pydict({"toxic": batch["toxic"], "share": shares})

    # one Python step a task: with two, each executor would hold twice the workers, each with a model
    found = counted.select("toxic", "hashes", "counts").mapInArrow(vote, "toxic int, share double").toArrow()
    y, x = found["toxic"].to_numpy().astype(np.float64), found["share"].to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    order = np.lexsort((x, y))
    y, x = y[order], logit(x[order])
    w = np.where(y == 1, n_of[1] / y.sum(), n_of[0] / (1 - y).sum())
    w /= w.mean()
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        r = w * p * (1 - p)
        slope = np.array([(w * (p - y) * x).sum() + 0.1 * (a - 1), (w * (p - y)).sum() + 0.1 * b])
        bend = np.array([[(r * x * x).sum() + 0.1, (r * x).sum()], [(r * x).sum(), r.sum() + 0.1]])
        step = np.clip(np.linalg.solve(bend, slope), -1, 1)
        a, b = max(a - step[0], 0.01), b - step[1]
    return float(a), float(b)


def idf_of(docs: DataFrame, sent: Broadcast) -> tuple[np.ndarray, float]:
    """Inverse document frequencies, counted over all documents: of the given words, and of one in no document.

    A task adds up its rows in one array, so it gives out a count per word however many rows it has.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, rows = TermNumbers(sent.value), np.zeros(len(sent.value), np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for block in blocks_of(each_text(batch["text"])):
                _, numbers, _ = known.counts(block)
                terms = known.terms[numbers]
                seen += np.bincount(terms[terms >= 0], minlength=len(seen))
        del known
        give_back_memory()
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"term": np.append(-1, found), "df": np.append(rows, seen[found])})

    counted = docs.select(whole_text().alias("text")).mapInArrow(count, "term long, df long")
    sums = counted.groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    terms, df = (sums[c].to_numpy() for c in ("term", "df"))
    n, of_word = int(df[terms < 0].sum()), np.zeros(len(sent.value))
    of_word[terms[terms >= 0]] = df[terms >= 0]
    return np.log((1 + n) / (1 + of_word)) + 1, float(np.log(1 + n) + 1)


def scorer(fitted: Fitted):
    """A column function: text to a struct of score and evidence."""

    @F.arrow_udf(RESULT)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = fitted.model.value
        known = TermNumbers(m.words)
        for texts in batches:
            votes = []
            for block in blocks_of(each_text(texts)):
                rows, numbers, counts = known.counts(block)
                votes += m.votes(m.vectors(len(block), rows, known.terms[numbers], counts))
            near = np.concatenate([v[1] for v in votes] or [np.zeros(0, np.int64)])
            cosines = np.concatenate([v[2] for v in votes] or [np.zeros(0)])
            columns = [pa.array(m.ids[near]), pa.array(cosines), pa.array(m.labels[near].astype(np.int32))]
            each = pa.StructArray.from_arrays(columns, ["doc_id", "similarity", "toxic"])
            offsets = np.append(0, np.cumsum([len(v[1]) for v in votes])).astype(np.int32)
            evidence = pa.ListArray.from_arrays(pa.array(offsets), each)
            scores = pa.array(fitted.probabilities(np.array([v[0] for v in votes], np.float64)))
            yield pa.StructArray.from_arrays([scores, evidence], ["score", "evidence"])
        del known
        give_back_memory()

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted and evidence."""
    score = scorer(fit(docs, labels))
    return docs.select(
        "doc_id",
        (fold_of(F.col("doc_id")) == 0).alias("held_out"),
        score(whole_text()).alias("r"),
    ).select(
        "doc_id",
        "held_out",
        "r.score",
        F.when(F.col("r.score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "r.evidence",
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is below 0.5, with all their columns."""
    score = scorer(fit(docs, labels))
    return docs.filter(score(whole_text())["score"] < 0.5)
