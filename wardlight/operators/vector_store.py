"""Vectors of texts, computed once per distinct text and stored by content hash."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.operators.embedding import BATCH_TEXTS, DIMENSION, FIRST_DELAY, TRIES, embed_with
from wardlight.operators.merge import content_hash
from wardlight.sources.tables import read_if_there

# New texts are embedded and appended in so many parts, each kept once it is written.
PARTS = 4
# Positions of terms that a worker remembers.
TERMS_KEPT = 200_000

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Positions(dict):
    """Word -> its position, its md5 modulo ``dim``; bounded memory."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, word: bytes) -> int:
        if len(self) >= TERMS_KEPT:
            self.clear()
        found = self[word] = int(hashlib.md5(word).hexdigest()[:8], 16) % self.dim
        return found


def term_counts(texts: Sequence[str], known: Positions) -> np.ndarray:
    """Counts of lower-cased words by position."""
    out = np.zeros((len(texts), known.dim))
    for row, text in enumerate(texts):
        words = (text or "").lower().encode().split()  # bytes are split at \x09-\x0D and \x20
        out[row] = np.bincount(np.fromiter(map(known.__getitem__, words), np.int64, len(words)), minlength=known.dim)
    return out


def unit_counts(texts: Sequence[str], known: Positions) -> np.ndarray:
    counts = term_counts(texts, known)
    length = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    return np.divide(counts, length, out=np.zeros_like(counts), where=length > 0).astype(np.float32)


def term_model(dim: int = DIMENSION) -> Callable[[list[str]], list[list[float]]]:
    """A simple model that needs no network: hashed term counts of length 1."""
    return lambda texts: unit_counts(texts, Positions(dim)).tolist()


def term_embedding(text: Column, dim: int = DIMENSION) -> Column:
    """The vectors of ``term_model`` as a column; a text without words has a vector of zeros."""

    @F.arrow_udf("array<float>")
    def embedded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Positions(dim)
        for texts in batches:
            vectors = unit_counts(texts.to_pylist(), known)
            offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * dim)
            yield pa.ListArray.from_arrays(offsets, pa.array(vectors.ravel()))

    return embedded(text)


def embed_terms(df: DataFrame, text: str = "chunk_text", dim: int = DIMENSION) -> DataFrame:
    """Add ``embedding`` by the term model."""
    return df.withColumn("embedding", term_embedding(F.col(text), dim))


def stored_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``(content_hash, embedding)`` of every text embedded so far."""
    return read_if_there(spark, path, "content_hash string, embedding array<float>")


def embed_new(
    texts: DataFrame,
    path: str,
    model: Callable[[list[str]], Sequence[Sequence[float]]],
    text: str = "chunk_text",
    dim: int = DIMENSION,
    batch_texts: int = BATCH_TEXTS,
    tries: int = TRIES,
    first_delay: float = FIRST_DELAY,
    parts: int = PARTS,
) -> None:
    """Embed the distinct texts that ``path`` does not hold yet and append their vectors.

    Work goes part by part of the hash range. A part is appended as a whole or not at all, so a run
    that fails and starts again embeds no text of a finished part a second time.
    """
    distinct = (
        texts.filter(F.col(text).isNotNull())
        .select(content_hash(F.col(text)).alias("content_hash"), F.col(text).alias("_text"))
        .groupBy("content_hash")
        .agg(F.first("_text").alias("_text"))
    )
    for i in range(parts):
        mine = F.pmod(F.conv(F.substring("content_hash", 1, 8), 16, 10).cast("long"), F.lit(parts)) == i
        known = stored_vectors(texts.sparkSession, path).select("content_hash")
        fresh = distinct.filter(mine).join(known.filter(mine), "content_hash", "left_anti")
        made = embed_with(fresh, model, "_text", dim, batch_texts, tries, first_delay)
        made.select("content_hash", "embedding").write.mode("append").parquet(path)


def embed_once(
    df: DataFrame,
    path: str,
    model: Callable[[list[str]], Sequence[Sequence[float]]],
    text: str = "chunk_text",
    **options: object,
) -> DataFrame:
    """Add ``embedding`` from any model, called once per distinct text; NULL where the text is.

    Vectors are kept under ``path`` for later runs with the same model.
    """
    embed_new(df, path, model, text, **options)
    vectors = stored_vectors(df.sparkSession, path).withColumnRenamed("content_hash", "_hash")
    return df.withColumn("_hash", content_hash(F.col(text))).join(vectors, "_hash", "left").drop("_hash")
