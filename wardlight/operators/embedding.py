"""Chunk texts to vectors, in full or for new and changed notes only."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.operators.chunking import chunk_notes, spread_notes
from wardlight.operators.merge import content_hash, not_embedded, replace_children

# Vector length, texts per call, tries and first delay in seconds.
DIMENSION = 1536
BATCH_TEXTS = 512
TRIES = 5
FIRST_DELAY = 1.0


def term_vectors(df: DataFrame, text: str = "chunk_text", dim: int = DIMENSION) -> DataFrame:
    """Add ``_tf``: hashed term counts as an ML vector."""
    words = Tokenizer(inputCol=text, outputCol="_words").transform(df)
    return HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim).transform(words).drop("_words")


def unit_embedding(df: DataFrame) -> DataFrame:
    """Add ``embedding``: the vector ``_tf`` scaled to length 1."""
    scaled = Normalizer(inputCol="_tf", outputCol="_unit", p=2.0).transform(df)
    return scaled.withColumn("embedding", vector_to_array("_unit", "float32")).drop("_unit")


def embed_hashed(df: DataFrame, text: str = "chunk_text", dim: int = DIMENSION) -> DataFrame:
    """Add ``embedding``: unit-length hashed term counts, computed in the JVM."""
    return unit_embedding(term_vectors(df, text, dim)).drop("_tf")


def embed_with(
    df: DataFrame,
    embed: Callable[[list[str]], Sequence[Sequence[float]]],
    text: str = "chunk_text",
    dim: int = DIMENSION,
    batch_texts: int = BATCH_TEXTS,
    tries: int = TRIES,
    first_delay: float = FIRST_DELAY,
) -> DataFrame:
    """Add ``embedding`` from a user's model, called once per batch of texts.

    A failed call is tried again with doubled delays. A wrong number or length of
    vectors is an error.
    """

    def call(texts: list[str]) -> list[list[float]]:
        for attempt in range(tries):
            try:
                return [[float(x) for x in v] for v in embed(texts)]
            except Exception:
                if attempt == tries - 1:
                    raise
                time.sleep(first_delay * 2**attempt)
        return []

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame[text].tolist()
            vectors: list[list[float]] = []
            for i in range(0, len(texts), batch_texts):
                part = texts[i : i + batch_texts]
                got = call(part)
                if len(got) != len(part) or any(len(v) != dim for v in got):
                    raise ValueError(f"the model must give one vector of length {dim} per text")
                vectors.extend(got)
            yield frame.assign(embedding=pd.Series(vectors, index=frame.index, dtype=object))

    schema = T.StructType(
        [*df.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType(), False), False)]
    )
    return df.mapInPandas(run, schema)


def embed_pending(
    notes: DataFrame,
    done: DataFrame,
    keep: Sequence[str],
    embed: Callable[[DataFrame], DataFrame] = embed_hashed,
    key: str = "note_id",
    pattern: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Chunks with vectors, and ``(key, content_hash)``, of new and changed notes."""
    fresh = not_embedded(notes, done, key)
    chunks = embed(chunk_notes(spread_notes(fresh, key), keep, pattern=pattern))
    return chunks, fresh.select(key, "content_hash")


def refresh_chunks(
    stored: DataFrame, chunks: DataFrame, processed: DataFrame, key: str = "note_id"
) -> DataFrame:
    """Stored chunks with all chunks of the processed notes replaced."""
    return replace_children(stored, chunks, processed, key)


def backfill(
    notes: DataFrame,
    keep: Sequence[str],
    embed: Callable[[DataFrame], DataFrame] = embed_hashed,
    key: str = "note_id",
    pattern: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All notes chunked and embedded, as when nothing is stored yet."""
    chunks = embed(chunk_notes(spread_notes(notes, key), keep, pattern=pattern))
    return chunks, notes.select(key, content_hash(F.col("TEXT")).alias("content_hash"))
