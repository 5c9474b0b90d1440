"""Nearest chunks by cosine similarity: one question, many questions, approximate."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlight.functions.vectors import cosine, dot, l2_normalise
from wardlight.operators import cells
from wardlight.operators.kernels import CHUNK_KEY, TIE_DECIMALS


def top_k_chunks(
    chunks: DataFrame,
    question: Column,
    k: int,
    stays: Sequence[int] | None = None,
) -> DataFrame:
    """The k chunks closest to one question vector, closest first.

    ``question`` is a literal or scalar-subquery column. An empty list of stays
    means all of them. Each task keeps its k best rows; chunks without a vector
    never match.
    """
    if stays:
        chunks = chunks.filter(F.col("ICUSTAY_ID").isin(list(stays)))
    return (
        chunks.filter(F.col("embedding").isNotNull())
        .withColumn("_question", question)
        .withColumn("cosine_similarity", cosine(F.col("embedding"), F.col("_question")))
        .drop("_question")
        .orderBy(
            F.round("cosine_similarity", TIE_DECIMALS).desc_nulls_last(),
            *[F.col(c) for c in CHUNK_KEY],
        )
        .limit(k)
    )


def top_k_batch(
    chunks: DataFrame,
    questions: DataFrame,
    k: int | None = None,
    allowed: DataFrame | None = None,
    most: int | None = None,
    index: cells.Cells | None = None,
) -> DataFrame:
    """``(question_id, rank, cosine_similarity, chunk columns)`` for many questions.

    ``questions`` holds question_id, embedding and, unless ``k`` is given for all, a
    column ``k``. ``allowed`` restricts a question to the stays listed for it as
    ``(question_id, ICUSTAY_ID)``; a question without entries finds nothing. ``most``
    states that no ``k`` is larger, so that tasks can leave rows out before the shuffle;
    a larger one is an error, as are a repeated question_id and vectors that differ in length.

    With ``allowed``, only chunks of the listed stays are compared, in an equi join on the stay.
    Without it, vectors are dealt into cells, and a question is compared with the chunks of those
    cells alone that may hold one of its k closest; ``index`` names cells stored by build_cells,
    else they are made here.
    """
    if k is not None:
        questions, most = questions.withColumn("k", F.lit(int(k))), int(k)
    asked = _single_questions(questions, most)
    usable = chunks.filter(F.col("embedding").isNotNull()).select(*CHUNK_KEY, "ICUSTAY_ID", "embedding")
    if allowed is None:
        found = cells.exact_top_k(index, asked) if index else cells.exact_over(usable, asked)
        return _with_chunks(chunks, found)
    found = _allowed_pairs(usable, asked, allowed)
    order = Window.partitionBy("question_id").orderBy(
        F.col("cosine_similarity").desc(), *[F.col(c) for c in CHUNK_KEY]
    )
    ranked = found.withColumn("rank", F.row_number().over(order))
    if most is not None:
        ranked = ranked.filter(F.col("rank") <= most)
    return _with_chunks(chunks, ranked.filter(F.col("rank") <= F.col("k")))


def top_k_near(
    chunks: DataFrame, questions: DataFrame, index: cells.Cells, k: int | None = None, probes: int | None = None
) -> DataFrame:
    """As top_k_batch without ``allowed``, among the chunks of the cells nearest to each question only."""
    if k is not None:
        questions = questions.withColumn("k", F.lit(int(k)))
    asked = _single_questions(questions, k)
    found = cells.approx_top_k(index, asked, probes or cells.PROBES)
    return _with_chunks(chunks, found)


def _with_chunks(chunks: DataFrame, found: DataFrame) -> DataFrame:
    return chunks.drop("embedding").join(
        found.select("question_id", *CHUNK_KEY, "cosine_similarity", "rank"), list(CHUNK_KEY)
    )


def _single_questions(questions: DataFrame, most: int | None) -> DataFrame:
    """``question_id, embedding, k`` with one row per id; others raise when they are read."""
    limit = F.when(F.col("_n") > 1, F.raise_error(F.lit("question_id repeats")).cast("int"))
    if most is not None:
        limit = limit.when(F.col("k") > most, F.raise_error(F.lit("k is larger than stated")).cast("int"))
    return (
        questions.filter(F.col("embedding").isNotNull())
        .groupBy("question_id")
        .agg(F.count(F.lit(1)).alias("_n"), F.first("embedding").alias("embedding"), F.first("k").cast("int").alias("k"))
        .select("question_id", "embedding", limit.otherwise(F.col("k")).alias("k"))
    )


def _allowed_pairs(usable: DataFrame, asked: DataFrame, allowed: DataFrame) -> DataFrame:
    """Similarity of every question with the chunks of its stays.

    A join on the stay; a stay with many chunks is split by adaptive execution.
    """
    wanted = asked.withColumn("_q", l2_normalise(F.col("embedding"))).drop("embedding")
    pairs = allowed.select("question_id", "ICUSTAY_ID").distinct().join(wanted, "question_id")
    unit = usable.withColumn("_c", l2_normalise(F.col("embedding"))).drop("embedding")
    similarity = F.when(
        F.size("_c") != F.size("_q"),
        F.raise_error(F.lit("chunk and question vectors differ in length")).cast("double"),
    ).otherwise(F.round(dot(F.col("_c"), F.col("_q")), TIE_DECIMALS))
    return (
        unit.join(pairs, "ICUSTAY_ID")
        .select("question_id", "k", *CHUNK_KEY, similarity.alias("cosine_similarity"))
        .filter(F.col("cosine_similarity").isNotNull() & ~F.isnan("cosine_similarity"))
    )


def lsh_index(
    chunks: DataFrame, bucket_length: float = 1.0, tables: int = 6, seed: int = 1
) -> tuple[BucketedRandomProjectionLSHModel, DataFrame]:
    """Hash model and chunks with unit vectors, for approximate search.

    On unit vectors the order by Euclidean distance is the order by cosine.
    """
    unit = chunks.filter(F.col("embedding").isNotNull()).withColumn(
        "_unit", array_to_vector(l2_normalise(F.col("embedding")))
    )
    lsh = BucketedRandomProjectionLSH(
        inputCol="_unit", outputCol="_hashes", bucketLength=bucket_length, numHashTables=tables, seed=seed
    )
    return lsh.fit(unit), unit


def approx_top_k(
    model: BucketedRandomProjectionLSHModel, unit: DataFrame, question: Sequence[float], k: int
) -> DataFrame:
    """About the k closest chunks; distance d on unit vectors is cosine 1 - d*d/2."""
    from pyspark.ml.linalg import Vectors

    q = np.asarray(question, dtype=np.float64)
    near = model.approxNearestNeighbors(unit, Vectors.dense(q / np.linalg.norm(q)), k, distCol="_d")
    return near.withColumn("cosine_similarity", 1 - F.col("_d") * F.col("_d") / 2).drop(
        "_unit", "_hashes", "_d"
    )
