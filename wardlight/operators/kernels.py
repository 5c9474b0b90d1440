"""Matrix products of chunk and question vectors inside a task."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

CHUNK_KEY = ("note_id", "chunk_index")
# Rows of a slice multiplied at a time, at most, and similarities computed at a time.
ROWS_AT_ONCE = 2048
PAIRS_AT_ONCE = 2**21
# Similarities that agree to this many decimals are ordered by chunk key.
TIE_DECIMALS = 9
# Candidates that are kept before they are reduced to the k best per question.
MOST_CANDIDATES = 2_000_000
# A similarity in these units and the place of its row share one 64-bit number.
_UNIT = 10**TIE_DECIMALS
_NOTHING = np.iinfo(np.int64).min

# Send these helpers with the task, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("chunk and question vectors differ in length")
    width = int(lengths[0]) if len(lengths) else 0
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), width)


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; NaN where the length is 0."""
    length = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, length, out=np.full_like(m, np.nan), where=length > 0)


def found_schema(held: DataFrame, sent: DataFrame) -> T.StructType:
    """Columns of what is found: question_id, k, chunk key, cosine_similarity."""
    return T.StructType(
        [
            T.StructField("question_id", sent.schema["question_id"].dataType),
            T.StructField("k", T.IntegerType()),
            *[T.StructField(c, held.schema[c].dataType) for c in CHUNK_KEY],
            T.StructField("cosine_similarity", T.DoubleType()),
        ]
    )


def cogrouped_best(held: DataFrame, sent: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """``(question_id, k, chunk key, cosine_similarity)``: the k best chunks of a group per question.

    ``held``: ``by``, the chunk key, embedding. ``sent``: ``by``, question_id, embedding, k.
    """
    out = found_schema(held, sent)
    return held.groupBy(*by).cogroup(sent.groupBy(*by)).applyInArrow(_best(to_arrow_schema(out)), out)


def _best(schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def best(chunks: pa.Table, questions: pa.Table) -> pa.Table:
        return best_of_slice(chunks, questions, schema)

    return best


def best_of_slice(chunks: pa.Table, questions: pa.Table, schema: pa.Schema) -> pa.Table:
    """The best chunks of all questions at once, ties by chunk key."""
    if not chunks.num_rows or not questions.num_rows:
        return schema.empty_table()
    asked, vectors = unit_rows(matrix(questions["embedding"])), matrix(chunks["embedding"])
    if vectors.shape[1] != asked.shape[1]:
        raise ValueError("chunk and question vectors differ in length")
    in_order = chunks.select(list(CHUNK_KEY)).combine_chunks().append_column("row", pa.array(np.arange(len(vectors))))
    rows = in_order.sort_by([(c, "ascending") for c in CHUNK_KEY])["row"].to_numpy()
    limits = np.array([k or 0 for k in questions["k"].to_pylist()])
    most = int(limits.max())
    if most < 1:
        return schema.empty_table()
    best = np.full((len(asked), 0), 0, np.int64)
    step = max(min(ROWS_AT_ONCE, PAIRS_AT_ONCE // len(asked)), 1)
    for start in range(0, len(rows), step):
        part = rows[start : start + step]
        sims = np.rint((asked @ unit_rows(vectors[part]).T) * _UNIT)
        places = np.arange(start, start + len(part), dtype=np.int64)
        coded = np.where(np.isnan(sims), 0, sims).astype(np.int64) * 2**32 - places
        both = np.concatenate([best, np.where(np.isnan(sims), _NOTHING, coded)], axis=1)
        keep = min(most, both.shape[1])
        best = np.partition(both, both.shape[1] - keep, axis=1)[:, both.shape[1] - keep :]
    best = np.sort(best, axis=1)[:, ::-1]
    question, place = np.nonzero((best != _NOTHING) & (np.arange(best.shape[1]) < limits[:, None]))
    codes = best[question, place]
    at = (-codes) % 2**32
    hits = {
        "question_id": questions["question_id"].combine_chunks().take(pa.array(question)),
        "k": pa.array(limits[question]),
        **{c: chunks[c].combine_chunks().take(pa.array(rows[at])) for c in CHUNK_KEY},
        "cosine_similarity": pa.array((codes + at) // 2**32 / _UNIT),
    }
    return pa.Table.from_arrays([hits[f.name].cast(f.type) for f in schema], schema=schema)


def at_least(
    chunks: np.ndarray, order: np.ndarray, asked: np.ndarray, limits: np.ndarray, reached: np.ndarray, open_rows: list
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Question, row and similarity of the k best rows per question that come up to its threshold.

    ``chunks`` and ``asked`` have rows of length 1, ``order`` is a row's place by chunk key, and
    ``open_rows`` lists pairs of questions and rows to compare. Products in single precision, less what
    they can be off, rule out nearly all pairs; the others are computed in double precision.
    """
    single, asked_single = chunks.astype(np.float32), asked.astype(np.float32)
    slack = 4 * (chunks.shape[1] + 4) * 2.0**-24 + 1 / _UNIT
    least = np.rint(np.maximum(reached, -2.0) * _UNIT)
    bound = (np.maximum(reached, -2.0) - slack).astype(np.float32)
    kept, waiting = [], 0
    for questions, rows in open_rows:
        mine, floor = asked_single[questions], bound[questions][:, None]
        step = max(min(ROWS_AT_ONCE, PAIRS_AT_ONCE // len(questions)), 1)
        for start in range(0, len(rows), step):
            part = rows[start : start + step]
            q, r = np.nonzero(mine @ single[part].T >= floor)
            if not len(q):
                continue
            if 16 * len(q) > len(questions) * len(part):
                sims = (asked[questions] @ chunks[part].T)[q, r]
            else:
                sims = np.concatenate(
                    [
                        np.einsum("ij,ij->i", asked[questions[q[i : i + 16384]]], chunks[part[r[i : i + 16384]]])
                        for i in range(0, len(q), 16384)
                    ]
                )
            codes, q, r = np.rint(sims * _UNIT), questions[q], part[r]
            fits = codes >= least[q]
            kept.append((q[fits], r[fits], codes[fits]))
            waiting += int(fits.sum())
            if waiting > MOST_CANDIDATES:
                kept = [_k_best(kept, order, limits)]
                waiting = len(kept[0][0])
    q, r, codes = _k_best(kept, order, limits)
    return q, r, codes / _UNIT


def _k_best(kept: list, order: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of some (question, row, similarity) those that are among the first k of their question, ties by key."""
    if not kept:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    q, r, codes = (np.concatenate(x) for x in zip(*kept))
    by = np.lexsort((order[r], -codes, q))
    q, r, codes = q[by], r[by], codes[by]
    first = np.searchsorted(q, q)
    best = np.arange(len(q)) - first < limits[q]
    return q[best], r[best], codes[best]
