"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.session import shared_dir

ROWS_PER_SLICE = 256
ROWS_PER_BATCH = 1_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def whole_text(name: str = "text") -> Column:
    """The text as it is; NULL counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and go on from the written rows."""
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession, "cut"))
    return df.checkpoint()


def small_batches(spark: SparkSession) -> None:
    """Send whole texts to Python in batches of few rows: a batch is held on both sides at once.

    The rows of a batch also wait in the executor for its answer. A smaller setting stays.
    """
    rows = int(spark.conf.get(BATCH_SETTING))
    if not 0 < rows <= ROWS_PER_BATCH:
        spark.conf.set(BATCH_SETTING, ROWS_PER_BATCH)


def give_back_memory() -> None:
    """Hand freed memory of this process back to the system, as far as the C library offers it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches in pieces of few rows, so that long texts need little memory at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_PER_SLICE):
            yield batch.slice(start, ROWS_PER_SLICE)


def each_text(column: pa.Array) -> Iterator[str]:
    """Texts of a column; few are Python strings at a time."""
    for start in range(0, len(column), ROWS_PER_SLICE):
        yield from texts_of(column.slice(start, ROWS_PER_SLICE))


def texts_of(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]
