"""Stream results as versions per micro-batch, read back as the newest version.

Each micro-batch writes only its own folder and overwrites it when it is run again,
so a restarted batch leaves no duplicates and no batch rewrites earlier results.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardlight.sources.tables import path_exists

BATCH = "batch_id"
# After so many batches their parts are reduced to one table.
REDUCE_EVERY = 16


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table as a stream of its files; ``path`` is a folder or one file."""
    schema = spark.read.parquet(path).schema
    # As a pattern the path may also name a single file.
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def write_versions(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    mode: str = "update",
    reduce: Callable[[DataFrame], DataFrame] | None = None,
    every: int = REDUCE_EVERY,
) -> StreamingQuery:
    """Start a query that writes each micro-batch as one version and stops at the end.

    With ``reduce``, which gives rows of the same columns, every so many batches the rows so far are
    reduced and written beside the versions; read_parts then starts from there.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        if reduce and batch_id % every == every - 1:
            so_far = reduce(read_parts(batch.sparkSession, path, batch_id))
            so_far.write.mode("overwrite").parquet(f"{path}-reduced/{BATCH}={batch_id}")

    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )


def read_parts(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """Rows of all batches, or of those up to one: the newest reduced table and the batches after it.

    When batch ``upto`` runs again, its own reduced table is not used.
    """
    parts = spark.read.parquet(path)
    if upto is not None:
        parts = parts.filter(F.col(BATCH) <= upto)
    if not path_exists(spark, f"{path}-reduced"):
        return parts.drop(BATCH)
    reduced = spark.read.parquet(f"{path}-reduced")
    found = {int(x) for name in reduced.inputFiles() for x in re.findall(rf"/{BATCH}=([0-9]+)/", name)}
    usable = [x for x in found if upto is None or x < upto]
    if not usable:
        return parts.drop(BATCH)
    last = max(usable)
    return (
        reduced.filter(F.col(BATCH) == last).drop(BATCH).unionByName(parts.filter(F.col(BATCH) > last).drop(BATCH))
    )


def latest_versions(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest version of every key."""
    newest = Window.partitionBy(*keys).orderBy(F.col(BATCH).desc())
    return (
        spark.read.parquet(path)
        .withColumn("_v", F.row_number().over(newest))
        .filter(F.col("_v") == 1)
        .drop("_v", BATCH)
    )


def latest_children(spark: SparkSession, path: str, parent: str) -> DataFrame:
    """All rows that the newest batch of every parent wrote."""
    rows = spark.read.parquet(path)
    newest = rows.groupBy(parent).agg(F.max(BATCH).alias(BATCH))
    return rows.join(newest, [parent, BATCH], "left_semi").drop(BATCH)
