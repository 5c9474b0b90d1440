"""Streaming forms of the hourly cleaning, scoring, embedding and metric jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.operators.chunking import chunk_notes
from wardlight.operators.cleaning import clinical_notes, valid_vitals
from wardlight.operators.embedding import embed_hashed
from wardlight.operators.metrics import LATENCY_BOUNDS, exact_sum
from wardlight.streaming.sink import BATCH, REDUCE_EVERY, latest_children, read_parts, write_versions
from wardlight.streaming.state import WINDOW_KEYS, latest_version_changes, started, trailing_worst_changes

VITAL_KEYS = ("ICUSTAY_ID", "vital_name", "hour_bucket")
METRIC_KEYS = ("window_start", "provider")


def hourly_parts(chart: DataFrame) -> DataFrame:
    """Per stay, vital and clock hour of some readings: sum, least, greatest and count.

    Works on a micro-batch. Parts of one hour from any number of batches add up, so
    there is no watermark and no state, and readings count however late they come.
    """
    return (
        valid_vitals(chart)
        .withColumn("hour_bucket", F.date_trunc("hour", F.col("CHARTTIME").cast("timestamp")))
        .groupBy(*VITAL_KEYS)
        .agg(
            F.sum("VALUENUM").alias("total"),
            F.min("VALUENUM").alias("min_val"),
            F.max("VALUENUM").alias("max_val"),
            F.count("VALUENUM").alias("measurement_count"),
        )
    )


def added_hours(parts: DataFrame) -> DataFrame:
    """One part per hour from any number of them."""
    return parts.groupBy(*VITAL_KEYS).agg(
        F.sum("total").alias("total"),
        F.min("min_val").alias("min_val"),
        F.max("max_val").alias("max_val"),
        F.sum("measurement_count").alias("measurement_count"),
    )


def hourly_vitals(parts: DataFrame) -> DataFrame:
    """The hourly table from the parts of all batches."""
    whole = added_hours(parts)
    mean = F.col("total") / F.col("measurement_count")
    return whole.select(*VITAL_KEYS, mean.alias("mean_val"), "min_val", "max_val", "measurement_count")


def run_hourly_vitals(
    spark: SparkSession, chart: DataFrame, path: str, checkpoint: str, every: int = REDUCE_EVERY
) -> DataFrame:
    """Run the stream over what is there and give the current hourly table."""
    write_versions(chart, path, checkpoint, hourly_parts, "append", added_hours, every).awaitTermination()
    return hourly_vitals(read_parts(spark, path))


def run_trailing_worst(spark: SparkSession, chart: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Least hourly mean per stay, vital and clock-aligned 24-hour window ending each hour.

    The stream gives out the windows that a batch changes; the newest value of each counts.
    """
    started(spark, lambda: write_versions(trailing_worst_changes(chart), path, checkpoint))
    return spark.read.parquet(path).groupBy(*WINDOW_KEYS).agg(F.max_by("worst", BATCH).alias("worst"))


def metric_parts(metrics: DataFrame) -> DataFrame:
    """Per 5 minutes and provider of some requests: queries, tokens, cost and latency buckets."""
    return (
        metrics.withColumn("w", F.window(F.col("queried_at").cast("timestamp"), "5 minutes"))
        .groupBy(F.col("w.start").alias("window_start"), "provider")
        .agg(
            F.count(F.lit(1)).alias("queries"),
            F.sum("tokens_used").alias("tokens"),
            exact_sum(F.col("estimated_cost_usd")).alias("cost_usd"),
            *[
                F.count_if(F.col("latency_ms") <= F.lit(b * 1000.0)).alias(f"le_{i}")
                for i, b in enumerate(LATENCY_BOUNDS)
            ],
        )
    )


def metric_counters(parts: DataFrame) -> DataFrame:
    """The counters from the parts of all batches."""
    counts = (f"le_{i}" for i in range(len(LATENCY_BOUNDS)))
    return parts.groupBy(*METRIC_KEYS).agg(
        *[F.sum(c).alias(c) for c in ("queries", "tokens")],
        exact_sum(F.col("cost_usd")).alias("cost_usd"),
        *[F.sum(c).alias(c) for c in counts],
    )


def run_metric_counters(
    spark: SparkSession, metrics: DataFrame, path: str, checkpoint: str, every: int = REDUCE_EVERY
) -> DataFrame:
    write_versions(metrics, path, checkpoint, metric_parts, "append", metric_counters, every).awaitTermination()
    return metric_counters(read_parts(spark, path))


def run_note_dedup(
    spark: SparkSession, notes: DataFrame, path: str, checkpoint: str, tie_break: str, every: int = REDUCE_EVERY
) -> DataFrame:
    """Latest version of each note over all batches.

    A batch writes the notes that are the latest so far; the same rule over these gives the overall
    latest, and takes the place of what was written from time to time.
    """

    def latest(rows: DataFrame) -> DataFrame:
        return clinical_notes(rows, tie_break).drop("word_count")

    changes = latest_version_changes(notes, tie_break)
    started(spark, lambda: write_versions(changes, path, checkpoint, latest, "update", latest, every))
    return clinical_notes(read_parts(spark, path), tie_break)


def run_embedding(
    spark: SparkSession,
    notes: DataFrame,
    path: str,
    checkpoint: str,
    keep: Sequence[str],
    embed: Callable[[DataFrame], DataFrame] = embed_hashed,
    key: str = "note_id",
    pattern: str | None = None,
) -> DataFrame:
    """Chunk and embed notes as they arrive; a note that comes again is replaced.

    The stream's checkpoint records which notes are done, including those that give
    no chunk. A note whose new version has no chunks writes one row without a chunk
    number, so that its old chunks are not read any more.
    """

    def prepare(batch: DataFrame) -> DataFrame:
        # The texts move once; chunks, vectors and the join below stay in place.
        by_note = batch.repartition(key)
        chunks = embed(chunk_notes(by_note, keep, pattern=pattern))
        return by_note.select(key).distinct().join(chunks, key, "left")

    write_versions(notes, path, checkpoint, prepare, mode="append").awaitTermination()
    return latest_children(spark, path, key).filter(F.col("chunk_index").isNotNull())
