"""Exact duplicates by a persistent digest index, bucketed and sorted by digest.

The index is a Parquet table of one row per distinct text (``digest``, ``keep_id``). A batch
of new documents is reduced to one row per digest (counting before the shuffle), sort-merge
anti-joined with the index, and what is new is appended. The stored row of a text never
changes, so batches are given in the order of preference; within a batch the largest id wins.

Defined cases: NULL text counts as empty, and all empty texts are one group. NULL ids lose
against any id; a group of NULL ids only keeps one row of them. Rows that repeat both id and
text are one document given more than once: one of them stays. An empty table gives an empty
result. Other columns, whatever their names, play no part.

A group of copies may hold any share of the rows: it is counted before the shuffle, and the
join that tells each row its group is a plain one, which adaptive execution splits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm.common import cut_lineage, whole_text
from wardlight.session import shared_dir

BUCKETS = 64


def create_index(
    spark: SparkSession, name: str | None = None, path: str | None = None, buckets: int = BUCKETS
) -> str:
    """An empty index table; its files lie under ``path``, else in the shared folder."""
    name = name or f"text_digests_{uuid.uuid4().hex}"
    empty = spark.createDataFrame([], "digest binary, keep_id long")
    _writer(empty, buckets).option("path", path or shared_dir(spark, name)).saveAsTable(name)
    return name


def _writer(rows: DataFrame, buckets: int):
    return (
        rows.write.format("parquet").mode("append").bucketBy(buckets, "digest").sortBy("digest")
    )


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct (id, text): ``id``, ``digest`` and how many rows gave it."""
    return (
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.unhex(F.sha2(whole_text(text_col), 256)).alias("digest"),
        )
        .groupBy("id", "digest")
        .agg(F.count("*").alias("copies"))
    )


def append_batch(batch: DataFrame, index: str, buckets: int = BUCKETS) -> None:
    """Add the digests of ``batch`` (see :func:`digests`) that the index does not hold yet."""
    spark = batch.sparkSession
    firsts = batch.groupBy("digest").agg(F.max("id").alias("keep_id"))
    known = spark.table(index).select("digest")
    new = firsts.join(known.hint("merge"), "digest", "left_anti")
    _writer(new.repartition(buckets, "digest"), buckets).saveAsTable(index)


def groups(batch: DataFrame, index: str) -> DataFrame:
    """Per digest of ``batch``: the id that stays and the number of rows."""
    sizes = batch.groupBy("digest").agg(F.sum("copies").alias("group_size"))
    held = batch.sparkSession.table(index)
    return sizes.join(held.hint("merge"), "digest")


def annotate(batch: DataFrame, index: str) -> DataFrame:
    """Every row of ``batch`` with its group: id, digest, keep_id, group_size, kept."""
    found = cut_lineage(groups(batch, index))
    return (
        batch.join(found, "digest")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))
        .select("id", "digest", "keep_id", "group_size", "kept")
    )


def index_documents(docs: DataFrame, index: str) -> DataFrame:
    """Digests of ``docs``, added to the index in two batches, larger ids first."""
    batch = cut_lineage(digests(docs))
    middle = batch.agg(((F.min("id") + F.max("id")) / 2).alias("m")).first()["m"] or 0
    upper = F.coalesce(F.col("id") >= F.lit(middle), F.lit(False))
    append_batch(batch.filter(upper), index)
    append_batch(batch.filter(~upper), index)
    return batch


def keep_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""

    def key(digest: Column, id: Column) -> Column:
        return F.concat_ws(":", F.hex(digest), F.coalesce(id.cast("string"), F.lit("null")))

    index = create_index(docs.sparkSession)
    index_documents(docs, index)
    own = F.unhex(F.sha2(whole_text(), 256))
    held = docs.sparkSession.table(index).select(key(F.col("digest"), F.col("keep_id")).alias("__key"))
    keyed = docs.withColumn("__key", key(own, F.col("doc_id").cast("long")))
    return keyed.join(held, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
