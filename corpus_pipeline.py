"""From raw documents to token ids: filter, deduplicate, mix and encode.

Each stage takes all rows its predecessor kept and returns the columns of ``documents``; the last
one returns token ids. ``run`` writes every stage to the shared folder and reads it again, so a
lost executor costs the tasks of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm import exact_dedup, mixing, ngram_join, toxicity
from wardlight.llm.byte_bpe import public_tokenizer
from wardlight.session import shared_dir, use_utc


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects (score of 0.5 or more) go."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id stays."""
    return exact_dedup.keep_documents(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, Jaccard 0.8 or more, chains included), the least id stays."""
    return ngram_join.keep_first(docs, size=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights; a document may come several times, or not at all."""
    return mixing.repeat_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives the text back."""
    bpe = public_tokenizer(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    ids = docs.select("doc_id", "lang", "source", "n_chars", text.alias("text"), bpe.round_trip(text).alias("r"))
    return ids.select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        F.expr("CAST(octet_length(r.ids) div 4 AS BIGINT)").alias("n_tokens"),
        "r.ids",
        (F.col("r.decoded") == F.encode("text", "UTF-8")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", clean),
    ("exact_dedup", without_copies),
    ("ngram_jaccard", without_near_copies),
    ("mix_sources", mixed),
    ("byte_bpe", encoded),
]

#: The first stage is a model, so no SQL gives these rows; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = use_utc(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
