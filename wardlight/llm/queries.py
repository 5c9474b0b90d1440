"""Registered queries of this folder; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm import (
    decontaminate,
    exact_dedup,
    fill_middle,
    importance,
    lm_scoring,
    lz_fingerprint,
    mixing,
    ngram_join,
    secrets,
    token_counts,
    toxicity,
    warc,
)
from wardlight.llm.byte_bpe import public_tokenizer
from wardlight.llm.sql import LLM_ORACLE
from wardlight.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", *mixing.OUTPUTS)


def op3_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    histogram = token_counts.length_histogram(table(spark, sf, "documents"), public_tokenizer(spark))
    return token_counts.context_table(histogram)


def op5_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    scores = lm_scoring.score(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")
    rounded = [F.round(c, 4).alias(c) for c in ("log_score", "mean_log_score")]
    return scores.select("doc_id", "n_words", "n_scored", "n_backed_off", *rounded)


def op6_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    bpe = public_tokenizer(spark)
    both = table(spark, sf, "documents").select("doc_id", bpe.round_trip("text").alias("r"))
    return both.select(
        "doc_id",
        F.expr("CAST(octet_length(r.ids) div 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("r.ids", 256).alias("ids_sha256"),
        F.sha2("r.decoded", 256).alias("decoded_sha256"),
    )


def op7_warc_derivatives(spark: SparkSession, sf: str) -> DataFrame:
    return warc.derivatives(warc.pages_as_responses(table(spark, sf, "pages")))


def op8_lz_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return lz_fingerprint.with_next(table(spark, sf, "documents"))


def op9_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    index = exact_dedup.create_index(spark)
    batch = exact_dedup.index_documents(table(spark, sf, "documents"), index)
    return exact_dedup.annotate(batch, index).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op10_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
    )


def op11_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    hit = decontaminate.hit_words(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op12_fill_middle(spark: SparkSession, sf: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
        F.sha2(F.encode(back, "UTF-8"), 256).alias("restored_sha256"),
    )


def op13_importance(spark: SparkSession, sf: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def llm_queries() -> dict[str, Query]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_toxicity": op1_toxicity,
        "op2_mix_sources": op2_mix_sources,
        "op3_ngram_join": op3_ngram_join,
        "op4_token_counts": op4_token_counts,
        "op5_lm_scores": op5_lm_scores,
        "op6_byte_bpe": op6_byte_bpe,
        "op7_warc_derivatives": op7_warc_derivatives,
        "op8_lz_fingerprints": op8_lz_fingerprints,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_secrets": op10_secrets,
        "op11_decontaminate": op11_decontaminate,
        "op12_fill_middle": op12_fill_middle,
        "op13_importance": op13_importance,
    }


def llm_oracle() -> dict[str, str]:
    return dict(LLM_ORACLE)
