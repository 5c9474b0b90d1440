"""The serving tables' constraints as counted checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions.scores import TIERS
from wardlight.operators.embedding import DIMENSION
from wardlight.operators.scoring import MAX_TOP_K, SUB_SCORES

# Allowed ranges of served values.
TOTAL_RANGE = (0, 24)
SUB_SCORE_RANGE = (0, 4)
MAX_QUESTION_CHARS = 1000


def alert_rules() -> dict[str, Column]:
    rules = {
        "icustay_id is set": F.col("ICUSTAY_ID").isNotNull(),
        "sofa_total in range": F.col("sofa_total").between(*TOTAL_RANGE),
        "risk_tier is known": F.col("risk_tier").isin(*TIERS),
    }
    for score in SUB_SCORES:
        rules[f"{score} in range"] = F.col(score).isNull() | F.col(score).between(*SUB_SCORE_RANGE)
    return rules


def chunk_rules(dim: int = DIMENSION) -> dict[str, Column]:
    return {
        "note_id is set": F.col("note_id").isNotNull(),
        "chunk_index is set": F.col("chunk_index").isNotNull(),
        "chunk_text is set": F.col("chunk_text").isNotNull(),
        "embedding has the right length": F.col("embedding").isNull() | (F.size("embedding") == dim),
    }


def question_rules() -> dict[str, Column]:
    return {
        "question is short enough": F.length("question") <= MAX_QUESTION_CHARS,
        "top_k in range": F.col("top_k").isNull() | F.col("top_k").between(1, MAX_TOP_K),
        "tiers are known": F.forall(
            F.coalesce("tiers", F.array().cast("array<string>")), lambda t: t.isin(*TIERS)
        ),
    }


def broken_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``(rule, rows, broken)``: how many rows break each rule, all in one pass.

    A rule that gives NULL counts as broken.
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"_r{i}") for i, rule in enumerate(rules.values())],
    )
    cells = [
        F.struct(F.lit(name).alias("rule"), F.col("_rows").alias("rows"), F.col(f"_r{i}").alias("broken"))
        for i, name in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*cells)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
