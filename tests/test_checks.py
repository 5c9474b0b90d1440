"""Counted checks and stored chunk form."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from wardlight.operators import checks, chunking, scoring


def broken(df, rules):
    return {r.rule: r.broken for r in checks.broken_rules(df, rules).collect() if r.broken}


def test_alert_rules(spark):
    rows = [(1, 11, "high", 3), (2, 25, "high", 4), (None, 0, "odd", 5), (4, None, None, None)]
    df = spark.createDataFrame(rows, "ICUSTAY_ID int, sofa_total int, risk_tier string, s int")
    for c in scoring.SUB_SCORES:
        df = df.withColumn(c, F.col("s") if c == "sofa_cns" else F.lit(1))
    assert broken(df, checks.alert_rules()) == {
        "icustay_id is set": 1, "sofa_total in range": 2, "risk_tier is known": 2, "sofa_cns in range": 1,
    }


def test_question_rules(spark):
    rows = [("ok", None, None), ("x" * 1001, 0, ["low"]), ("ok", 100, ["low", "?"])]
    df = spark.createDataFrame(rows, "question string, top_k int, tiers array<string>")
    assert broken(df, checks.question_rules()) == {"question is short enough": 1, "top_k in range": 2, "tiers are known": 1}


def test_chunk_rules_and_duplicates(spark):
    rows = [(1, 0, "t", [1.0, 2.0]), (1, 0, "t", [1.0]), (1, None, None, None)]
    df = spark.createDataFrame(rows, "note_id int, chunk_index int, chunk_text string, embedding array<float>")
    assert broken(df, checks.chunk_rules(2)) == {
        "chunk_index is set": 1, "chunk_text is set": 1, "embedding has the right length": 1,
    }
    assert [tuple(r) for r in checks.duplicate_keys(df, ["note_id", "chunk_index"]).collect()] == [(1, 0, 2)]


def test_metadata(spark):
    df = spark.createDataFrame([(1, 0, "t", "Report", None)], "note_id int, chunk_index int, chunk_text string, DESCRIPTION string, page int")
    row = chunking.with_metadata(df).first()
    assert json.loads(row.metadata) == {"DESCRIPTION": "Report", "page": None}
    assert row.asDict().keys() == {"note_id", "chunk_index", "chunk_text", "metadata"}
    assert chunking.with_metadata(df.select("note_id", "chunk_text")).first().metadata == "{}"
