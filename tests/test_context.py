"""Risk lists, excerpts, prompts and answers against plain Python."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardlight.operators import context, scoring
from wardlight.plans import jobs

T0 = dt.datetime(2150, 1, 1, 12, 0)
SUB = ["sofa_resp", "sofa_coag", "sofa_liver", "sofa_cardio", "sofa_cns", "sofa_renal"]
TIER = {0: "low", 1: "moderate", 2: "high", 3: "critical"}


def alerts(spark, n=260):
    rows = [(200000 + i, T0 + dt.timedelta(microseconds=i), i % 19, TIER[i % 4], 3, 2, 1, 1, 2, 1) for i in range(n)]
    return spark.createDataFrame(
        rows, "ICUSTAY_ID bigint, score_window_end timestamp, sofa_total int, risk_tier string, " + ", ".join(f"{c} int" for c in SUB)
    )


def questions(spark):
    rows = [
        (1, "Who is at risk?", [1.0, 0.0], None, 50),
        (2, "Any \\ 50% case?", [0.0, 1.0], ["high", "critical"], 7),
        (3, "None?", [1.0, 1.0], ["unknown"], 10),
        (4, "All?", [1.0, -1.0], [], 3),
        (5, "Twice?", [1.0, -1.0], ["low", "low"], 4),
    ]
    return spark.createDataFrame(
        rows, "question_id bigint, question string, embedding array<double>, tiers array<string>, top_k int"
    )


def chunks(spark):
    rows = [(i, 0, 200000 + i % 30, "cat" if i % 2 else None, f"note {i} " + "y" * 900, [float(i % 11), float(i % 7 + 1)]) for i in range(300)]
    return spark.createDataFrame(
        rows, "note_id bigint, chunk_index int, ICUSTAY_ID bigint, note_category string, chunk_text string, embedding array<float>"
    )


def test_risk_lists_equal_single_lists(spark):
    a, q = alerts(spark), questions(spark)
    got: dict[int, list] = {}
    for r in context.risk_lists(q, a).orderBy("question_id", "patient_rank").collect():
        got.setdefault(r.question_id, []).append(r.ICUSTAY_ID)
    for r in q.collect():
        want = [x.ICUSTAY_ID for x in scoring.risk_list(a, r.tiers, r.top_k).collect()]
        assert got.get(r.question_id, []) == want, r.question_id
    assert len(got[1]) == 50 and 3 not in got


def test_whole_answer(spark):
    a, q, c = alerts(spark), questions(spark), chunks(spark)
    responses = q.select(
        "question_id",
        F.concat(F.lit("answer "), F.col("question_id").cast("string")).alias("response_text"),
        F.lit("claude").alias("provider"),
        F.lit("other").alias("model"),
        F.lit(1_000_000).alias("tokens_in"),
        F.lit(1_000_000).alias("tokens_out"),
        F.lit(1234.5678).alias("latency_ms"),
    )
    prompts, answers, rows = jobs.answer_questions(q, a, c, responses, F.lit(T0))
    by_id = {r.question_id: r for r in answers.collect()}
    assert {k: r.patients_at_risk for k, r in by_id.items()} == {1: 50, 2: 7, 3: 0, 4: 3, 5: 4}
    assert (by_id[3].model, by_id[3].latency_ms, by_id[3].alerts, by_id[3].tokens_used) == ("n/a", 0.0, None, None)
    assert (by_id[1].latency_ms, by_id[1].tokens_used, by_id[1].estimated_cost_usd) == (1234.57, 2_000_000, 20.0)
    totals = [p.sofa_total for p in by_id[2].alerts]
    assert totals == sorted(totals, reverse=True) and {p.risk_tier for p in by_id[2].alerts} <= {"high", "critical"}
    for r in by_id.values():
        for p in r.alerts or []:
            assert all(0 <= p.sub_scores[x] <= 4 for x in p.sub_scores.asDict())
            assert p.summary == f"answer {r.question_id}" and len(p.supporting_notes) <= 3
            assert all(len(n) <= 300 for n in p.supporting_notes)
    assert {r.query_id: r.patients_returned for r in rows.collect()} == {"1": 50, "2": 7, "4": 3, "5": 4}

    text = {r.question_id: r.prompt for r in prompts.collect()}
    assert "No patients currently flagged." in text[3] and "No clinical notes retrieved." in text[3]
    assert text[2].startswith("Clinician Query: Any \\ 50% case?\n\nRetrieved Timestamp: 2150-01-01 12:00 UTC\n")
    assert text[1].count("Patient ICU Stay: ") == 50
    assert text[1].count("[Excerpt ") <= 8
    first = by_id[2].alerts[0]
    micro = first.score_window_end.microsecond
    assert (
        f"Patient ICU Stay: {first.ICUSTAY_ID}\n"
        f"  SOFA Total: {first.sofa_total} ({first.risk_tier.upper()} risk)\n"
        "  Sub-scores — Respiratory: 3, Coagulation: 2, Liver: 1, Cardiovascular: 1, CNS: 2, Renal: 1\n"
        f"  Score window end: 2150-01-01 12:00:00{f'.{micro:06d}' if micro else ''}+00:00"
    ) in text[2]


def test_excerpts_follow_similarity(spark):
    q = questions(spark)
    found = context.retrieve(q, context.risk_lists(q, alerts(spark)), chunks(spark))
    sizes = {r.question_id: r["count"] for r in found.groupBy("question_id").count().collect()}
    assert all(n <= 20 for n in sizes.values())
    ranked = found.filter("question_id = 1").orderBy("rank").collect()
    assert [r.rank for r in ranked] == list(range(1, len(ranked) + 1))
    sims = [r.cosine_similarity for r in ranked]
    assert sims == sorted(sims, reverse=True)
    text = {r.question_id: r.notes_section for r in context.excerpt_sections(found).collect()}
    shown = text[1].split("\n\n---\n\n")
    assert len(shown) == min(8, len(ranked))
    head, body = shown[0].split("\n", 1)
    top = ranked[0]
    assert head == f"[Excerpt 1 — ICU Stay {top.ICUSTAY_ID}, Category: {top.note_category or 'unknown'}]"
    assert body == top.chunk_text[:600]


def test_clock_text(spark):
    row = spark.range(1).select(
        context.clock_text(F.lit(T0)).alias("whole"),
        context.clock_text(F.lit(T0 + dt.timedelta(microseconds=50))).alias("part"),
    ).first()
    assert row.whole == "2150-01-01 12:00:00+00:00" and row.part == "2150-01-01 12:00:00.000050+00:00"


@pytest.mark.parametrize("k, size", [(1, 2), (10, 20), (50, 20)])
def test_retrieval_size(spark, k, size):
    assert spark.range(1).select(context.retrieval_size(F.lit(k)).alias("n")).first().n == size


def test_high_risk_view_counts_chunks(spark):
    view = scoring.high_risk_view(alerts(spark, 60), chunks(spark)).collect()
    assert {r.risk_tier for r in view} == {"high", "critical"}
    assert {r.ICUSTAY_ID: r.embedded_note_chunks for r in view if r.ICUSTAY_ID in (200002, 200055)} == {200002: 10, 200055: 0}


def test_top_k_missing_and_large(spark):
    alerts = spark.createDataFrame(
        [(i, i % 20, "high", i) for i in range(90)], "ICUSTAY_ID int, sofa_total int, risk_tier string, x int"
    )
    asked = spark.createDataFrame([("a", None, None), ("b", None, 80)], "question_id string, tiers array<string>, top_k int")
    rows = context.risk_lists(asked, alerts).groupBy("question_id").count().collect()
    assert {r.question_id: r["count"] for r in rows} == {"a": 10, "b": 80}
