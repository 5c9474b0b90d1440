"""Questions to answers: risk list, excerpts, prompt and answer record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlight.functions.scores import TIERS
from wardlight.functions.text import excerpt
from wardlight.functions.times import micros
from wardlight.operators.scoring import DEFAULT_TOP_K
from wardlight.operators.search import top_k_batch

# Limits on excerpts.
MAX_RETRIEVED = 20
NOTES_PER_STAY = 3
NOTE_CHARS = 300
PROMPT_EXCERPTS = 8
PROMPT_CHARS = 600

# Wording of the prompt.
NO_PATIENTS = "No patients currently flagged."
NO_NOTES = "No clinical notes retrieved."
PATIENT_BLOCK = (
    "Patient ICU Stay: %s\n"
    "  SOFA Total: %d (%s risk)\n"
    "  Sub-scores — Respiratory: %d, Coagulation: %d, Liver: %d, Cardiovascular: %d, "
    "CNS: %d, Renal: %d\n"
    "  Score window end: %s"
)
EXCERPT_BLOCK = "[Excerpt %d — ICU Stay %s, Category: %s]\n%s"
EXCERPT_RULE = "\n\n---\n\n"
ALERTS_TITLE = "─── SOFA Alert Data ───────────────────────────────────────────────"
NOTES_TITLE = "─── Retrieved Clinical Notes ──────────────────────────────────────"
TASK_TITLE = "─── Task ───────────────────────────────────────────────────────────"
TASK_TEXT = (
    "Based on the above data, provide a ranked sepsis risk assessment.\n"
    "For each patient, include:\n"
    "1. Risk level and primary clinical drivers\n"
    "2. Organ systems of greatest concern\n"
    "3. Recommended immediate monitoring actions\n\n"
    "Format your response as a structured list, one entry per patient."
)

SYSTEM_TEXT = (
    "You are a critical care clinical decision support assistant.  Your role is to\n"
    "analyse ICU patient data and identify patients at elevated risk of sepsis\n"
    "within the next 6 hours.\n\n"
    "Guidelines:\n"
    "- Base your assessment on the provided SOFA scores and retrieved clinical notes.\n"
    "- Be concise and clinician-friendly: use medical terminology, avoid hedging.\n"
    "- For each high-risk patient, give a brief rationale (2-3 sentences) referencing\n"
    "  specific lab values, vital trends, or note findings.\n"
    "- Rank patients from highest to lowest risk.\n"
    "- If data is insufficient to assess a patient, say so clearly rather than guessing.\n"
    "- Do not fabricate clinical details not present in the provided context.\n"
)


def retrieval_size(top_k: Column) -> Column:
    """Excerpts to fetch for a list of ``top_k`` patients."""
    return F.least(F.coalesce(top_k, F.lit(DEFAULT_TOP_K)) * 2, F.lit(MAX_RETRIEVED))


def risk_lists(questions: DataFrame, alerts: DataFrame) -> DataFrame:
    """The risk list of every question: ``(question_id, patient_rank, alert columns)``.

    ``questions`` has question_id, tiers (an empty or NULL array means all) and
    top_k; a NULL top_k is 10. No list is longer than the largest top_k, so that many
    highest alerts of each of the four tiers are enough for every question. Whether a
    top_k is in its range is for ``checks.question_rules`` to say; none is cut here.
    """
    asked = questions.withColumn("_k", F.coalesce("top_k", F.lit(DEFAULT_TOP_K)))
    longest = asked.agg(F.max("_k").alias("k")).first()["k"] or 0
    leading = Window.partitionBy("risk_tier").orderBy(F.col("sofa_total").desc(), "ICUSTAY_ID")
    top_per_tier = (
        alerts.withColumn("_r", F.row_number().over(leading)).filter(F.col("_r") <= longest).drop("_r")
    )
    wanted = asked.select(
        "question_id",
        "_k",
        F.explode(
            F.when(F.size(F.coalesce("tiers", F.array().cast("array<string>"))) > 0, F.array_distinct("tiers"))
            .otherwise(F.array(*map(F.lit, TIERS)))
        ).alias("risk_tier"),
    )
    per_question = Window.partitionBy("question_id").orderBy(F.col("sofa_total").desc(), "ICUSTAY_ID")
    return (
        wanted.join(top_per_tier, "risk_tier")
        .withColumn("patient_rank", F.row_number().over(per_question))
        .filter(F.col("patient_rank") <= F.col("_k"))
        .drop("_k")
    )


def retrieve(questions: DataFrame, risk: DataFrame, chunks: DataFrame) -> DataFrame:
    """Excerpts for every question from the notes of the stays on its risk list."""
    asked = questions.select("question_id", "embedding", retrieval_size(F.col("top_k")).alias("k"))
    return top_k_batch(chunks, asked, allowed=risk.select("question_id", "ICUSTAY_ID"), most=MAX_RETRIEVED)


def supporting_notes(retrieved: DataFrame) -> DataFrame:
    """The three closest excerpts per question and stay, cut to 300 characters."""
    closest = Window.partitionBy("question_id", "ICUSTAY_ID").orderBy("rank")
    return (
        retrieved.withColumn("note_rank", F.row_number().over(closest))
        .filter(F.col("note_rank") <= NOTES_PER_STAY)
        .select(
            "question_id",
            "ICUSTAY_ID",
            "note_rank",
            excerpt(F.col("chunk_text"), NOTE_CHARS).alias("note"),
        )
    )


def clock_text(ts: Column) -> Column:
    """``2024-01-02 03:04:05.678901+00:00``; the fraction only when there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    fraction = F.pmod(micros(ts), F.lit(1_000_000))
    return F.concat(
        whole, F.when(fraction > 0, F.format_string(".%06d", fraction)).otherwise(""), F.lit("+00:00")
    )


def _joined(df: DataFrame, by: str, block: Column, glue: str, name: str) -> DataFrame:
    """Blocks of a question in rank order, as one text (bounded by the list limits)."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col(by).alias("r"), block.alias("b"))))
    return df.groupBy("question_id").agg(
        F.array_join(F.transform(ordered, lambda x: x["b"]), glue).alias(name)
    )


def patient_sections(risk: DataFrame) -> DataFrame:
    block = F.format_string(
        PATIENT_BLOCK,
        F.col("ICUSTAY_ID").cast("string"),
        "sofa_total",
        F.upper("risk_tier"),
        "sofa_resp",
        "sofa_coag",
        "sofa_liver",
        "sofa_cardio",
        "sofa_cns",
        "sofa_renal",
        clock_text(F.col("score_window_end")),
    )
    return _joined(risk, "patient_rank", block, "\n\n", "patients_section")


def excerpt_sections(retrieved: DataFrame) -> DataFrame:
    block = F.format_string(
        EXCERPT_BLOCK,
        "rank",
        F.coalesce(F.col("ICUSTAY_ID").cast("string"), F.lit("unknown")),
        F.coalesce("note_category", F.lit("unknown")),
        excerpt(F.col("chunk_text"), PROMPT_CHARS),
    )
    shown = retrieved.filter(F.col("rank") <= PROMPT_EXCERPTS)
    return _joined(shown, "rank", block, EXCERPT_RULE, "notes_section")


def prompts(
    questions: DataFrame, risk: DataFrame, retrieved: DataFrame, as_of: Column
) -> DataFrame:
    """``(question_id, prompt)`` for every question."""
    parts = (
        questions.select("question_id", "question")
        .join(patient_sections(risk), "question_id", "left")
        .join(excerpt_sections(retrieved), "question_id", "left")
    )
    prompt = F.concat(
        F.lit("Clinician Query: "),
        F.col("question"),
        F.lit("\n\nRetrieved Timestamp: "),
        F.date_format(as_of, "yyyy-MM-dd HH:mm"),
        F.lit(f" UTC\n\n{ALERTS_TITLE}\n"),
        F.coalesce("patients_section", F.lit(NO_PATIENTS)),
        F.lit(f"\n\n{NOTES_TITLE}\n"),
        F.coalesce("notes_section", F.lit(NO_NOTES)),
        F.lit(f"\n\n{TASK_TITLE}\n{TASK_TEXT}"),
    )
    return parts.select("question_id", prompt.alias("prompt"))


def messages(made: DataFrame, system: str = SYSTEM_TEXT) -> DataFrame:
    """``(question_id, messages)``: the system message and the prompt, as roles with contents."""
    turns = [("system", F.lit(system)), ("user", F.col("prompt"))]
    parts = F.array(*(F.struct(F.lit(role).alias("role"), text.alias("content")) for role, text in turns))
    return made.select("question_id", parts.alias("messages"))


def answer_records(risk: DataFrame, retrieved: DataFrame, responses: DataFrame) -> DataFrame:
    """One record per question and patient, with the model's text as its summary.

    ``responses`` holds ``(question_id, response_text)``.
    """
    notes = (
        supporting_notes(retrieved)
        .groupBy("question_id", "ICUSTAY_ID")
        .agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("note_rank", "note"))), lambda x: x["note"]
            ).alias("supporting_notes")
        )
    )
    return (
        risk.join(notes, ["question_id", "ICUSTAY_ID"], "left")
        .join(responses.select("question_id", "response_text"), "question_id", "left")
        .select(
            "question_id",
            "patient_rank",
            "ICUSTAY_ID",
            "sofa_total",
            "risk_tier",
            F.struct(
                F.col("sofa_resp").alias("respiratory"),
                F.col("sofa_coag").alias("coagulation"),
                F.col("sofa_liver").alias("liver"),
                F.col("sofa_cardio").alias("cardiovascular"),
                F.col("sofa_cns").alias("cns"),
                F.col("sofa_renal").alias("renal"),
            ).alias("sub_scores"),
            "score_window_end",
            F.col("response_text").alias("summary"),
            F.coalesce("supporting_notes", F.array().cast("array<string>")).alias("supporting_notes"),
        )
    )


def answers(questions: DataFrame, records: DataFrame, usage: DataFrame) -> DataFrame:
    """One row per question with its patients in rank order and its usage.

    ``usage`` holds question_id, provider, model, latency_ms, tokens_used and
    estimated_cost_usd. A question without patients was never sent to a model.
    """
    listed = records.groupBy("question_id").agg(
        F.count(F.lit(1)).alias("patients_at_risk"),
        F.sort_array(
            F.collect_list(F.struct("patient_rank", *[c for c in records.columns if c not in ("question_id", "patient_rank")]))
        ).alias("alerts"),
    )
    asked = F.col("patients_at_risk").isNotNull()
    return (
        questions.select("question_id", "question")
        .join(listed, "question_id", "left")
        .join(usage, "question_id", "left")
        .select(
            "question_id",
            "question",
            "provider",
            F.when(asked, F.col("model")).otherwise("n/a").alias("model"),
            F.coalesce("patients_at_risk", F.lit(0)).alias("patients_at_risk"),
            "alerts",
            F.when(asked, F.round("latency_ms", 2)).otherwise(0.0).alias("latency_ms"),
            F.when(asked, F.col("tokens_used")).alias("tokens_used"),
            F.when(asked, F.round("estimated_cost_usd", 6)).alias("estimated_cost_usd"),
        )
    )
