"""The batch jobs: ingest, clean, score, alert, embed, answer.

Each reads tables, writes tables and returns row counts; nothing is gathered on the
driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.operators import chunking, cleaning, context, embedding, merge, metrics, scoring
from wardlight.sources.audit import require_files, source_audit
from wardlight.sources.raw import AUDIT, audit_rows, ingest, ingest_observed
from wardlight.sources.schemas import GATE_FILES, RAW_TYPES
from wardlight.sources.tables import read_if_there, read_table, write_table


def ingest_all(spark: SparkSession, raw: str, out: str) -> dict[str, int]:
    """Every raw table that is present; the gate files must be."""
    audit = source_audit(spark, raw)
    require_files(audit, GATE_FILES)
    # One row per expected file.
    present = {r.file_name for r in audit.filter("present").select("file_name").collect()}
    return {
        t: write_table(ingest(spark, f"{raw}/{t}.csv", t), f"{out}/{t.lower()}")
        for t in RAW_TYPES
        if f"{t}.csv" in present
    }


def audited_ingest(
    spark: SparkSession, raw: str, out: str, tables: Sequence[str] = tuple(RAW_TYPES)
) -> DataFrame:
    """Every raw table that is present, and the audit table of all of them, written to ``out``."""
    audit = source_audit(spark, raw, {f"{t}.csv": False for t in tables})
    present = {r.file_name for r in audit.filter("present").select("file_name").collect()}  # one row per table
    rows = [
        row
        for t in tables
        for row in audit_rows(
            t, ingest_observed(spark, f"{raw}/{t}.csv", t, f"{out}/{t.lower()}") if f"{t}.csv" in present else None
        )
    ]
    write_table(spark.createDataFrame(rows, AUDIT).coalesce(1), f"{out}/ingest_audit")
    return read_table(spark, f"{out}/ingest_audit")


def latest_notes(notes: DataFrame) -> DataFrame:
    """Latest versions; equal store times are told apart by row id, else by content."""
    if "ROW_ID" in notes.columns:
        return cleaning.clinical_notes(notes, "ROW_ID")
    marked = notes.withColumn("_content", F.sha2(F.coalesce("TEXT", F.lit("")), 256))
    return cleaning.clinical_notes(marked, "_content").drop("_content")


def clean_all(spark: SparkSession, typed: str, out: str) -> dict[str, int]:
    def t(name: str) -> DataFrame:
        return read_table(spark, f"{typed}/{name}")

    built = {
        "patient_stays": cleaning.patient_stays(t("icustays"), t("patients"), t("admissions")),
        "vitals_hourly": cleaning.vitals_hourly(t("chartevents")),
        "labs_per_stay": cleaning.labs_per_stay(t("labevents")),
        "clinical_notes": latest_notes(t("noteevents")),
    }
    return {
        name: write_table(df.withColumn("_transformed_at", F.current_timestamp()), f"{out}/{name}")
        for name, df in built.items()
    }


def score_all(spark: SparkSession, clean: str, out: str, missing: str = "worst") -> int:
    scores = scoring.sofa_scores(
        read_table(spark, f"{clean}/patient_stays"),
        read_table(spark, f"{clean}/vitals_hourly"),
        read_table(spark, f"{clean}/labs_per_stay"),
        missing,
    )
    return write_table(scores.withColumn("_scored_at", F.current_timestamp()), f"{out}/sofa_scores")


def refresh_alerts(stored: DataFrame, scores: DataFrame, now: Column) -> DataFrame:
    """Alert table after a scoring run: ``created_at`` is kept, ``updated_at`` moves."""
    fresh = scoring.latest_alerts(scores).withColumns({"created_at": now, "updated_at": now})
    changed = [c for c in scoring.ALERT_COLUMNS if c != "ICUSTAY_ID"] + ["updated_at"]
    return merge.merge_by_key(stored, fresh, ["ICUSTAY_ID"], changed)


def embed_new_notes(
    notes: DataFrame,
    stored: DataFrame,
    done: DataFrame,
    keep: list[str],
    embed: Callable[[DataFrame], DataFrame] = embedding.embed_hashed,
) -> tuple[DataFrame, DataFrame]:
    """New chunk table and new list of processed notes."""
    chunks, processed = embedding.embed_pending(notes, done, keep, embed)
    return (
        embedding.refresh_chunks(stored, chunks, processed),
        merge.replace_children(done, processed, processed, "note_id"),
    )


def run_queue(
    queue: DataFrame,
    stored: DataFrame,
    embed: Callable[[DataFrame], DataFrame],
    now: Column,
    size: int | None = None,
    pattern: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One run of the embedding queue: the new chunk table and the new queue.

    All pending notes, or the newest ``size`` of them, are chunked and embedded; their chunks take
    the place of stored ones, and all of them are marked done, those that give no chunk as well.
    ``stored``: note_id (the queue's id), chunk_index, chunk_text, embedding.
    """
    waiting = merge.pending(queue) if size is None else merge.pending_batch(queue, size)
    notes = waiting.select(F.col("queue_id").alias("note_id"), F.col("note_text").alias("TEXT"))
    made = embed(chunking.chunk_notes(chunking.spread_notes(notes), ["note_id"], pattern=pattern)).select(*stored.columns)
    return merge.replace_children(stored, made, notes, "note_id"), merge.mark_done(queue, waiting, now)


def backfill_in_units(
    notes: DataFrame,
    path: str,
    keep: Sequence[str],
    embed: Callable[[DataFrame], DataFrame],
    units: int = 64,
    most: int | None = None,
    key: str = "note_id",
    pattern: str | None = None,
) -> DataFrame:
    """Chunk and embed all notes in ranges of their key, going on where an earlier run stopped.

    The first run stores the ranges; a range is done when it has a row in ``done``, written after its
    chunks. A later run takes the ranges that are not done and writes each of them whole, so every
    note is embedded once however often a run stops. ``most`` ends a run after so many ranges.
    """
    spark = notes.sparkSession
    schema = f"unit int, low {notes.schema[key].dataType.simpleString()}, high {notes.schema[key].dataType.simpleString()}"
    ranges = read_if_there(spark, f"{path}/units", schema)
    if ranges.isEmpty():
        cuts = notes.agg(F.percentile_approx(key, [i / units for i in range(1, units)], 10 * units)).first()[0]
        edges = [None, *sorted(set(cuts or ())), None]
        rows = [(i, low, high) for i, (low, high) in enumerate(zip(edges, edges[1:]))]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/units")
        ranges = read_table(spark, f"{path}/units")
    done = read_if_there(spark, f"{path}/done", "unit int, notes long")
    open_units = ranges.join(done, "unit", "left_anti").orderBy("unit").collect()  # at most ``units`` rows
    for r in open_units[:most]:
        mine = F.lit(True) if r.low is None else F.col(key) >= r.low
        mine = mine if r.high is None else mine & (F.col(key) < r.high)
        mine = mine | F.col(key).isNull() if r.low is None else mine
        taken = notes.filter(mine)
        write_table(embed(chunking.chunk_notes(chunking.spread_notes(taken, key), keep, pattern=pattern)), f"{path}/chunks/unit={r.unit}")
        counted = taken.agg(F.lit(r.unit).alias("unit"), F.count(F.lit(1)).alias("notes"))
        counted.coalesce(1).write.mode("append").parquet(f"{path}/done")
    done = read_table(spark, f"{path}/done")
    return read_table(spark, f"{path}/chunks").join(done.select("unit").distinct(), "unit", "left_semi").drop("unit")


def answer_questions(
    questions: DataFrame, alerts: DataFrame, chunks: DataFrame, responses: DataFrame, as_of: Column
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Prompts, answers and new metric rows for a table of questions.

    ``questions``: question_id, question, embedding, tiers, top_k. ``responses``:
    question_id, response_text, provider, model, tokens_in, tokens_out, latency_ms.
    """
    risk = context.risk_lists(questions, alerts)
    found = context.retrieve(questions, risk, chunks)
    usage = responses.withColumns(
        {
            "tokens_used": F.col("tokens_in") + F.col("tokens_out"),
            "estimated_cost_usd": metrics.request_cost(
                F.col("model"), F.col("tokens_in"), F.col("tokens_out")
            ),
        }
    )
    records = context.answer_records(risk, found, responses)
    result = context.answers(questions, records, usage.drop("response_text"))
    rows = (
        records.groupBy("question_id")
        .agg(F.count(F.lit(1)).alias("patients_returned"))
        .join(usage, "question_id")
        .join(questions.select("question_id", F.col("question").alias("query_text")), "question_id")
        .select(
            F.col("question_id").cast("string").alias("query_id"),
            "query_text",
            "provider",
            "model",
            "latency_ms",
            "tokens_used",
            "estimated_cost_usd",
            "patients_returned",
            as_of.alias("queried_at"),
        )
    )
    return context.prompts(questions, risk, found, as_of), result, rows
