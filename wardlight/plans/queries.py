"""Every operator as a query over the test tables: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.functions import text as tx
from wardlight.functions import vectors as vx
from wardlight.operators import (
    cells,
    checks,
    chunking,
    cleaning,
    context,
    embedding,
    merge,
    metrics,
    rolling,
    scoring,
    search,
    vector_store,
)
from wardlight.plans import jobs
from wardlight.plans import proxies as px
from wardlight.session import shared_dir, use_utc
from wardlight.sources.audit import source_audit
from wardlight.sources.drain import drain, read_drained
from wardlight.sources.raw import ingest
from wardlight.streaming import jobs as streams

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

PATTERN = tx.header_pattern(px.LINE_HEADERS, colon=False)
HASH_DIM = 256


# Money is a multiple of 1e-8 USD and converted values of 1e-9, so these columns are
# shown at that grain: rounding them coarser would have to break exact ties.
_PLACES = {
    "cost_usd": 8,
    "total_cost_usd": 8,
    "cost_usd_total": 8,
    "usd_per_hour": 8,
    "usd_per_second": 12,
    "value": 8,
    "value_std": 9,
    "fence_low": 9,
    "fence_high": 9,
}


def _out(df: DataFrame) -> DataFrame:
    """Lower-case names, zone-less timestamps, rounded doubles."""

    def cell(field: T.StructField) -> Column:
        name, c = field.name.lower(), F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DoubleType):
            c = F.round(c, _PLACES.get(name, 6))
        return c.alias(name)

    return df.select(*[cell(f) for f in df.schema.fields])


def _query(build: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _out(build(use_utc(spark), sf))

    run.__name__ = run.__qualname__ = build.__name__
    _QUERIES[build.__name__] = run
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- sources ---------------------------------------------------------------


@_query
def csv_cast_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Chart rows written as raw CSV with bad numbers, read back and cast."""
    path = shared_dir(spark, "chartevents-csv")
    e, k = px.table(spark, sf, "events"), px.k_of()
    e.select(
        F.col("event_id").cast("string").alias("row_id"),
        F.concat((F.expr("user_id div 15")).cast("string"), F.lit(".0")).alias("icustay_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("charttime"),
        F.when(k == 13, "n/a").otherwise(F.col("value").cast("string")).alias("valuenum"),
        F.when(k < 50, F.lit(None)).when(k == 60, "?").otherwise("0").alias("error"),
    ).write.option("header", True).csv(path)
    return ingest(spark, path, "CHARTEVENTS").drop("_ingested_at", "_source_file")


@_query
def ingest_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files ingested with an audit row per typed column; tables without a file are skipped."""
    root = shared_dir(spark, "raw")
    e, k = px.table(spark, sf, "events"), px.k_of()
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    e.repartition(3, "event_id").select(
        F.col("event_id").cast("string").alias("subject_id"),
        F.when(k == 4, "x").otherwise(F.expr("user_id div 15").cast("string")).alias("icustay_id"),
        F.when(k == 9, "soon").otherwise(at).alias("charttime"),
        F.when(k == 13, "n/a").when(k != 14, F.col("value").cast("string")).alias("valuenum"),
        F.when(k < 50, F.lit(None)).when(k == 60, "?").otherwise("0").alias("error"),
    ).write.option("header", True).csv(f"{root}/CHARTEVENTS.csv")
    px.admissions(spark, sf).select(
        F.when(F.col("HADM_ID") % 50 == 0, "?").otherwise(F.col("HADM_ID").cast("string")).alias("HADM_ID"),
        F.date_format("ADMITTIME", "yyyy-MM-dd HH:mm:ss").alias("ADMITTIME"),
        "INSURANCE",
    ).coalesce(1).write.option("header", True).csv(f"{root}/ADMISSIONS.csv")
    return jobs.audited_ingest(spark, root, f"{root}-typed")


@_query
def csv_notes_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Notes with line breaks and quotes written as raw CSV and read back whole."""
    path = shared_dir(spark, "noteevents-csv")
    (
        px.notes(spark, sf)
        .select("note_id", "HADM_ID", "CATEGORY", "CHARTTIME", "ISERROR", "TEXT")
        .write.option("header", True)
        .option("escape", '"')
        .option("quoteAll", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
    return ingest(spark, path, "NOTEEVENTS").select(
        F.col("NOTE_ID").cast("bigint"), "HADM_ID", "CATEGORY", "CHARTTIME", "ISERROR", F.md5("TEXT").alias("text_md5")
    )


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@_query
def source_audit_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Presence of every table file, with the row counts of those present."""
    expected = {f"{t}.parquet": True for t in TABLES} | {"d_items.parquet": False}
    audit = source_audit(spark, sf, expected)
    counts = None
    for t in TABLES:
        one = px.table(spark, sf, t).agg(
            F.lit(f"{t}.parquet").alias("file_name"), F.count(F.lit(1)).alias("n_rows")
        )
        counts = one if counts is None else counts.unionByName(one)
    return audit.join(counts, "file_name", "left").select("file_name", "required", "present", "n_rows")


# --- cleaning --------------------------------------------------------------


@_query
def patient_stays(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.patient_stays(px.line_stays(spark, sf), px.patients(spark, sf), px.admissions(spark, sf))


@_query
def vitals_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.vitals_hourly(px.chart(spark, sf))


@_query
def labs_flagged(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.labs_per_stay(px.chart(spark, sf)).select(
        "event_id", "HADM_ID", "ITEMID", "CHARTTIME", "VALUENUM", "FLAG", "lab_name", "is_abnormal"
    )


@_query
def notes_clean(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clinical_notes(px.notes(spark, sf), "note_id").withColumn(
        "n_chars", F.length("TEXT")
    ).drop("TEXT")


_CODES = {**cleaning.VITAL_CODES, **cleaning.LAB_CODES}


def _measures(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.named_codes(px.chart(spark, sf), "ITEMID", _CODES, "name")


@_query
def outlier_flags(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.outlier_flags(_measures(spark, sf), "name").select(
        "event_id", "name", "VALUENUM", "fence_low", "fence_high", "is_outlier"
    )


@_query
def unit_normalised(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.unit_normalised(_measures(spark, sf), "name").select(
        "event_id", "name", "VALUEUOM", "VALUENUM", "value_std"
    )


# --- scoring ---------------------------------------------------------------


@_query
def score_spine(spark: SparkSession, sf: str) -> DataFrame:
    return rolling.score_spine(px.icu_stays(spark, sf))


def _worst(spark: SparkSession, sf: str) -> DataFrame:
    rows = px.chart(spark, sf)
    return rolling.rolling_worst(
        px.icu_stays(spark, sf), cleaning.vitals_hourly(rows), cleaning.labs_per_stay(rows)
    )


@_query
def worst_vital_24h(spark: SparkSession, sf: str) -> DataFrame:
    return _worst(spark, sf).select("ICUSTAY_ID", "score_window_end", "map", "gcs", "spo2")


@_query
def worst_lab_24h(spark: SparkSession, sf: str) -> DataFrame:
    return _worst(spark, sf).select(
        "ICUSTAY_ID", "score_window_end", "creatinine", "bilirubin", "platelet", "pao2", "fio2"
    )


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.with_scores(_worst(spark, sf))


@_query
def sofa_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf)


@_query
def sofa_scores_adjusted(spark: SparkSession, sf: str) -> DataFrame:
    """Scores from values in common units, without outliers and without rows that lack a key."""
    chart = px.chart(spark, sf).withColumn("SUBJECT_ID", F.when(F.col("event_id") % 37 != 0, F.col("SUBJECT_ID")))
    rows = px.stored(cleaning.adjusted_values(px.stored(chart, "chart"), _CODES), "adjusted")
    return scoring.sofa_scores(px.icu_stays(spark, sf), cleaning.vitals_hourly(rows, strict_keys=True), cleaning.labs_per_stay(rows))


@_query
def tier_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.tier_distribution(_scores(spark, sf))


@_query
def top_risk(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.top_risk(_scores(spark, sf)).select(
        "ICUSTAY_ID", "score_window_end", "sofa_total", "risk_tier"
    )


@_query
def latest_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.latest_alerts(_scores(spark, sf))


@_query
def risk_list(spark: SparkSession, sf: str) -> DataFrame:
    alerts = scoring.latest_alerts(_scores(spark, sf))
    return scoring.risk_list(alerts, ["moderate", "high", "critical"], 10)


@_query
def baseline_delta(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.baseline_delta(_scores(spark, sf)).select(
        "ICUSTAY_ID", "score_window_end", "sofa_total", "baseline", "rise", "rise_alert"
    )


def _steps(line: str) -> Column:
    step = lambda s: F.concat_ws(
        ":", s["sofa_total"].cast("string"), s["risk_tier"], F.coalesce(s["change"].cast("string"), F.lit("-"))
    )
    return F.array_join(F.transform(line, step), " ").alias("timeline")


@_query
def timeline_by_week(spark: SparkSession, sf: str) -> DataFrame:
    """A row per stay and week, so a stay of any length has rows of bounded size."""
    made = scoring.timeline_weeks(_scores(spark, sf))
    return made.select("ICUSTAY_ID", "week_start", _steps("timeline"), "windows", "lowest_total", "peak_total")


@_query
def patient_timeline(spark: SparkSession, sf: str) -> DataFrame:
    made = scoring.patient_timeline(_scores(spark, sf))
    return made.select("ICUSTAY_ID", _steps("timeline"), "windows", "lowest_total", "peak_total")


# --- keyed tables ----------------------------------------------------------


@_query
def alerts_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """First alerts below critical are stored; the latest alerts, unless moderate, replace or join them.

    Each update comes twice, at first with an earlier window: the one with the later window counts.
    """
    scores = px.stored(_scores(spark, sf), "scores")
    first = (
        scores.filter("sepsis_alert = 1")
        .groupBy("ICUSTAY_ID")
        .agg(F.min("score_window_end").alias("score_window_end"))
        .join(scores, ["ICUSTAY_ID", "score_window_end"])
        .select(*scoring.ALERT_COLUMNS, F.col("score_window_end").alias("created_at"))
        .filter("risk_tier != 'critical'")
    )
    latest = scoring.latest_alerts(scores).filter("risk_tier != 'moderate'")
    earlier = latest.withColumns(
        {"score_window_end": F.col("score_window_end") - F.expr("INTERVAL 1 HOUR"), "sofa_total": F.lit(99)}
    )
    updates = latest.unionByName(earlier).withColumn("created_at", F.col("score_window_end"))
    changed = [c for c in scoring.ALERT_COLUMNS if c != "ICUSTAY_ID"]
    return merge.merge_by_key(first, updates, ["ICUSTAY_ID"], changed, order=["score_window_end"])


@_query
def drain_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """The latest alerts drained to files by partition, committed as one run and read back."""
    alerts = scoring.latest_alerts(_scores(spark, sf))
    path = shared_dir(spark, "drained")
    drain(alerts.repartition(3, "ICUSTAY_ID"), path)
    return read_drained(spark, path, alerts.schema)


@_query
def chunks_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Stored chunks of all notes, updated by those of German notes that grew at the front."""
    notes = px.notes(spark, sf)
    edited = notes.filter("CATEGORY = 'de'").withColumns(
        {
            "TEXT": F.concat(F.repeat(F.lit("Addendum. "), 300), F.col("TEXT")),
            "SUBJECT_ID": F.lit("moved"),
            "CATEGORY": F.lit("addendum"),
        }
    )
    return merge.merge_by_key(
        _chunk_sizes(notes), _chunk_sizes(edited), ["note_id", "chunk_index"], ["CATEGORY", "n_chars"]
    )


def _chunk_sizes(notes: DataFrame) -> DataFrame:
    made = chunking.chunk_notes(notes, ["note_id", "SUBJECT_ID", "CATEGORY"], pattern=PATTERN)
    return made.select("note_id", "chunk_index", "SUBJECT_ID", "CATEGORY", F.length("chunk_text").alias("n_chars"))


@_query
def chunks_replaced(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of shortened French notes replaced, none of their old ones left."""
    notes = px.notes(spark, sf)
    edited = notes.filter("CATEGORY = 'fr'").withColumn("TEXT", F.expr("substring(TEXT, 1, length(TEXT) div 2)"))
    return merge.replace_children(_chunk_sizes(notes), _chunk_sizes(edited), edited, "note_id")


@_query
def metrics_insert_new(spark: SparkSession, sf: str) -> DataFrame:
    rows = px.metric_rows(spark, sf).select("query_id", "provider", "latency_ms")
    known = rows.filter("provider != 'error'").withColumn("latency_ms", F.col("latency_ms") + 1)
    twice = rows.unionByName(rows.withColumn("latency_ms", F.col("latency_ms") + 5))
    return merge.insert_absent(known, twice, ["query_id"], order=["latency_ms"])


@_query
def queue_mark_done(spark: SparkSession, sf: str) -> DataFrame:
    queue = px.queue(spark, sf)
    done = merge.pending(queue).filter(F.length("note_text") > 1000)
    return merge.mark_done(queue, done, F.expr("timestamp_ntz'2024-02-01 00:00:00'")).drop("note_text")


@_query
def pending_batch(spark: SparkSession, sf: str) -> DataFrame:
    return merge.pending_batch(px.queue(spark, sf)).drop("note_text")


@_query
def pending_count(spark: SparkSession, sf: str) -> DataFrame:
    return merge.pending_count(px.queue(spark, sf))


@_query
def not_embedded(spark: SparkSession, sf: str) -> DataFrame:
    return merge.not_embedded(px.notes(spark, sf), px.done_notes(spark, sf)).select("note_id", "content_hash")


@_query
def high_risk_view(spark: SparkSession, sf: str) -> DataFrame:
    alerts = scoring.latest_alerts(_scores(spark, sf))
    return scoring.high_risk_view(alerts, px.chunks(spark, sf))


@_query
def table_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that break a constraint, per served table and rule."""
    tables = {
        "alerts": (scoring.latest_alerts(_scores(spark, sf)), checks.alert_rules()),
        "chunks": (px.chunks(spark, sf), checks.chunk_rules(dim=64)),
        "questions": (px.questions(spark, sf), checks.question_rules()),
        "notes": (
            px.notes(spark, sf),
            {"store time is set": F.col("STORETIME").isNotNull(), "text is long enough": F.length("TEXT") > 50},
        ),
    }
    found = None
    for name, (df, rules) in tables.items():
        one = checks.broken_rules(df, rules).select(F.lit(name).alias("table_name"), "rule", "rows", "broken")
        found = one if found is None else found.unionByName(one)
    return found


@_query
def duplicate_notes(spark: SparkSession, sf: str) -> DataFrame:
    return checks.duplicate_keys(px.notes(spark, sf), ["SUBJECT_ID", "HADM_ID", "CATEGORY", "CHARTTIME"])


# --- text ------------------------------------------------------------------


@_query
def note_sections(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.note_sections(px.notes(spark, sf), ["note_id"], pattern=PATTERN)


@_query
def note_windows(spark: SparkSession, sf: str) -> DataFrame:
    whole = px.notes(spark, sf).withColumn("t", tx.strip(F.col("TEXT"))).filter("t != ''")
    return whole.select(
        "note_id", F.posexplode(tx.overlapping_windows(F.col("t"), F.lit(0))).alias("chunk_index", "w")
    ).select("note_id", "chunk_index", F.col("w.start").alias("char_start"), F.col("w.text").alias("chunk_text"))


@_query
def note_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunk_notes(px.notes(spark, sf), ["note_id", "CATEGORY"], pattern=PATTERN).drop("section_index")


@_query
def chunk_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks in their stored form: all further columns as JSON text."""
    notes = px.notes(spark, sf).withColumnRenamed("CATEGORY", "note_category")
    made = chunking.chunk_notes(notes, ["note_id", "note_category", "ISERROR"], pattern=PATTERN)
    return chunking.with_metadata(made.drop("section_index")).drop("chunk_text")


@_query
def note_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return px.notes(spark, sf).select(
        "note_id",
        tx.token_estimate(F.col("TEXT")).alias("tokens"),
        tx.word_count(F.col("TEXT")).alias("words"),
        F.length(tx.strip(F.col("TEXT"))).alias("stripped_chars"),
    )


@_query
def note_stay_join(spark: SparkSession, sf: str) -> DataFrame:
    """Notes to the stay of their admission that covers their chart time."""
    stays = px.icu_stays(spark, sf).withColumn("HADM_ID", F.col("ICUSTAY_ID") % 20)
    return chunking.note_stays(px.notes(spark, sf), stays).select("note_id", "HADM_ID", "ICUSTAY_ID")


def _embedded(df: DataFrame, text: str = "chunk_text") -> DataFrame:
    return vector_store.embed_terms(df, text, HASH_DIM)


def _vector_md5() -> Column:
    return F.md5(vx.to_text(F.col("embedding"))).alias("vector_md5")


def _shown_vectors(df: DataFrame, text: str) -> list[Column]:
    return [
        F.size("embedding").alias("dims"),
        F.regexp_count(text, F.lit(r"[^\x09-\x0D\x20]+")).cast("bigint").alias("terms"),
        F.round(vx.norm(F.col("embedding")), 4).alias("length"),
        _vector_md5(),
    ]


@_query
def embed_hashed(spark: SparkSession, sf: str) -> DataFrame:
    """Every chunk of every note embedded."""
    notes = chunking.spread_notes(px.notes(spark, sf))
    made = _embedded(chunking.chunk_notes(notes, ["note_id"], pattern=PATTERN))
    return made.select("note_id", "chunk_index", *_shown_vectors(made, "chunk_text"))


@_query
def embed_model(spark: SparkSession, sf: str) -> DataFrame:
    """As embed_hashed, by a model that is called once per distinct text; the vectors are kept for later runs."""
    made = chunking.chunk_notes(chunking.spread_notes(px.notes(spark, sf)), ["note_id"], pattern=PATTERN)
    path = shared_dir(spark, "vectors")
    found = vector_store.embed_once(made, path, vector_store.term_model(HASH_DIM), dim=HASH_DIM)
    return found.select("note_id", "chunk_index", *_shown_vectors(found, "chunk_text"))


def _user_turns(spark: SparkSession, sf: str) -> DataFrame:
    return px.table(spark, sf, "conversations").filter("role = 'user'").withColumn(
        "question_id", F.concat_ws("-", "conv_id", "turn")
    )


@_query
def embed_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Every user turn embedded in the way the chunks are."""
    made = _embedded(_user_turns(spark, sf), "text")
    return made.select("conv_id", "turn", *_shown_vectors(made, "text"))


@_query
def retrieve_notes(spark: SparkSession, sf: str) -> DataFrame:
    """The five closest note chunks of every user turn, from texts alone."""
    notes = chunking.spread_notes(px.notes(spark, sf))
    made = chunking.chunk_notes(notes, ["note_id", "HADM_ID"], pattern=PATTERN)
    chunks = px.stored(_embedded(made).withColumn("ICUSTAY_ID", F.col("HADM_ID")), "chunk-vectors")
    asked = px.stored(_embedded(_user_turns(spark, sf), "text"), "question-vectors")
    found = search.top_k_batch(chunks, asked, k=5)
    return found.select("question_id", "rank", "note_id", "chunk_index", "cosine_similarity")


@_query
def embed_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Only new and changed notes are chunked and embedded."""
    made, _ = embedding.embed_pending(
        px.notes(spark, sf),
        px.done_notes(spark, sf),
        ["note_id"],
        _embedded,
        pattern=PATTERN,
    )
    return made.select(
        "note_id", "chunk_index", "char_start", F.size("embedding").alias("dims"),
        F.length("chunk_text").alias("n_chars"), _vector_md5(),
    )


@_query
def queue_run(spark: SparkSession, sf: str) -> DataFrame:
    """The whole queue worked off: pending notes chunked, embedded, stored and marked done.

    Some pending notes are blank and give no chunk. Stored before: one old chunk of every note.
    """
    blank = F.col("queue_id") % 29 == 0
    queue = px.queue(spark, sf).withColumn("note_text", F.when(blank, "  ").otherwise(F.col("note_text")))
    old = queue.select(
        F.col("queue_id").alias("note_id"),
        F.lit(7).alias("chunk_index"),
        F.lit("old").alias("chunk_text"),
        F.array(F.lit(0.5)).cast("array<float>").alias("embedding"),
    )
    stored, after = jobs.run_queue(queue, old, _embedded, F.expr("timestamp_ntz'2024-02-01 00:00:00'"), pattern=PATTERN)
    of_note = stored.select("note_id", F.struct("chunk_index", _vector_md5()).alias("v")).groupBy("note_id").agg(
        F.count("*").alias("n_chunks"), F.sort_array(F.collect_list("v")).alias("v")
    )
    vectors = F.md5(F.array_join(F.transform("v", lambda x: x["vector_md5"]), ","))
    return after.join(of_note, F.col("queue_id") == F.col("note_id"), "left").select(
        "queue_id", "embedded_at", F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"), vectors.alias("vectors_md5")
    )


@_query
def notes_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """All notes embedded in ranges of their key, in two runs: the first stops after three ranges."""
    path, notes = shared_dir(spark, "backfill"), px.notes(spark, sf)
    for most in (3, None):
        made = jobs.backfill_in_units(notes, path, ["note_id"], _embedded, units=8, most=most, pattern=PATTERN)
    return made.select("note_id", "chunk_index", "char_start", _vector_md5())


@_query
def vectors_as_text(spark: SparkSession, sf: str) -> DataFrame:
    """The export form of every stored vector."""
    return px.table(spark, sf, "embeddings").select("vec_id", vx.to_text(F.col("embedding")).alias("vector_text"))


@_query
def vectors_normalised(spark: SparkSession, sf: str) -> DataFrame:
    scaled = F.transform("embedding", lambda x: x.cast("double") * 3)
    return px.table(spark, sf, "embeddings").select(
        "vec_id", F.posexplode(vx.l2_normalise(scaled)).alias("pos", "x")
    )


# --- search ----------------------------------------------------------------


@_query
def cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    found = search.top_k_chunks(px.chunks(spark, sf), px.mean_vector(spark, sf), 10)
    return found.select("note_id", "ICUSTAY_ID", "cosine_similarity")


@_query
def cosine_topk_by_stay(spark: SparkSession, sf: str) -> DataFrame:
    """As cosine_topk, among the notes of the five stays at highest risk."""
    alerts = scoring.latest_alerts(_scores(spark, sf))
    # At most top_k rows.
    stays = [r.ICUSTAY_ID for r in scoring.risk_list(alerts, top_k=5).select("ICUSTAY_ID").collect()]
    found = search.top_k_chunks(px.chunks(spark, sf), px.mean_vector(spark, sf), 10, stays=stays)
    return found.select("note_id", "ICUSTAY_ID", "cosine_similarity")


@_query
def cosine_topk_batch(spark: SparkSession, sf: str) -> DataFrame:
    found = search.top_k_batch(px.chunks(spark, sf), px.questions(spark, sf), k=10)
    return found.select("question_id", "rank", "note_id", "cosine_similarity")


@_query
def ann_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The ten closest chunks of every question among those of the nearest stored cells."""
    made = px.chunks(spark, sf)
    index = cells.build_cells(made, shared_dir(spark, "cells"))
    found = search.top_k_near(made, px.questions(spark, sf), index, k=10)
    return found.select("question_id", "rank", "note_id", "cosine_similarity")


@_query
def ann_lsh(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate neighbours of the mean vector of the whole table."""
    made = px.chunks(spark, sf)
    model, unit = search.lsh_index(made)
    # One row: the mean vector.
    question = (
        made.agg(Summarizer.mean(array_to_vector("embedding")).alias("m")).first().m.toArray().tolist()
    )
    return search.approx_top_k(model, unit, question, 10).select("note_id", "ICUSTAY_ID", "cosine_similarity")


# --- answers ---------------------------------------------------------------


def _asked(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Questions, their risk lists from the stored alerts, and their excerpts."""
    alerts = px.stored(scoring.latest_alerts(_scores(spark, sf)), "alerts")
    asked = px.stored(px.questions(spark, sf), "questions")
    risk = context.risk_lists(asked, alerts)
    return asked, risk, context.retrieve(asked, risk, px.chunks(spark, sf))


def _responses(asked: DataFrame) -> DataFrame:
    return asked.select("question_id", F.concat(F.lit("Reviewed "), F.col("question_id").cast("string")).alias("response_text"))


@_query
def question_risk_lists(spark: SparkSession, sf: str) -> DataFrame:
    alerts = px.stored(scoring.latest_alerts(_scores(spark, sf)), "alerts")
    return context.risk_lists(px.questions(spark, sf), alerts).select(
        "question_id", "patient_rank", "ICUSTAY_ID", "sofa_total", "risk_tier"
    )


@_query
def supporting_notes(spark: SparkSession, sf: str) -> DataFrame:
    return context.supporting_notes(_asked(spark, sf)[2])


@_query
def prompt_patients(spark: SparkSession, sf: str) -> DataFrame:
    alerts = px.stored(scoring.latest_alerts(_scores(spark, sf)), "alerts")
    return context.patient_sections(context.risk_lists(px.questions(spark, sf), alerts))


@_query
def prompt_excerpts(spark: SparkSession, sf: str) -> DataFrame:
    return context.excerpt_sections(_asked(spark, sf)[2])


@_query
def prompt_full(spark: SparkSession, sf: str) -> DataFrame:
    asked, risk, found = _asked(spark, sf)
    return context.prompts(asked, risk, found, px.last_event(spark, sf))


@_query
def prompt_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The messages of every question: role and content, in order."""
    asked, risk, found = _asked(spark, sf)
    made = context.messages(context.prompts(asked, risk, found, px.last_event(spark, sf)))
    return made.select("question_id", F.posexplode("messages").alias("place", "m")).select(
        "question_id", "place", F.col("m.role").alias("role"), F.col("m.content").alias("content")
    )


@_query
def answer_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The metric row that answering each question leaves."""
    alerts = px.stored(scoring.latest_alerts(_scores(spark, sf)), "alerts")
    asked = px.stored(px.questions(spark, sf), "questions")
    responses = px.metric_rows(spark, sf).select(
        F.col("query_id").alias("question_id"),
        F.concat(F.lit("Reviewed "), F.col("query_id").cast("string")).alias("response_text"),
        "provider", "model", "tokens_in", "tokens_out", "latency_ms",
    )
    return jobs.answer_questions(asked, alerts, px.chunks(spark, sf), responses, px.last_event(spark, sf))[2]


@_query
def answer_records(spark: SparkSession, sf: str) -> DataFrame:
    asked, risk, found = _asked(spark, sf)
    made = context.answer_records(risk, found, _responses(asked))
    return made.select(
        "question_id",
        "patient_rank",
        "ICUSTAY_ID",
        "sofa_total",
        F.col("sub_scores.respiratory").alias("respiratory"),
        F.col("sub_scores.cns").alias("cns"),
        "score_window_end",
        "summary",
        F.size("supporting_notes").alias("n_notes"),
        F.array_join("supporting_notes", "|").alias("supporting_notes"),
    )


@_query
def answers(spark: SparkSession, sf: str) -> DataFrame:
    """One answer per question; usage comes from one metric row per question."""
    asked, risk, found = _asked(spark, sf)
    usage = px.metric_rows(spark, sf).select(
        F.col("query_id").alias("question_id"), "provider", "model", "latency_ms", "tokens_used", "estimated_cost_usd"
    )
    made = context.answers(asked, context.answer_records(risk, found, _responses(asked)), usage)
    ids = F.transform("alerts", lambda a: a["ICUSTAY_ID"].cast("string"))
    return made.withColumn("alerts", F.coalesce(F.array_join(ids, ","), F.lit("")))


# --- usage -----------------------------------------------------------------


@_query
def usage_24h(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.usage_summary(px.metric_rows(spark, sf), px.last_event(spark, sf))


@_query
def usage_all_time(spark: SparkSession, sf: str) -> DataFrame:
    """As usage_24h over a span that covers every row."""
    return metrics.usage_summary(px.metric_rows(spark, sf), px.last_event(spark, sf), hours=24 * 366)


@_query
def cost_24h(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.cost_view(px.metric_rows(spark, sf), px.last_event(spark, sf))


@_query
def tier_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.tier_counts(scoring.latest_alerts(_scores(spark, sf)))


@_query
def metrics_summary(spark: SparkSession, sf: str) -> DataFrame:
    made = metrics.summary_document(
        metrics.usage_summary(px.metric_rows(spark, sf), px.last_event(spark, sf)),
        metrics.tier_counts(scoring.latest_alerts(_scores(spark, sf))),
        merge.pending_count(px.queue(spark, sf)),
    )
    line = lambda *cs: F.concat_ws(":", *[c.cast("string") for c in cs])
    return made.select(
        F.array_join(
            F.transform("llm_usage_last_24h", lambda u: line(u["provider"], u["total_queries"], u["total_tokens"])), ";"
        ).alias("usage"),
        F.array_join(
            F.transform("sepsis_alerts_by_tier", lambda t: line(t["risk_tier"], t["patient_count"])), ";"
        ).alias("tiers"),
        "embedding_queue_pending",
    )


@_query
def request_cost(spark: SparkSession, sf: str) -> DataFrame:
    return px.metric_rows(spark, sf).select(
        "query_id", "model", "tokens_in", "tokens_out", F.round("estimated_cost_usd", 6).alias("cost_usd"),
        F.round("latency_ms", 2).alias("latency_ms"),
    )


def _seconds() -> Column:
    return F.col("latency_ms") / F.lit(1000.0)


@_query
def latency_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.latency_histogram(px.metric_rows(spark, sf), _seconds())


@_query
def latency_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.latency_quantiles(
        px.metric_rows(spark, sf), _seconds(), {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    )


@_query
def query_counter(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.query_counter(px.metric_rows(spark, sf))


@_query
def token_counter(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.token_counter(px.metric_rows(spark, sf))


@_query
def query_rate(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.query_rate(px.metric_rows(spark, sf))


@_query
def token_rate(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.token_rate(px.metric_rows(spark, sf))


@_query
def cost_rate(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.cost_rate(px.metric_rows(spark, sf))


@_query
def panel_status(spark: SparkSession, sf: str) -> DataFrame:
    """Traffic lights of the three panels: latency, cost and alerts."""
    rows = px.metric_rows(spark, sf)
    wide = metrics.latency_quantiles(rows, _seconds(), {"p95": 0.95}, window="10000 days")
    cost = metrics.cost_view(rows, px.last_event(spark, sf))
    tiers = metrics.tier_counts(scoring.latest_alerts(_scores(spark, sf)))
    return (
        metrics.panel(wide, "p95_latency_seconds", "provider", "p95")
        .unionByName(metrics.panel(cost, "cost_usd_24h", "provider", "total_cost_usd"))
        .unionByName(metrics.panel(tiers, "active_alerts", "risk_tier", "patient_count"))
    )


# --- streams ---------------------------------------------------------------


STREAM_BATCHES = 3


def _stream(spark: SparkSession, sf: str, name: str, key: str) -> DataFrame:
    """A table as a stream of three batches, each with rows of all times: later ones are late.

    A batch has as many files as it takes for no task to write or read more than a split of the table.
    """
    source = px.table(spark, sf, name)
    path = shared_dir(spark, f"stream-{name}")
    files = -(-source.rdd.getNumPartitions() // STREAM_BATCHES)
    source.repartition(STREAM_BATCHES * files, key).write.parquet(path)
    return spark.readStream.schema(source.schema).option("maxFilesPerTrigger", files).parquet(path)


def _paths(spark: SparkSession, name: str) -> tuple[str, str]:
    root = shared_dir(spark, name)
    return f"{root}/out", f"{root}/checkpoint"


@_query
def stream_vitals_hourly(spark: SparkSession, sf: str) -> DataFrame:
    source = px.as_chart(_stream(spark, sf, "events", "event_id"))
    return streams.run_hourly_vitals(spark, source, *_paths(spark, "stream-vitals"), every=2)


@_query
def stream_worst_24h(spark: SparkSession, sf: str) -> DataFrame:
    source = px.as_chart(_stream(spark, sf, "events", "event_id"))
    return streams.run_trailing_worst(spark, source, *_paths(spark, "stream-worst"))


@_query
def stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    source = px.as_metrics(_stream(spark, sf, "events", "event_id"))
    return streams.run_metric_counters(spark, source, *_paths(spark, "stream-metrics"), every=2)


@_query
def stream_note_dedup(spark: SparkSession, sf: str) -> DataFrame:
    source = px.as_notes(_stream(spark, sf, "documents", "doc_id"))
    return streams.run_note_dedup(spark, source, *_paths(spark, "stream-notes"), "note_id", every=2).select(
        "note_id", "CATEGORY", "CHARTTIME", "STORETIME", "word_count"
    )


@_query
def stream_embed(spark: SparkSession, sf: str) -> DataFrame:
    source = px.as_notes(_stream(spark, sf, "documents", "doc_id"))
    made = streams.run_embedding(
        spark,
        source,
        *_paths(spark, "stream-embed"),
        ["note_id"],
        _embedded,
        pattern=PATTERN,
    )
    return made.select(
        "note_id", "chunk_index", "char_start", F.size("embedding").alias("dims"),
        F.length("chunk_text").alias("n_chars"), _vector_md5(),
    )
