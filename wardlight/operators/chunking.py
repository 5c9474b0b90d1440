"""Notes to chunks, and the stay each note belongs to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlight.functions.text import (
    CHUNK_CHARS,
    OVERLAP_CHARS,
    SECTION_HEADERS,
    header_pattern,
    note_chunks,
    raw_sections,
    strip,
)


def note_sections(
    notes: DataFrame, keep: Sequence[str], text: str = "TEXT", pattern: str | None = None
) -> DataFrame:
    """One row per non-blank section; a section starts at a header line."""
    bodies = F.transform(raw_sections(F.col(text), pattern), lambda s: strip(s["body"]))
    filled = F.filter(bodies, lambda b: b != "")
    return notes.select(*keep, F.posexplode(filled).alias("section_index", "section_text"))


def chunk_notes(
    notes: DataFrame,
    keep: Sequence[str],
    text: str = "TEXT",
    pattern: str | None = None,
    size: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per chunk: the ``keep`` columns, its number, text and true offset.

    A narrow transformation: every note is split inside its own task, and the input's
    own splits share out the work. Before a dear step such as embedding, spread_notes
    shares it out anew.
    """
    chunks = note_chunks(
        F.col(text), pattern or header_pattern(SECTION_HEADERS), size, overlap
    )
    return notes.select(*keep, F.posexplode(chunks).alias("chunk_index", "c")).select(
        *keep,
        "chunk_index",
        F.col("c.section").alias("section_index"),
        F.col("c.start").alias("char_start"),
        F.col("c.text").alias("chunk_text"),
    )


def spread_notes(notes: DataFrame, key: str = "note_id") -> DataFrame:
    """Notes dealt over all tasks by key, however few or uneven the files they come from."""
    return notes.repartition(F.xxhash64(key))


# Columns of a stored chunk; any other goes into its metadata.
CHUNK_COLUMNS = (
    "note_id",
    "SUBJECT_ID",
    "HADM_ID",
    "ICUSTAY_ID",
    "note_category",
    "CHARTTIME",
    "chunk_index",
    "chunk_text",
    "embedding",
)


def with_metadata(chunks: DataFrame, columns: Sequence[str] = CHUNK_COLUMNS) -> DataFrame:
    """Move every column not in ``columns`` into a JSON text ``metadata``."""
    known = {c.lower() for c in columns}
    extra = [c for c in chunks.columns if c.lower() not in known]
    kept = [c for c in chunks.columns if c.lower() in known]
    packed = F.to_json(F.struct(*extra), {"ignoreNullFields": "false"}) if extra else F.lit("{}")
    return chunks.select(*kept, packed.alias("metadata"))


def note_stays(notes: DataFrame, stays: DataFrame) -> DataFrame:
    """Add ICUSTAY_ID: the first stay of the admission that covers the chart time.

    That is the stay with the least INTIME among those ending at or after the chart
    time, provided it has begun by then. A running minimum over the end times, latest
    first, gives it without pairing notes with stays. Each distinct chart time of an
    admission is looked up once, and an admission is cut into days: the minimum over
    all later days needs one row per day only. Notes outside every stay keep a NULL
    stay; those without admission or chart time go round the join.
    """
    at = lambda c: F.col(c).cast("timestamp")
    ends = stays.filter(F.col("INTIME").isNotNull() & F.col("OUTTIME").isNotNull()).select(
        "HADM_ID",
        at("OUTTIME").alias("t"),
        F.struct(at("INTIME").alias("begin"), F.col("ICUSTAY_ID").alias("id")).alias("stay"),
        F.lit(False).alias("asked"),
    )
    asked = (
        notes.filter(F.col("HADM_ID").isNotNull() & F.col("CHARTTIME").isNotNull())
        .select("HADM_ID", at("CHARTTIME").alias("t"))
        .distinct()
        .withColumn("asked", F.lit(True))
    )
    points = ends.unionByName(asked, allowMissingColumns=True).withColumn("day", F.to_date("t"))

    later_days = Window.partitionBy("HADM_ID").orderBy(F.col("day").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    by_day = (
        points.groupBy("HADM_ID", "day")
        .agg(F.min("stay").alias("first_of_day"))
        .select("HADM_ID", "day", F.min("first_of_day").over(later_days).alias("later"))
    )
    rest_of_day = Window.partitionBy("HADM_ID", "day").orderBy(F.col("t").desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    first = F.least("same_day", "later")
    found = (
        points.withColumn("same_day", F.min("stay").over(rest_of_day))
        .filter("asked")
        .join(by_day, ["HADM_ID", "day"])
        .select(
            "HADM_ID",
            F.col("t").alias("_at"),
            F.when(first["begin"] <= F.col("t"), first["id"]).alias("ICUSTAY_ID"),
        )
    )
    timed = notes.withColumn("_at", at("CHARTTIME"))
    keyed = F.col("HADM_ID").isNotNull() & F.col("_at").isNotNull()
    none = F.lit(None).cast(stays.schema["ICUSTAY_ID"].dataType)
    matched = timed.filter(keyed).join(found, ["HADM_ID", "_at"], "left")
    return matched.unionByName(timed.filter(~keyed).withColumn("ICUSTAY_ID", none)).drop("_at")
