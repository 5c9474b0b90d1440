"""Section split and windows against a plain Python reading of the rules."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from wardlight.functions import text as tx
from wardlight.operators.chunking import chunk_notes, note_sections, note_stays

HEADERS = sorted(tx.SECTION_HEADERS, key=len, reverse=True)


def python_chunks(text: str, size: int = 1600, overlap: int = 320):
    """(section, text, start) of every chunk."""
    cuts = [m.start() for m in re.finditer(rf"(?im)^(?:{'|'.join(HEADERS)})\s*:", text)]
    bounds = sorted({0, *cuts, len(text)})
    out, section = [], 0
    for a, b in zip(bounds, bounds[1:]):
        body = text[a:b]
        whole = body.strip()
        if not whole:
            continue
        begin = a + len(body) - len(body.lstrip())
        at = 0
        while True:
            piece = whole[at : at + size]
            if piece.strip():
                out.append((section, piece.strip(), begin + at + len(piece) - len(piece.lstrip())))
            if at + size >= len(whole):
                break
            at += size - overlap
        section += 1
    return out


def sample_texts():
    long = "This is a clinical note. " * 160
    yield "Chief Complaint: chest pain. Assessment: rule out MI."
    yield ""
    yield "   \n\t  "
    yield long
    yield "word " * 533
    yield "x" * 1600
    yield "x" * 1601
    yield "x" * 2880 + " " * 1300 + "y"
    yield f"Chief Complaint: pain\nHistory of Present Illness :\n{long}\nPLAN: rest\n\nplan b: none"
    yield "\n\nAssessment and Plan: both\nAssessment: one\nmedications:\n" + "é世\U0001f600 " * 900
    yield "  lead" + " " * 1590 + "tail " * 700
    yield "Impression:\n" * 40
    yield ("z" * 99 + " ") * 1700  # longer than one piece of windows
    yield " Plan: em space \nx\x1cAllergies: none"


def spark_chunks(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "note_id int, TEXT string")
    got: dict[int, list] = {}
    for r in chunk_notes(df, ["note_id"], **kw).orderBy("note_id", "chunk_index").collect():
        assert r.chunk_index == len(got.setdefault(r.note_id, []))
        got[r.note_id].append((r.section_index, r.chunk_text, r.char_start))
    return got


def test_chunks_follow_the_rules(spark):
    texts = list(sample_texts())
    got = spark_chunks(spark, texts)
    for i, text in enumerate(texts):
        assert got.get(i, []) == python_chunks(text), i


def test_offsets_point_into_the_text(spark):
    texts = list(sample_texts())
    for i, chunks in spark_chunks(spark, texts).items():
        for _, chunk, start in chunks:
            assert texts[i][start : start + len(chunk)] == chunk


def test_chunks_cover_all_visible_text(spark):
    texts = list(sample_texts())
    got = spark_chunks(spark, texts)
    for i, text in enumerate(texts):
        seen = set()
        for _, chunk, start in got.get(i, []):
            seen.update(range(start, start + len(chunk)))
        assert all(text[p].isspace() for p in range(len(text)) if p not in seen)


def test_other_sizes(spark):
    texts = ["abc " * 100, "Plan: " + "word " * 30]
    got = spark_chunks(spark, texts, size=50, overlap=10)
    assert {i: python_chunks(t, 50, 10) for i, t in enumerate(texts)} == got


def test_metadata_is_copied_and_blank_notes_give_nothing(spark):
    df = spark.createDataFrame(
        [(1, 99, "Discharge summary", "Some clinical text here."), (2, 98, "x", " "), (3, 97, "x", None)],
        "note_id int, HADM_ID int, CATEGORY string, TEXT string",
    )
    rows = chunk_notes(df, ["note_id", "HADM_ID", "CATEGORY"]).collect()
    assert [(r.note_id, r.HADM_ID, r.CATEGORY, r.chunk_text) for r in rows] == [
        (1, 99, "Discharge summary", "Some clinical text here.")
    ]


def test_sections(spark):
    df = spark.createDataFrame([(1, "intro\nPlan: a\nb\n\nAllergies : none")], "note_id int, TEXT string")
    rows = note_sections(df, ["note_id"]).orderBy("section_index").collect()
    assert [r.section_text for r in rows] == ["intro", "Plan: a\nb", "Allergies : none"]


@pytest.mark.parametrize("text, words", [("a b", 2), (" a b ", 4), ("a\n\nb", 2), ("", 1)])
def test_word_count(spark, text, words):
    assert spark.range(1).select(tx.word_count(F.lit(text)).alias("n")).first().n == words


def test_token_estimate(spark):
    row = spark.range(1).select(*[tx.token_estimate(F.lit("x" * n)).alias(f"n{n}") for n in (0, 1, 4, 5)]).first()
    assert tuple(row) == (0, 1, 1, 2)


def test_note_stays(spark):
    notes = spark.sql(
        """SELECT * FROM VALUES (1, 7, timestamp'2024-01-01 12:00:00'), (2, 7, timestamp'2024-01-03 00:00:00'),
           (3, 7, timestamp'2024-02-01 00:00:00'), (4, 8, timestamp'2024-01-01 12:00:00'), (5, 7, NULL)
           AS t(note_id, HADM_ID, CHARTTIME)"""
    )
    stays = spark.sql(
        """SELECT * FROM VALUES (70, 7, timestamp'2024-01-01 00:00:00', timestamp'2024-01-03 00:00:00'),
           (71, 7, timestamp'2024-01-03 00:00:00', timestamp'2024-01-05 00:00:00')
           AS t(ICUSTAY_ID, HADM_ID, INTIME, OUTTIME)"""
    )
    got = {r.note_id: r.ICUSTAY_ID for r in note_stays(notes, stays).collect()}
    assert got == {1: 70, 2: 70, 3: None, 4: None, 5: None}


def test_note_stays_with_overlaps(spark):
    rng = random.Random(11)
    t0 = dt.datetime(2024, 1, 1)
    hour = lambda a, b: t0 + dt.timedelta(hours=rng.randint(a, b))
    stays = []
    for i in range(60):
        begin = hour(0, 200)
        stays.append((i, rng.randint(0, 3), begin, begin + dt.timedelta(hours=rng.randint(0, 90))))
    stays += [(90, 0, None, hour(0, 9)), (91, 0, t0, None)]
    notes = [(i, rng.randint(0, 4), hour(-10, 300)) for i in range(400)] + [(900, 1, None), (901, None, t0)]
    want = {}
    for n, h, t in notes:
        hits = [(a, i) for i, hadm, a, b in stays if hadm == h and t and a and b and a <= t <= b]
        want[n] = min(hits)[1] if hits else None
    got = note_stays(
        spark.createDataFrame(notes, "note_id int, HADM_ID int, CHARTTIME timestamp"),
        spark.createDataFrame(stays, "ICUSTAY_ID int, HADM_ID int, INTIME timestamp, OUTTIME timestamp"),
    )
    rows = got.collect()
    assert len(rows) == len(notes) and {r.note_id: r.ICUSTAY_ID for r in rows} == want


def test_header_line_starts(spark):
    from wardlight.functions.text import header_pattern, raw_sections

    texts = ["intro\rPlan: a", "intro\u2028Plan: a", "intro\nPlan\u00a0: a", "intro\nPlan: a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.orderBy("i").select(raw_sections(F.col("t"), header_pattern(("Plan",))).alias("s")).collect()
    assert [len(r.s) for r in got] == [1, 1, 2, 2]
