"""Text helpers: strip, counts, section split and overlapping windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Section headers of clinical notes.
SECTION_HEADERS = (
    "Chief Complaint",
    "History of Present Illness",
    "Past Medical History",
    "Social History",
    "Family History",
    "Review of Systems",
    "Physical Exam",
    "Assessment and Plan",
    "Assessment",
    "Plan",
    "Medications",
    "Allergies",
    "Discharge Diagnosis",
    "Discharge Condition",
    "Discharge Instructions",
    "Discharge Medications",
    "Laboratory Data",
    "Imaging",
    "Procedures",
    "Impression",
)

# 4 characters per token, chunks of 400 tokens, 80 of them shared.
CHARS_PER_TOKEN = 4
CHUNK_CHARS = 400 * CHARS_PER_TOKEN
OVERLAP_CHARS = 80 * CHARS_PER_TOKEN

# Every character that counts as blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Windows cut from one piece of a long text: see overlapping_windows.
_WINDOWS_PER_PIECE = 64


def header_pattern(headers: tuple[str, ...] = SECTION_HEADERS, colon: bool = True) -> str:
    """Zero-width match before every header at the start of a line.

    Only a line feed ends a line, and blanks are those of Unicode.
    """
    return rf"(?imdU)^(?=(?:{'|'.join(headers)}){r'\s*:' if colon else ''})"


def strip(text: Column) -> Column:
    """Trim by character set: looks at the ends only, unlike a pattern."""
    return F.btrim(text, F.lit(BLANKS))


def leading_blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.ltrim(text, F.lit(BLANKS)))


def word_count(text: Column) -> Column:
    r"""Pieces between runs of ``\s``; blanks at the ends add an empty piece."""
    return F.size(F.split(text, r"\s+"))


def token_estimate(text: Column) -> Column:
    return F.ceil(F.length(text) / CHARS_PER_TOKEN).cast("int")


def raw_sections(text: Column, pattern: str | None = None) -> Column:
    """``array<struct<body, start>>``: unstripped segments that add up to the text."""
    parts = F.split(text, pattern or header_pattern())
    return F.aggregate(
        parts,
        F.struct(
            F.array().cast("array<struct<body:string,start:int>>").alias("done"),
            F.lit(0).alias("at"),
        ),
        lambda acc, part: F.struct(
            F.array_append(
                acc["done"], F.struct(part.alias("body"), acc["at"].alias("start"))
            ).alias("done"),
            (acc["at"] + F.length(part)).alias("at"),
        ),
        lambda acc: acc["done"],
    )


def _blank_free(items: Column) -> Column:
    return F.filter(items, lambda w: w["text"] != "")


def overlapping_windows(
    text: Column, start: Column, size: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> Column:
    """``array<struct<text, start>>`` of stripped windows over a stripped text.

    Window i covers ``size`` characters from ``i * step``; the last is the first
    that reaches the end. A character position inside a UTF-8 string is found by
    walking from its front, so a long text is first cut into pieces of many
    windows each: the walk is then short and the cost does not grow with the
    square of the length.
    """
    step = size - overlap
    last = F.greatest(F.ceil((F.length(text) - size) / step), F.lit(0)).cast("int")
    piece_chars = step * _WINDOWS_PER_PIECE

    pieces = F.transform(
        F.sequence(F.lit(0), F.floor(last / _WINDOWS_PER_PIECE).cast("int")),
        lambda p: F.struct(
            (p * _WINDOWS_PER_PIECE).alias("first"),
            F.substring(text, p * piece_chars + 1, F.lit(piece_chars + overlap)).alias("body"),
        ),
    )

    def cut(piece: Column) -> Column:
        upto = F.least(last - piece["first"], F.lit(_WINDOWS_PER_PIECE - 1))
        raw = F.transform(
            F.sequence(F.lit(0), upto),
            lambda j: F.struct(
                F.substring(piece["body"], j * step + 1, F.lit(size)).alias("body"),
                ((piece["first"] + j) * step).alias("at"),
            ),
        )
        return F.transform(
            raw,
            lambda w: F.struct(
                strip(w["body"]).alias("text"),
                (start + w["at"] + leading_blanks(w["body"])).alias("start"),
            ),
        )

    return _blank_free(F.flatten(F.transform(pieces, cut)))


def note_chunks(
    text: Column,
    pattern: str | None = None,
    size: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> Column:
    """``array<struct<section, text, start>>`` for one note, in reading order.

    Sections up to ``size`` characters stay whole, longer ones become
    overlapping windows. Everything happens inside the row, so numbering the
    chunks of a note needs no shuffle.
    """
    trimmed = F.transform(
        raw_sections(text, pattern),
        lambda s: F.struct(
            strip(s["body"]).alias("text"),
            (s["start"] + leading_blanks(s["body"])).alias("start"),
        ),
    )
    return F.flatten(
        F.transform(
            _blank_free(trimmed),
            lambda s, i: F.transform(
                overlapping_windows(s["text"], s["start"], size, overlap),
                lambda w: F.struct(
                    i.alias("section"), w["text"].alias("text"), w["start"].alias("start")
                ),
            ),
        )
    )


def excerpt(text: Column, chars: int) -> Column:
    return F.substring(text, 1, chars)
