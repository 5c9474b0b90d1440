"""Fill-in-the-middle: a text is cut at two units and put together in another order.

A unit is a word with the blanks before it, or a run of blanks at the end. One fullmatch of
``(unit)*`` by the regex library keeps every repetition of its group, so ``ends(1)`` gives the
number of units and both cut offsets at once. Units are matched possessively: the first way to
read a text is the only one, and nothing is kept for backtracking.

Two numbers of a seeded digest of the id give the cuts, two more the form: ``plain`` is the text,
``psm`` is prefix, suffix, middle and ``spm`` is suffix, prefix, middle, each part after its mark.
A text that is empty or holds a mark stays plain, so an output with marks can always be taken
apart again.

Defined cases: NULL counts as empty. A NULL id is the empty string in the digest. Rows are
independent of each other: repeated rows give equal rows, nothing is shuffled, and an empty table
gives an empty result. Other columns stay; those named as an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import each_text, small_batches, whole_text

SEED = "42"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE = 50  # per cent of texts that are cut
SPM_RATE = 80  # per cent of those in suffix-first form
BLANK = r"\x20\x09-\x0D"
UNITS = rf"([{BLANK}]*+[^{BLANK}]++|[{BLANK}]++)*+"
OUTPUTS = ("n", "form", "prefix_chars", "middle_chars", "output")

_match = regex.compile(UNITS).fullmatch


def unit_ends(text: str) -> list[int]:
    """Where each unit of a text ends."""
    return _match(text).ends(1)


def cuts(text: Column, one: Column, other: Column) -> Column:
    """Units of a text and both cut offsets, in code points, by two numbers taken modulo n + 1."""

    @F.arrow_udf("struct<n: long, first: long, second: long>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, ones, others in batches:
            counts, firsts, seconds = [], [], []
            for text, a, b in zip(each_text(texts), ones.to_pylist(), others.to_pylist()):
                ends = [0, *unit_ends(text)]
                low, high = sorted((a % len(ends), b % len(ends)))
                counts.append(len(ends) - 1)
                firsts.append(ends[low])
                seconds.append(ends[high])
            columns = [pa.array(x, pa.int64()) for x in (counts, firsts, seconds)]
            yield pa.StructArray.from_arrays(columns, ["n", "first", "second"])

    return cut(text, one, other)


def seeded_numbers(key: Column, seed: str, count: int = 4) -> list[Column]:
    """The first 8-digit groups of the hex sha256 of ``seed:key``, as unsigned integers."""
    tag = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digest = F.sha2(F.encode(tag, "UTF-8"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(count)]


def transform(
    docs: DataFrame, key: str = "doc_id", seed: str = SEED, rate: int = RATE, spm_rate: int = SPM_RATE
) -> DataFrame:
    """All rows and columns of ``docs`` with n, form, prefix_chars, middle_chars and output."""
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() not in OUTPUTS]
    h = seeded_numbers(F.col(key), seed)
    rows = docs.select(
        *kept, whole_text().alias("__text"), *(x.alias(f"__h{i}") for i, x in enumerate(h))
    ).withColumn("__cut", cuts(*map(F.col, ("__text", "__h0", "__h1"))))
    text, first, second = F.col("__text"), F.col("__cut.first"), F.col("__cut.second")
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(mark))
    form = (
        F.when((text == "") | marked | (F.col("__h2") % 100 >= rate), "plain")
        .when(F.col("__h3") % 100 < spm_rate, "spm")
        .otherwise("psm")
    )
    whole = F.length(text)
    prefix = F.substring(text, F.lit(1), first.cast("int"))
    middle = F.substring(text, (first + 1).cast("int"), (second - first).cast("int"))
    suffix = F.substring(text, (second + 1).cast("int"), (whole - second).cast("int"))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    cut = F.col("form") != "plain"
    return rows.withColumn("form", form).select(
        *kept,
        F.col("__cut.n").alias("n"),
        "form",
        F.when(cut, first).alias("prefix_chars"),
        F.when(cut, second - first).alias("middle_chars"),
        F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(text).alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. A cut text holds no mark, so each mark occurs once."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")  # nothing before the first mark
    return (
        F.when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
        .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
        .otherwise(output)
    )
