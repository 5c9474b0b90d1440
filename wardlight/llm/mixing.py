"""Mixing sources to target weights by capped water-filling and seeded sampling.

Every source asks for its share of the budget by weight, but gets at most ``max_epochs`` times
its own size. What a full source cannot take goes to the others by weight, until none is above
its limit. The full sources are those with the least limit per weight, so one pass over the
sources in that order replaces the repeated clamping.

A source then gives ``floor(target / size)`` whole repetitions of all its documents and a
fractional repetition: documents in a seeded hash order, as far as the rest of the quota goes;
the document at the end of the rest is taken in part.

Defined cases: NULL and empty texts have size 0 and take nothing. A NULL source is a source of
its own, the last in order. Sources of size 0 get target 0. Repeated rows count one by one; rows
with equal id, size and text are alike, so their order does not matter. An empty table gives an
empty result. Columns of the input that share a name with an output column are replaced.

A source may hold any share of the rows: its documents are dealt over 4,096 hash ranges, sums
per range are combined before the shuffle, and each range is ordered by itself. Only the table
of sources (one row each) is ordered as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.llm.common import whole_text

MAX_EPOCHS = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
RANGE_DIGITS = 3  # hex digits, so 4,096 ranges


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, .. ``cycle``, repeating, by code point of the source, NULL last."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    return sources.withColumn("weight", (F.row_number().over(order) - 1) % cycle + 1)


def water_fill(
    sources: DataFrame, max_epochs: int = MAX_EPOCHS, budget: Column | None = None
) -> DataFrame:
    """Add ``target`` to rows of source, source_size (long) and weight (a whole number).

    All sums are whole numbers and each target is one division, so any engine gets the same.
    """
    everything = W.partitionBy()
    order = W.orderBy(
        F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()
    ).rowsBetween(W.unboundedPreceding, -1)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(order), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(order), F.lit(0)
    )
    fits = F.col("left") * F.col("weight") <= F.col("cap") * F.col("weight_left")
    # (money left, weight left) at the first source that is below its limit
    level = F.max(F.when(F.col("fits"), F.struct("weight_left", "left"))).over(everything)
    share = F.col("level.left") * F.col("weight") / F.col("level.weight_left")
    return (
        sources.withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn(
            "budget", F.sum("source_size").over(everything) if budget is None else budget
        )
        .withColumn("left", left)
        .withColumn("weight_left", weight_left)
        .withColumn("fits", fits)
        .withColumn("level", level)
        .withColumn(
            "target",
            F.when(F.coalesce(F.col("weight_left") <= F.col("level.weight_left"), F.lit(False)), share)
            .otherwise(F.col("cap"))
            .cast("double"),
        )
        .select("source", "source_size", "weight", "target")
    )


def mix(docs: DataFrame, seed: str = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """All rows and columns of ``docs`` with size, source_size, target, repeats, part and taken.

    ``repeats`` is the number of whole repetitions, ``part`` the words of one more that are
    taken, and ``taken`` is ``repeats * size + part``.
    """
    tag = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    keyed = (
        docs.withColumn("size", word_count(whole_text()))
        .withColumn("__order", F.md5(tag))
        .withColumn("__text", F.xxhash64(whole_text()))
        .withColumn("__range", F.substring("__order", 1, RANGE_DIGITS))
    )
    ranges = keyed.groupBy("source", "__range").agg(F.sum("size").alias("range_size"))
    totals = ranges.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    targets = (
        water_fill(cyclic_weights(totals), max_epochs)
        .withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))
        .withColumn(
            "repeats",
            F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(0),
        )
        .withColumn("rest", F.col("quota") - F.col("repeats") * F.col("source_size"))
        .withColumnRenamed("source", "__of")
    )
    upto = W.partitionBy("source").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        ranges.withColumn("before", F.coalesce(F.sum("range_size").over(upto), F.lit(0)))
        .join(targets, F.col("source").eqNullSafe(F.col("__of")))
        .select(
            F.col("source").alias("__source"),
            F.col("__range").alias("__at"),
            *(F.col(c).alias(f"__{c}") for c in ("before", "source_size", "target", "repeats", "rest")),
        )
    )
    within = (
        W.partitionBy("source", "__range")
        .orderBy("__order", "doc_id", "size", "__text")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    room = F.col("__rest") - F.col("__before") - F.col("__inside")
    return (
        keyed.withColumn("__inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(
            starts,
            F.col("source").eqNullSafe(F.col("__source")) & (F.col("__range") == F.col("__at")),
        )
        .withColumn("source_size", F.col("__source_size"))
        .withColumn("target", F.col("__target"))
        .withColumn("repeats", F.col("__repeats"))
        .withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), room)).cast("long"))
        .withColumn("taken", F.col("repeats") * F.col("size") + F.col("part"))
        .select(
            *(c for c in docs.columns if c not in OUTPUTS),
            *OUTPUTS,
        )
    )


OUTPUTS = ("size", "source_size", "target", "repeats", "part", "taken")


def repeat_documents(docs: DataFrame) -> DataFrame:
    """The mix as rows: every document as often as it is taken, whole texts only.

    The one document per source that ends the rest counts as taken if at least half of it is.
    """
    copies = F.col("__repeats") + F.when(
        (F.col("__part") > 0) & (F.col("__part") * 2 >= F.col("__size")), 1
    ).otherwise(0)
    kept = docs.select(*(F.col(c).alias(f"in_{i}") if c in OUTPUTS else F.col(c) for i, c in enumerate(docs.columns)))
    mixed = mix(kept).withColumnsRenamed({c: f"__{c}" for c in OUTPUTS})
    back = [F.col(f"in_{i}").alias(c) if c in OUTPUTS else F.col(c) for i, c in enumerate(docs.columns)]
    return (
        mixed.withColumn("__copies", copies.cast("int"))
        .filter("__copies > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select(*back)
    )
