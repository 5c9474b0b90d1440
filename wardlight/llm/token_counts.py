"""Token counts for every context limit from an exact histogram of encoded lengths.

Documents are aggregated by their number of tokens, before the shuffle and exactly. All later
answers come from that histogram, which has one row per length that occurs: documents and tokens
up to and from a length, the total when every document is cut at a limit (for a limit that no
document has, the row of the next smaller length tells ``truncated_total`` plus ``n_longer`` for
each token between), and the place of the length among all documents for quantiles.

The sums over longer documents run in two steps, within blocks of 256 lengths and over block
totals, so no task orders the whole histogram.

Defined cases: NULL and empty texts have length 0 and are counted. Repeated rows count one by
one. An empty table gives an empty histogram. Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.llm.byte_bpe import Tokenizer
from wardlight.llm.common import cut_lineage

BLOCK = 256


def length_histogram(docs: DataFrame, tokenizer: Tokenizer, text_col: str = "text") -> DataFrame:
    """One row per encoded length: ``n_tokens`` and ``n_docs``."""
    counted = docs.select(tokenizer.count(F.col(text_col)).alias("n_tokens"))
    return counted.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def context_table(histogram: DataFrame) -> DataFrame:
    """Per length L that occurs, as a context limit: what is below, above and cut.

    n_docs / tokens: documents of this length and their tokens; n_longer: documents longer than
    L; tokens_longer: their tokens; truncated_total: tokens left when all are cut at L;
    lost_tokens: tokens cut off; share_fitting: share of documents of at most L tokens (the
    least L with share_fitting >= q is the q quantile).
    """
    base = cut_lineage(histogram).withColumn("block", F.expr(f"n_tokens div {BLOCK}"))
    base = base.withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    later = W.orderBy(F.col("block").desc()).rowsBetween(W.unboundedPreceding, -1)
    blocks = (
        base.groupBy("block")
        .agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
        .select(
            "block",
            F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
            F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"),
            F.sum("d").over(W.partitionBy()).alias("all_docs"),
            F.sum("t").over(W.partitionBy()).alias("all_tokens"),
        )
    )
    inside = W.partitionBy("block").orderBy(F.col("n_tokens").desc())
    inside = inside.rowsBetween(W.unboundedPreceding, -1)
    n_longer = F.coalesce(F.sum("n_docs").over(inside), F.lit(0)) + F.col("docs_after")
    tokens_longer = F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("tokens_after")
    kept = F.col("all_tokens") - F.col("tokens_longer") + F.col("n_tokens") * F.col("n_longer")
    return (
        base.join(blocks, "block")
        .withColumn("n_longer", n_longer)
        .withColumn("tokens_longer", tokens_longer)
        .withColumn("truncated_total", kept)
        .withColumn("lost_tokens", F.col("all_tokens") - F.col("truncated_total"))
        .withColumn("share_fitting", (F.col("all_docs") - F.col("n_longer")) / F.col("all_docs"))
        .select(
            "n_tokens",
            "n_docs",
            "tokens",
            "n_longer",
            "tokens_longer",
            "truncated_total",
            "lost_tokens",
            "share_fitting",
        )
    )


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """The least length that covers each share of the documents: ``share`` and ``n_tokens``."""
    picks = [
        F.min(F.when(F.col("share_fitting") >= q, F.col("n_tokens"))).alias(f"q{i}")
        for i, q in enumerate(shares)
    ]
    pairs = [F.struct(F.lit(q).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, q in enumerate(shares)]
    return table.agg(*picks).select(F.inline(F.array(*pairs)))


def at_limits(table: DataFrame, limits: list[int]) -> DataFrame:
    """Totals for any context limits, from the row of the largest length not above each.

    A limit below every length cuts all documents to the limit itself.
    """
    picks = [
        F.max(F.when(F.col("n_tokens") <= m, F.struct("n_tokens", "truncated_total", "n_longer"))).alias(f"m{i}")
        for i, m in enumerate(limits)
    ]
    row = []
    for i, m in enumerate(limits):
        below = F.col(f"m{i}.truncated_total") + (m - F.col(f"m{i}.n_tokens")) * F.col(f"m{i}.n_longer")
        row.append(
            F.struct(
                F.lit(m).alias("limit"),
                F.coalesce(below, F.col("all_docs") * m, F.lit(0)).alias("truncated_total"),
                F.coalesce(F.col(f"m{i}.n_longer"), F.col("all_docs"), F.lit(0)).alias("n_longer"),
            )
        )
    return table.agg(*picks, F.sum("n_docs").alias("all_docs")).select(F.inline(F.array(*row)))
