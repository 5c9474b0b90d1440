"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import cut_lineage

ROWS_PER_PART = 200_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's least neighbour (or itself)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    larger = both.filter(F.col("b") > F.col("a"))
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang the smaller neighbours of a node, and the node, on the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _few(edges: DataFrame, n: int) -> DataFrame:
    """Written edges in parts of about ROWS_PER_PART: a round's files and blocks follow their number."""
    return cut_lineage(edges.coalesce(max(1, -(-n // ROWS_PER_PART))))


def components(edges: DataFrame) -> DataFrame:
    """Rows of ``node`` and ``root`` (its component's least node) for nodes with an edge.

    ``edges``: columns a and b, comparable, not NULL. Each step is a grouping and a plain join;
    a round never makes more edges than there were. Ends when every node hangs on its root.
    """
    down = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).alias("e")
    now = cut_lineage(edges.filter("a != b").select(down).select("e.*").distinct())
    print_of = [F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")]
    mark = now.agg(*print_of).first()
    now = now.coalesce(max(1, -(-mark.n // ROWS_PER_PART)))
    while True:
        hung = _few(_large_star(now), mark.n)  # a row per edge, some of them equal
        now = _few(_small_star(hung).distinct(), mark.n)
        after = now.agg(*print_of).first()
        if after == mark:
            break
        mark = after
    hung = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return hung.union(roots)
