"""Exact interpolated percentiles by counting, without gathering or ordering a group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 20_000
# Value ranges that the values around a sought rank are counted in.
RANGES = 4_096


def exact_percentiles(
    df: DataFrame, groups: list[str], value: str, probs: dict[str, float], accuracy: int = ACCURACY
) -> DataFrame:
    """One row per group with a linearly interpolated percentile per entry of ``probs``.

    The built-in exact ``percentile`` keeps every distinct value of a group in one buffer. Here ranks
    are selected by counting. A bounded sketch tells about where each rank lies; the values around it
    are counted in ``RANGES`` equal ranges, all others in one range below and one above. Prefix sums
    over the ranges give the one that holds a rank, and only its values are counted one by one in a
    second pass: some ten-millionths of a large group per percentile. Counts combine before each
    shuffle. The ranges cover every value, so the result is exact however good the sketch is.

    NaN is left out, as NULL is, and so are rows whose group is NULL.
    """
    base = df.select(*groups, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    slack = 2.0 / accuracy
    edges = [min(max(p + side * slack, 0.0), 1.0) for p in probs.values() for side in (-1, 1)]
    sketch = base.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", edges, accuracy).alias("_edges")
    )
    # Each part grows with the value, and so does their sum: a range is a run of neighbouring values.
    part = reduce(Column.__add__, (_range_of(F.col("_v"), _edge(2 * i), _edge(2 * i + 1)) for i in range(len(probs))))

    ranks: list[Column] = []
    for p in probs.values():
        below = F.floor(F.lit(p) * (F.col("_n") - 1))
        ranks += [below, F.least(below + 1, F.col("_n") - 1)]

    counted = base.join(sketch, groups).groupBy(*groups, "_n", part.alias("_part")).agg(F.count(F.lit(1)).alias("_c"))
    ranges = _with_places(counted, groups, "_part").groupBy(*groups, "_n").agg(
        *[F.max(F.when(_holds(r), F.struct("_part", "_before"))).alias(f"_at{j}") for j, r in enumerate(ranks)]
    )
    sought = sketch.drop("_n").join(ranges, groups)
    wanted = F.array_contains(F.array(*(F.col(f"_at{j}._part") for j in range(len(ranks)))), part)
    known = ["_n", *(f"_at{j}" for j in range(len(ranks)))]  # one value per group, carried along
    inside = base.join(sought, groups).filter(wanted).groupBy(*groups, *known, part.alias("_part"), "_v").agg(
        F.count(F.lit(1)).alias("_c")
    )
    placed = _with_places(inside, [*groups, "_part"], "_v")
    found = placed.groupBy(*groups, "_n").agg(
        *[
            F.max(F.when((F.col("_part") == F.col(f"_at{j}._part")) & _holds(r - F.col(f"_at{j}._before")), F.col("_v"))).alias(f"_x{j}")
            for j, r in enumerate(ranks)
        ]
    )

    def interpolate(i: int, p: float) -> Column:
        a, b = F.col(f"_x{2 * i}"), F.col(f"_x{2 * i + 1}")
        position = F.lit(p) * (F.col("_n") - 1)
        return a + (b - a) * (position - F.floor(position))

    return found.select(*groups, *[interpolate(i, p).alias(n) for i, (n, p) in enumerate(probs.items())])


def _edge(i: int) -> Column:
    return F.col("_edges")[i]


def _range_of(v: Column, low: Column, high: Column) -> Column:
    """Number of the range that holds a value: -1 below, RANGES above, equal widths between.

    Halves keep the differences finite; between infinite ends all values share one range.
    """
    width = high / 2 - low / 2
    share = F.when(width > 0, F.nanvl((v / 2 - low / 2) / width, F.lit(0.5))).otherwise(F.lit(0.0))
    inner = F.least(F.floor(share * RANGES), F.lit(RANGES - 1).cast("long"))
    return (
        F.when(v < low, F.lit(-1).cast("long"))
        .when(v > high, F.lit(RANGES).cast("long"))
        .when(v == low, F.lit(0).cast("long"))
        .when(v == high, F.lit(RANGES - 1).cast("long"))
        .otherwise(inner)
    )


def _with_places(counts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add how many values come before, and up to, the ones counted in a row."""
    upto = F.sum("_c").over(Window.partitionBy(*keys).orderBy(order))
    return counts.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_c"))


def _holds(rank: Column) -> Column:
    return (rank >= F.col("_before")) & (rank < F.col("_upto"))
