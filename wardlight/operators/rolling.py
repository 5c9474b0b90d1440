"""Worst value of each feature in the trailing 24 hours, at every hour of a stay."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlight.functions.times import hour_index, plus_hours
from wardlight.operators.joins import within

LOOK_BACK_HOURS = 24


class Feature(NamedTuple):
    source: str
    worst: str


# Feature -> where it comes from and which extreme is the worst.
FEATURES: dict[str, Feature] = {
    "map": Feature("vital", "min"),
    "gcs": Feature("vital", "min"),
    "spo2": Feature("vital", "min"),
    "creatinine": Feature("lab", "max"),
    "bilirubin": Feature("lab", "max"),
    "platelet": Feature("lab", "min"),
    "pao2": Feature("lab", "min"),
    "fio2": Feature("lab", "min"),
}

_WORST = {"min": F.min, "max": F.max}

# A stay is cut into blocks of this many hours, so a very long stay is many tasks.
BLOCK_HOURS = 24 * 7


def scored_spans(stays: DataFrame, look_back: int = LOOK_BACK_HOURS) -> DataFrame:
    """Stays long enough for one window, with the index of their last window.

    Window j covers hours ``[j, j + look_back)`` after INTIME. The length is taken
    in microseconds, so a stay a fraction short of the minimum is left out.
    """
    return (
        stays.select("ICUSTAY_ID", "HADM_ID", "INTIME", "OUTTIME")
        .withColumn("last", hour_index(F.col("OUTTIME"), F.col("INTIME")) - look_back)
        .filter(F.col("last") >= 0)
        .drop("OUTTIME")
    )


def score_spine(stays: DataFrame, look_back: int = LOOK_BACK_HOURS) -> DataFrame:
    """One row per stay and hourly window, from INTIME + look_back up to OUTTIME."""
    return _with_window(
        scored_spans(stays, look_back).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("last")))),
        look_back,
    ).select("ICUSTAY_ID", "HADM_ID", "score_window_start", "score_window_end")


def _with_window(df: DataFrame, look_back: int) -> DataFrame:
    return df.withColumns(
        {
            "score_window_start": plus_hours(F.col("INTIME"), F.col("k")),
            "score_window_end": plus_hours(F.col("INTIME"), F.col("k") + look_back),
        }
    )


def _of(features: dict[str, Feature], source: str) -> list[str]:
    return [name for name, f in features.items() if f.source == source]


def hourly_points(
    spans: DataFrame,
    vitals: DataFrame,
    labs: DataFrame,
    features: dict[str, Feature],
    look_back: int = LOOK_BACK_HOURS,
) -> DataFrame:
    """Measurements as ``(ICUSTAY_ID, INTIME, k, name, value)`` that some window can see.

    Vitals enter at the start of their clock hour, labs at their own time. A lab
    belongs to an admission and counts for each of its stays; the admission join
    is a plain join, which adaptive execution splits when an admission has many rows.
    """
    vital_points = (
        vitals.filter(F.col("vital_name").isin(_of(features, "vital")))
        .select(
            "ICUSTAY_ID",
            F.col("hour_bucket").alias("t"),
            F.col("vital_name").alias("name"),
            F.col("mean_val").alias("value"),
        )
        .join(spans.drop("HADM_ID"), "ICUSTAY_ID")
    )
    lab_points = (
        labs.filter(F.col("lab_name").isin(_of(features, "lab")))
        .select(
            "HADM_ID",
            F.col("CHARTTIME").alias("t"),
            F.col("lab_name").alias("name"),
            F.col("VALUENUM").alias("value"),
        )
        .join(spans, "HADM_ID")
    )
    return _visible(vital_points, look_back).unionByName(_visible(lab_points, look_back))


def _visible(points: DataFrame, look_back: int) -> DataFrame:
    return (
        points.withColumn("k", hour_index(F.col("t"), F.col("INTIME")))
        .filter((F.col("k") >= 0) & (F.col("k") < F.col("last") + look_back))
        .select("ICUSTAY_ID", "INTIME", "k", "name", "value")
    )


def rolling_worst(
    stays: DataFrame,
    vitals: DataFrame,
    labs: DataFrame,
    features: dict[str, Feature] | None = None,
    look_back: int = LOOK_BACK_HOURS,
    block_hours: int = BLOCK_HOURS,
) -> DataFrame:
    """Every window of every stay with the worst value of each feature (NULL if none).

    Equal to joining each window with the measurements inside it, feature by
    feature, but one pass: (1) reduce measurements and window starts to one row
    per stay and hour, which combines before the shuffle; (2) slide a 24-row range
    over the hours. For (2) a stay is cut into blocks; rows in the first 23 hours
    of a block are also given to the block before it, whose windows reach them. So
    the work of one task is bounded by the block length, not by the stay.
    """
    features = FEATURES if features is None else features
    if block_hours < look_back:
        raise ValueError("block_hours must not be shorter than look_back")
    spans = scored_spans(stays, look_back)
    points = hourly_points(spans, vitals, labs, features, look_back)
    starts = spans.select(
        "ICUSTAY_ID", "INTIME", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("k")
    )
    per_hour = (
        points.withColumn("scored", F.lit(0))
        .unionByName(starts.withColumn("scored", F.lit(1)), allowMissingColumns=True)
        .groupBy("ICUSTAY_ID", "INTIME", "k")
        .agg(
            F.max("scored").alias("scored"),
            *[
                _WORST[f.worst](F.when(F.col("name") == name, F.col("value"))).alias(name)
                for name, f in features.items()
            ],
        )
    )

    own = F.floor(F.col("k") / block_hours).cast("int")
    seen_before = (F.col("k") % block_hours < look_back - 1) & (own > 0)
    in_blocks = per_hour.withColumn(
        "block", F.explode(F.when(seen_before, F.array(own, own - 1)).otherwise(F.array(own)))
    )
    ahead = (
        Window.partitionBy("ICUSTAY_ID", "block").orderBy("k").rangeBetween(0, look_back - 1)
    )
    rolled = in_blocks.select(
        "ICUSTAY_ID",
        "INTIME",
        "k",
        ((F.col("scored") == 1) & (F.col("block") == own)).alias("wanted"),
        *[_WORST[f.worst](F.col(name)).over(ahead).alias(name) for name, f in features.items()],
    ).filter("wanted")
    return _with_window(rolled, look_back).select(
        "ICUSTAY_ID", "score_window_end", "score_window_start", *features
    )


def worst_by_interval_join(
    spine: DataFrame,
    series: DataFrame,
    key: str,
    name: str,
    worst: str,
) -> DataFrame:
    """One feature by joining windows with the measurements inside them.

    ``series`` holds ``(key, name, t, value)``. Each measurement meets up to 24
    windows, so this is for checks and small data; ``rolling_worst`` gives the same.
    """
    return (
        spine.join(series.filter(F.col("name") == name).select(key, "t", "value"), key)
        .filter(within(F.col("t"), F.col("score_window_start"), F.col("score_window_end")))
        .groupBy("ICUSTAY_ID", "score_window_end")
        .agg(_WORST[worst]("value").alias(name))
    )
