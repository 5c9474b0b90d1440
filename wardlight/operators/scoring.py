"""Scores per window, and the reports and alerts made from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlight.functions.scores import LADDERS, alert_flag, organ_score, oxygen_ratio, risk_tier
from wardlight.operators.rolling import FEATURES, LOOK_BACK_HOURS, rolling_worst

SUB_SCORES = tuple(f"sofa_{organ}" for organ in LADDERS)
ALERT_COLUMNS = ("ICUSTAY_ID", "score_window_end", "sofa_total", "risk_tier", *SUB_SCORES)

DEFAULT_TOP_K = 10
MAX_TOP_K = 50


def with_scores(features: DataFrame, missing: str = "worst") -> DataFrame:
    """Add the oxygen ratio, six sub-scores, total, tier, alert flag and gaps."""
    used = [ladder.feature for ladder in LADDERS.values()]
    rated = features.withColumn(
        "pao2_fio2", oxygen_ratio(F.col("pao2"), F.col("fio2"))
    ).withColumns(
        {
            **{
                f"sofa_{organ}": organ_score(organ, F.col(ladder.feature), missing)
                for organ, ladder in LADDERS.items()
            },
            "n_missing": sum((F.col(c).isNull().cast("int") for c in used), F.lit(0)),
        }
    )
    total = sum((F.col(c) for c in SUB_SCORES[1:]), F.col(SUB_SCORES[0]))
    return rated.withColumn("sofa_total", total).withColumns(
        {
            "risk_tier": F.when(F.col("sofa_total").isNotNull(), risk_tier(F.col("sofa_total"))),
            "sepsis_alert": alert_flag(F.col("sofa_total")),
        }
    )


def sofa_scores(
    stays: DataFrame,
    vitals: DataFrame,
    labs: DataFrame,
    missing: str = "worst",
    look_back: int = LOOK_BACK_HOURS,
) -> DataFrame:
    """One scored row per stay and hourly window."""
    return with_scores(rolling_worst(stays, vitals, labs, FEATURES, look_back), missing)


def tier_distribution(scores: DataFrame) -> DataFrame:
    return (
        scores.groupBy("risk_tier")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("sofa_total").alias("avg_sofa"),
            F.max("sofa_total").alias("max_sofa"),
        )
        .orderBy(F.col("avg_sofa").desc(), "risk_tier")
    )


def top_risk(scores: DataFrame, k: int = 10) -> DataFrame:
    """The k windows with the highest totals."""
    return scores.orderBy(F.col("sofa_total").desc(), "ICUSTAY_ID", "score_window_end").limit(k)


def latest_alerts(scores: DataFrame) -> DataFrame:
    """Latest window of each stay among its alerting windows.

    Only rank 1 is kept, so each input task sends one row per stay.
    """
    newest = Window.partitionBy("ICUSTAY_ID").orderBy(F.col("score_window_end").desc())
    return (
        scores.filter(F.col("sepsis_alert") == 1)
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .select(*ALERT_COLUMNS)
    )


def check_top_k(k: int) -> int:
    if not 1 <= k <= MAX_TOP_K:
        raise ValueError(f"top_k must be between 1 and {MAX_TOP_K}")
    return k


def risk_list(
    alerts: DataFrame, tiers: Sequence[str] | None = None, top_k: int = DEFAULT_TOP_K
) -> DataFrame:
    """Alerts by total, highest first; an empty tier list means every tier."""
    if tiers:
        alerts = alerts.filter(F.col("risk_tier").isin(list(tiers)))
    return alerts.orderBy(F.col("sofa_total").desc(), "ICUSTAY_ID").limit(check_top_k(top_k))


def high_risk_view(alerts: DataFrame, chunks: DataFrame) -> DataFrame:
    """High and critical alerts with the number of stored note chunks of the stay."""
    counted = chunks.groupBy("ICUSTAY_ID").agg(F.count(F.lit(1)).alias("embedded_note_chunks"))
    return (
        alerts.filter(F.col("risk_tier").isin("high", "critical"))
        .join(counted, "ICUSTAY_ID", "left")
        .withColumn("embedded_note_chunks", F.coalesce("embedded_note_chunks", F.lit(0)))
        .orderBy(F.col("sofa_total").desc(), "ICUSTAY_ID")
    )


def by_week(scores: DataFrame) -> DataFrame:
    """Add ``_week`` and what a row needs to know of earlier weeks of its stay.

    ``_low_before`` is the lowest total of all earlier weeks, ``_last_before`` the last total of the
    week before that has rows. Each week is reduced to one row first, so no task holds more of a stay
    than a row per week, or the hours of one week. Rows without a stay or window end are left out.
    """
    keyed = scores.filter(F.col("ICUSTAY_ID").isNotNull() & F.col("score_window_end").isNotNull()).withColumn(
        "_week", F.date_trunc("week", "score_window_end")
    )
    weeks = Window.partitionBy("ICUSTAY_ID").orderBy("_week")
    history = (
        keyed.groupBy("ICUSTAY_ID", "_week")
        .agg(F.min("sofa_total").alias("_low"), F.max_by("sofa_total", "score_window_end").alias("_last"))
        .select(
            "ICUSTAY_ID",
            "_week",
            F.min("_low").over(weeks.rowsBetween(Window.unboundedPreceding, -1)).alias("_low_before"),
            F.lag("_last").over(weeks).alias("_last_before"),
        )
    )
    return keyed.join(history, ["ICUSTAY_ID", "_week"])


def baseline_delta(scores: DataFrame, rise: int = 2) -> DataFrame:
    """Rise of the total over the lowest earlier total of the stay, and its alert."""
    in_week = Window.partitionBy("ICUSTAY_ID", "_week").orderBy("score_window_end")
    earlier = F.min("sofa_total").over(in_week.rowsBetween(Window.unboundedPreceding, -1))
    delta = F.col("sofa_total") - F.col("baseline")
    return (
        by_week(scores)
        .withColumn("baseline", F.least(earlier, "_low_before"))
        .drop("_week", "_low_before", "_last_before")
        .withColumns({"rise": delta, "rise_alert": F.coalesce((delta >= rise).cast("int"), F.lit(0))})
    )


def timeline_weeks(scores: DataFrame) -> DataFrame:
    """Per stay and week the ordered windows with total, tier and change since the last one."""
    in_week = Window.partitionBy("ICUSTAY_ID", "_week").orderBy("score_window_end")
    place, last = F.row_number().over(in_week), F.lag("sofa_total").over(in_week)
    steps = by_week(scores).select(
        "ICUSTAY_ID",
        "_week",
        "score_window_end",
        "sofa_total",
        "risk_tier",
        (F.col("sofa_total") - F.when(place == 1, F.col("_last_before")).otherwise(last)).alias("change"),
    )
    return steps.groupBy("ICUSTAY_ID", F.col("_week").alias("week_start")).agg(
        F.sort_array(
            F.collect_list(F.struct("score_window_end", "sofa_total", "risk_tier", "change"))
        ).alias("timeline"),
        F.count(F.lit(1)).alias("windows"),
        F.min("sofa_total").alias("lowest_total"),
        F.max("sofa_total").alias("peak_total"),
    )


def patient_timeline(scores: DataFrame) -> DataFrame:
    """The weeks of a stay in one row: the ordered windows of all of them.

    Use timeline_weeks where a stay may be too long for one row.
    """
    weeks = F.sort_array(F.collect_list(F.struct("week_start", "timeline")))
    return (
        timeline_weeks(scores)
        .groupBy("ICUSTAY_ID")
        .agg(
            F.flatten(F.transform(weeks, lambda w: w["timeline"])).alias("timeline"),
            F.sum("windows").alias("windows"),
            F.min("lowest_total").alias("lowest_total"),
            F.max("peak_total").alias("peak_total"),
        )
    )
