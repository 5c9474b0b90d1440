"""The one-pass rolling form against joining windows with measurements."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardlight.operators import rolling, scoring

T0 = dt.datetime(2024, 3, 1, 5, 17, 23, 456789)
H = dt.timedelta(hours=1)
US = dt.timedelta(microseconds=1)


def frames(spark, stays, vitals, labs):
    return (
        spark.createDataFrame(stays, "ICUSTAY_ID int, HADM_ID int, INTIME timestamp, OUTTIME timestamp"),
        spark.createDataFrame(vitals, "ICUSTAY_ID int, hour_bucket timestamp, vital_name string, mean_val double"),
        spark.createDataFrame(labs, "HADM_ID int, CHARTTIME timestamp, lab_name string, VALUENUM double"),
    )


def expected(stays, vitals, labs):
    """Windows and worst values by plain loops."""
    out = {}
    for stay, hadm, start, end in stays:
        k = 0
        while start + (24 + k) * H <= end:
            a, b = start + k * H, start + (24 + k) * H
            row = {}
            for name, feature in rolling.FEATURES.items():
                if feature.source == "vital":
                    seen = [v for s, t, n, v in vitals if s == stay and n == name and a <= t < b]
                else:
                    seen = [v for h, t, n, v in labs if h == hadm and n == name and a <= t < b]
                row[name] = (min if feature.worst == "min" else max)(seen) if seen else None
            out[stay, b] = row
            k += 1
    return out


def actual(df):
    return {
        (r.ICUSTAY_ID, r.score_window_end.replace(tzinfo=None)): {n: r[n] for n in rolling.FEATURES}
        for r in df.collect()
    }


def random_case(seed):
    rng = random.Random(seed)
    stays = [
        (1, 10, T0, T0 + 24 * H),
        (2, 10, T0 + 30 * H, T0 + 90 * H + US),
        (3, 11, T0, T0 + 24 * H - US),
        (4, 12, T0, T0 + 400 * H),
        (5, 13, T0, None),
        (6, 14, T0, T0 - H),
    ]
    vital = [n for n, f in rolling.FEATURES.items() if f.source == "vital"]
    lab = [n for n, f in rolling.FEATURES.items() if f.source == "lab"]
    when = lambda: T0 + rng.uniform(-30, 430) * H
    vitals = [
        (rng.choice([1, 2, 3, 4]), when().replace(minute=0, second=0, microsecond=0), rng.choice(vital), rng.uniform(3, 100))
        for _ in range(250)
    ]
    labs = [(rng.choice([10, 11, 12]), when(), rng.choice(lab), rng.uniform(0, 300)) for _ in range(250)]
    return stays, vitals, labs


@pytest.mark.parametrize("seed, block", [(1, 168), (2, 24), (3, 50)])
def test_rolling_equals_loops(spark, seed, block):
    stays, vitals, labs = random_case(seed)
    got = actual(rolling.rolling_worst(*frames(spark, stays, vitals, labs), block_hours=block))
    assert got == expected([s for s in stays if s[3]], vitals, labs)


def test_window_edges_and_lab_fan_out(spark):
    stays = [(1, 10, T0, T0 + 25 * H), (2, 10, T0, T0 + 24 * H)]
    labs = [
        (10, T0, "platelet", 100.0),
        (10, T0 + 24 * H, "platelet", 50.0),
        (10, T0 - US, "platelet", 1.0),
        (10, T0 + 25 * H, "platelet", 2.0),
    ]
    got = actual(rolling.rolling_worst(*frames(spark, stays, [], labs)))
    values = {k: v["platelet"] for k, v in got.items()}
    assert values == {(1, T0 + 24 * H): 100.0, (1, T0 + 25 * H): 50.0, (2, T0 + 24 * H): 100.0}


def test_rolling_equals_interval_join(spark):
    stays, vitals, labs = random_case(5)
    s, v, m = frames(spark, stays, vitals, labs)
    rolled = rolling.rolling_worst(s, v, m)
    spine = rolling.score_spine(s)
    series = v.select("ICUSTAY_ID", F.col("hour_bucket").alias("t"), F.col("vital_name").alias("name"), F.col("mean_val").alias("value"))
    joined = rolling.worst_by_interval_join(spine, series, "ICUSTAY_ID", "map", "min")
    ours = rolled.filter("map IS NOT NULL").select("ICUSTAY_ID", "score_window_end", "map")
    assert ours.exceptAll(joined).count() == 0 and joined.exceptAll(ours).count() == 0


def test_every_window_is_scored(spark):
    stays, vitals, labs = random_case(6)
    s, v, m = frames(spark, stays, vitals, labs)
    scores = scoring.sofa_scores(s, v, m)
    assert scores.count() == rolling.score_spine(s).count()
    empty = scoring.sofa_scores(s, v.limit(0), m.limit(0)).select("sofa_total", "risk_tier", "n_missing").distinct().collect()
    assert [tuple(r) for r in empty] == [(21, "critical", 6)]
    normal = scoring.sofa_scores(s, v.limit(0), m.limit(0), missing="normal").select("sofa_total", "sepsis_alert").distinct()
    assert [tuple(r) for r in normal.collect()] == [(0, 0)]


def test_no_range_join_in_the_plan(spark):
    s, v, m = frames(spark, *random_case(7))
    plan = rolling.rolling_worst(s, v, m)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_latest_alert_is_the_latest_alerting_window(spark):
    cols = "ICUSTAY_ID int, score_window_end timestamp, sofa_total int, risk_tier string, sepsis_alert int"
    rows = [(1, T0, 8, "moderate", 1), (1, T0 + H, 1, "low", 0), (2, T0, 1, "low", 0)]
    df = spark.createDataFrame(rows, cols)
    for c in scoring.SUB_SCORES:
        df = df.withColumn(c, F.lit(1))
    got = scoring.latest_alerts(df).collect()
    assert [(r.ICUSTAY_ID, r.sofa_total) for r in got] == [(1, 8)]
    assert "WindowGroupLimit" in scoring.latest_alerts(df)._jdf.queryExecution().executedPlan().toString()


def test_baseline_and_timeline(spark):
    totals = [5, 3, 4, 6, 3]
    rows = [(1, T0 + i * H, t, "low") for i, t in enumerate(totals)]
    df = spark.createDataFrame(rows, "ICUSTAY_ID int, score_window_end timestamp, sofa_total int, risk_tier string")
    out = scoring.baseline_delta(df).orderBy("score_window_end").collect()
    assert [(r.baseline, r.rise, r.rise_alert) for r in out] == [(None, None, 0), (5, -2, 0), (3, 1, 0), (3, 3, 1), (3, 0, 0)]
    line = scoring.patient_timeline(df).first()
    assert [s.sofa_total for s in line.timeline] == totals
    assert [s.change for s in line.timeline] == [None, -2, 1, 2, -3]
    assert (line.windows, line.lowest_total, line.peak_total) == (5, 3, 6)


def test_risk_list_bounds_and_empty_filter(spark):
    rows = [(i, i, "low" if i < 3 else "high") for i in range(6)]
    df = spark.createDataFrame(rows, "ICUSTAY_ID int, sofa_total int, risk_tier string")
    assert [r.ICUSTAY_ID for r in scoring.risk_list(df, [], 2).collect()] == [5, 4]
    assert [r.ICUSTAY_ID for r in scoring.risk_list(df, ["low"], 50).collect()] == [2, 1, 0]
    for bad in (0, 51, 100):
        with pytest.raises(ValueError):
            scoring.risk_list(df, None, bad)


def test_a_stay_of_many_years(spark):
    """200,000 hours of one stay: no window is over more than a week of rows, or a row per week."""
    hours = 200_000
    total = F.pmod(F.xxhash64("id"), F.lit(20)).cast("int")
    scores = spark.range(hours, numPartitions=8).select(
        F.lit(1).alias("ICUSTAY_ID"),
        F.timestamp_seconds(F.col("id") * 3600).alias("score_window_end"),
        total.alias("sofa_total"),
        F.lit("low").alias("risk_tier"),
    )
    rows = scores.orderBy("score_window_end").collect()
    got = scoring.baseline_delta(scores).orderBy("score_window_end").collect()
    low = None
    for before, r in zip(rows, got):
        assert (r.baseline, r.sofa_total) == (low, before.sofa_total)
        low = r.sofa_total if low is None else min(low, r.sofa_total)
    weeks = scoring.timeline_weeks(scores)
    assert weeks.agg(F.max("windows"), F.sum("windows"), F.max(F.size("timeline"))).first()[:] == (168, hours, 168)
    steps = [s for r in weeks.orderBy("week_start").collect() for s in r.timeline]
    assert [s.change for s in steps] == [None, *(b.sofa_total - a.sofa_total for a, b in zip(rows, rows[1:]))]
    for made in (scoring.baseline_delta(scores), scoring.timeline_weeks(scores)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
        assert windows and all("_week" in line for line in windows)
