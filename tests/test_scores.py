"""Score ladders: values, exact boundaries, missing input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wardlight.functions import scores as sc

LADDER_CASES = [
    (sc.respiratory_score, [500, 400, 350, 300, 299, 200, 199, 100, 99.9, 80], [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]),
    (sc.coagulation_score, [200, 150, 149, 100, 99, 50, 49, 20, 15], [0, 0, 1, 1, 2, 2, 3, 3, 4]),
    (sc.liver_score, [0.8, 1.2, 1.5, 2.0, 3.0, 6.0, 8.0, 12.0, 15.0], [0, 1, 1, 2, 2, 3, 3, 4, 4]),
    (sc.cardiovascular_score, [90, 70, 69.9, 10], [0, 0, 1, 1]),
    (sc.cns_score, [15, 15.5, 14.5, 13, 10, 7, 6, 4], [0, 1, 1, 1, 2, 3, 3, 4]),
    (sc.renal_score, [0.9, 1.2, 1.5, 2.0, 2.8, 3.5, 4.2, 5.0, 6.0], [0, 1, 1, 2, 2, 3, 3, 4, 4]),
]


def apply(spark, score, values):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "i int, v double")
    return [r.s for r in df.select("i", score(F.col("v")).alias("s")).orderBy("i").collect()]


@pytest.mark.parametrize("score, values, expected", LADDER_CASES)
def test_ladder(spark, score, values, expected):
    assert apply(spark, score, values) == expected


@pytest.mark.parametrize("score, worst", [(c[0], 1 if c[0] is sc.cardiovascular_score else 4) for c in LADDER_CASES])
def test_missing_value(spark, score, worst):
    assert apply(spark, score, [None]) == [worst]
    assert apply(spark, lambda c: score(c, missing="normal"), [None]) == [0]
    assert apply(spark, lambda c: score(c, missing="null"), [None]) == [None]


def test_unknown_missing_rule():
    with pytest.raises(ValueError):
        sc.organ_score("resp", F.lit(1.0), missing="best")


def test_tiers(spark):
    got = apply(spark, sc.risk_tier, [0, 5, 6, 9, 10, 12, 13, 22])
    assert got == ["low", "low", "moderate", "moderate", "high", "high", "critical", "critical"]


def test_tier_rank_and_alert(spark):
    row = spark.range(1).select(
        sc.tier_rank(F.lit("low")).alias("low"),
        sc.tier_rank(F.lit("critical")).alias("critical"),
        sc.alert_flag(F.lit(1)).alias("off"),
        sc.alert_flag(F.lit(2)).alias("on"),
    ).first()
    assert (row.low, row.critical, row.off, row.on) == (0, 3, 0, 1)


def test_oxygen_ratio(spark):
    rows = [(90.0, 30.0), (90.0, 0.0), (90.0, None), (None, 30.0)]
    df = spark.createDataFrame(rows, "p double, f double")
    got = [r.r for r in df.select(sc.oxygen_ratio(F.col("p"), F.col("f")).alias("r")).collect()]
    assert got[0] == pytest.approx(300.0) and got[1:] == [None, None, None]
