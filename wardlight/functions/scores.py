"""Organ sub-scores, total, alert flag and risk tier."""

from __future__ import annotations

import operator
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Ladder(NamedTuple):
    """Ordered tests on one feature: the first that holds gives the score."""

    feature: str
    steps: tuple[tuple[str, float], ...]
    worst: int


# Organ -> feature, tests for scores 0, 1, 2, ..., score otherwise.
LADDERS: dict[str, Ladder] = {
    "resp": Ladder("pao2_fio2", ((">=", 400), (">=", 300), (">=", 200), (">=", 100)), 4),
    "coag": Ladder("platelet", ((">=", 150), (">=", 100), (">=", 50), (">=", 20)), 4),
    "liver": Ladder("bilirubin", (("<", 1.2), ("<", 2.0), ("<", 6.0), ("<", 12.0)), 4),
    "cardio": Ladder("map", ((">=", 70),), 1),
    "cns": Ladder("gcs", (("==", 15), (">=", 13), (">=", 10), (">=", 6)), 4),
    "renal": Ladder("creatinine", (("<", 1.2), ("<", 2.0), ("<", 3.5), ("<", 5.0)), 4),
}

# Highest total of each tier; anything above is critical.
TIER_LIMITS = (("low", 5), ("moderate", 9), ("high", 12))
TIERS = ("low", "moderate", "high", "critical")
ALERT_TOTAL = 2

_TESTS = {">=": operator.ge, "<": operator.lt, "==": operator.eq}
MISSING = ("worst", "normal", "null")


def organ_score(organ: str, value: Column, missing: str = "worst") -> Column:
    """Score of one organ.

    A missing value scores worst by default, as an unmeasured organ is treated
    as failing; ``missing="normal"`` scores it 0 and ``"null"`` leaves it open.
    """
    if missing not in MISSING:
        raise ValueError(f"missing must be one of {MISSING}")
    ladder = LADDERS[organ]
    chain = F
    if missing == "normal":
        chain = chain.when(value.isNull(), 0)
    elif missing == "null":
        chain = chain.when(value.isNull(), F.lit(None).cast("int"))
    for score, (test, cut) in enumerate(ladder.steps):
        chain = chain.when(_TESTS[test](value, F.lit(float(cut))), score)
    return chain.otherwise(ladder.worst).cast("int")


def respiratory_score(pao2_fio2: Column, missing: str = "worst") -> Column:
    return organ_score("resp", pao2_fio2, missing)


def coagulation_score(platelets: Column, missing: str = "worst") -> Column:
    return organ_score("coag", platelets, missing)


def liver_score(bilirubin: Column, missing: str = "worst") -> Column:
    return organ_score("liver", bilirubin, missing)


def cardiovascular_score(map_val: Column, missing: str = "worst") -> Column:
    return organ_score("cardio", map_val, missing)


def cns_score(gcs: Column, missing: str = "worst") -> Column:
    return organ_score("cns", gcs, missing)


def renal_score(creatinine: Column, missing: str = "worst") -> Column:
    return organ_score("renal", creatinine, missing)


def oxygen_ratio(pao2: Column, fio2: Column) -> Column:
    """PaO2 over the FiO2 fraction (FiO2 is in percent); NULL unless FiO2 > 0."""
    return F.when(fio2 > 0, pao2 / (fio2 / F.lit(100.0)))


def risk_tier(total: Column) -> Column:
    chain = F
    for tier, limit in TIER_LIMITS:
        chain = chain.when(total <= limit, tier)
    return chain.otherwise("critical")


def tier_rank(tier: Column) -> Column:
    """0 for low up to 3 for critical, for sorting by severity."""
    return F.array_position(F.array(*map(F.lit, TIERS)), tier).cast("int") - 1


def alert_flag(total: Column) -> Column:
    return (total >= ALERT_TOTAL).cast("int")
