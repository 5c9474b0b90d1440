"""Time arithmetic in exact microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def hour_index(ts: Column, origin: Column) -> Column:
    """Whole hours from origin to ts, rounded down (so just before origin is -1)."""
    gap = micros(ts) - micros(origin)
    return ((gap - F.pmod(gap, F.lit(HOUR_US))) / HOUR_US).cast("int")


def plus_hours(ts: Column, hours: Column | int) -> Column:
    hours = hours if isinstance(hours, Column) else F.lit(hours)
    zero = F.lit(0)
    return ts + F.make_dt_interval(zero, hours.cast("int"), zero, zero.cast("decimal(18,6)"))


def elapsed_hours(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(float(HOUR_US))


def age_at(when: Column, born: Column, masked_above: int = 89, masked_as: float = 90.0) -> Column:
    """Age in years; ages above the privacy limit are all given as one value."""
    age = F.months_between(when, born) / 12
    return F.when(age > masked_above, F.lit(masked_as)).otherwise(age)


def within_last(ts: Column, as_of: Column, hours: int) -> Column:
    return ts >= as_of - F.expr(f"INTERVAL {int(hours)} HOURS")
