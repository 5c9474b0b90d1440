"""Range test shared by the interval joins."""

from __future__ import annotations

from pyspark.sql import Column


def within(t: Column, start: Column, end: Column) -> Column:
    """Half-open range test."""
    return (t >= start) & (t < end)
