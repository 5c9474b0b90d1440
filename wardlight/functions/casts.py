"""Casts that turn bad input into NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column


def lenient(col: Column, to: str) -> Column:
    """``'1.0'`` counts as the integer 1, so integers go through double."""
    if to in ("int", "bigint"):
        return col.try_cast("double").try_cast(to)
    return col.try_cast(to)
