"""Vector arithmetic on ``array<float>`` columns, in double precision."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(
        F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    )


def cosine(a: Column, b: Column) -> Column:
    """1 minus the cosine distance; NULL when a vector is all zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def l2_normalise(v: Column) -> Column:
    """Unit vector; elements are NULL when the vector is all zero.

    The norm is computed once per row and carried along in a struct.
    """
    with_norm = F.transform(F.array(v), lambda u: F.struct(u.alias("u"), norm(u).alias("n")))
    return F.flatten(
        F.transform(
            with_norm,
            lambda s: F.transform(s["u"], lambda x: F.try_divide(x.cast("double"), s["n"])),
        )
    )


def to_text(v: Column, decimals: int = 8) -> Column:
    """``[0.10000000,0.20000000]``, the export form of a vector.

    Elements are rounded from their exact binary value, a tie to the even digit, as printf and
    Python do; the JVM's formatter rounds a shortened decimal, and ties away from zero.
    """

    @F.arrow_udf("string")
    def shown(vectors: pa.Array) -> pa.Array:
        flat = vectors.flatten()
        numbers = flat.to_pylist() if flat.null_count else flat.to_numpy(zero_copy_only=False).tolist()
        texts, start = [], 0
        for length in vectors.value_lengths().to_pylist():
            texts.append(None if length is None else number_list(numbers[start : start + length], decimals))
            start += length or 0
        return pa.array(texts, pa.string())

    return shown(v)


def number_list(numbers: Sequence[float | None], decimals: int) -> str:
    number = f"%.{decimals}f"
    if None in numbers:
        return f"[{','.join('null' if x is None else number % x for x in numbers)}]"
    return f"[{','.join([number] * len(numbers)) % tuple(numbers)}]"
