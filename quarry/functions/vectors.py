"""Vector column functions over ARRAY<FLOAT|DOUBLE> (V1, V2), evaluated in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.scalar import as_col


def as_double_array(c: str | Column) -> Column:
    return as_col(c).cast("array<double>")


def dot(a: str | Column, b: str | Column) -> Column:
    """V1: sum_i a_i * b_i (arrays of equal length)."""
    prod = F.zip_with(as_double_array(a), as_double_array(b), lambda x, y: x * y)
    return F.aggregate(prod, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: str | Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: str | Column, b: str | Column) -> Column:
    """V2: dot / (|a| |b|); null for a zero vector (ANSI mode raises on x / 0)."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))
