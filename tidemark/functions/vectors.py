"""Vector expressions on ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null for a zero vector."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def as_doubles(a: Column) -> Column:
    return a.cast("array<double>")


def unit(a: Column) -> Column:
    """Scaled to length 1; a zero vector stays as it is.

    The factor is spread out as an array because a lambda body is evaluated for every element.
    """
    factor = F.coalesce(F.lit(1.0) / F.nullif(norm(a), F.lit(0.0)), F.lit(1.0))
    return F.zip_with(a, F.array_repeat(factor, F.size(a)), lambda x, f: x * f)
