"""Vector arithmetic on ``array<double>`` Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """NULL when a vector is all zeros."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def max_abs_difference(a: Column, b: Column) -> Column:
    """Largest per-dimension difference; NULL when the lengths differ."""
    gaps = F.zip_with(a, b, lambda x, y: F.abs(x - y))
    return F.when(F.size(a) == F.size(b), F.array_max(gaps))


def finite(vector: Column) -> Column:
    """Has numbers, and only finite ones."""
    return F.coalesce(
        (F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))
