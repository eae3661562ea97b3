"""Arithmetic on ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(total(F.transform(a, lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    """In [-1, 1]; null when either vector has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def squared_distance(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def unit(a: Column) -> Column:
    """Scale to length one; a zero vector stays as it is."""
    length = norm(a)
    return F.when(length == 0, a).otherwise(F.transform(a, lambda x: x / length))


def same_up_to_sign(a: Column, b: Column, tolerance: float = 1e-6) -> Column:
    """Element-wise equality of absolute values."""
    return F.forall(F.zip_with(a, b, lambda x, y: F.abs(F.abs(x) - F.abs(y)) <= tolerance), lambda ok: ok)


def non_negative(a: Column) -> Column:
    """Replace negative elements by zero."""
    return F.transform(a, lambda x: F.greatest(x, F.lit(0.0)))
