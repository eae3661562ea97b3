"""Scalar number rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_signal(value: Column, threshold: float) -> Column:
    """1 at or above the threshold, else 0."""
    return F.when(value < threshold, F.lit(0)).otherwise(F.lit(1))


def above(score: Column, threshold: float = 0.5) -> Column:
    """Hard 0/1 prediction: strictly above the threshold."""
    return F.when(score > threshold, F.lit(1.0)).otherwise(F.lit(0.0))


def fixed_decimals(value: Column, digits: int) -> Column:
    """Text with a fixed number of decimals and no thousands separator."""
    return F.format_string(f"%.{digits}f", value)
