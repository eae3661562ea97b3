"""Joins against dimensions: broadcast only what has been measured to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 32


def _width(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType)):
        return F.greatest(F.size(c), F.lit(0)) * 16
    return F.lit(8)


def measured_bytes(df: DataFrame) -> int:
    """Approximate in-memory size, from one aggregate over the real rows."""
    row = sum((_width(f) for f in df.schema.fields), F.lit(_ROW_OVERHEAD))
    return df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()[0]


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join a dimension: broadcast when it measures at most ``max_bytes``, else an
    ordinary shuffle join, which Spark splits where a key is skewed."""
    small = measured_bytes(dim) <= max_bytes
    return df.join(F.broadcast(dim) if small else dim, on, how)


def paired(actual: DataFrame, predicted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Actual next to predicted value, matched by key and never by position."""
    return actual.join(predicted, list(keys), "inner")


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``."""
    return df.join(other.select(*keys), list(keys), "left_anti")
