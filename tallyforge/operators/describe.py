"""Descriptive statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.ordering import rank_within


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct values of several columns, in one pass."""
    return df.agg(*[F.count_distinct(c).alias(f"distinct_{c}") for c in columns])


def summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, population standard deviation, max and min."""
    c = F.col(column)
    return df.agg(
        F.count(c).alias("n"),
        F.avg(c).alias("mean"),
        F.stddev_pop(c).alias("stdev"),
        F.max(c).alias("max"),
        F.min(c).alias("min"),
    )


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key; counted map-side before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def rows_per_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Average number of rows per distinct value of each column."""
    rows = F.count(F.lit(1))
    return df.agg(*[(rows / F.count_distinct(c)).alias(f"rows_per_{c}") for c in columns])


def shares(df: DataFrame, column: str) -> DataFrame:
    """Relative frequency of each value."""
    counts = count_by(df, column)
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def member_lists(
    df: DataFrame, key: str, member: Sequence[str], chunk: int = 4096, name: str = "members"
) -> DataFrame:
    """Members of each key as sorted lists of at most ``chunk`` elements.

    ``part`` counts the lists of a key from 0 and follows from a member's rank, so the lists
    laid end to end are the sorted list of all members, whatever the size of the key; no
    task builds more than ``chunk`` elements at once.
    """
    ranked = rank_within(df.select(key, *member), [key], list(member), "__rank")
    entry = F.struct(*member) if len(member) > 1 else F.col(member[0])
    return (
        ranked.withColumn("part", F.floor((F.col("__rank") - 1) / chunk).cast("long"))
        .groupBy(key, "part")
        .agg(F.sort_array(F.collect_list(entry)).alias(name))
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width density histogram; the last bin is closed on the right."""
    bounds = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("b")).scalar()
    placed = df.select(F.col(column).cast("double").alias("x"), bounds.alias("b"))
    width = (F.col("b.hi") - F.col("b.lo")) / bins
    # A constant column has width 0: all its rows belong to bin 0.
    raw = F.when(width == 0, 0).otherwise(F.floor((F.col("x") - F.col("b.lo")) / F.nullif(width, F.lit(0.0))))
    counts = (
        placed.select(F.least(raw, F.lit(bins - 1)).cast("long").alias("bin"), F.col("b.lo").alias("lo"), width.alias("w"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"), F.first("lo").alias("lo"), F.first("w").alias("w"))
    )
    rows = counts.agg(F.sum("n")).scalar()
    return counts.select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("w")).alias("left"),
        "n",
        F.try_divide(F.col("n"), rows * F.col("w")).alias("density"),
    )


def edge_histogram(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Counts per bin of given ascending edges; rows outside are left out, as in a plot."""
    lower, upper = edges[0], edges[-1]
    c = F.col(column)
    bin_no = sum((F.when(c >= e, 1).otherwise(0) for e in edges[1:-1]), F.lit(0))
    return (
        df.where((c >= lower) & (c <= upper))
        .groupBy(bin_no.cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def column_summary(df: DataFrame, features: str) -> DataFrame:
    """Per position of a vector: mean, min, max, sample variance, non-zero count."""
    names = ["mean", "min", "max", "variance", "numNonZeros"]
    vec = array_to_vector(F.col(features))
    one = df.select(Summarizer.metrics(*names).summary(vec).alias("s"))
    zipped = F.arrays_zip(*[vector_to_array(F.col(f"s.{n}")).alias(n) for n in names])
    return one.select(F.posexplode(zipped).alias("pos", "v")).select(
        "pos",
        "v.mean",
        "v.min",
        "v.max",
        "v.variance",
        F.col("v.numNonZeros").cast("long").alias("non_zero"),
    )


def purchase_report(purchases: DataFrame) -> DataFrame:
    """Rows, distinct buyers, revenue and the best-selling product.

    Products are counted first, so the best seller is picked among one row per
    product; ties go to the smaller product.
    """
    totals = purchases.agg(
        F.count(F.lit(1)).alias("purchases"),
        F.count_distinct("user").alias("buyers"),
        F.sum("price").alias("revenue"),
    )
    best = F.max_by("product", F.struct("n", (-F.col("product")).alias("t")))
    popular = count_by(purchases, "product").agg(
        F.struct(best.alias("product"), F.max("n").alias("n")).alias("b")
    )
    return totals.withColumn("b", popular.scalar()).select(
        "purchases",
        "buyers",
        "revenue",
        F.col("b.product").alias("best_product"),
        F.col("b.n").alias("best_count"),
    )


def impute_sentinel(df: DataFrame, column: str, sentinel: int, replacement: Column) -> DataFrame:
    """Replace every sentinel by the given scalar."""
    return df.withColumn(column, F.when(F.col(column) == sentinel, replacement).otherwise(F.col(column)))
