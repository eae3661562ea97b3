"""Shared by the operators of this subpackage: tables, Arrow maps, components of links."""

from __future__ import annotations

import ctypes
import weakref
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import ship_package, written

#: White space of the word rules: blank and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` puts it in a lambda."""
    return F.transform(F.array(value), use)[0]


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on every Arrow batch, a few hundred rows at a time: long texts and what is
    made of them stay small next to the batch itself."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Remembered.keep(work.__module__)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                yield work(batch.slice(start, ROWS))
        give_back()

    ship_package(df.sparkSession)
    return df.mapInArrow(each, schema)


def give_back() -> None:
    """Hand freed memory back to the system: Python workers live on between tasks and would
    keep the most that any of them has needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


class Remembered(dict):
    """Results by argument, in two generations of at most ``size``: what is used again while
    the younger one fills stays. Python workers live on and serve one operator after another,
    so a worker keeps what one module remembers and forgets that of all others."""

    _all: list[weakref.ref] = []

    def __init__(self, make: Callable[[str], Any], size: int, longest: int = 64):
        super().__init__()
        self.make, self.size, self.longest, self.older = make, size, longest, {}
        Remembered._all.append(weakref.ref(self))

    @staticmethod
    def keep(module: str) -> None:
        """Forget what functions of other modules have made."""
        Remembered._all = [r for r in Remembered._all if r() is not None]
        for other in (r() for r in Remembered._all):
            if other is not None and other.make.__module__ != module:
                other.clear()
                other.older = {}

    def __missing__(self, text: str) -> Any:
        found = self.older.get(text)
        if found is None:
            found = self.make(text)
        if len(text) <= self.longest:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[text] = found
        return found


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, a: str, b: str, label: str = "links") -> DataFrame:
    """``(node, component)`` for every node of an edge list; the component is the least
    node of its connected part.

    Alternating large-star and small-star steps: every step joins edges with one row per
    node, so a hub costs its degree and the number of rounds grows with the logarithm of
    the part. The stars are written to the shared folder after each round.
    """
    now = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    now, before = written(now, label), None
    while True:
        summed = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if summed[0] == 0 or tuple(summed) == before:
            break
        before = tuple(summed)
        now = written(_small_star(_large_star(now).distinct()).distinct(), label)
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
