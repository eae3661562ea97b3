"""Batch sinks, and the keyed table that streams write to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_delimited(df: DataFrame, path: str, sep: str = " ", **options: str) -> None:
    """Overwrite ``path`` with delimited text, one file per partition."""
    df.write.mode("overwrite").options(**options).csv(path, sep=sep)


def write_single(df: DataFrame, path: str, sep: str = ",") -> None:
    """Overwrite ``path`` with one text file, at any size. One task writes it: for reports;
    tables go through ``write_delimited``, which writes a file per partition."""
    write_delimited(df.coalesce(1), path, sep)


def spread(df: DataFrame, array: str, names: Sequence[str]) -> DataFrame:
    """Array elements as columns, because text sinks take flat rows only."""
    rest = [c for c in df.columns if c != array]
    return df.select(*rest, *[F.col(array)[i].alias(n) for i, n in enumerate(names)])


def latest_per_key(df: DataFrame, key: str, order: Column, values: Sequence[str]) -> DataFrame:
    """The last row of every key; combined map-side, so a hot key sends one row per task."""
    last = F.max_by(F.struct(*values), order)
    return df.groupBy(key).agg(last.alias("__v"), F.max(order).alias("__o")).select(key, "__v.*", F.col("__o").alias("version"))


class KeyedTable:
    """Last write wins per key, as folders of collapsed batches.

    A batch costs its own size: it is collapsed per key and written to the folder of its
    ``run`` (one per checkpoint) and ``batch_id``, which a replay of the same batch simply
    overwrites and a new checkpoint never meets. Rows keep the order they came with, and
    readers take the greatest of each key, so batches of different runs can be compared.
    The order must compare rows of one key: an offset does where a key lives in one
    partition. ``compact`` folds all batches into one.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, values: Sequence[str]):
        self.spark, self.path, self.key, self.values = spark, path.rstrip("/"), key, list(values)

    def upsert(self, batch: DataFrame, batch_id: int, order: Column, run: str = "0") -> None:
        rows = latest_per_key(batch, self.key, order, self.values)
        rows.write.mode("overwrite").parquet(f"{self.path}/run={run}/batch_id={batch_id}")

    def batches(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        return self._newest().drop("version")

    def _newest(self) -> DataFrame:
        return latest_per_key(self.batches(), self.key, F.col("version"), self.values)

    def compact(self, target: str) -> KeyedTable:
        """The current rows as one batch of a new table; later batches go there."""
        self._newest().write.mode("overwrite").parquet(f"{target.rstrip('/')}/run=compact/batch_id=0")
        return KeyedTable(self.spark, target, self.key, self.values)
