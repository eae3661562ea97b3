"""Where registered queries, their oracle SQL and the inventory ids they cover meet."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyforge.plans.views import Tables


@dataclass(frozen=True)
class Registered:
    build: Callable[[Tables], DataFrame]
    covers: tuple[str, ...]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


CATALOG: dict[str, Registered] = {}


def query(covers: str, sql: str | None = None):
    """Register a query under its function name; ``covers`` lists inventory ids."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        if name in CATALOG:
            raise ValueError(f"duplicate query {name}")
        CATALOG[name] = Registered(build, tuple(covers.split()), sql)
        return build

    return register
