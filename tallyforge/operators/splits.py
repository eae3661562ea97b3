"""Reproducible splits: they depend on keys and seeds, never on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.ordering import global_index, rank_within, top_per_key


def hash_percent(keys: Sequence[str], seed: int) -> Column:
    """A number 0-99 from the key and the seed, the same in every engine with MD5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100


def hash_split(
    df: DataFrame, keys: Sequence[str], percents: Sequence[int], seed: int, name: str = "part"
) -> DataFrame:
    """Add the part number; ``percents`` sum to 100. A pure projection: no shuffle."""
    if sum(percents) != 100:
        raise ValueError("percents must sum to 100")
    h = hash_percent(keys, seed)
    part, edge = F.lit(len(percents) - 1), 100
    for i in range(len(percents) - 1, 0, -1):
        edge -= percents[i]
        part = F.when(h < edge, F.lit(i - 1)).otherwise(part)
    return df.withColumn(name, part)


def sample_and_rest(df: DataFrame, keys: Sequence[str], percent: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """A sample without replacement by key, and every row whose key is not in it: the same
    predicate and its negation, so neither side is shuffled."""
    drawn = hash_percent(keys, seed) < percent
    return df.where(drawn), df.where(~drawn)


def leave_out(
    df: DataFrame,
    user: str,
    order: Sequence[str],
    start: int,
    stop: int,
    max_test: int = 0,
    name: str = "is_test",
) -> DataFrame:
    """Rows number ``start`` to ``stop`` of each user become test rows, at most
    ``max_test`` in all (0: no limit), earliest first. ``(user, *order)`` must be unique."""
    keys = list(dict.fromkeys([user, *order]))
    picked = top_per_key(df.select(*keys), [user], order, stop, "__seq").where(F.col("__seq") >= start)
    if max_test > 0:
        picked = global_index(picked, order, "__idx").where(F.col("__idx") < max_test)
    flagged = picked.select(*keys, F.lit(True).alias(name))
    return df.join(flagged, keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def sequence_per_user(df: DataFrame, user: str, order: Sequence[str], name: str = "seq") -> DataFrame:
    """Full per-user numbering from 1."""
    return rank_within(df, [user], order, name)


def consecutive_folds(df: DataFrame, order: Sequence[str], k: int, name: str = "fold") -> DataFrame:
    """``k`` consecutive slices of the ordered table, sizes differing by at most one."""
    indexed = global_index(df, order, "__idx")
    n = df.agg(F.count(F.lit(1))).scalar()
    return indexed.withColumn(name, F.floor(F.col("__idx") * k / n).cast("int")).drop("__idx")
