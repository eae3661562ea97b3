"""Global order at scale: indices, running totals, per-key ranks, medians.

A window without ``partitionBy`` runs in one task, and a window by key puts a hot
key in one task. The operators here range-partition on the order plus a tie-break,
so that even one value held by a third of all rows is spread evenly, then correct
each partition by an offset. The ranged table is checkpointed once: range bounds
come from sampling and must not change between the pass that counts and the pass
that numbers, nor when an executor is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.session import ensure_checkpoint

_TIE, _PART, _POS = "__tie", "__part", "__pos"
_ROW_BITS = (1 << 33) - 1
_REAL = (T.DoubleType, T.FloatType)
#: Buckets of one narrowing step of a selection, and values that are few enough to be looked at.
BUCKETS, FEW = 4096, 10_000
#: Spark's own threshold (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def frozen_order(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Sorted rows with their partition number and position inside the partition."""
    ensure_checkpoint(df.sparkSession)
    keys = [_column(c) for c in order] + [F.col(_TIE)]
    ranged = (
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .checkpoint()
    )
    return ranged.withColumns(
        {_PART: F.spark_partition_id(), _POS: F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))}
    ).drop(_TIE)


def _offsets(frozen: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Sum of each total over all earlier partitions; one row per partition."""
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = frozen.groupBy(_PART).agg(*[c.alias(n) for n, c in totals.items()])
    shifted = [F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in totals]
    # One row per shuffle partition, whatever the data size: safe to broadcast.
    return F.broadcast(sums.select(_PART, *shifted))


def global_index(df: DataFrame, order: Sequence[str | Column], name: str = "idx") -> DataFrame:
    """Dense 0-based index over the whole table in the given order."""
    frozen = frozen_order(df, order)
    offsets = _offsets(frozen, {"__base": F.count(F.lit(1))})
    return (
        frozen.join(offsets, _PART)
        .withColumn(name, F.col("__base") + F.col(_POS))
        .drop(_PART, _POS, "__base")
    )


def _per_partition(frozen: DataFrame, work: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]], added: str) -> DataFrame:
    """``frozen`` with the columns that ``work`` makes of each Arrow batch; one call of
    ``work`` serves the batches of a partition in their order, so it can carry values on."""
    fields = T._parse_datatype_string(added).fields
    names = [*frozen.columns, *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = work()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, *step(batch)], names)

    return frozen.mapInArrow(run, T.StructType([*frozen.schema.fields, *fields]))


def running_sum(df: DataFrame, order: Sequence[str | Column], sums: dict[str, str | Column]) -> DataFrame:
    """Running totals in the given order; ``sums`` maps new names to columns. Rows are summed
    where they were ranged to, and each partition gets the total of those before it."""
    frozen = frozen_order(df, order)
    given = frozen.withColumns({f"__v_{n}": _column(c) for n, c in sums.items()})
    kinds = {n: given.select(F.sum(f"__v_{n}").alias("s")).schema["s"].dataType for n in sums}
    given = given.withColumns({f"__v_{n}": F.col(f"__v_{n}").cast(kinds[n]) for n in sums})
    places = [given.columns.index(f"__v_{n}") for n in sums]

    def work() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        carry: list[pa.Scalar | None] = [None] * len(places)

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            out = []
            for i, at in enumerate(places):
                values = batch.column(at)
                total = pc.cumulative_sum(values, start=carry[i], skip_nulls=True)
                total = pc.fill_null_forward(total)  # a null adds nothing
                if carry[i] is not None:
                    total = pc.fill_null(total, carry[i])
                carry[i] = total[-1] if total[-1].is_valid else None
                out.append(total.cast(values.type))
            return out

        return step

    added = ", ".join(f"`{n}` {kinds[n].simpleString()}" for n in sums)
    local = _per_partition(given, work, added)
    offsets = _offsets(given, {f"__base_{n}": F.sum(f"__v_{n}") for n in sums})
    joined = local.join(offsets, _PART)
    totals = {n: F.coalesce(F.col(n), F.lit(0).cast(kinds[n])) + F.col(f"__base_{n}") for n in sums}
    return joined.withColumns(totals).drop(_PART, _POS, *(f"__base_{n}" for n in sums), *(f"__v_{n}" for n in sums))


def rank_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "rank", count: tuple[str, str] | None = None
) -> DataFrame:
    """Full 1-based rank inside each key; a hot key is ranked by many tasks. ``count`` names a
    boolean column without nulls and a new one: how many of the key's rows up to here it holds for.

    Rows are numbered where they were ranged to. Only the key that a partition begins with
    can go on from the one before; what it has there comes as one number per partition.
    """
    frozen = frozen_order(df, [*keys, *order])
    places = [frozen.columns.index(k) for k in keys]
    flag = frozen.columns.index(count[0]) if count else None

    def work() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        last: list[pa.Scalar] | None = None
        done, held, leading = 0, 0, True

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            nonlocal last, done, held, leading
            columns = [batch.column(i) for i in places]
            n = batch.num_rows
            new = np.zeros(n, bool)
            for i, c in enumerate(columns):
                same = pc.fill_null(pc.equal(c[1:], c[:-1]), False)
                both = pc.and_(c[1:].is_null(), c[:-1].is_null())
                new[1:] |= ~pc.or_(same, both).to_numpy(zero_copy_only=False)
                if last is not None and c[0] != last[i]:
                    new[0] = True
            starts = np.nonzero(new)[0]
            begin = np.zeros(n, np.int64)
            begin[starts] = starts
            begin = np.maximum.accumulate(begin)
            run = np.cumsum(new)
            local = np.arange(n) - begin + 1 + np.where(run == 0, done, 0)
            lead = (run == 0) & leading
            leading, done, last = bool(lead[-1]), int(local[-1]), [c[n - 1] for c in columns]
            if flag is None:
                return [pa.array(local), pa.array(lead)]
            holds = batch.column(flag).to_numpy(zero_copy_only=False).astype(np.int64)
            upto = np.cumsum(holds)
            found = upto - (upto - holds)[begin] + np.where(run == 0, held, 0)
            held = int(found[-1])
            return [pa.array(local), pa.array(lead), pa.array(found)]

        return step

    local = _per_partition(frozen, work, "__local long, __lead boolean" + (", __held long" if count else ""))
    key = F.struct(*keys)
    edges = local.groupBy(_PART).agg(
        F.min_by(key, _POS).alias("first"), F.max_by(key, _POS).alias("last"),
        F.max_by("__local", _POS).alias("tail"), F.min("__lead").alias("single"),
        (F.max_by("__held", _POS) if count else F.lit(0)).alias("held"),
    )
    before, base, held, rows = None, 0, 0, []
    for row in sorted(edges.collect(), key=lambda r: r[_PART]):  # one row per shuffle partition
        base, held = (base, held) if before is not None and row["first"] == before else (0, 0)
        rows.append((row[_PART], base, held))
        before, base, held = row["last"], *((row["tail"] + base, row["held"] + held) if row["single"] else (row["tail"], row["held"]))
    carried = df.sparkSession.createDataFrame(rows, f"{_PART} int, __base long, __before long")
    made = {name: F.col("__local") + F.when(F.col("__lead"), F.col("__base")).otherwise(F.lit(0))}
    if count:
        made[count[1]] = F.col("__held") + F.when(F.col("__lead"), F.col("__before")).otherwise(F.lit(0))
    ranked = local.join(F.broadcast(carried), _PART).withColumns(made)
    return ranked.drop(_PART, _POS, "__local", "__lead", "__base", "__before", *(["__held"] if count else []))


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int, name: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each key. Up to ``GROUP_LIMIT`` Spark keeps at most ``k`` rows
    per key and map task before the shuffle (WindowGroupLimit), which bounds a hot key; a
    larger ``k`` gets full ranks, which many tasks make."""
    if k > GROUP_LIMIT:
        return rank_within(df, keys, order, name).where(F.col(name) <= k)
    w = Window.partitionBy(*keys).orderBy(*[_column(c) for c in order])
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def top(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """The first ``k`` rows of the table (TakeOrderedAndProject)."""
    return df.orderBy(*[_column(c) for c in order]).limit(k)


def _selected(values: DataFrame, first: int, second: int, low: Any, high: Any) -> tuple[Any, Any]:
    """The values of two neighbouring (or equal) ranks among finite ``v`` from ``low`` to ``high``.

    A step cuts the range into ``BUCKETS`` of equal width and goes on in the one that holds
    the rank, from its least to its greatest value, so gaps cost nothing."""
    real = isinstance(values.schema["v"].dataType, _REAL)
    while low != high:
        if real:  # halves, as the whole range may be beyond a double
            span = float(high) / 2 - float(low) / 2
            above = F.col("v").cast("double") / 2 - F.lit(float(low) / 2)
        else:
            span = float(high - low)
            above = (F.col("v") - F.lit(low)).cast("double")
        share = above / F.lit(span or 1.0)
        inside = values.where(F.col("v").between(F.lit(low), F.lit(high)))
        bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))
        if not span:  # neighbours that differ by less than half the least double
            bucket = F.col("v")
        rows = inside.groupBy(bucket.alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
        )
        found = sorted(rows.collect(), key=lambda r: r["low"])  # at most BUCKETS rows
        at = 0
        while first > found[at]["n"]:
            first, second = first - found[at]["n"], second - found[at]["n"]
            at += 1
        if second > found[at]["n"]:
            return found[at]["high"], found[at + 1]["low"]
        low, high = found[at]["low"], found[at]["high"]
        if found[at]["n"] <= FEW and low != high:
            held = values.where(F.col("v").between(F.lit(low), F.lit(high))).collect()  # at most FEW rows
            ordered = sorted(r["v"] for r in held)
            return ordered[first - 1], ordered[second - 1]
    return low, low


def exact_median(df: DataFrame, column: str, name: str = "median") -> DataFrame:
    """One row: the true median of a number column; nulls don't count, and without values it
    is null. Infinite values count as such, NaN as greater than all.

    Selection, not a sort: one pass for the ends, then histograms over an ever narrower range.
    A pass divides the range by ``BUCKETS`` at least, so two or three do for most columns, and
    nothing is shuffled but one row per bucket and task."""
    values = df.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
    kind = values.schema["v"].dataType
    endless = F.lit(float("inf"))
    finite = (F.col("v") < endless) & (F.col("v") > -endless) if isinstance(kind, _REAL) else F.lit(True)
    beyond = [F.count_if(F.col("v") == x) if isinstance(kind, _REAL) else F.lit(0) for x in (-endless, endless)]
    own = F.when(finite, F.col("v"))
    n, inside, low, high, under, over = values.agg(F.count(F.lit(1)), F.count(own), F.min(own), F.max(own), *beyond).first()
    ranks = [(n + 1) // 2 - under, n // 2 + 1 - under]
    held = [r for r in ranks if 0 < r <= inside] if n else []
    known = dict(zip((held[0], held[-1]), _selected(values.where(finite), held[0], held[-1], low, high))) if held else {}

    def at(rank: int) -> Column:
        outer = float("-inf") if rank <= 0 else float("inf") if rank <= inside + over else float("nan")
        return F.lit(known.get(rank, outer)).cast(kind)

    both = [at(r) for r in ranks] if n else [F.lit(None).cast(kind)] * 2
    return df.sparkSession.range(1).select(((both[0] + both[1]) / 2).alias(name))
