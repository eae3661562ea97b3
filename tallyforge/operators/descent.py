"""Gradient descent over rows of any width, dense or sparse.

A row is a list of positions and a list of values. Each step sends the weights to the tasks,
which fold their Arrow blocks into one gradient by position; Spark adds these by position and
the driver gets ``width`` numbers. The plan has the same size at any width, and a row costs
what it holds. For a handful of dense columns :mod:`linear` stays in built-in sums. Squared error
over at most ``MOMENT_WIDTH`` positions reads the rows once for their moments, which all steps share.

Rows with a null label or null lists take no part, nor do null values and their positions; a row
with empty lists counts with a margin of zero (or the intercept). An empty input gives zero
weights. Repeated positions of a row add up. Positions outside ``0 .. width - 1`` raise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.linear import LinearModel, _shrink
from tallyforge.operators.moments import Moments
from tallyforge.session import ship_package

#: The factor of x in one row's gradient, from margins and labels.
SLOPES: dict[str, Callable[[np.ndarray, np.ndarray], np.ndarray]] = {
    "squared": lambda m, y: m - y,
    "logistic": lambda m, y: 1 / (1 + np.exp(-np.clip(m, -500, 500))) - y,
    "hinge": lambda m, y: np.where(m * (2 * y - 1) < 1, 1 - 2 * y, 0.0),
}
#: Widest rows whose moments are kept, and rows that are spread out to that width at a time.
MOMENT_WIDTH, ROWS_AT_ONCE = 256, 4096
#: Parts of a million that mini-batches are drawn in.
PARTS = 1_000_000


def dense(features: Column) -> tuple[Column, Column]:
    """Positions and values of a dense list."""
    return F.transform(features, lambda _, i: i), features


def _cells(positions: pa.Array, values: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position and value of every cell of a block."""
    row = np.repeat(np.arange(len(positions)), np.diff(positions.offsets.to_numpy()))
    at = positions.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    value = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    given = ~np.isnan(at) & ~np.isnan(value)
    row, at, value = row[given], at[given].astype(np.int64), value[given]
    if len(at) and (at.min() < 0 or at.max() >= width):
        raise ValueError(f"positions must lie in 0 .. {width - 1}")
    return row, at, value


def _rows_of(df: DataFrame, positions: Column, values: Column, label: str, *more: Column) -> DataFrame:
    rows = df.select(
        positions.cast("array<bigint>").alias("at"), values.cast("array<double>").alias("value"), F.col(label).cast("double").alias("label"), *more
    )
    return rows.where("at IS NOT NULL AND value IS NOT NULL AND label IS NOT NULL")


def spread(batch: pa.RecordBatch, width: int, around: tuple[int, int] = (0, 0)) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Dense rows of a block with ``around`` empty columns on the left and right, and their labels."""
    whole = around[0] + width + around[1]
    for low in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(low, ROWS_AT_ONCE)
        row, at, value = _cells(part.column(0), part.column(1), width)
        x = np.bincount(row * whole + at + around[0], value, part.num_rows * whole).reshape(-1, whole)
        yield x, part.column(2).to_numpy(zero_copy_only=False)


def sparse_moments(df: DataFrame, positions: Column, values: Column, width: int, label: str = "label") -> Moments:
    """Moments of the rows from one pass, for up to ``MOMENT_WIDTH`` positions."""
    ship_package(df.sparkSession)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 2, width + 2))
        for batch in batches:
            for x, y in spread(batch, width, (1, 1)):
                x[:, 0], x[:, -1] = 1.0, y
                total += x.T @ x
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total.reshape(-1)[used])], ["at", "part"])

    rows = _rows_of(df, positions, values, label)
    summed = rows.mapInArrow(fold, "at bigint, part double").groupBy("at").agg(F.sum("part").alias("part")).toPandas()
    sums = np.zeros((width + 2) ** 2)
    sums[summed["at"].to_numpy(np.int64)] = summed["part"].to_numpy(float)
    return Moments(sums.reshape(width + 2, width + 2))


def _folded(rows: DataFrame, weights: np.ndarray, width: int, loss: str) -> tuple[float, np.ndarray]:
    """Number of rows and sum of their gradients; the last weight may be an intercept."""
    bias = len(weights) > width

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(weights)), 0
        for batch in batches:
            row, at, value = _cells(batch.column(0), batch.column(1), width)
            label = batch.column(2).to_numpy(zero_copy_only=False)
            margin = np.bincount(row, weights[at] * value, len(label)) + (weights[-1] if bias else 0.0)
            slope = SLOPES[loss](margin, label)
            total[:width] += np.bincount(at, slope[row] * value, width)
            if bias:
                total[-1] += slope.sum()
            n += len(label)
        used = np.nonzero(total)[0]
        where = pa.array(np.concatenate([[-1], used]), pa.int64())
        yield pa.RecordBatch.from_arrays([where, pa.array(np.concatenate([[float(n)], total[used]]))], ["at", "part"])

    summed = rows.mapInArrow(fold, "at bigint, part double").groupBy("at").agg(F.sum("part").alias("part")).toPandas()
    sums = np.zeros(len(weights) + 1)
    sums[summed["at"].to_numpy(np.int64)] = summed["part"].to_numpy(float)  # the count, at -1, comes last
    return sums[-1], sums[:-1]


def sparse_descent(
    df: DataFrame,
    positions: Column,
    values: Column,
    width: int,
    label: str = "label",
    loss: str = "squared",
    iterations: int = 100,
    step: float = 1.0,
    reg: float = 0.0,
    penalty: str | None = None,
    intercept: bool = False,
    tolerance: float = 0.001,
    batch: tuple[Sequence[str], float] | None = None,
) -> LinearModel:
    """Descent with rate ``step / sqrt(t)``, as :func:`linear.gradient_descent` takes it.

    ``batch`` names key columns and a share: step ``t`` reads the rows whose key hashes, with
    ``t``, into that share, whatever the partitioning. The input is read once a step, where
    moments don't serve, and should then be persisted or written by the caller.
    """
    ship_package(df.sparkSession)
    rows = _rows_of(df, positions, values, label, *([F.array(*[F.col(c).cast("string") for c in batch[0]]).alias("key")] if batch else []))
    known = sparse_moments(df, positions, values, width, label) if loss == "squared" and width <= MOMENT_WIDTH and not batch else None
    w, done = np.zeros(width + intercept), 0
    for t in range(1, iterations + 1):
        drawn = rows
        if batch:
            drawn = rows.where(F.pmod(F.xxhash64("key", F.lit(t)), F.lit(PARTS)) < batch[1] * PARTS)
        n, sums = _folded(drawn.select("at", "value", "label"), w, width, loss) if known is None else (known.n, known.gradient(w))
        rate = step / np.sqrt(t)
        move = rate * sums / max(n, 1.0)
        new = _shrink(w - move, rate, reg, penalty) if penalty == "l1" else _shrink(w, rate, reg, penalty) - move
        moved, w, done = np.linalg.norm(new - w), new, t
        if t > 1 and moved < tolerance * max(np.linalg.norm(new), 1.0):
            break
    body, bias = (w[:-1], float(w[-1])) if intercept else (w, 0.0)
    return LinearModel(tuple(float(v) for v in body), bias, done)


def margins(df: DataFrame, model: LinearModel, positions: Column, values: Column, name: str = "margin") -> DataFrame:
    """``df`` with the margin of every row; null lists have a null margin."""
    width, weights = len(model.weights), np.array([*model.weights, 0.0])
    names = [f.name for f in df.schema.fields]
    ship_package(df.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, value = batch.column(1), batch.column(2)
            row, place, x = _cells(at, value, width)
            found = np.bincount(row, weights[place] * x, batch.num_rows) + model.intercept
            null = np.array(at.is_null()) | np.array(value.is_null())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, mask=null)], ["row", "margin"])

    packed = df.select(
        F.struct(F.lit(1).alias("_"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names))).alias("row"),
        positions.cast("array<bigint>").alias("at"), values.cast("array<double>").alias("value"),
    )
    # both lists are null or none is, so that their cells stay side by side
    both = F.col("at").isNotNull() & F.col("value").isNotNull()
    packed = packed.withColumns({"at": F.when(both, F.col("at")), "value": F.when(both, F.col("value"))})
    schema = f"row {packed.schema['row'].dataType.simpleString()}, margin double"
    scored = packed.mapInArrow(score, schema)
    return scored.select(*(F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(names)), F.col("margin").alias(name))
