"""Leading directions of rows of any width, by a randomised range finder.

``A`` stands for the rows, centred or not. A round sends a thin block of directions ``V`` to
the tasks and gets ``A'(A V)`` back: each task folds its rows into one ``width x block`` matrix,
and those are summed by position. Neither the Gram matrix nor a centred row is ever formed:
``(x - mu) V`` is ``x V`` less one row, and ``(A - 1 mu')' P`` is ``A' P`` less ``mu`` times the column
sums of ``P``. Every round adds what is new in the image to the basis (power steps without
losing what earlier ones found); the directions are those of ``A'A`` seen from the basis. It
ends when the residuals of all wanted directions are small against the largest value, or when
the basis is all there is. A basis that grew too wide is folded into its best directions.

The driver holds a few matrices of ``width x (k + spare)``; nothing on it grows with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.clusters import matrix
from tallyforge.session import ship_package

#: Blocks of a basis before it is folded, and rounds before the search gives up.
BLOCKS, ROUNDS = 8, 60
TOLERANCE = 1e-9
_SEED = 20


def _summed(parts: DataFrame, width: int) -> np.ndarray:
    """Sum by position of the rows ``(i, v)`` that the tasks send."""
    sums = parts.groupBy("i").agg(F.array(*[F.sum(F.col("v")[j]) for j in range(width)]).alias("v"))
    found = sums.toArrow()  # one row per position
    out = np.zeros((found.num_rows, width))
    out[found["i"].to_numpy()] = found["v"].combine_chunks().flatten().to_numpy().reshape(-1, width)
    return out


def _rows(total: np.ndarray, at: int = 0) -> pa.RecordBatch:
    edges = pa.array(np.arange(0, total.size + 1, total.shape[1], dtype=np.int32))
    values = pa.ListArray.from_arrays(edges, pa.array(total.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + len(total))), values], ["i", "v"])


def moments(df: DataFrame, features: str = "features") -> tuple[int, np.ndarray, float]:
    """Number of rows, column means, and the sum of squares about them, in one pass."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0))
                own = np.vstack([x.sum(axis=0), (x * x).sum(axis=0), np.full(x.shape[1], float(len(x)))]).T
                total = own if total is None else total + own
        if total is not None:
            yield _rows(total)

    ship_package(df.sparkSession)
    sums = _summed(df.select(features).mapInArrow(fold, "i long, v array<double>"), 3)
    if not len(sums):
        raise ValueError("no rows")
    n = int(sums[0, 2])
    return n, sums[:, 0] / n, float(sums[:, 1].sum() - (sums[:, 0] ** 2).sum() / n)


def image(df: DataFrame, v: np.ndarray, mean: np.ndarray | None, features: str = "features") -> np.ndarray:
    """``A'(A V)`` in one pass over the rows."""
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((v, None if mean is None else mean @ v))
    width = v.shape[1]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, shift = shared.value
        total, sums = None, np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0))
                seen = x @ directions
                if shift is not None:
                    seen -= shift
                    sums += seen.sum(axis=0)
                own = x.T @ seen
                total = own if total is None else total + own
        if total is not None:
            yield _rows(np.vstack([total, sums]))

    try:
        found = _summed(df.select(features).mapInArrow(fold, "i long, v array<double>"), width)
    finally:
        shared.destroy()
    return found[:-1] if mean is None else found[:-1] - np.outer(mean, found[-1])


def _fresh(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal directions of a block that the basis does not have."""
    size = np.linalg.norm(block, axis=0).max(initial=0.0)
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    if not size:
        return block[:, :0]
    left, values, _ = np.linalg.svd(block, full_matrices=False)
    kept = left[:, values > 1e-12 * size]
    kept = kept - basis @ (basis.T @ kept)
    return np.linalg.qr(kept)[0] if kept.shape[1] else kept


def leading(
    df: DataFrame, k: int, mean: np.ndarray | None, width: int, features: str = "features",
    spare: int = 16, tolerance: float = TOLERANCE, rounds: int = ROUNDS,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of ``A'A`` and their directions, ``width x k``. Fewer if the
    rows have fewer directions: the rest are zero. Raises if ``rounds`` are not enough."""
    block = min(k + spare, width)
    fresh = np.linalg.qr(np.random.default_rng(_SEED).standard_normal((width, block)))[0]
    basis, images = np.zeros((width, 0)), np.zeros((width, 0))
    for _ in range(rounds):
        basis = np.hstack([basis, fresh])
        images = np.hstack([images, image(df, fresh, mean, features)])
        inner = basis.T @ images
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        wanted = turn[:, :k]
        residual = np.linalg.norm(images @ wanted - (basis @ wanted) * values[:k], axis=0)
        fresh = _fresh(images[:, -fresh.shape[1] :], basis)
        if residual.max() <= tolerance * max(values[0], 0.0) or not fresh.shape[1] or basis.shape[1] >= width:
            found = np.zeros((width, k))
            found[:, : wanted.shape[1]] = basis @ wanted
            sizes = np.zeros(k)
            sizes[: wanted.shape[1]] = np.maximum(values[:k], 0.0)
            return sizes, found
        if basis.shape[1] >= BLOCKS * block:
            basis, images = basis @ turn[:, :block], images @ turn[:, :block]
            fresh = _fresh(fresh, basis)
        fresh = fresh[:, : width - basis.shape[1]]
    raise RuntimeError(f"the directions still move after {rounds} rounds: allow more, or a larger tolerance")
