"""Linear regression from moment matrices: whole penalty paths and k folds in one pass.

With ``z = (x, y)`` (and a 1 for the intercept) squared error depends on the rows through the
sum of ``z z'`` alone. One pass over the rows keeps one such matrix per fold, summed by
position; the training side of a fold is the total less its own, its test side its own. All
fits after that, for every fold and every penalty, read matrices of ``width + 2`` and no rows.

Objective: ``(1 / 2n) |y - Xw - b|^2 + penalty``, with ``reg / 2 |w|^2`` (l2) or ``reg |w|_1`` (l1); the
intercept, if there is one, has no penalty. L2 rows are solved directly, L1 rows by coordinate
descent, each starting from the weights of the next larger penalty.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.clusters import matrix
from tallyforge.session import ship_package

#: Sweeps of coordinate descent at most, and the move below which it has ended.
SWEEPS, TOLERANCE = 10_000, 1e-12


@dataclass(frozen=True)
class Moments:
    """Sum of ``z z'`` over rows, ``z = (1, x, y)``."""

    sums: np.ndarray

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.sums - other.sums)

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.sums + other.sums)

    @property
    def n(self) -> float:
        return float(self.sums[0, 0])

    def gradient(self, w: np.ndarray) -> np.ndarray:
        """Sum over rows of the gradient of half the squared error; a weight more than columns is an intercept."""
        width = len(self.sums) - 2
        order = [*range(1, width + 1), *([0] if len(w) > width else [])]
        return self.sums[np.ix_(order, order)] @ w - self.sums[order, -1]

    def equal_rows(self) -> list[tuple[list[float], float, float]]:
        """``(x, y, weight)`` of a few rows with the same moments: two on either side of the mean
        for each direction of spread. A fit that reads moments alone comes out the same."""
        mean = self.sums[0, 1:] / self.n
        size, basis = np.linalg.eigh(self.sums[1:, 1:] / self.n - np.outer(mean, mean))
        steps = basis * np.sqrt(np.maximum(size, 0.0) * len(size))
        made = np.concatenate([mean + steps.T, mean - steps.T])
        return [([float(v) for v in z[:-1]], float(z[-1]), self.n / len(made)) for z in made]

    def _centred(self, intercept: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mean products of x with x and with y, and the means taken off."""
        mean = self.sums[0] / self.n if intercept else np.zeros(len(self.sums))
        whole = self.sums / self.n - np.outer(mean, mean)
        return whole[1:-1, 1:-1], whole[1:-1, -1], mean

    def _model(self, w: np.ndarray, mean: np.ndarray, intercept: bool) -> np.ndarray:
        return np.concatenate([[mean[-1] - mean[1:-1] @ w if intercept else 0.0], w])

    def ridge(self, reg: float, intercept: bool = False) -> np.ndarray:
        """Intercept and weights under an l2 penalty; of equal solutions the shortest."""
        xx, xy, mean = self._centred(intercept)
        return self._model(np.linalg.lstsq(xx + reg * np.eye(len(xx)), xy, rcond=1e-12)[0], mean, intercept)

    def lasso_path(self, regs: Sequence[float], intercept: bool = False) -> dict[float, np.ndarray]:
        """Intercept and weights for every l1 penalty, from the largest down."""
        xx, xy, mean = self._centred(intercept)
        w, out = np.zeros(len(xx)), {}
        for reg in sorted({float(r) for r in regs}, reverse=True):
            w = _descent(xx, xy, reg, w)
            out[reg] = self._model(w, mean, intercept)
        return out

    def squared_error(self, model: np.ndarray) -> float:
        """Mean squared error of a model on the rows of these moments."""
        z = np.concatenate([-model, [1.0]])
        return max(float(z @ self.sums @ z) / self.n, 0.0)


def _descent(xx: np.ndarray, xy: np.ndarray, reg: float, start: np.ndarray) -> np.ndarray:
    """Coordinate descent on mean products; columns without spread keep weight zero."""
    w, left = start.copy(), xy - xx @ start
    scale = max(float(np.abs(xy).max(initial=0.0)), 1.0)
    for _ in range(SWEEPS):
        moved = 0.0
        for j in np.nonzero(np.diag(xx) > 0)[0]:
            own = left[j] + xx[j, j] * w[j]
            new = np.sign(own) * max(abs(own) - reg, 0.0) / xx[j, j]
            if new != w[j]:
                left -= xx[:, j] * (new - w[j])
                moved = max(moved, abs(new - w[j]) * np.sqrt(xx[j, j]))
                w[j] = new
        if moved <= TOLERANCE * scale:
            break
    return w


def fold_moments(df: DataFrame, fold: str | Column, features: str = "features", label: str = "label") -> dict[int, Moments]:
    """Moments of every fold, from one pass over the rows. Rows with a null fold, label or
    features take no part; an empty table has no folds."""
    ship_package(df.sparkSession)
    given = df.select(
        (F.col(fold) if isinstance(fold, str) else fold).cast("int").alias("fold"),
        F.col(features).cast("array<double>").alias("x"), F.col(label).cast("double").alias("y"),
    ).dropna()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, folds = matrix(batch.column("x")), batch.column("fold").to_numpy()
            z = np.hstack([np.ones((len(x), 1)), x, batch.column("y").to_numpy()[:, None]])
            for f in np.unique(folds):
                part = z[folds == f]
                totals[f] = totals.get(f, 0.0) + part.T @ part
        for f, total in totals.items():
            i = np.repeat(np.arange(len(total)), len(total))
            j = np.tile(np.arange(len(total)), len(total))
            upper = i <= j
            made = {"fold": np.full(upper.sum(), f, np.int32), "i": i[upper], "j": j[upper], "s": total.ravel()[upper]}
            yield pa.RecordBatch.from_pydict({n: pa.array(v) for n, v in made.items()})

    cells = given.mapInArrow(add, "fold int, i long, j long, s double").groupBy("fold", "i", "j").agg(F.sum("s").alias("s"))
    out: dict[int, np.ndarray] = {}
    found = cells.toPandas()  # folds times width squared, whatever the number of rows
    width = int(found["j"].max()) + 1 if len(found) else 0
    for f, part in found.groupby("fold"):
        sums = np.zeros((width, width))
        sums[part["i"], part["j"]] = part["s"]
        out[int(f)] = sums + np.triu(sums, 1).T
    return {f: Moments(s) for f, s in sorted(out.items())}


def penalty_path(
    train: Moments, test: Moments, l2: Sequence[float] = (), l1: Sequence[float] = (), intercept: bool = False
) -> list[tuple[str, float, float, int]]:
    """``(penalty, reg, squared error on the test rows, zero weights)`` for every penalty."""
    lasso = train.lasso_path(l1, intercept)
    models = [("l2", float(r), train.ridge(r, intercept)) for r in l2] + [("l1", float(r), lasso[float(r)]) for r in l1]
    return [(kind, reg, test.squared_error(m), int(np.sum(m[1:] == 0.0))) for kind, reg, m in models]


def fold_errors(
    folds: dict[int, Moments], l2: Sequence[float] = (0.0,), l1: Sequence[float] = (), intercept: bool = False
) -> list[tuple[int, str, float, float, int]]:
    """``(fold, penalty, reg, squared error on the fold, zero weights)``: each fold is tested by
    the models of all others."""
    total = sum(list(folds.values())[1:], start=list(folds.values())[0]) if folds else None
    out = []
    for fold, own in folds.items():
        rest = total - own
        if rest.n > 0:
            out += [(fold, *row) for row in penalty_path(rest, own, l2, l1, intercept)]
    return out
