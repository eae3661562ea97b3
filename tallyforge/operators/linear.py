"""Linear models: target transforms and gradient descent over DataFrame aggregates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.arrays import dot


@dataclass(frozen=True)
class Transform:
    forward: Callable[[Column], Column]
    inverse: Callable[[Column], Column]


TRANSFORMS = {
    "none": Transform(lambda c: c, lambda c: c),
    "log": Transform(F.ln, F.exp),
    "sqrt": Transform(F.sqrt, lambda c: F.pow(c, F.lit(2.0))),
}


# A loss gives the factor of x in one row's gradient, from margin and label.
LOSSES: dict[str, Callable[[Column, Column], Column]] = {
    "squared": lambda m, y: m - y,
    "logistic": lambda m, y: 1.0 / (1.0 + F.exp(-m)) - y,
    "hinge": lambda m, y: F.when(m * (2 * y - 1) < 1, 1 - 2 * y).otherwise(F.lit(0.0)),
}


def _shrink(w: np.ndarray, rate: float, reg: float, penalty: str | None) -> np.ndarray:
    if penalty == "l2":
        return w * (1 - rate * reg)
    if penalty == "l1":
        return np.sign(w) * np.maximum(np.abs(w) - rate * reg, 0.0)
    return w


@dataclass(frozen=True)
class LinearModel:
    weights: tuple[float, ...]
    intercept: float
    iterations: int

    def margin(self, features: Column) -> Column:
        return dot(features, F.array(*[F.lit(w) for w in self.weights])) + F.lit(self.intercept)


def gradient_descent(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    loss: str = "squared",
    iterations: int = 100,
    step: float = 1.0,
    reg: float = 0.0,
    penalty: str | None = None,
    intercept: bool = False,
    tolerance: float = 0.001,
) -> LinearModel:
    """Full-batch descent with rate ``step / sqrt(t)``.

    Each step is one aggregate of width + 1 sums over the input, combined map-side;
    only those sums reach the driver, and the weights go back as literals, so the
    plan does not grow. The input should be persisted by the caller. It stops when
    the weights move less than ``tolerance * max(|w|, 1)``.
    """
    width = len(df.select(features).head()[0])
    x = [F.col(features)[i] for i in range(width)] + ([F.lit(1.0)] if intercept else [])
    w = np.zeros(len(x))
    done = 0
    n = None
    for t in range(1, iterations + 1):
        margin = sum((F.lit(float(w[i])) * x[i] for i in range(1, len(x))), F.lit(float(w[0])) * x[0])
        rows = df.select(LOSSES[loss](margin, F.col(label)).alias("__g"), *[c.alias(f"__x{i}") for i, c in enumerate(x)])
        sums = rows.agg(F.count(F.lit(1)), *[F.sum(F.col("__g") * F.col(f"__x{i}")) for i in range(len(x))]).first()
        n = sums[0]
        rate = step / np.sqrt(t)
        new = _shrink(w, rate, reg, penalty) - rate * np.array(sums[1:]) / n if penalty != "l1" else _shrink(
            w - rate * np.array(sums[1:]) / n, rate, reg, penalty
        )
        moved = np.linalg.norm(new - w)
        w, done = new, t
        if t > 1 and moved < tolerance * max(np.linalg.norm(new), 1.0):
            break
    body, bias = (w[:-1], float(w[-1])) if intercept else (w, 0.0)
    return LinearModel(tuple(float(v) for v in body), bias, done)


def zero_weights(model) -> int:
    """How many weights are exactly zero."""
    weights = getattr(model, "weights", None)
    values = np.array(weights if weights is not None else model.coefficients)
    return int(np.sum(values == 0.0))
