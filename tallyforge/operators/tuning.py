"""Parameter sweeps and cross-validation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame

# The grids swept by default.
GRIDS: dict[str, list] = {
    "iterations_classifier": [1, 5, 10, 50],
    "step_classifier": [0.001, 0.01, 0.1, 1.0, 10.0],
    "l2_classifier": [0.001, 0.01, 0.1, 1.0, 10.0],
    "depth_classifier": [1, 2, 3, 4, 5, 10, 20],
    "smoothing": [0.001, 0.01, 0.1, 1.0, 10.0],
    "iterations_regression": [1, 5, 10, 20, 50, 100],
    "step_regression": [0.01, 0.025, 0.05, 0.1, 1.0],
    "l2_regression": [0.0, 0.01, 0.1, 1.0, 5.0, 10.0, 20.0],
    "l1_regression": [0.0, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0],
    "intercept": [False, True],
    "depth_regression": [1, 2, 3, 4, 5, 10, 20],
    "bins_regression": [2, 4, 8, 16, 32, 64, 100],
    "depth_digits": [5, 10, 15, 20, 25, 30],
    "bins_digits": [16, 20, 24, 28, 32, 36, 40, 44, 48, 52, 56, 60, 64],
    "reg_digits": [1e-5, 1e-4, 1e-3, 1e-2, 1e-1, 1.0, 10.0],
    "clusters": [2, 3, 4, 5, 10, 20],
}


def sweep(
    train: DataFrame,
    test: DataFrame,
    grid: Sequence,
    fit: Callable[[DataFrame, object], object],
    score: Callable[[object, DataFrame], float],
    parallel: int = 2,
) -> DataFrame:
    """``(param, metric)``, one row per grid point, in grid order.

    Both sets are persisted once; ``parallel`` fits run at a time so that the
    cluster stays busy through the short tail of each fit.
    """
    train, test = train.persist(), test.persist()
    try:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            results = list(pool.map(lambda p: float(score(fit(train, p), test)), grid))
    finally:
        train.unpersist()
        test.unpersist()
    rows = [(i, str(p), m) for i, (p, m) in enumerate(zip(grid, results))]
    return train.sparkSession.createDataFrame(rows, "place int, param string, metric double")


def cross_validate(
    df: DataFrame, estimator, evaluator: Evaluator, param_maps: list, fold: str, folds: int, parallel: int = 2
) -> CrossValidatorModel:
    """Spark's cross-validator on a fold column made by :mod:`splits`."""
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=param_maps, evaluator=evaluator,
        numFolds=folds, foldCol=fold, parallelism=parallel,
    )
    return cv.fit(df)
