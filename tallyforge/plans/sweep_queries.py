"""Parameter sweeps over every grid of ``tuning``, on held-out parts.

Classifiers are swept over the labelled documents, ten-class models over the embeddings,
regressors over the rental rows and order lines: 60 % training, 40 % test by a hash of the id
(all lines of an order are on one side).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators import descent, encode, linear, metrics, models, splits, tuning
from tallyforge.plans.encode_queries import CATEGORIES, NUMBERS
from tallyforge.plans.model_queries import _accuracy, _documents, _gd_rows, _tree_columns, _tree_groups
from tallyforge.plans.registry import query
from tallyforge.plans.views import Tables
from tallyforge.session import written

# Penalties of the sweep that is scored by area on both parts.
AREA_PENALTIES = [0.0, 0.001, 0.0025, 0.005, 0.01]


def _parts(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    parts = written(splits.hash_split(df, keys, [60, 40], seed=123), "parts")
    return parts.where("part = 0"), parts.where("part = 1")


def _tables(train: DataFrame, test: DataFrame, sweeps: list[tuple[str, str, Callable]], score: Callable) -> DataFrame:
    """One table of several sweeps: ``swept``, place, param, metric."""
    lines = [
        tuning.sweep(train, test, tuning.GRIDS[grid], fit, score).select(F.lit(name).alias("swept"), "*")
        for name, grid, fit in sweeps
    ]
    return reduce(DataFrame.unionByName, lines)


@query("TUN-1 TUN-2 ML-1 ML-5 FE-10")
def sweep_classifiers(t: Tables) -> DataFrame:
    train, test = _parts(_documents(t), ["id"])
    return _tables(
        train, test,
        [
            ("iterations", "iterations_classifier", lambda d, p: models.fit_logistic(d, iterations=p)),
            ("l1", "l2_classifier", lambda d, p: models.fit_logistic(d, p, "l1", 10)),
            ("gini depth", "depth_classifier", lambda d, p: models.fit_tree_classifier(d, "gini", p)),
        ],
        _accuracy,
    )


def _area(model, df: DataFrame) -> float:
    return metrics.binary_areas(models.predicted(model, df), "prediction").first()["area_under_roc"]


@query("TUN-1 TUN-2 ML-1 EV-2")
def sweep_area_by_penalty(t: Tables) -> DataFrame:
    """Area on the training and on the held-out part for each penalty."""
    train, test = _parts(_documents(t), ["id"])
    lines = [
        tuning.sweep(train, on, AREA_PENALTIES, lambda d, p: models.fit_logistic(d, p, "l2", 10), _area).select(
            F.lit(name).alias("scored_on"), "*"
        )
        for name, on in (("train", train), ("test", test))
    ]
    return reduce(DataFrame.unionByName, lines)


def _hits(model: linear.LinearModel, df: DataFrame) -> float:
    right = (model.margin(F.col("features")) > 0) == (F.col("label") == 1.0)
    return df.agg(F.avg(right.cast("double")).alias("share")).first()["share"]


@query("TUN-1 TUN-2 ML-1")
def sweep_classifier_steps(t: Tables) -> DataFrame:
    rows = _gd_rows(t, "l_orderkey").select("l_orderkey", "features", F.col("returned").alias("label"))
    return tuning.sweep(
        *_parts(rows, ["l_orderkey"]), tuning.GRIDS["step_classifier"],
        lambda d, step: linear.gradient_descent(d, loss="logistic", iterations=10, step=step, intercept=True), _hits,
    )


def _line_rmsle(model: linear.LinearModel, df: DataFrame) -> float:
    pred = df.select(F.col("label").alias("actual"), F.greatest(model.margin(F.col("features")), F.lit(0.0)).alias("predicted"))
    return metrics.regression_errors(pred).first()["rmsle"]


@query("TUN-1 TUN-2 ML-7")
def sweep_regression_steps(t: Tables) -> DataFrame:
    rows = _gd_rows(t, "l_orderkey").select("l_orderkey", "features", "label")
    return tuning.sweep(
        *_parts(rows, ["l_orderkey"]), tuning.GRIDS["step_regression"],
        lambda d, step: linear.gradient_descent(d, iterations=10, step=step, intercept=True), _line_rmsle,
    )


def _log_errors(df: DataFrame, positions: Column, values: Column, width: int, models_: np.ndarray) -> list[float]:
    """RMSLE of all linear models, columns of weights below intercepts, from one pass; predictions are 0 at least."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(models_.shape[1]), 0
        for batch in batches:
            for x, y in descent.spread(batch, width, (1, 0)):
                x[:, 0] = 1.0
                gap = np.log1p(np.maximum(x @ models_, 0.0)) - np.log1p(y)[:, None]
                total += (gap * gap).sum(axis=0)
                n += len(y)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()], pa.list_(pa.float64()))], ["n", "total"])

    parts = descent._rows_of(df, positions, values, "label").mapInArrow(fold, "n bigint, total array<double>")
    sums = parts.agg(F.sum("n"), *[F.sum(F.col("total")[i]) for i in range(models_.shape[1])]).first()
    return [float(np.sqrt(s / sums[0])) for s in sums[1:]]


@query("TUN-1 TUN-2 ML-7 ML-8")
def sweep_regressions(t: Tables) -> DataFrame:
    """Spark fits a linear model of at most 4096 columns from the rows' moments, so each fit gets a
    few rows with the same ones. The training rows are read once, and so are those that all models are scored on."""
    rentals = written(splits.hash_split(t.rentals, ["order_id"], [60, 40], seed=123), "rentals")
    encoder = encode.MixedEncoder(CATEGORIES, NUMBERS).fit(rentals)
    at, value = encoder.cells()
    rows = encoder.positions(rentals).withColumn("label", F.col("target"))
    few = descent.sparse_moments(rows.where("part = 0"), at, value, encoder.width).equal_rows()
    train = t.spark.createDataFrame(few, "features array<double>, label double, weight double").coalesce(1).persist()
    fits = [
        ("iterations", "iterations_regression", lambda p: models.fit_linear(train, iterations=p, weight="weight")),
        ("l2", "l2_regression", lambda p: models.fit_linear(train, p, "l2", 10, weight="weight")),
        ("l1", "l1_regression", lambda p: models.fit_linear(train, p, "l1", 10, weight="weight")),
        ("intercept", "intercept", lambda p: models.fit_linear(train, iterations=10, intercept=p, weight="weight")),
    ]
    places = [(name, i, p, fit) for name, grid, fit in fits for i, p in enumerate(tuning.GRIDS[grid])]
    made = [fit(p) for _, _, p, fit in places]
    train.unpersist()
    weights = np.array([[m.intercept, *m.coefficients.toArray()] for m in made]).T
    errors = _log_errors(rows.where("part = 1"), at, value, encoder.width, weights)
    lines = [(name, i, str(p), e) for (name, i, p, _), e in zip(places, errors, strict=True)]
    return t.spark.createDataFrame(lines, "swept string, place int, param string, metric double")


@query("TUN-1 TUN-2 ML-6")
def sweep_regression_depth(t: Tables) -> DataFrame:
    """Rows are read once: trees are fitted to and scored on the moments of rows with the same features."""
    parts = splits.hash_split(_tree_columns(t, "order_id"), ["order_id"], [60, 40], seed=123)
    groups = _tree_groups(parts, "part")
    return tuning.sweep(
        models.rows_of_moments(groups.where("part = 0")), groups.where("part = 1"), tuning.GRIDS["depth_regression"],
        lambda d, p: models.fit_tree_regressor(d, p, 32, "weight"), models.log_error_of_moments,
    )


@query("TUN-1 TUN-2 ML-2 ML-5")
def sweep_ten_classes(t: Tables) -> DataFrame:
    train, test = _parts(t.vectors.select("id", "label", "features"), ["id"])
    return _tables(
        train, test,
        [
            ("depth", "depth_digits", lambda d, p: models.fit_tree_classifier(d, "gini", p, 32)),
            ("bins", "bins_digits", lambda d, p: models.fit_tree_classifier(d, "gini", 5, p)),
            ("l2", "reg_digits", lambda d, p: models.fit_logistic(d, p, "l2", 10, 10)),
            ("l1", "reg_digits", lambda d, p: models.fit_logistic(d, p, "l1", 10, 10)),
        ],
        _accuracy,
    )
