import os
from functools import partial

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from tallyforge.operators import descent, encode, linear, metrics, models, splits, tuning
from tallyforge.plans import model_queries
from tallyforge.plans.catalog import CATALOG
from tallyforge.plans.views import Tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def two_classes(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(m, 1, (60, 2)) for m in (1, 5)])
    rows = [(float(i >= 60), [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "label double, features array<double>").persist()


@pytest.fixture(scope="module")
def line(spark):
    rng = np.random.default_rng(1)
    x = rng.random((80, 3))
    y = x @ np.array([3.0, 0.0, -2.0]) + 1
    return spark.createDataFrame([(float(b), [float(v) for v in a]) for a, b in zip(x, y)], "label double, features array<double>").persist()


def _accuracy(model, df):
    return metrics.accuracy(models.predicted(model, df)).first()["accuracy"]


def test_classifiers_beat_the_majority(two_classes):
    for fit in (models.fit_logistic, models.fit_svm, models.fit_tree_classifier):
        model = fit(two_classes)
        assert _accuracy(model, two_classes) > 0.9
        assert {r[0] for r in models.predicted(model, two_classes).select("prediction").distinct().collect()} <= {0.0, 1.0}
    shallow, deep = (models.fit_tree_classifier(two_classes, depth=d) for d in (1, 6))
    assert _accuracy(deep, two_classes) >= _accuracy(shallow, two_classes)


def test_ten_classes(spark):
    rng = np.random.default_rng(3)
    rows = [(float(c), [float(v) for v in rng.normal(0, 0.3, 3) + np.eye(3)[c] * 4]) for c in range(3) for _ in range(30)]
    df = spark.createDataFrame(rows, "label double, features array<double>")
    clamped = df.withColumn("features", F.transform("features", lambda x: F.greatest(x, F.lit(0.0))))
    assert _accuracy(models.fit_logistic(df, classes=3), df) > 0.8
    assert _accuracy(models.fit_svm(df, classes=3), df) > 0.8
    assert _accuracy(models.fit_bayes(clamped), clamped) > 0.8


def test_descent_finds_the_line(line):
    model = linear.gradient_descent(line, iterations=400, step=2.0, intercept=True, tolerance=0.0)
    np.testing.assert_allclose([*model.weights, model.intercept], [3, 0, -2, 1], atol=0.15)
    x, y = (np.array([r[c] for r in line.collect()]) for c in ("features", "label"))
    w = np.zeros(3)
    for t in range(1, 8):
        w = w * (1 - 0.1 * 0.5 / t**0.5) - 0.5 / t**0.5 * x.T @ (x @ w - y) / len(y)
    ridge = linear.gradient_descent(line.repartition(7), iterations=7, step=0.5, reg=0.1, penalty="l2", tolerance=0.0)
    np.testing.assert_allclose(ridge.weights, w, atol=1e-10)
    early = linear.gradient_descent(line, iterations=50, step=0.5, tolerance=0.5)
    assert early.iterations < 50


def test_penalties(line):
    zeros = [linear.zero_weights(linear.gradient_descent(line, iterations=30, reg=r, penalty="l1")) for r in (0.0, 0.2, 5.0)]
    assert zeros == sorted(zeros) and zeros[-1] == 3
    small, large = (models.fit_linear(line, r, "l2") for r in (0.01, 10.0))
    assert np.linalg.norm(large.coefficients.toArray()) < np.linalg.norm(small.coefficients.toArray())


def test_tree_regression(line):
    model = models.fit_tree_regressor(line, depth=1)
    assert models.tree_shape(model) == (1, 3)
    assert models.predicted(model, line).select("prediction").distinct().count() <= 2


def test_tree_on_moments(spark):
    """Rows with the same features, as moments, give Spark's tree of the rows and its error, and copies add no rows."""
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(1, 6, 3000), rng.integers(0, 9, 3000)]).astype(float)
    y = x[:, 0] * 3 + (x[:, 1] > 4) * x[:, 1] + rng.exponential(2.0, 3000) - 1.5
    rows = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "p double, q double, label double")
    raw = encode.ordinal_features(rows, ["p", "q"])
    groups = encode.ordinal_features(models.label_moments(rows, ["p", "q"]), ["p", "q"]).persist()
    few = models.rows_of_moments(groups, 200).persist()
    assert groups.count() == 45 and few.count() < 300 and abs(few.agg(F.sum("weight")).first()[0] - 3000) < 1e-6
    for depth, bins in ((1, 2), (3, 4), (10, 32)):
        a, b = models.fit_tree_regressor(raw, depth, bins), models.fit_tree_regressor(few, depth, bins, "weight")
        assert models.tree_shape(a) == models.tree_shape(b)
        error = metrics.regression_errors(models.truth_and_prediction(a, raw)).first()["rmsle"]
        assert abs(models.log_error_of_moments(b, groups) - error) < 1e-9
    copies = rows.crossJoin(spark.range(10)).drop("id")
    many = encode.ordinal_features(models.label_moments(copies, ["p", "q"]), ["p", "q"])
    assert models.rows_of_moments(many, 200).count() < 300
    lone = encode.ordinal_features(models.label_moments(rows.withColumn("q", F.monotonically_increasing_id() * 1.0), ["q"]), ["q"])
    assert models.rows_of_moments(lone).count() == 3000


@pytest.mark.parametrize("name", ["sweep_regression_bins", "sweep_regression_depth"])
def test_tree_sweeps_fit_to_moments(spark, name, tmp_path, monkeypatch):
    """Copies of the order lines add no rows to what the trees of a sweep are fitted to."""
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    for copies in (1, 8):
        (tmp_path / str(copies)).mkdir()
        lines.crossJoin(spark.range(copies)).drop("id").write.parquet(f"{tmp_path}/{copies}/lineitem.parquet")
        os.symlink(f"{SMALL}/orders.parquet", tmp_path / str(copies) / "orders.parquet")
    monkeypatch.setattr(tuning, "sweep", lambda train, *_: train)
    monkeypatch.setattr(models, "rows_of_moments", partial(models.rows_of_moments, pieces=1000))
    once, often = (CATALOG[name](spark, str(tmp_path / str(copies))) for copies in (1, 8))
    assert often.count() <= 2 * once.count()
    assert abs(often.agg(F.sum("weight")).first()[0] - 8 * once.agg(F.sum("weight")).first()[0]) < 1e-3


def test_bins_swept_as_on_rows(spark, monkeypatch):
    monkeypatch.setitem(tuning.GRIDS, "bins_regression", [2, 32])
    got = [r.metric for r in CATALOG["sweep_regression_bins"](spark, SMALL).collect()]
    rows = model_queries._tree_rows(Tables(spark, SMALL)).persist()
    for bins, error in zip([2, 32], got, strict=True):
        model = models.fit_tree_regressor(rows, 5, bins)
        assert abs(error - metrics.regression_errors(models.truth_and_prediction(model, rows)).first()["rmsle"]) < 1e-9


def test_target_transforms(line):
    for t in linear.TRANSFORMS.values():
        back = line.select(F.max(F.abs(t.inverse(t.forward(F.col("label") + 5)) - F.col("label") - 5))).first()[0]
        assert back < 1e-9


def test_sweep_equals_direct_fit(two_classes):
    grid = [1, 3]
    table = tuning.sweep(two_classes, two_classes, grid, lambda d, p: models.fit_tree_classifier(d, depth=p), _accuracy)
    got = {r.param: r.metric for r in table.collect()}
    assert got == {str(p): _accuracy(models.fit_tree_classifier(two_classes, depth=p), two_classes) for p in grid}


def test_cross_validation_on_folds(line):
    rows = models.as_vectors(line).withColumn("pos", F.monotonically_increasing_id())
    folded = splits.consecutive_folds(rows, ["pos"], 3)
    estimator = LinearRegression()
    grid = ParamGridBuilder().addGrid(estimator.regParam, [0.0, 5.0]).build()
    model = tuning.cross_validate(folded, estimator, RegressionEvaluator(), grid, "fold", 3)
    assert len(model.avgMetrics) == 2 and model.avgMetrics[0] < model.avgMetrics[1]


def test_fits_on_rows_of_equal_moments(spark):
    """Some rows that have the moments of many give Spark's fits of the many, whatever the penalty."""
    rng = np.random.default_rng(9)
    x = np.column_stack([np.eye(3)[rng.integers(0, 3, 500)][:, 1:], np.eye(2)[rng.integers(0, 2, 500)][:, 1:], rng.random((500, 2)) * 50])
    y = x @ np.array([-2.0, 0.0, 1.0, 0.5, -0.1]) + rng.normal(0, 2, 500) + 30
    rows = [([float(v) for v in a], float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "features array<double>, label double").repartition(3).persist()
    found = descent.sparse_moments(df, *descent.dense(F.col("features")), 5)
    few = spark.createDataFrame(found.equal_rows(), "features array<double>, label double, weight double")
    assert few.count() == 12
    for options in ({}, {"iterations": 1}, {"intercept": False}, {"reg": 0.5, "penalty": "l2"}, {"reg": 0.5, "penalty": "l1"}):
        a, b = models.fit_linear(df, **options), models.fit_linear(few, weight="weight", **options)
        np.testing.assert_allclose(x @ b.coefficients.toArray() + b.intercept, x @ a.coefficients.toArray() + a.intercept, atol=1e-3)
