import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import descent, linear

KIND = "id long, positions array<int>, values array<double>, label double"


def plain(x, y, loss, steps, step, reg, penalty):
    w = np.zeros(x.shape[1])
    for t in range(1, steps + 1):
        rate = step / t**0.5
        move = rate * x.T @ descent.SLOPES[loss](x @ w, y) / len(y)
        if penalty == "l1":
            w = np.sign(w - move) * np.maximum(np.abs(w - move) - rate * reg, 0)
        else:
            w = w * (1 - rate * reg) - move
    return w


@pytest.mark.parametrize("loss,penalty", [("logistic", "l2"), ("squared", "l1"), ("hinge", "l2")])
def test_ten_thousand_positions(spark, loss, penalty):
    rng, width = np.random.default_rng(4), 10_000
    x, rows = np.zeros((300, width)), []
    for i in range(300):
        at = rng.choice(width, 25, replace=False)
        at[0] = i % 2
        x[i, at] = rng.random(25)
        rows.append((i, [int(a) for a in at], [float(v) for v in x[i, at]], float(i % 2)))
    df = spark.createDataFrame(rows, KIND).repartition(5)
    model = descent.sparse_descent(df, F.col("positions"), F.col("values"), width, loss=loss, iterations=6, step=2.0, reg=1e-4, penalty=penalty, tolerance=0.0)
    want = plain(x, np.arange(300) % 2.0, loss, 6, 2.0, 1e-4, penalty)
    np.testing.assert_allclose(model.weights, want, atol=1e-10)
    got = {r["id"]: r["margin"] for r in descent.margins(df, model, F.col("positions"), F.col("values")).collect()}
    np.testing.assert_allclose([got[i] for i in range(300)], x @ want, atol=1e-10)


def test_dense_equals_the_built_in_sums(spark):
    rng = np.random.default_rng(5)
    rows = [([float(v) for v in rng.random(3)], float(rng.random() > 0.5)) for _ in range(90)]
    df = spark.createDataFrame(rows, "features array<double>, label double").persist()
    for loss in descent.SLOPES:
        asked = dict(loss=loss, iterations=5, step=0.7, reg=0.05, penalty="l2", intercept=True, tolerance=0.0)
        a = linear.gradient_descent(df, **asked)
        b = descent.sparse_descent(df, *descent.dense(F.col("features")), 3, **asked)
        np.testing.assert_allclose([*b.weights, b.intercept], [*a.weights, a.intercept], atol=1e-10)


def test_odd_rows(spark):
    rows = [(1, [0, 0], [1.0, 2.0], 3.0), (2, [], [], 0.0), (3, None, None, 1.0), (4, [1], [1.0], None), (5, [1, None], [None, 4.0], 0.0), (6, [1], None, 1.0)]
    df = spark.createDataFrame(rows, KIND)
    at, value = F.col("positions"), F.col("values")
    model = descent.sparse_descent(df, at, value, 2, iterations=1, step=1.0)
    np.testing.assert_allclose(model.weights, [3.0, 0.0])  # 3 * 3 over three rows
    got = {r["id"]: r["margin"] for r in descent.margins(df, model, at, value).collect()}
    assert got == {1: 9.0, 2: 0.0, 3: None, 4: 0.0, 5: 0.0, 6: None}
    assert descent.sparse_descent(df.limit(0), at, value, 2, iterations=2).weights == (0.0, 0.0)
    with pytest.raises(Exception, match="positions must lie in"):
        descent.sparse_descent(spark.createDataFrame([(1, [2], [1.0], 1.0)], KIND), at, value, 2, iterations=1)


def test_mini_batches_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [0, 1], [float(v) for v in rng.random(2)], float(i % 3 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, KIND)
    fit = lambda d: descent.sparse_descent(d, F.col("positions"), F.col("values"), 2, iterations=8, tolerance=0.0, batch=(["id"], 0.3))
    one, other = fit(df.repartition(1)), fit(df.repartition(6))
    np.testing.assert_allclose(one.weights, other.weights, atol=1e-10)
    whole = descent.sparse_descent(df, F.col("positions"), F.col("values"), 2, iterations=8, tolerance=0.0)
    assert np.abs(np.array(one.weights) - whole.weights).max() > 1e-4


def test_the_plan_has_a_fixed_size(spark, monkeypatch):
    plans, fold = [], descent._folded

    def noted(rows, weights, width, loss):
        plans.append(len(rows._jdf.queryExecution().optimizedPlan().toString()))
        return fold(rows, weights, width, loss)

    monkeypatch.setattr(descent, "_folded", noted)
    df = spark.createDataFrame([(1, [0], [1.0], 1.0)], KIND)
    for width in (2, 20_000):
        descent.sparse_descent(df, F.col("positions"), F.col("values"), width, iterations=3, tolerance=0.0)
    assert max(plans) - min(plans) < 50


def test_squared_error_reads_the_rows_once(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.random((200, 6)) * (rng.random((200, 6)) < 0.6)
    y = rng.random(200)
    rows = [(i, [int(a) for a in np.flatnonzero(x[i])], [float(v) for v in x[i][x[i] != 0]], float(y[i])) for i in range(200)]
    df = spark.createDataFrame(rows, KIND).repartition(4)
    monkeypatch.setattr(descent, "_folded", lambda *_: pytest.fail("a step read the rows"))
    for penalty in ("l1", "l2"):
        asked = dict(iterations=6, step=0.5, reg=0.01, penalty=penalty, tolerance=0.0)
        model = descent.sparse_descent(df, F.col("positions"), F.col("values"), 6, **asked)
        np.testing.assert_allclose(model.weights, plain(x, y, "squared", 6, 0.5, 0.01, penalty), atol=1e-10)
