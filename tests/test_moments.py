import numpy as np
import pytest

from tallyforge.operators import decompose, moments, wide

ROWS = "features array<double>, label double, fold int, i int"


def _data(n=90, width=4, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) + np.arange(width)
    x[:, -1] = 3.0  # a column without spread
    y = x @ np.arange(1.0, width + 1) + rng.normal(size=n)
    return x, y, np.arange(n) % 3


def _table(spark, x, y, folds):
    rows = [(v.tolist(), float(t), int(f), 7) for v, t, f in zip(x, y, folds)]
    return spark.createDataFrame([*rows, (None, 1.0, 0, 1), ([0.0] * x.shape[1], None, 1, 1), ([0.0] * x.shape[1], 1.0, None, 1)], ROWS).repartition(4)


@pytest.mark.parametrize("intercept", [False, True])
def test_paths_and_fold_errors_equal_plain_fits(spark, intercept):
    x, y, folds = _data()
    found = moments.fold_moments(_table(spark, x, y, folds), "fold")
    assert [m.n for m in found.values()] == [30.0, 30.0, 30.0]
    errors = {(f, kind, reg): (e, z) for f, kind, reg, e, z in moments.fold_errors(found, [0.0, 2.0], [0.5, 100.0], intercept)}
    assert len(errors) == 12
    for f in range(3):
        a, b, ta, tb = x[folds != f], y[folds != f], x[folds == f], y[folds == f]
        means = (a.mean(axis=0), b.mean()) if intercept else (np.zeros(4), 0.0)
        ca, cb = a - means[0], b - means[1]
        for reg in (0.0, 2.0):
            w = np.linalg.lstsq(np.vstack([ca / np.sqrt(len(a)), np.sqrt(reg) * np.eye(4)]), np.concatenate([cb / np.sqrt(len(a)), np.zeros(4)]), rcond=1e-9)[0]
            want = np.mean((tb - (ta - means[0]) @ w - means[1]) ** 2)
            assert errors[f, "l2", reg][0] == pytest.approx(want, rel=1e-6)
        # lasso: the gradient of the smooth part is inside the penalty's subgradient
        total = sum(list(found.values())[1:], start=found[0])
        model = (total - found[f]).lasso_path([0.5, 100.0], intercept)
        for reg, m in model.items():
            gradient = ca.T @ (ca @ m[1:] - cb) / len(a)
            for g, w in zip(gradient, m[1:]):
                assert abs(g + reg * np.sign(w)) < 1e-6 if w else abs(g) <= reg + 1e-6
        assert errors[f, "l1", 100.0][1] == 4 if intercept else errors[f, "l1", 100.0][1] >= 3


def test_no_rows_have_no_folds(spark):
    assert moments.fold_moments(spark.createDataFrame([], ROWS), "fold") == {}
    assert moments.fold_errors({}) == []


@pytest.mark.parametrize("centred", [False, True])
def test_range_finder_equals_plain_decomposition(spark, centred):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 40)) * np.linspace(3, 0.1, 40) + 2
    df = spark.createDataFrame([(r.tolist(),) for r in x], "features array<double>").repartition(5)
    n, mean, spread = wide.moments(df)
    assert n == 60 and np.allclose(mean, x.mean(axis=0)) and spread == pytest.approx(((x - mean) ** 2).sum())
    centre = mean if centred else None
    values, found = wide.leading(df, 3, centre, 40, spare=4)
    a = x - mean if centred else x
    _, s, right = np.linalg.svd(a)
    assert np.allclose(values, s[:3] ** 2, rtol=1e-9)
    assert np.allclose(np.abs(np.sum(found * right[:3].T, axis=0)), 1.0, atol=1e-9)


def test_components_of_ten_thousand_columns(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(30, 6)) @ (rng.normal(size=(6, 10_000)) * np.array([[9.0], [6], [4], [2], [1], [0.5]])) + 1
    df = spark.createDataFrame([(r.tolist(),) for r in x], "features array<double>").repartition(4)
    components, shares = decompose.principal_components(df, 8)
    a = x - x.mean(axis=0)
    _, s, right = np.linalg.svd(a, full_matrices=False)
    assert components.shape == (10_000, 8)
    assert np.allclose(shares[:6], (s**2 / (s**2).sum())[:6], atol=1e-9) and np.allclose(shares[6:], 0, atol=1e-9)
    assert np.allclose(np.abs(np.sum(components[:, :5] * right[:5].T, axis=0)), 1.0, atol=1e-6)
    values, found = decompose.truncated_svd(df, 2)
    _, s, right = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(values, s[:2]) and np.allclose(np.abs(np.sum(found * right[:2].T, axis=0)), 1.0, atol=1e-6)
