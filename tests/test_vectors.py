import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import clusters, decompose, encode


def _points(spark, values):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(values)], "id long, features array<double>")


def _lloyd(points, centres, rounds):
    centres = dict(centres)
    for _ in range(rounds):
        ids = sorted(centres)
        d = np.array([((points - centres[i]) ** 2).sum(1) for i in ids])
        near = np.array(ids)[d.argmin(axis=0)]
        centres = {i: points[near == i].mean(axis=0) for i in ids if (near == i).any()}
    return centres


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("limit", [2_000_000, 4])
def test_lloyd_from_given_centres(spark, parts, limit, monkeypatch):
    monkeypatch.setattr(clusters, "MAX_CENTRE_VALUES", limit)
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 1, (20, 2)) for c in ((0, 0), (8, 8), (0, 9))])
    start = {1: x[0], 2: x[25], 3: x[45], 9: np.array([1e6, 1e6])}
    table = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in start.items()], "id long, features array<double>")
    points = _points(spark, x).repartition(parts)
    got = {r.id: r.features for r in clusters.lloyd(points, table, 4).collect()}
    want = _lloyd(x, start, 4)
    assert got.keys() == want.keys() == {1, 2, 3}
    for i in want:
        np.testing.assert_allclose(got[i], want[i], atol=1e-9)


def test_tie_goes_to_smaller_id_and_no_centre_to_minus_one(spark):
    centres = spark.createDataFrame([(5, [0.0]), (2, [2.0])], "id long, features array<double>")
    points = _points(spark, [[1.0], [0.4]])
    got = {r.id: r.cluster for r in clusters.assign(points, centres).collect()}
    assert got == {0: 2, 1: 5}
    assert {r.cluster for r in clusters.assign(points, centres.where("id < 0")).collect()} == {-1}


def test_kmeans(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.3, (30, 3)) for c in (0, 5, 10)])
    points = _points(spark, x)
    costs = {}
    for k in (2, 3):
        model = clusters.fit_kmeans(points, k, 20)
        assigned = clusters.assign(points, clusters.centre_table(spark, model))
        costs[k] = clusters.wcss(assigned).first()[0]
        assert costs[k] == pytest.approx(model.summary.trainingCost, rel=1e-6)
    assert costs[3] < costs[2] / 10
    near = clusters.nearest_members(assigned, 4).toPandas()
    assert (near.groupby("cluster")["squared"].is_monotonic_increasing).all() and len(near) == 12


def test_components_and_singular_values(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 5)) * np.array([5, 3, 2, 1, 0.5]) + 1
    df = _points(spark, x).repartition(5)
    cov = {(r.i, r.j): r.covariance for r in decompose.covariance(df).collect()}
    want = np.cov(x.T)
    assert all(cov[i, j] == pytest.approx(want[i, j]) for i in range(5) for j in range(i, 5)) and len(cov) == 15

    pc, shares = decompose.principal_components(df, 3)
    np.testing.assert_allclose(pc.T @ pc, np.eye(3), atol=1e-8)
    size, basis = np.linalg.eigh(want)
    np.testing.assert_allclose(np.abs((pc * basis[:, ::-1][:, :3]).sum(0)), 1, atol=1e-8)
    np.testing.assert_allclose(shares, size[::-1][:3] / size.sum(), atol=1e-8)

    s, v = decompose.truncated_svd(df, 5)
    np.testing.assert_allclose(s, np.linalg.svd(x)[1], rtol=1e-8)
    assert (np.diff(s) <= 0).all() and (s**2).sum() == pytest.approx((x**2).sum())
    u = np.array([r.u for r in decompose.left_vectors(df, s, v).orderBy("id").collect()])
    np.testing.assert_allclose(u * s, x @ v, atol=1e-8)

    # Centred rows: the projection on the components equals U S up to sign.
    centred = encode.scaled(df, encode.fit_scaler(df, "features", with_std=False), "features", "c").select("id", F.col("c").alias("features"))
    s, v = decompose.truncated_svd(centred, 3)
    np.testing.assert_allclose(np.abs(v), np.abs(pc), atol=1e-7)


def test_scaler_and_encoder(spark):
    df = _points(spark, [[1.0, 5.0], [3.0, 5.0]])
    scaled = {r.id: r.scaled for r in encode.scaled(df, encode.fit_scaler(df, "features"), "features").collect()}
    assert scaled[0][0] == pytest.approx(-(0.5**0.5)) and scaled[0][1] == 0.0
    rows = spark.createDataFrame([("b", "x", 1.0), ("a", "y", 2.0), ("b", "y", 3.0)], "c string, d string, n double")
    e = encode.MixedEncoder(["c", "d"], ["n"]).fit(rows.repartition(3))
    assert (e.category_width, e.width) == (4, 5)
    got = {(r.c, r.d): r.features for r in e.dense_features(rows).collect()}
    assert got == {("b", "x"): [0, 1, 1, 0, 1], ("a", "y"): [1, 0, 0, 1, 2], ("b", "y"): [0, 1, 0, 1, 3]}
    sparse = {(r.c, r.d): r.features.toArray().tolist() for r in e.vector_features(rows).collect()}
    assert sparse == got
    unseen = spark.createDataFrame([("z", "x", 1.0)], rows.schema)
    odd = unseen.unionByName(spark.createDataFrame([(None, "y", 2.0)], rows.schema))
    assert {r.c: r.features for r in e.dense_features(odd).collect()} == {"z": [0, 0, 1, 0, 1], None: [0, 0, 0, 1, 2]}
    assert {r.c: r.features.toArray().tolist() for r in e.vector_features(odd).collect()} == {"z": [0, 0, 1, 0, 1], None: [0, 0, 0, 1, 2]}
    assert {r.c: r.hot for r in e.positions(odd).collect()} == {"z": [2], None: [3]}
    fitted = encode.MixedEncoder(["c", "d"], ["n"]).fit(odd)
    assert fitted.widths == {"c": 1, "d": 2} and fitted.dense_features(odd).count() == 2


def test_wide_dictionaries_and_empty_bags(spark):
    many = spark.range(5000).select(F.format_string("v%04d", "id").alias("c"), F.lit(1.0).alias("n"))
    e = encode.MixedEncoder(["c"], ["n"]).fit(many)
    vectors = e.vector_features(many.limit(3)).collect()
    assert e.width == 5001 and all(r.features.size == 5001 and r.features.numNonzeros() == 2 for r in vectors)
    assert len(e.dense_features(many.limit(1)).first().features) == 5001
    texts = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, None), (4, ["unknown"])], "id long, w array<string>")
    terms = encode.term_dictionary(texts.where("id = 1"), F.col("w"))
    bags = {r.id: r.terms for r in encode.bag_of_terms(texts, "id", F.col("w"), terms).collect()}
    assert bags == {1: [0, 1], 2: [], 3: [], 4: []}
