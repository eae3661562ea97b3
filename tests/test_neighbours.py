import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import blocks, factors, neighbours

# User 6 rated everything; items 5 and 6 share no rater but user 6; item 7 has a rater of its own.
ROWS = [
    (1, 1, 5), (1, 2, 3), (1, 3, 4), (2, 1, 3), (2, 2, 1), (2, 4, 2), (3, 1, 4), (3, 2, 3), (3, 3, 4),
    (4, 5, 2), (4, 1, 1), (5, 6, 5), (5, 3, 4), (8, 7, 3),
] + [(6, i, 1 + i % 5) for i in range(1, 8)]
SCHEMA = "user_id long, item_id long, rating double"
ITEMS = sorted({r[1] for r in ROWS})
USERS = sorted({r[0] for r in ROWS})


def _table(spark, rows=ROWS):
    return spark.createDataFrame([(u, i, float(v)) for u, i, v in rows], SCHEMA)


def _matrix(rows):
    m = {(u, i): float(v) for u, i, v in rows}
    return m


def _co(m, a, b):
    users = [u for u, i in m if i == a and (u, b) in m]
    return np.array([m[u, a] for u in users]), np.array([m[u, b] for u in users])


def _euclid(a, b):
    return 1 / (1 + np.linalg.norm(a - b))


def _pearson(a, b):
    if len(a) < 3:
        return 1.0
    if a.std() == 0 or b.std() == 0:
        return 0.0
    return 0.5 + 0.5 * np.corrcoef(a, b)[0, 1]


def _cosine(a, b):
    return 0.5 + 0.5 * (a @ b) / (np.linalg.norm(a) * np.linalg.norm(b))


KINDS = {"euclid": (_euclid, neighbours.euclid), "pearson": (_pearson, neighbours.pearson), "cosine": (_cosine, neighbours.cosine)}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("light", [256, 3, 0])
def test_similarity_equals_brute_force(spark, kind, light):
    plain, column = KINDS[kind]
    m = _matrix(ROWS)
    want = {}
    for a in ITEMS:
        for b in ITEMS:
            if a < b:
                x, y = _co(m, a, b)
                if len(x):
                    want[a, b] = (len(x), plain(x, y))
    sums = neighbours.co_rating_sums(_table(spark).repartition(5), light=light, item_block=2, user_block=2)
    got = {(r.item_a, r.item_b): (r.n, r.similarity) for r in neighbours.similarities(sums, column).collect()}
    assert got.keys() == want.keys()
    for pair, (n, s) in want.items():
        assert got[pair][0] == n and got[pair][1] == pytest.approx(s, abs=1e-9)


def test_heavy_and_light_agree_on_random_data(spark):
    rng = np.random.default_rng(3)
    rows = [(u, i, int(rng.integers(1, 6))) for u in range(40) for i in range(60) if rng.random() < (0.9 if u < 3 else 0.1)]
    t = _table(spark, rows)
    a = neighbours.co_rating_sums(t, light=10_000).toPandas().sort_values(["item_a", "item_b"]).to_numpy()
    b = neighbours.co_rating_sums(t, light=20, item_block=16, user_block=2).toPandas().sort_values(["item_a", "item_b"]).to_numpy()
    np.testing.assert_allclose(a, b)


@pytest.mark.parametrize("cell_pairs", [1, 40, 10**6])
def test_pairs_of_cells_equal_joined_rows(spark, cell_pairs, monkeypatch):
    """Whatever the cells are: cut by user, one for each few items, one for all."""
    monkeypatch.setattr(neighbours, "PAIRS_AT_ONCE", 30)
    monkeypatch.setattr(neighbours, "LISTS_AT_ONCE", 7)
    rng = np.random.default_rng(4)
    rows = [(u, 7 * i - 90, int(rng.integers(1, 6))) for u in range(-20, 40) for i in range(30) if rng.random() < (0.9 if i == 3 else 0.2)]
    t = _table(spark, rows)
    extra = spark.createDataFrame([(None, 1, 2.0), (3, None, 2.0), (99, 1, 5.0)], SCHEMA)
    a, b = (t.select("user_id", F.col("item_id").alias(f"item_{x}"), F.col("rating").alias(x)) for x in "ab")
    want = a.join(b, "user_id").where("item_a < item_b").groupBy("item_a", "item_b").agg(
        F.count("*").cast("double"), F.sum("a"), F.sum("b"), F.sum(F.expr("a * b")), F.sum(F.expr("a * a")), F.sum(F.expr("b * b"))
    )
    got = neighbours.co_rating_sums(t.unionByName(extra), cell_pairs=cell_pairs)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert neighbours.co_rating_sums(t.where("user_id > 100")).collect() == []


def test_pairs_are_not_shuffled(spark):
    """Without hot users and items, users' lists move and pairs don't: each comes out of one cell."""
    r = _table(spark, [(u, i, 1 + (u + i) % 5) for u in range(50) for i in range(u % 7, 40, 3)])
    plan = neighbours.co_rating_sums(r, cell_pairs=1000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(cell" in plan and "Join" not in plan


@pytest.mark.parametrize("kind", KINDS)
def test_recommendations_equal_brute_force(spark, kind):
    plain, column = KINDS[kind]
    m = _matrix(ROWS)
    want = {}
    for u in USERS:
        scores = []
        for i in ITEMS:
            if (u, i) in m:
                continue
            num = den = 0.0
            for j in ITEMS:
                if (u, j) in m:
                    x, y = _co(m, i, j)
                    s = plain(x, y) if len(x) else 0.0
                    num, den = num + s * m[u, j], den + s
            scores.append((i, round(num / den + 1e-9, 6) if den else 0.0))
        want[u] = sorted(scores, key=lambda p: (-p[1], p[0]))[:4]
    got = {}
    for r in neighbours.recommend(_table(spark), 4, column).orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append((r.item_id, r.score))
    assert 6 not in got
    for u in USERS:
        assert got.get(u, []) == want[u], u


def _small_blocks(monkeypatch, users, targets, sources):
    for name, size in (("USER_BLOCK", users), ("TARGET_BLOCK", targets), ("SOURCE_BLOCK", sources), ("TERMS_AT_ONCE", 50)):
        monkeypatch.setattr(blocks, name, size)


@pytest.mark.parametrize("sizes", [(4096, 1024, 32768), (7, 3, 32768), (7, 8, 5)])
def test_blocked_estimates_equal_joined_terms(spark, monkeypatch, sizes):
    _small_blocks(monkeypatch, *sizes)
    rng = np.random.default_rng(5)
    t = _table(spark, [(u, i, int(rng.integers(1, 6))) for u in range(30) for i in range(40) if rng.random() < 0.2])
    sims = neighbours.similarities(neighbours.co_rating_sums(t))
    links = neighbours.mirrored(sims.where("similarity > 0"))
    want = (
        t.join(links, "item_id").groupBy("user_id", F.col("target").alias("item_id"))
        .agg((F.sum(F.col("similarity") * F.col("rating")) / F.sum("similarity")).alias("score"))
        .join(t.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    )
    rounded = ["user_id", "item_id", F.round("score", 9).alias("s")]
    got = neighbours.estimates(t, sims)
    assert sorted(got.select(*rounded).collect()) == sorted(want.select(*rounded).collect())
    ranked = {}
    for r in sorted(neighbours.estimates(t, sims, 6).collect(), key=lambda r: (-r.score, r.item_id)):
        ranked.setdefault(r.user_id, []).append(r.item_id)
    best = {}
    for r in sorted(neighbours.estimates(t, sims, 6, best=3).collect(), key=lambda r: (-r.score, r.item_id)):
        best.setdefault(r.user_id, []).append(r.item_id)
    assert {u: v[:3] for u, v in ranked.items()} == {u: v[:3] for u, v in best.items()}
    pairs = spark.createDataFrame([(u, i) for u in range(0, 33, 3) for i in range(0, 44, 4)], "user_id int, item_id int")
    stated = {r[:2]: r[2] for r in map(tuple, neighbours.stated_estimates(t, sims, pairs.union(pairs), 6).collect())}
    every = {r[:2]: r[2] for r in map(tuple, neighbours.estimates(t, sims, 6).collect())}
    rated = {(r.user_id, r.item_id) for r in t.collect()}
    assert len(stated) == pairs.count()
    assert all(stated[p] == pytest.approx(every.get(p)) if every.get(p) else stated[p] is None for p in stated if p not in rated)


def test_cells_are_bounded_while_items_grow(spark, monkeypatch):
    """Strips of a cell stay below the source block and terms of a strip below the other blocks,
    however many items there are; links go to blocks of users that rated their source only."""
    _small_blocks(monkeypatch, 16, 8, 20)
    rng = np.random.default_rng(9)
    for items in (40, 160):
        t = neighbours._typed(_table(spark, [(u, i, 3) for i in range(items) for u in rng.choice(100, 3, replace=False).tolist()]))
        sims = neighbours.similarities(neighbours.co_rating_sums(t)).select("item_a", "item_b", "similarity")
        grid = blocks.Grid.of(100, items, 1)
        assert grid.targets == items // 8 and grid.sources == items // 20
        rows = blocks.cells(t, sims, grid).select("ub", "tb", "sb", "source", F.size("ub_ids").alias("u"), F.size("tb_ids").alias("t")).collect()
        strips = {}
        for r in rows:
            strips[r.ub, r.tb, r.sb] = strips.get((r.ub, r.tb, r.sb), 0) + 1
        assert max(strips.values()) <= 2 * 2 * 20  # an item's links and its own mark; hashing fills blocks unevenly
        assert max(r.u for r in rows) <= 2 * 16 and max(r.t for r in rows) <= 3 * 8
        raters = {(r.item_id, r.ub) for r in t.select("item_id", blocks.numbered("user_id", grid.users).alias("ub")).collect()}
        assert {(r.source, r.ub) for r in rows} == raters


def test_ids_that_lie_together_share_cells(spark, monkeypatch):
    """Ten groups of users and items that have nothing in common: with ids in ranges each strip meets one or two
    cells a side and sums are whole; ids that leave gaps are hashed and give the same scores."""
    monkeypatch.setattr(blocks, "USER_BLOCK", 10)
    monkeypatch.setattr(blocks, "TARGET_BLOCK", 8)
    rng = np.random.default_rng(6)
    rows = [(10 * g + u, 8 * g + i, int(rng.integers(1, 6))) for g in range(10) for u in range(10) for i in range(8) if rng.random() < 0.5]
    rows += [(10 * g, 8 * g, 1) for g in range(10)] + [(10 * g + 9, 8 * g + 7, 1) for g in range(10)]
    t = neighbours._typed(_table(spark, [(u, i, v) for (u, i), v in {(u, i): v for u, i, v in rows}.items()]))

    def scores(ratings):
        sims = neighbours.similarities(neighbours.co_rating_sums(ratings))
        seen = []
        cells = blocks.cells
        monkeypatch.setattr(blocks, "cells", lambda *a: seen.append(cells(*a)) or seen[-1])
        got = {r[:2]: r[2] for r in map(tuple, neighbours.estimates(ratings, sims, 6).collect())}
        monkeypatch.setattr(blocks, "cells", cells)
        return got, seen[0].select("ub", "tb", "sb").distinct().count()

    near, few = scores(t)
    apart, many = scores(t.select(F.expr("user_id + (user_id DIV 60) * 1000000").alias("user_id"), F.expr("-item_id * item_id * item_id").alias("item_id"), "rating"))
    assert few <= 2 * 10 and many > 2 * few
    assert {(u + u // 60 * 10**6, -(i**3)): s for (u, i), s in near.items()} == apart


def test_latent_space_and_profiles(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(30, 5)) @ (rng.normal(size=(5, 12)) * np.array([[6], [4], [3], [2], [0.5]])) + 5
    rows = [(u, i, float(m[u, i])) for u in range(30) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    space = factors.latent_items(df, 4)
    v = np.array([r.features for r in space.orderBy("item_id").collect()])
    right = np.linalg.svd(m)[2][:4].T
    np.testing.assert_allclose(np.abs((v * right).sum(axis=0)), 1.0, atol=1e-8)
    top = np.abs(v).argmax(axis=0)
    assert (v[top, range(4)] > 0).all()

    kept = df.where((F.col("user_id") + F.col("item_id")) % 3 != 0)
    pairs = df.select("user_id", "item_id").where("user_id < 5")
    fast = {(r[0], r[1]): r[2] for r in neighbours.profile_estimates(kept, pairs, space).collect()}
    slow = {(r[0], r[1]): r[2] for r in neighbours.pair_estimates(kept, pairs, space, neighbours.cosine_of).collect()}
    assert fast.keys() == slow.keys() and len(fast) == 60
    for pair, score in slow.items():
        assert fast[pair] == pytest.approx(score, abs=1e-9)
    flipped = space.withColumn("features", F.transform("features", lambda x: -x))
    again = {(r[0], r[1]): r[2] for r in neighbours.profile_estimates(kept, pairs, flipped).collect()}
    assert again == pytest.approx(fast)


def test_latent_space_moves_no_rating(spark, monkeypatch, tmp_path):
    """Blocks of users get the vectors of their items; no user's sums are shuffled. Users with too many rows are joined."""
    rng = np.random.default_rng(3)
    rows = [(u, i, float(rng.integers(1, 6))) for u in range(40) for i in range(25) if rng.random() < 0.6 or u == 7]
    rows += [(None, 3, 1.0), (3, None, 1.0), (99, 3, None)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double").persist()
    pairs = df.where("user_id < 20").select("user_id", "item_id").unionByName(spark.createDataFrame([(2, 10**6), (10**6, 2)], "user_id long, item_id long"))

    def everything():
        space = factors.latent_items(df, 2)
        vectors = {r.item_id: r.features for r in space.collect()}
        both = [{(r[0], r[1]): r[2] for r in neighbours.profile_estimates(df, p, space).collect()} for p in (pairs, None)]
        return vectors, *both

    plain = everything()
    m = np.zeros((40, 25))
    for u, i, rating in rows[:-3]:
        m[u, i] = rating
    right = np.linalg.svd(m)[2][:2].T
    np.testing.assert_allclose(np.abs((np.array([plain[0][i] for i in range(25)]) * right).sum(axis=0)), 1.0, atol=1e-8)
    assert len(plain[1]) == sum(r[0] is not None and r[0] < 20 for r in rows if r[1] is not None)
    assert {p: s for p, s in plain[2].items() if p[0] < 20} == pytest.approx(plain[1])
    monkeypatch.setattr(blocks, "ROWS", 100)
    monkeypatch.setattr(blocks, "HEAVY", 20)
    for cut, whole in zip(everything(), plain):
        assert cut.keys() == whole.keys()
        for key, value in whole.items():
            assert cut[key] == pytest.approx(value, abs=1e-9)
    placed, heavy = blocks.by_user(df.dropna())
    assert placed.select("block").distinct().count() > 1 and 7 in {r[0] for r in heavy.select("user_id").distinct().collect()}
    assert placed.groupBy("user_id").agg(F.count_distinct("block").alias("n")).agg(F.max("n")).first()[0] == 1


def test_most_similar_leaves_itself_out(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0])], "id long, features array<double>")
    assert [r.id for r in neighbours.most_similar(df, 1, 5).collect()] == [2, 3]


def test_factor_model(spark):
    rng = np.random.default_rng(2)
    u, v = rng.random((20, 3)) + 0.5, rng.random((15, 3)) + 0.5
    rows = [(i, j, float(u[i] @ v[j])) for i in range(20) for j in range(15) if (i * j) % 4]
    df = spark.createDataFrame(rows, SCHEMA)
    model = factors.fit(df, rank=3, rounds=10, reg=0.01)
    uf = {r.id: np.array(r.features) for r in factors.user_factors(model).collect()}
    vf = {r.id: np.array(r.features) for r in factors.item_factors(model).collect()}
    assert len(uf) == df.select("user_id").distinct().count() and len(vf) == df.select("item_id").distinct().count()
    for r in factors.predict(model, df).limit(20).collect():
        assert r.prediction == pytest.approx(uf[r.user_id] @ vf[r.item_id], abs=1e-4)
    err = df.join(factors.predict(model, df), ["user_id", "item_id"]).select(F.avg((F.col("rating") - F.col("prediction")) ** 2)).first()[0]
    assert err < df.select(F.var_pop("rating")).first()[0]
    every = factors.recommend_to_all(model, 5)
    assert {tuple(r) for r in every.groupBy("user_id").agg(F.count("*"), F.max("rank")).select("count(1)", "max(rank)").collect()} == {(5, 5)}
    one = factors.recommend_to(model, df.where("user_id = 3").select("user_id").distinct(), 5)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, every.where("user_id = 3").collect()))
    again = factors.recommend_to_all(factors.fit(df, rank=3, rounds=10, reg=0.01), 5)
    assert sorted(r.item_id for r in again.collect()) == sorted(r.item_id for r in every.collect())


def test_blocks_of_a_fit_are_ranges_of_ids(spark, monkeypatch):
    """Codes turn back into ids, and ids that lie together share Spark's block, the code's remainder."""
    ids = [*range(-50, 950), 940]
    assert factors.Codes.of(spark.createDataFrame([(i,) for i in ids], "user_id long"), "user_id", 10).span is None
    monkeypatch.setattr(factors, "RANGED", 1)
    df = spark.createDataFrame([(i,) for i in ids], "user_id long")
    codes = factors.Codes.of(df, "user_id", 10)
    coded = [tuple(r) for r in df.select("user_id", codes.code(F.col("user_id")), codes.id(codes.code(F.col("user_id")))).collect()]
    assert codes.span == (-50, 949) and all(i == back for i, _, back in coded) and len({c for _, c, _ in coded}) == 1000
    assert all(c % 10 == (i + 50) // 100 for i, c, _ in coded)
    assert df.limit(1).select(codes.code(F.lit(950)), codes.code(F.lit(-51))).first() == (None, None)
    uneven = factors.Codes.of(df.unionByName(df.limit(1).select(F.lit(10**6).alias("user_id"))), "user_id", 10)
    assert uneven.span is None
    t = _table(spark, [(u, i, 1 + (u * i) % 5) for u in range(40) for i in range(30) if (u + i) % 3])
    model = factors.fit(t, rank=2, rounds=2)
    assert model.users.span == (0, 39) and model.items.span == (0, 29)
    asked = spark.createDataFrame([(1, 1), (1, 30), (40, 1), (50, 50)], "user_id int, item_id int")
    assert [r[:2] for r in factors.predict(model, asked).collect()] == [(1, 1)]
    assert factors.optimality(t, model).agg(F.max("residual")).first()[0] < 1e-6


@pytest.mark.parametrize("users", [3, 16_384])
def test_factors_are_sent_once_a_block(spark, monkeypatch, users):
    """Blocks of any size find each rating's factors; a wrong score and unknown ids are seen as such. What
    is joined with factors are items of blocks, never ratings."""
    monkeypatch.setattr(factors, "USERS", users)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        t = _table(spark, [(u, i, 1 + (u * i) % 5) for u in range(20) for i in range(15) if (u + i) % 3])
        model = factors.fit(t, rank=3, rounds=2)
        extra = spark.createDataFrame([(1, 99, 1.0), (99, 1, 1.0), (None, 1, 1.0)], "user_id int, item_id int, prediction double")
        scored = factors.predict(model, t).withColumn("prediction", F.when(F.expr("user_id = 4 AND item_id = 3"), 99.0).otherwise(F.col("prediction")))
        rows = factors.agreement(scored.unionByName(extra), "prediction", model)
        got = {(r.user_id, r.item_id): r.same for r in rows.collect()}
        assert got == {(r.user_id, r.item_id): (r.user_id, r.item_id) != (4, 3) for r in t.collect()}
        plan = factors.in_blocks(t, "rating", model, 0, None, None, "a long")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Join [") == 1 and "Exchange hashpartitioning(user_id" not in plan
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _raw_ratings(spark):
    rng = np.random.default_rng(5)
    u, v = rng.random((25, 3)) + 0.5, rng.random((18, 3)) + 0.5
    return spark.createDataFrame([(i, j, float(u[i] @ v[j])) for i in range(25) for j in range(18) if (i * j) % 3], SCHEMA)


@pytest.mark.parametrize("alpha", [None, 3.0])
def test_users_solve_their_equations(spark, alpha):
    df = _raw_ratings(spark)
    model = factors.fit(df, rank=3, rounds=3, reg=0.05, implicit_alpha=alpha)
    found = {r.user_id: r for r in factors.optimality(df, model, 0.05, alpha).collect()}
    assert max(r.residual for r in found.values()) < 1e-6
    u = {r.id: np.array(r.features) for r in factors.user_factors(model).collect()}
    v = {r.id: np.array(r.features) for r in factors.item_factors(model).collect()}
    assert found.keys() == u.keys()
    everything = sum(np.outer(x, x) for x in v.values())
    for user in (1, 7):  # the solution of the plain equations is what the fit found
        rows = [(r.item_id, r.rating) for r in df.where(f"user_id = {user}").collect()]
        weight = [1.0 if alpha is None else alpha * r for _, r in rows]
        target = [r if alpha is None else 1 + alpha * r for _, r in rows]
        left = sum(w * np.outer(v[i], v[i]) for (i, _), w in zip(rows, weight)) + 0.05 * len(rows) * np.eye(3)
        left = left if alpha is None else left + everything
        right = sum(t * v[i] for (i, _), t in zip(rows, target))
        np.testing.assert_allclose(np.linalg.solve(left, right), u[user], rtol=1e-3, atol=1e-4)
        assert found[user].n == len(rows)
    wrong = factors.optimality(df, model, 0.5, alpha).agg(F.min("residual")).first()[0]
    moved = factors.optimality(df.withColumn("rating", F.col("rating") + 0.1), model, 0.05, alpha).agg(F.min("residual")).first()[0]
    assert wrong > 1e-4 and moved > 1e-4


def test_factors_of_any_ids(spark):
    df = _raw_ratings(spark)
    named = df.select(F.format_string("u%03d", "user_id").alias("user_id"), (F.col("item_id") + 10**12).alias("item_id"), "rating")
    extra = spark.createDataFrame([(None, 10**12, 1.0), ("u001", None, 1.0)], "user_id string, item_id long, rating double")
    ours = factors.NamedFactors(named.unionByName(extra), rank=3, rounds=3, reg=0.05)
    codes = {r.user_id: r.code for r in ours.users.collect()}
    assert sorted(codes, key=codes.get) == sorted(codes) and sorted(codes.values()) == list(range(len(codes)))
    assert {r.user_id for r in ours.user_factors().collect()} == codes.keys()
    assert {r.item_id for r in ours.item_factors().collect()} == {r.item_id for r in named.select("item_id").distinct().collect()}
    assert ours.optimality().agg(F.max("residual")).first()[0] < 1e-6
    best = ours.recommend_to_all(2)
    assert best.count() == 2 * len(codes) and best.columns == ["user_id", "rank", "item_id", "score"]
    pairs = spark.createDataFrame([("u001", 10**12 + 1), ("nobody", 10**12 + 1)], "user_id string, item_id long")
    one = ours.predict(pairs).collect()
    u = {r.user_id: np.array(r.features) for r in ours.user_factors().collect()}
    v = {r.item_id: np.array(r.features) for r in ours.item_factors().collect()}
    assert len(one) == 1 and one[0].prediction == pytest.approx(u["u001"] @ v[10**12 + 1], abs=1e-5)


def test_recommendations_make_no_cross_join(spark):
    """Every user's items come out of a cell that is final, equal scores by the smaller item."""
    t = _table(spark, [(u, i, 1 + (u * (i // 2)) % 5) for u in range(12) for i in range(10) if (u + i // 2) % 3])
    model = factors.fit(t, rank=2, rounds=3)
    every = factors.recommend_to_all(model, 4)
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    u, v = ({r.id: np.array(r.features) for r in f(model).collect()} for f in (factors.user_factors, factors.item_factors))
    want = {(i, place): j for i, a in u.items() for place, (_, j) in enumerate(sorted((-float(np.einsum("i,i->", a, b)), j) for j, b in v.items())[:4], 1)}
    assert {(r.user_id, r["rank"]): r.item_id for r in every.collect()} == want


def test_errors_need_no_join_of_ratings(spark):
    """Ratings and predictions come out of blocks: those of the plain predictions, and no rating is joined."""
    t = _table(spark, [(u, i, 1 + (u * i) % 5) for u in range(20) for i in range(15) if (u + i) % 3])
    model = factors.fit(t, rank=3, rounds=2)
    both = factors.stated_and_predicted(t.unionByName(_table(spark, [(99, 1, 1.0), (1, 99, 1.0)])), model)
    want = t.join(factors.predict(model, t), ["user_id", "item_id"]).select("rating", "prediction").collect()
    assert sorted(map(tuple, both.collect())) == [pytest.approx(tuple(r), abs=1e-5) for r in sorted(map(tuple, want))]
    plan = factors.stated_and_predicted(t, model)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join [") == 1 and "Exchange hashpartitioning(user_id" not in plan
