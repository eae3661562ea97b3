"""What stays on disk and in memory behind a step, and how work is cut."""

import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import factors, linked, neighbours, similar
from tallyforge.session import discard, shared_dir, tidy, written

SCHEMA = "user_id long, item_id long, rating double"


def _shuffles(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {n for n in (str(blocks.apply(i)) for i in range(blocks.size())) if n.startswith("shuffle_")}


def _no_more_than(spark, before: set[str]) -> bool:
    """Spark's cleaner works in a thread of its own."""
    for _ in range(20):
        if not (left := _shuffles(spark) - before):
            return True
        time.sleep(0.2)
    print(left)
    return False


def _ratings(spark, users=30, items=20, step=1):
    return spark.createDataFrame([(u * step, i, float(1 + (u * i) % 5)) for u in range(users) for i in range(items) if (u + i) % 3], SCHEMA)


def test_written_leaves_no_shuffle_files(spark):
    before = _shuffles(spark)
    df = written(spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count(), "test")
    with tidy(spark):
        assert df.groupBy("count").agg(F.max("k")).count() > 0
    assert len(df.collect()) == 7 and _no_more_than(spark, before)
    discard(df)
    with pytest.raises(Exception):
        spark.read.parquet(df._written_at)


def test_a_fit_leaves_its_factors_alone(spark):
    """Nothing is persisted or shuffled once a model is there, whatever its kind."""
    persisted = spark.sparkContext._jsc.getPersistentRDDs().size()
    df = written(_ratings(spark), "test")
    for alpha in (None, 2.0):
        before = _shuffles(spark)
        model = factors.fit(df, rank=2, rounds=3, implicit_alpha=alpha)
        assert spark.sparkContext._jsc.getPersistentRDDs().size() <= persisted and _no_more_than(spark, before)
        assert "Scan parquet" in factors.user_factors(model)._jdf.queryExecution().executedPlan().toString()


def test_blocks_of_a_fit_grow_with_the_ratings(spark, monkeypatch):
    """So a task's share is bounded; given blocks and few ratings stay as they were."""
    made = []
    of = factors.Codes.of
    monkeypatch.setattr(factors.Codes, "of", staticmethod(lambda ids, column, blocks: made.append(blocks) or of(ids, column, blocks)))
    df = written(_ratings(spark), "test")
    few = max(10, spark.sparkContext.defaultParallelism)
    factors.fit(df, rank=2, rounds=1)
    monkeypatch.setattr(factors, "RATINGS", 10)
    model = factors.fit(df, rank=2, rounds=1)
    factors.fit(df, rank=2, rounds=1, blocks=3)
    assert made == [few, few, 40, 40, 3, 3] and df.count() == 400
    assert factors.optimality(df, model).agg(F.max("residual")).first()[0] < 1e-6


def test_predictions_join_no_rating(spark):
    """Users whose ids fill no range are hashed; all pairs are scored, in the pairs' own types."""
    df = _ratings(spark, step=1).withColumn("user_id", F.when(F.col("user_id") == 29, 10**6).otherwise(F.col("user_id")).cast("int"))
    model = factors.fit(df, rank=3, rounds=2)
    got = factors.predict(model, df.select("item_id", "user_id"))
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "bigint", "double"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join [") == 1 and "Exchange hashpartitioning(user_id" not in plan
    want = model.als.transform(model.coded(df, "user", "item")).select("user_id", "item_id", F.col("prediction").cast("double"))
    a, b = (sorted(map(tuple, x.collect())) for x in (got, want))
    assert len(a) == df.count() and [r[:2] for r in a] == [r[:2] for r in b]
    np.testing.assert_allclose([r[2] for r in a], [r[2] for r in b], rtol=1e-5)
    assert factors.agreement(got.withColumn("user_id", F.col("user_id").cast("long")), "prediction", model).where("same").count() == len(a)


def test_cells_of_best_products_are_made_in_turn(spark, monkeypatch):
    """No more cells than cores have their copies of all blocks at a time; what they find is the same."""
    rng = np.random.default_rng(3)
    kind = "id long, features array<double>"
    rows = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(400)], kind)
    want = sorted(map(tuple, similar.best_products(rows, rows, 3).collect()))
    copies, sizes = [], []
    by_id = type(rows).repartitionById
    monkeypatch.setattr(type(rows), "repartitionById", lambda self, n, *c: copies.append(self.where("place >= 0").count()) or sizes.append(n) or by_id(self, n, *c))
    got = similar.best_products(rows, rows, 3, block=40, cell=20)
    cores = spark.sparkContext.defaultParallelism
    assert len(sizes) > 1 and max(sizes) <= cores and max(copies) <= 10 * cores and sum(sizes) >= 20
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("similarity", [neighbours.euclid, neighbours.pearson, neighbours.cosine])
@pytest.mark.parametrize("links", [60, 1 << 22])
def test_estimates_make_their_own_links(spark, monkeypatch, similarity, links):
    """In cells of any size, the same scores as from stored links; no link is shuffled."""
    rng = np.random.default_rng(6)
    rows = [(u, int(i) * 3 - 20, float(rng.integers(1, 6)) if u % 5 else 2.0) for u in range(60) for i in rng.choice(40, 2 + u % 7, replace=False) if (u < 30) == (i < 20) or u == 7]
    df = written(spark.createDataFrame([*rows, (100, 500 if links < 100 else 2**40, 1.0 if links < 100 else 0.1)], SCHEMA), "test")
    for name, value in (("LINKS", links), ("TARGETS", 5 if links < 100 else 8192), ("TERMS_AT_ONCE", 40), ("FINE", 3), ("LINKS_AT_ONCE", 50), ("SUMS_AT_ONCE", 12), ("LISTS_AT_ONCE", 7)):
        monkeypatch.setattr(linked, name, value)
    sims = neighbours.similarities(neighbours.co_rating_sums(df), similarity)
    for best in (None, 2):
        got = neighbours.estimates(df, sims, 6, best)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "source" not in plan and "late" in plan
        want = neighbours.estimates(df, sims.where("true"), 6, None)
        a, b = ({(r.user_id, r.item_id): r.score for r in x.collect()} for x in (got, want))
        if best is None:
            assert a.keys() == b.keys() and len(a) > 500
        else:  # cells keep what can be among the best
            for u in {u for u, _ in b}:
                first = sorted((-s, i) for (v, i), s in b.items() if v == u)[:best]
                assert all((u, i) in a for _, i in first)
        assert all(a[x] == pytest.approx(b[x], abs=1e-9) for x in a)


def test_a_latent_space_leaves_one_table(spark):
    """Each round's table takes the place of the one before."""
    base = Path(shared_dir(spark).removeprefix("file:")) / "tallyforge"
    before = set(base.glob("svd-*")) if base.exists() else set()
    items = factors.latent_items(_ratings(spark, 25, 18), dims=2, spare=2)
    assert items.count() == 18 and {p.name.rsplit("-", 1)[0] for p in set(base.glob("svd-*")) - before} == {"svd-v"}
