from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import describe, joins, metrics, ordering, splits


def _hot(spark, n=3000):
    """A third of all rows share one key; another third are copies of one value."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)
    value = F.when(F.col("id") % 3 == 1, 7.0).otherwise(F.rand(5))
    return spark.range(n).select("id", key.alias("k"), value.alias("v"))


@pytest.mark.parametrize("parts", [1, 7])
def test_index_and_running_sum(spark, parts):
    df = _hot(spark).repartition(parts)
    idx = ordering.global_index(df, ["v", "id"]).orderBy("idx").toPandas()
    assert idx["idx"].tolist() == list(range(3000))
    assert idx["v"].is_monotonic_increasing
    run = ordering.running_sum(df.withColumn("one", F.lit(1)), [F.desc("v"), "id"], {"c": "one"}).orderBy("c").toPandas()
    assert run["c"].tolist() == list(range(1, 3001))
    assert run["v"].is_monotonic_decreasing


@pytest.mark.parametrize("parts", [1, 7])
def test_rank_of_a_hot_key(spark, parts):
    got = ordering.rank_within(_hot(spark).repartition(parts), ["k"], ["id"]).toPandas()
    want = got.groupby("k")["id"].rank().astype(int)
    assert (got["rank"] == want).all()


@pytest.mark.parametrize("values", [[1], [1, 2], [5, 1, 4], [1, 1, 1, 9, 9, 10], [2.5, 3.5, -1.0, 8.0]])
def test_median(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert ordering.exact_median(df, "x").first()[0] == np.median(values)


def _median_by_sorting(values):
    ordered = sorted(v for v in values if v is not None)
    n = len(ordered)
    return (ordered[(n - 1) // 2] + ordered[n // 2]) / 2 if n else None


@pytest.mark.parametrize("seed", range(4))
def test_median_narrows_any_range(spark, monkeypatch, seed):
    monkeypatch.setattr(ordering, "BUCKETS", 4)
    monkeypatch.setattr(ordering, "FEW", 3)
    rng = np.random.default_rng(seed)
    n = int(rng.integers(40, 80))
    cases = [
        ("double", [float(x) for x in rng.normal(size=n) * 10.0 ** rng.integers(-8, 9, n)]),
        ("double", [float(x) for x in rng.choice([-1.7e308, 1.7e308, 0.5], n)]),
        ("long", [int(x) for x in rng.integers(-50, 50, n)]),
        ("long", [2**61 + int(x) for x in rng.integers(0, 9, n)]),
        ("decimal(20,2)", [Decimal(int(x)) / 100 for x in rng.integers(-999, 999, n)]),
    ]
    for kind, values in cases:
        df = spark.createDataFrame([(v,) for v in [*values, None]], f"x {kind}")
        expected = _median_by_sorting(values)
        assert float(ordering.exact_median(df, "x").first()[0]) == pytest.approx(float(expected), rel=1e-15), kind


def test_median_of_odd_columns(spark):
    inf, nan = float("inf"), float("nan")

    def median(values):
        return ordering.exact_median(spark.createDataFrame([(v,) for v in values], "x double"), "x").first()[0]

    assert median([]) is None and median([None, None]) is None
    assert median([-inf, -inf, 1.0]) == -inf and median([inf, 2.0, inf]) == inf and np.isnan(median([nan, 1.0, nan]))
    assert median([-inf, 3.0, nan]) == 3.0 and median([-inf, 1.0, 2.0, inf]) == 1.5
    assert median([5e-324, 0.0, 5e-324]) == 5e-324
    assert median([7.0] * 20_001 + [8.0] * 20_001) == 7.5


def test_index_of_equal_rows(spark):
    df = spark.range(1000).select(F.lit("same").alias("x"))
    got = [r.idx for r in ordering.global_index(df, ["x"]).collect()]
    assert sorted(got) == list(range(1000))


def test_chunked_lists(spark):
    df = _hot(spark)
    whole = {r.k: r.members for r in describe.member_lists(df, "k", ["id"], chunk=5000).collect()}
    for chunk in (2, 100):
        parts = describe.member_lists(df, "k", ["id"], chunk=chunk).orderBy("k", "part").collect()
        assert all(len(r.members) <= chunk for r in parts)
        laid = {}
        for r in parts:
            assert r.part * chunk == len(laid.setdefault(r.k, []))
            laid[r.k] += r.members
        assert laid == whole and sorted(x for m in whole.values() for x in m) == list(range(3000))


def test_top_beyond_the_group_limit(spark):
    df = _hot(spark)
    got = ordering.top_per_key(df, ["k"], [F.desc("id")], 1200)
    want = {}
    for r in df.collect():
        want.setdefault(r.k, []).append(r.id)
    mine = {}
    for r in got.orderBy("k", "rank").collect():
        mine.setdefault(r.k, []).append(r.id)
    assert mine == {k: sorted(v, reverse=True)[:1200] for k, v in want.items()}


def test_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 3, 4, 4)], "x double")
    assert {r.bin: r.n for r in describe.histogram(df, "x", 2).collect()} == {0: 2, 1: 4}
    constant = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [tuple(r)[:3] for r in describe.histogram(constant, "x", 4).collect()] == [(0, 1.0, 2)]


def test_lookup_join_without_broadcast(spark):
    left, dim = spark.range(100).withColumn("k", F.col("id") % 5), spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("n"))
    small, big = joins.lookup_join(left, dim, "k"), joins.lookup_join(left, dim, "k", max_bytes=1)
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in big._jdf.queryExecution().analyzed().toString()
    assert sorted(small.collect()) == sorted(big.collect())


def test_splits_ignore_partitioning(spark):
    df = _hot(spark)
    a = splits.hash_split(df.repartition(1), ["id"], [60, 30, 10], 1).groupBy("part").count().collect()
    b = splits.hash_split(df.repartition(7), ["id"], [60, 30, 10], 1).groupBy("part").count().collect()
    assert sorted(a) == sorted(b) and {r.part for r in a} == {0, 1, 2}
    test, rest = splits.sample_and_rest(df, ["id"], 20, 42)
    assert test.count() + rest.count() == 3000
    assert test.join(rest, "id").count() == 0


def test_folds_and_leave_out(spark):
    df = spark.range(10).select(F.col("id").alias("pos"), (F.col("id") % 2).alias("u"))
    folds = splits.consecutive_folds(df, ["pos"], 3).orderBy("pos").collect()
    assert [r.fold for r in folds] == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2]
    out = splits.leave_out(df, "u", ["pos"], 2, 3, max_test=3)
    assert sorted(r.pos for r in out.where("is_test").collect()) == [2, 3, 4]


def test_full_rankings_are_sorted_once_and_not_joined(spark):
    rng = np.random.default_rng(12)
    rows = [(int(u), float(rng.random()), None if rng.random() < 0.1 else bool(rng.random() < 0.4)) for u in [0] * 3000 + rng.integers(1, 40, 600).tolist()]
    rows += [(99, 0.5, False), (98, 0.5, True)]
    df = spark.createDataFrame(rows, "user_id long, code double, liked boolean").repartition(6)
    values = []
    for user in {r[0] for r in rows}:
        mine = [bool(r[2]) for r in sorted(r for r in rows if r[0] == user)]
        values.append(sum(sum(mine[: i + 1]) / (i + 1) for i, hit in enumerate(mine) if hit) / max(sum(mine), 1))
    found = metrics.full_ranking_precision(df, ["code"], "liked")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1  # the offsets of partitions
    row = found.first()
    assert row["users"] == len(values) and row["map"] == pytest.approx(np.mean(values), abs=1e-12)
