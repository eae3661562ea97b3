import pytest
from pyspark.mllib.evaluation import BinaryClassificationMetrics, MulticlassMetrics, RankingMetrics
from pyspark.sql import functions as F

from tallyforge.operators import metrics

ROWS = [(1.0, 0.9), (0.0, 0.8), (1.0, 0.8), (1.0, 0.4), (0.0, 0.4), (0.0, 0.1), (1.0, 0.1), (0.0, 0.05)]


def test_areas_agree_with_spark(spark):
    df = spark.createDataFrame(ROWS, "label double, score double")
    ours = metrics.binary_areas(df, "score", start_precision=None).first()
    theirs = BinaryClassificationMetrics(df.select("score", "label").rdd.map(tuple))
    assert ours.area_under_roc == pytest.approx(theirs.areaUnderROC)
    assert ours.area_under_pr == pytest.approx(theirs.areaUnderPR)


def test_hard_labels_give_mean_of_both_rates(spark):
    df = spark.createDataFrame([(l, float(s > 0.5)) for l, s in ROWS], "label double, prediction double")
    assert metrics.binary_areas(df, "prediction").first().area_under_roc == pytest.approx((2 / 4 + 3 / 4) / 2)


def test_areas_of_one_class_are_null(spark):
    df = spark.createDataFrame([(1.0, 0.2), (1.0, 0.7)], "label double, score double")
    assert metrics.binary_areas(df, "score").first().area_under_roc is None


def test_classes_agree_with_spark(spark):
    rows = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0), (2.0, 2.0), (2.0, 3.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = metrics.weighted_scores(df).first()
    theirs = MulticlassMetrics(df.select("prediction", "label").rdd.map(tuple))
    assert ours.accuracy == pytest.approx(theirs.accuracy)
    assert ours.weighted_precision == pytest.approx(theirs.weightedPrecision)
    assert ours.weighted_recall == pytest.approx(theirs.weightedRecall)
    assert ours.weighted_f1 == pytest.approx(theirs.weightedFMeasure())


def test_regression_errors(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (0.0, -1.0)], "actual double, predicted double")
    e = metrics.regression_errors(df).first()
    assert (e.mse, e.mae, e.undefined) == (pytest.approx(2 / 3), pytest.approx(2 / 3), 1)


def _plain_ap(actual, predicted, k):
    hits = gain = 0
    for place, item in enumerate(predicted[:k], 1):
        if item in actual:
            hits += 1
            gain += hits / place
    return gain / min(len(actual), k) if actual else 1.0


@pytest.mark.parametrize("k", [2, 3, 100, None])
def test_average_precision(spark, k):
    actual = {1: [1, 2, 3], 2: [9], 3: [], 4: [5, 6, 7, 8]}
    shown = {1: [3, 9, 1, 2], 2: [1, 2, 3], 3: [1], 4: [5, 1, 6]}
    a = spark.createDataFrame([(u, i) for u, s in actual.items() for i in s], "user_id long, item_id long")
    p = spark.createDataFrame([(u, i, r) for u, s in shown.items() for r, i in enumerate(s, 1)], "user_id long, item_id long, rank long")
    got = {r.user_id: r.average_precision for r in metrics.average_precision(p.repartition(3), a, k).collect()}
    # Over the full ranking the divisor is the number of wanted items.
    want = {u: _plain_ap(actual[u], shown[u], k or 10_000) for u in actual}
    assert got == pytest.approx(want)
    if k is None:
        pairs = spark.sparkContext.parallelize([([float(i) for i in shown[u]], [float(i) for i in actual[u]]) for u in actual])
        ours = metrics.mean_average_precision(p, a).first()["map"]
        assert ours == pytest.approx(RankingMetrics(pairs).meanAveragePrecision)


def test_accuracy(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0)], "label double, prediction double")
    assert metrics.accuracy(df).select(F.col("accuracy")).first()[0] == 0.5
