"""Classifiers and regressors of Spark ML behind one calling convention.

Every ``fit_*`` takes a DataFrame with ``features`` (``array<double>`` or vector) and
``label`` and returns a fitted model for :func:`predicted`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of equal moments have at most twice the weight of one in so many parts of all rows, as
#: Spark finds the splits of a tree on a sample of rows, whatever they weigh.
PIECES = 500_000

# Mixing parameter of the penalty for each name.
PENALTIES = {"none": 0.0, "l1": 1.0, "l2": 0.0}


def as_vectors(df: DataFrame, features: str = "features") -> DataFrame:
    if isinstance(df.schema[features].dataType, T.ArrayType):
        return df.withColumn(features, array_to_vector(features))
    return df


def predicted(model, df: DataFrame, features: str = "features") -> DataFrame:
    """All columns plus ``prediction``: the rows keep their identity, nothing is zipped."""
    return model.transform(as_vectors(df, features))


def fit_logistic(df: DataFrame, reg: float = 0.0, penalty: str = "none", iterations: int = 100, classes: int = 2):
    return LogisticRegression(
        maxIter=iterations,
        regParam=0.0 if penalty == "none" else reg,
        elasticNetParam=PENALTIES[penalty],
        family="binomial" if classes == 2 else "multinomial",
    ).fit(as_vectors(df))


def fit_svm(df: DataFrame, reg: float = 0.01, iterations: int = 10, classes: int = 2):
    """Linear support vectors; more than two classes go one against the rest."""
    svm = LinearSVC(maxIter=iterations, regParam=reg)
    if classes == 2:
        return svm.fit(as_vectors(df))
    return OneVsRest(classifier=svm, parallelism=4).fit(as_vectors(df))


def fit_bayes(df: DataFrame, smoothing: float = 1.0, kind: str = "multinomial"):
    """Naive Bayes; features must not be negative (clamp them first)."""
    return NaiveBayes(smoothing=smoothing, modelType=kind).fit(as_vectors(df))


def fit_tree_classifier(df: DataFrame, impurity: str = "entropy", depth: int = 5, bins: int = 32):
    return DecisionTreeClassifier(impurity=impurity, maxDepth=depth, maxBins=bins, seed=42).fit(as_vectors(df))


def fit_tree_regressor(df: DataFrame, depth: int = 5, bins: int = 32, weight: str | None = None):
    tree = DecisionTreeRegressor(maxDepth=depth, maxBins=bins, seed=42)
    return (tree.setWeightCol(weight) if weight else tree).fit(as_vectors(df))


def label_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per distinct ``columns``: ``n`` rows, the ``mean`` and ``spread`` (variance) of ``label``, and
    ``n_log``, ``mean_log`` and ``spread_log`` of the logarithm of 1 + label where that is defined. A tree
    treats such rows alike, so fits and errors come from this table, however many rows there are. A null
    label counts as not a number, which Spark's fit refuses."""
    rows = df.withColumn("label", F.coalesce("label", F.lit(float("nan")))).withColumn("log", F.log1p("label"))
    return rows.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean"), F.var_pop("label").alias("spread"),
        F.count("log").alias("n_log"), F.avg("log").alias("mean_log"), F.var_pop("log").alias("spread_log"),
    )


def rows_of_moments(groups: DataFrame, pieces: int = PIECES) -> DataFrame:
    """``features``, ``label``, ``weight``: a few rows with the count, sum and sum of squares of labels
    that the rows of each group have: the mean, or one on either side of it. Never more than there were."""
    total = groups.agg(F.sum("n")).first()[0] or 0
    off = F.sqrt("spread")
    sides = F.when(F.col("spread") > 0, F.array(F.col("mean") - off, F.col("mean") + off)).otherwise(F.array("mean"))
    each = groups.select("features", "n", F.size(sides).alias("sides"), F.explode(sides).alias("label"))
    times = F.greatest(F.lit(1), F.floor(F.col("n") / F.col("sides") / max(1.0, total / pieces)))
    weighted = each.select("features", "label", (F.col("n") / F.col("sides") / times).alias("weight"), times.cast("int").alias("times"))
    return weighted.select("features", "label", "weight", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("col")


def log_error_of_moments(model, groups: DataFrame) -> float:
    """RMSLE of a model over the rows of the groups; undefined logarithms are left out."""
    gap = F.log1p("prediction") - F.col("mean_log")
    sums = predicted(model, groups).where(gap.isNotNull()).agg(
        F.sum(F.col("n_log") * (F.col("spread_log") + gap * gap)).alias("squares"), F.sum("n_log").alias("n")
    )
    return sums.select(F.sqrt(F.col("squares") / F.col("n"))).first()[0]


def fit_linear(
    df: DataFrame, reg: float = 0.0, penalty: str = "none", iterations: int = 100, intercept: bool = True, weight: str | None = None
):
    """``weight`` names a column that counts a row several times. With weights and no intercept it
    descends over the rows: the normal equations of collinear columns are solved or not as rounding has it."""
    regression = LinearRegression(
        solver="l-bfgs" if weight and not intercept else "auto",
        maxIter=iterations,
        regParam=0.0 if penalty == "none" else reg,
        elasticNetParam=PENALTIES[penalty],
        fitIntercept=intercept,
    )
    return (regression.setWeightCol(weight) if weight else regression).fit(as_vectors(df))


def tree_shape(model) -> tuple[int, int]:
    """Depth and number of nodes."""
    return model.depth, model.numNodes


def truth_and_prediction(model, df: DataFrame) -> DataFrame:
    return predicted(model, df).select(F.col("label").alias("actual"), F.col("prediction").alias("predicted"))
