"""Supervised models, factorisation and sweeps."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import arrays, numeric
from tallyforge.operators import clusters, encode, factors, linear, metrics, models, neighbours, splits, tuning
from tallyforge.plans.encode_queries import CATEGORIES, NUMBERS
from tallyforge.plans.registry import query
from tallyforge.plans.views import Tables, with_views
from tallyforge.session import written

# ------------------------------------------------------------- gradient descent


def _gd_rows(t: Tables, *keys: str) -> DataFrame:
    """Three scaled numbers with a regression and a two-class target."""
    return t.lineitem.select(
        *keys,
        F.array(F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 10).alias("features"),
        (F.col("l_extendedprice") / 10000).alias("label"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("returned"),
    )


def _gd_sql(loss: str, label: str, steps: int, step: float, reg: float, penalty: str | None, bias: bool) -> str:
    """The same descent with its steps written out as one CTE each."""
    n = 4 if bias else 3
    sql = """WITH rows AS (SELECT l_quantity / 50 AS x0, l_discount * 10 AS x1, l_tax * 10 AS x2, 1.0 AS x3,
        l_extendedprice / 10000 AS price, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS returned FROM lineitem),
        w0 AS (SELECT 0.0::DOUBLE AS a0, 0.0::DOUBLE AS a1, 0.0::DOUBLE AS a2, 0.0::DOUBLE AS a3)"""
    margin = " + ".join(f"x{i} * a{i}" for i in range(n))
    for t in range(1, steps + 1):
        rate = step / float(np.sqrt(t))
        sql += f""", m{t} AS (SELECT rows.*, {margin} AS m FROM rows, w{t - 1}),
        g{t} AS (SELECT {', '.join(f'avg(({loss}) * x{i}) AS g{i}' for i in range(4))} FROM (SELECT *, {label} AS y FROM m{t}))"""
        new = []
        for i in range(n):
            plain = f"a{i} - {rate!r} * g{i}"
            if penalty == "l2":
                plain = f"a{i} * (1 - {rate!r} * {reg}) - {rate!r} * g{i}"
            if penalty == "l1":
                plain = f"sign({plain}) * greatest(abs({plain}) - {rate!r} * {reg}, 0)"
            new.append(f"{plain} AS a{i}")
        new += [f"0.0::DOUBLE AS a{i}" for i in range(n, 4)]
        sql += f", w{t} AS (SELECT {', '.join(new)} FROM w{t - 1}, g{t})"
    return sql + f""" SELECT round(a0, 6) AS w0, round(a1, 6) AS w1, round(a2, 6) AS w2, round(a3, 6) AS intercept FROM w{steps}"""


def _weights(t: Tables, model: linear.LinearModel) -> DataFrame:
    row = tuple(round(v, 6) + 0.0 for v in (*model.weights, model.intercept))
    return t.spark.createDataFrame([row], "w0 double, w1 double, w2 double, intercept double")


@query("ML-7", _gd_sql("m - y", "price", 5, 0.5, 0.0, None, True))
def descent_least_squares(t: Tables) -> DataFrame:
    rows = _gd_rows(t).persist()
    return _weights(t, linear.gradient_descent(rows, iterations=5, step=0.5, intercept=True, tolerance=0.0))


@query("ML-7", _gd_sql("m - y", "price", 5, 0.5, 0.2, "l2", False))
def descent_ridge(t: Tables) -> DataFrame:
    rows = _gd_rows(t).persist()
    return _weights(t, linear.gradient_descent(rows, iterations=5, step=0.5, reg=0.2, penalty="l2", tolerance=0.0))


@query("ML-7 ML-8", _gd_sql("m - y", "price", 5, 0.5, 2.0, "l1", False))
def descent_lasso(t: Tables) -> DataFrame:
    rows = _gd_rows(t).persist()
    return _weights(t, linear.gradient_descent(rows, iterations=5, step=0.5, reg=2.0, penalty="l1", tolerance=0.0))


@query("ML-3", _gd_sql("CASE WHEN m * (2 * y - 1) < 1 THEN 1 - 2 * y ELSE 0 END", "returned", 10, 1.0, 0.01, "l2", False))
def descent_support_vectors(t: Tables) -> DataFrame:
    rows = _gd_rows(t).withColumn("label", F.col("returned")).persist()
    model = linear.gradient_descent(rows, loss="hinge", iterations=10, step=1.0, reg=0.01, penalty="l2", tolerance=0.0)
    return _weights(t, model)


@query("ML-1", _gd_sql("1 / (1 + exp(-m)) - y", "returned", 5, 1.0, 0.01, "l2", False))
def descent_logistic(t: Tables) -> DataFrame:
    rows = _gd_rows(t).withColumn("label", F.col("returned")).persist()
    model = linear.gradient_descent(rows, loss="logistic", iterations=5, step=1.0, reg=0.01, penalty="l2", tolerance=0.0)
    return _weights(t, model)


# ---------------------------------------------------------------- classification


def _documents(t: Tables) -> DataFrame:
    """Scaled numbers plus category 1-of-k, two classes."""
    rows = t.labelled.select("id", "label", "category", F.col("numbers").alias("raw"))
    numbers = encode.scaled(rows, encode.fit_scaler(rows, "raw"), "raw", "numbers")
    encoder = encode.MixedEncoder(["category"], []).fit(rows)
    coded = encoder.dense_features(numbers, "code")
    return coded.select("id", "label", F.concat("code", "numbers").alias("features"))


def _report(name: str, model, df: DataFrame) -> DataFrame:
    pred = models.predicted(model, df)
    both = metrics.accuracy(pred).withColumn("areas", metrics.binary_areas(pred, "prediction").select(
        F.struct("area_under_pr", "area_under_roc")).scalar())
    return both.select(F.lit(name).alias("model"), "accuracy", "areas.area_under_pr", "areas.area_under_roc")


@query("ML-1 ML-3 ML-4 ML-5 ML-9 SET-2 EV-1 EV-2")
def classifier_report(t: Tables) -> DataFrame:
    """Accuracy and both areas of four classifiers on the same rows."""
    df = _documents(t).persist()
    clamped = df.withColumn("features", arrays.non_negative(F.col("features")))
    return (
        _report("logistic", models.fit_logistic(df), df)
        .unionByName(_report("support vectors", models.fit_svm(df), df))
        .unionByName(_report("naive bayes", models.fit_bayes(clamped), clamped))
        .unionByName(_report("decision tree", models.fit_tree_classifier(df), df))
    )


@query(
    "ML-4 PRJ-7",
    with_views(
        "cells",
        """, x AS (SELECT id, label, pos, greatest(x, 0.0) AS x FROM cells),
        s AS (SELECT label, pos, sum(x) AS s FROM x GROUP BY ALL),
        c AS (SELECT label, count(DISTINCT id) AS n FROM x GROUP BY 1),
        theta AS (SELECT label, pos, ln(s + 1) - ln(sum(s) OVER (PARTITION BY label) + 64) AS w FROM s),
        prior AS (SELECT label, ln(n + 1) - ln(sum(n) OVER () + count(*) OVER ()) AS p FROM c),
        score AS (SELECT x.id, theta.label, max(p) + sum(x.x * w) AS v
                  FROM x JOIN theta USING (pos) JOIN prior ON prior.label = theta.label GROUP BY 1, 2)
        SELECT id, CAST(arg_max(label, v) AS DOUBLE) AS prediction, round(max(v), 5) AS best FROM score GROUP BY id""",
    ),
)
def bayes_predictions(t: Tables) -> DataFrame:
    rows = t.vectors.withColumn("features", arrays.non_negative(F.col("features")))
    from pyspark.ml.functions import vector_to_array

    pred = models.predicted(models.fit_bayes(rows), rows)
    best = F.array_max(vector_to_array("rawPrediction"))
    return pred.select("id", "prediction", F.round(best, 5).alias("best"))


@query("ML-2 EV-3")
def ten_class_logistic(t: Tables) -> DataFrame:
    rows = t.vectors.persist()
    return metrics.weighted_scores(models.predicted(models.fit_logistic(rows, classes=10, iterations=10), rows))


@query("ML-3 EV-3")
def ten_class_support_vectors(t: Tables) -> DataFrame:
    rows = t.vectors.persist()
    return metrics.weighted_scores(models.predicted(models.fit_svm(rows, classes=10), rows))


@query("ML-5 EV-3")
def ten_class_tree(t: Tables) -> DataFrame:
    rows = t.vectors.persist()
    return metrics.weighted_scores(models.predicted(models.fit_tree_classifier(rows, "gini", 5, 32), rows))


# -------------------------------------------------------------------- regression


def _rentals(t: Tables, *keys: str) -> DataFrame:
    encoder = encode.MixedEncoder(CATEGORIES, NUMBERS).fit(t.rentals)
    return encoder.vector_features(t.rentals).select(*keys, F.col("target").alias("label"), "features")


TREE_COLUMNS = ["line", "month", *NUMBERS]


def _tree_columns(t: Tables, *keys: str) -> DataFrame:
    raw = t.rentals.withColumns({c: F.col(c).cast("double") for c in ("line", "month")})
    return raw.select(*keys, F.col("target").alias("label"), *TREE_COLUMNS)


def _tree_rows(t: Tables, *keys: str) -> DataFrame:
    return encode.ordinal_features(_tree_columns(t, *keys), TREE_COLUMNS).select(*keys, "label", "features")


def _tree_groups(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows with the same features (and ``keys``) as one row of moments, written once."""
    return encode.ordinal_features(written(models.label_moments(rows, [*keys, *TREE_COLUMNS]), "groups"), TREE_COLUMNS)


@query("ML-7 ML-9 FE-9 EV-4 EV-5 EV-6")
def regression_report(t: Tables) -> DataFrame:
    """Errors of linear regression on the plain, logarithmic and square-root target."""
    rows = _rentals(t).persist()
    out = None
    for name, how in linear.TRANSFORMS.items():
        model = models.fit_linear(rows.withColumn("label", how.forward(F.col("label"))), iterations=10)
        pred = models.predicted(model, rows).select(
            F.col("label").alias("actual"), how.inverse(F.col("prediction")).alias("predicted")
        )
        line = metrics.regression_errors(pred).select(F.lit(name).alias("target"), "*")
        out = line if out is None else out.unionByName(line)
    return out


@query("ML-6 FE-4")
def tree_regression_report(t: Tables) -> DataFrame:
    rows = _tree_rows(t).persist()
    model = models.fit_tree_regressor(rows)
    depth, nodes = models.tree_shape(model)
    errors = metrics.regression_errors(models.truth_and_prediction(model, rows))
    return errors.select(F.lit(depth).alias("depth"), F.lit(nodes).alias("nodes"), "*")


@query("ML-8 TUN-1 TUN-2")
def zero_weights_by_penalty(t: Tables) -> DataFrame:
    """How many weights vanish as the L1 penalty grows."""
    rows = _rentals(t)
    return tuning.sweep(
        rows, rows, [1.0, 10.0, 100.0],
        lambda df, reg: models.fit_linear(df, reg, "l1", 50),
        lambda model, _: linear.zero_weights(model),
    )


# ------------------------------------------------------------------------ sweeps


def _accuracy(model, df: DataFrame) -> float:
    return metrics.accuracy(models.predicted(model, df)).first()["accuracy"]


@query("TUN-1 TUN-2 ML-1 FE-10")
def sweep_logistic_penalty(t: Tables) -> DataFrame:
    parts = splits.hash_split(_documents(t), ["id"], [60, 40], seed=123)
    return tuning.sweep(
        parts.where("part = 0"), parts.where("part = 1"), tuning.GRIDS["l2_classifier"],
        lambda df, reg: models.fit_logistic(df, reg, "l2", 10), _accuracy,
    )


@query("TUN-1 TUN-2 ML-5")
def sweep_tree_depth(t: Tables) -> DataFrame:
    df = _documents(t)
    return tuning.sweep(
        df, df, tuning.GRIDS["depth_classifier"], lambda d, depth: models.fit_tree_classifier(d, "entropy", depth), _accuracy
    )


@query("TUN-1 TUN-2 ML-4")
def sweep_bayes_smoothing(t: Tables) -> DataFrame:
    df = _documents(t).withColumn("features", arrays.non_negative(F.col("features")))
    return tuning.sweep(df, df, tuning.GRIDS["smoothing"], lambda d, s: models.fit_bayes(d, s), _accuracy)


@query("TUN-1 TUN-2 ML-6")
def sweep_regression_bins(t: Tables) -> DataFrame:
    """Fitted to and scored on all rows, by the moments of rows with the same features."""
    groups = _tree_groups(_tree_columns(t))
    return tuning.sweep(
        models.rows_of_moments(groups), groups, tuning.GRIDS["bins_regression"],
        lambda d, bins: models.fit_tree_regressor(d, 5, bins, "weight"), models.log_error_of_moments,
    )


@query("CL-5 TUN-1")
def sweep_cluster_count(t: Tables) -> DataFrame:
    parts = splits.hash_split(t.vectors, ["id"], [60, 40], seed=123)
    return tuning.sweep(
        parts.where("part = 0"), parts.where("part = 1"), tuning.GRIDS["clusters"],
        lambda df, k: clusters.fit_kmeans(df, k, 100),
        lambda m, df: clusters.wcss(clusters.assign(df, clusters.centre_table(t.spark, m))).first()[0],
    )


# ----------------------------------------------------------------- factorisation


@lru_cache(maxsize=4)
def _written_ratings(spark, sf_dir: str) -> DataFrame:
    return written(Tables(spark, sf_dir).ratings.select("user_id", "item_id", "rating"), "ratings")


def ratings_of(t: Tables) -> DataFrame:
    """The ratings, made once per data folder."""
    return _written_ratings(t.spark, t.sf_dir)


@lru_cache(maxsize=4)
def _fitted(spark, sf_dir: str, alpha: float | None):
    ratings = _written_ratings(spark, sf_dir)
    if alpha is not None:
        signal = numeric.to_signal(F.col("rating"), 3).cast("double")
        ratings = ratings.select("user_id", "item_id", signal.alias("rating"))
    return factors.fit(ratings, implicit_alpha=alpha)


def _model(t: Tables, alpha: float | None = None):
    """One fit per data folder, shared by the queries below."""
    return _fitted(t.spark, t.sf_dir, alpha)


@query(
    "REC-1",
    with_views(
        "ratings",
        """SELECT 'users' AS side, count(DISTINCT user_id) AS n, CAST(50 AS INTEGER) AS width FROM ratings
           UNION ALL SELECT 'items', count(DISTINCT item_id), 50 FROM ratings""",
    ),
)
def factor_table_sizes(t: Tables) -> DataFrame:
    model = _model(t)

    def side(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("width")).select(
            F.lit(name).alias("side"), "n", "width"
        )

    return side("users", factors.user_factors(model)).unionByName(side("items", factors.item_factors(model)))


@query("REC-1")
def item_factor_vectors(t: Tables) -> DataFrame:
    return factors.item_factors(_model(t)).select("id", F.posexplode("features").alias("pos", "value"))


@query("REC-2")
def implicit_recommendations(t: Tables) -> DataFrame:
    return factors.recommend_to_all(_model(t, 5.0), 10)


@query("REC-3 JN-2 EV-4")
def factor_model_errors(t: Tables) -> DataFrame:
    return metrics.regression_errors(factors.stated_and_predicted(ratings_of(t), _model(t)))


@query("REC-4")
def recommendations_for_one_user(t: Tables) -> DataFrame:
    users = t.ratings.where(F.col("user_id") == 7).select("user_id").distinct()
    return factors.recommend_to(_model(t), users, 10, t.items.select("item_id", "raw_title"))


@query("REC-5 JN-6")
def recommendations_for_all_users(t: Tables) -> DataFrame:
    return factors.recommend_to_all(_model(t), 10)


@query("EV-8 REC-5")
def factor_model_map(t: Tables) -> DataFrame:
    recs = written(factors.recommend_to_all(_model(t), 10), "recommendations")
    return metrics.mean_average_precision(recs, ratings_of(t).select("user_id", "item_id"), 10)


@query("REC-6")
def items_like_one_by_factors(t: Tables) -> DataFrame:
    return neighbours.most_similar(factors.item_factors(_model(t)), 7, 10)


@query("CL-1 CL-3 CL-4")
def item_factor_clusters(t: Tables) -> DataFrame:
    points = factors.item_factors(_model(t)).persist()
    model = clusters.fit_kmeans(points, 5, 10)
    assigned = clusters.assign(points, clusters.centre_table(t.spark, model))
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("squared").alias("cost"))


@query("REC-12")
def latent_space_estimates(t: Tables) -> DataFrame:
    """Every observed pair estimated from the user's other items in a 4-dimensional space."""
    ratings = written(t.ratings.select("user_id", "item_id", "rating"), "latent-ratings")
    return neighbours.profile_estimates(ratings, None, factors.latent_items(ratings, 4))
