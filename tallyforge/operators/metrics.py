"""Model evaluation as DataFrame algebra; every measure is one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.operators.ordering import rank_within, running_sum


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def binary_areas(
    df: DataFrame, score: str, label: str = "label", start_precision: float | None = 1.0
) -> DataFrame:
    """Areas under the ROC and the precision-recall curve, by trapezoids.

    Rows are counted per score first, so ties form one step and a hard 0/1 score
    leaves two rows. The precision-recall curve starts at recall 0 with
    ``start_precision``, or with the first precision when that is None.
    """
    positive = F.sum(F.when(F.col(label) > 0.5, 1).otherwise(0)).cast("double")
    steps = df.groupBy(F.col(score).alias("__s")).agg(
        positive.alias("__p"), (F.count(F.lit(1)) - positive).alias("__q")
    )
    curve = running_sum(steps, [F.desc("__s")], {"__tp": "__p", "__fp": "__q"})
    tp, fp, p, q = (F.col(c) for c in ("__tp", "__fp", "__p", "__q"))
    precision = tp / (tp + fp)
    first = precision if start_precision is None else F.lit(start_precision)
    before = F.coalesce(F.try_divide(tp - p, (tp - p) + (fp - q)), first)
    areas = curve.agg(
        F.sum(p).alias("P"),
        F.sum(q).alias("Q"),
        F.sum(q * (tp + (tp - p)) / 2).alias("roc"),
        F.sum(p * (precision + before) / 2).alias("pr"),
    )
    return areas.select(
        F.try_divide("pr", "P").alias("area_under_pr"),
        F.try_divide(F.col("roc"), F.col("P") * F.col("Q")).alias("area_under_roc"),
    )


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall and F1 of each class that occurs as a label."""
    n, lab, pred = F.col("n"), F.col("label"), F.col("prediction")
    sides = F.array(
        F.struct(lab.alias("cls"), n.alias("true"), F.lit(0).cast("long").alias("said"),
                 F.when(lab == pred, n).otherwise(0).alias("hit")),
        F.struct(pred.alias("cls"), F.lit(0).cast("long").alias("true"), n.alias("said"),
                 F.lit(0).cast("long").alias("hit")),
    )
    totals = (
        confusion(df, label, prediction)
        .select(F.explode(sides).alias("s"))
        .groupBy(F.col("s.cls").alias("label"))
        .agg(*[F.sum(f"s.{c}").alias(c) for c in ("true", "said", "hit")])
        .where(F.col("true") > 0)
    )
    precision = F.coalesce(F.try_divide("hit", "said"), F.lit(0.0))
    recall = F.col("hit") / F.col("true")
    return totals.select("label", F.col("true").alias("n"), precision.alias("precision"), recall.alias("recall")).withColumn(
        "f1",
        F.coalesce(
            F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)
        ),
    )


def weighted_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and class scores weighted by class size."""
    total = F.sum("n")
    weighted = [
        (F.sum(F.col(c) * F.col("n")) / total).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")
    ]
    return class_scores(df, label, prediction).agg(
        (F.sum(F.col("recall") * F.col("n")) / total).alias("accuracy"), *weighted
    )


def squared_error(actual: Column, predicted: Column) -> Column:
    return (actual - predicted) * (actual - predicted)


def squared_log_error(actual: Column, predicted: Column) -> Column:
    """Null where undefined, that is for predictions at or below -1."""
    gap = F.log1p(F.when(predicted > -1, predicted)) - F.log1p(actual)
    return gap * gap


def regression_errors(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """MSE, RMSE, MAE, RMSLE, and how many rows RMSLE had to leave out."""
    a, p = F.col(actual), F.col(predicted)
    sle = squared_log_error(a, p)
    mse = F.avg(squared_error(a, p))
    return df.agg(
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(a - p)).alias("mae"),
        F.sqrt(F.avg(sle)).alias("rmsle"),
        F.sum(sle.isNull().cast("long")).alias("undefined"),
    )


def average_precision(
    predicted: DataFrame, actual: DataFrame, k: int | None = None, keys: Sequence[str] = ("user_id", "item_id")
) -> DataFrame:
    """Average precision at ``k`` (or over the full ranking) for every user with predictions.

    ``predicted(user, item, rank)`` ranks from 1; ``actual(user, item)`` is distinct.
    Only hits matter, so ranks come first, then one equi-join, then the hits of a
    user are numbered. With ``k`` that is at most ``k`` rows per user; without, the
    numbering is spread over tasks. A user with nothing to find gets 1.
    """
    user, item = keys
    shown = predicted.select(user, item, "rank")
    hits = (shown.where(F.col("rank") <= k) if k else shown).join(actual.select(user, item), [user, item])
    if k:
        numbered = hits.withColumn("hit", F.row_number().over(Window.partitionBy(user).orderBy("rank")))
    else:
        numbered = rank_within(hits, [user], ["rank"], "hit")
    gained = numbered.groupBy(user).agg(F.sum(F.col("hit") / F.col("rank")).alias("gain"))
    wanted = actual.groupBy(user).agg(F.count(F.lit(1)).alias("n_actual"))
    limit = F.least(F.col("n_actual"), F.lit(k)) if k else F.col("n_actual")
    users = shown.select(user).distinct()
    return (
        users.join(wanted, user, "left")
        .join(gained, user, "left")
        .select(
            user,
            F.coalesce("n_actual", F.lit(0)).alias("n_actual"),
            F.when(F.col("n_actual").isNull(), 1.0)
            .otherwise(F.coalesce("gain", F.lit(0.0)) / limit)
            .alias("average_precision"),
        )
    )


def full_ranking_precision(
    ranking: DataFrame, order: Sequence[str | Column], liked: str, user: str = "user_id"
) -> DataFrame:
    """Mean average precision over full rankings that tell themselves which rows were ``liked``
    (null: not). One sort numbers rows and hits; nothing is joined."""
    rows = ranking.withColumn("__liked", F.coalesce(F.col(liked), F.lit(False)))
    ranked = rank_within(rows, [user], order, "__rank", ("__liked", "__hit"))
    gain = F.sum(F.when(F.col("__liked"), F.col("__hit") / F.col("__rank")))
    per_user = ranked.groupBy(user).agg(gain.alias("gain"), F.count_if(F.col("__liked")).alias("n"))
    found = F.when(F.col("n") > 0, F.col("gain") / F.col("n")).otherwise(0.0)
    return per_user.agg(F.avg(found).alias("map"), F.count(F.lit(1)).alias("users"))


def mean_average_precision(
    predicted: DataFrame, actual: DataFrame, k: int | None = None, keys: Sequence[str] = ("user_id", "item_id")
) -> DataFrame:
    """Sum over users that have something to find, divided by all users with predictions."""
    per_user = average_precision(predicted, actual, k, keys)
    found = F.when(F.col("n_actual") > 0, F.col("average_precision")).otherwise(0.0)
    return per_user.agg(F.avg(found).alias("map"), F.count(F.lit(1)).alias("users"))
