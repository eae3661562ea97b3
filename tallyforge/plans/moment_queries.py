"""Penalty paths and scores per fold from moment matrices; components by the range finder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators import decompose, moments
from tallyforge.operators.tuning import GRIDS
from tallyforge.plans.registry import query
from tallyforge.plans.views import Tables, with_views

L2, L1 = [float(r) for r in GRIDS["l2_regression"]], [float(r) for r in GRIDS["l1_regression"]]
FOLDS = 5


def _folds(t: Tables, features: list[str]) -> dict[int, moments.Moments]:
    rows = t.rentals.select(
        (F.col("order_id") % FOLDS).alias("fold"), F.array(*[F.col(f).cast("double") for f in features]).alias("features"),
        (F.col("target") / 1000).alias("label"),
    )
    return moments.fold_moments(rows, "fold")


def _values(numbers: list[float]) -> str:
    return ", ".join(f"({n!r}::DOUBLE)" for n in numbers)


@query(
    "TUN-1 TUN-2 ML-7 ML-8",
    with_views(
        "rentals",
        f""", rows AS (SELECT order_id % {FOLDS} = 0 AS test, CAST(quantity AS DOUBLE) AS x, target / 1000 AS y FROM rentals),
        m AS (SELECT avg(x) AS mx, avg(y) AS my, avg(x * x) - avg(x) * avg(x) AS sxx, avg(x * y) - avg(x) * avg(y) AS sxy
              FROM rows WHERE NOT test),
        fits AS (
          SELECT 'l2' AS penalty, reg, sxy / (sxx + reg) AS w, mx, my FROM m, (VALUES {_values(L2)}) AS g(reg)
          UNION ALL
          SELECT 'l1', reg, sign(sxy) * greatest(abs(sxy) - reg, 0) / sxx, mx, my FROM m, (VALUES {_values(L1)}) AS g(reg))
        SELECT penalty, reg, round(avg((y - my - w * (x - mx)) * (y - my - w * (x - mx))), 6) AS squared_error,
               CAST(max(CASE WHEN w = 0 THEN 1 ELSE 0 END) AS INTEGER) AS zero_weights
        FROM fits, rows WHERE test GROUP BY penalty, reg""",
    ),
)
def penalty_path_errors(t: Tables) -> DataFrame:
    """All penalties of both grids from one pass; trained on four fifths of the orders, scored on the rest."""
    folds = _folds(t, ["quantity"])
    train = sum([m for f, m in folds.items() if f > 1], start=folds[1])
    path = moments.penalty_path(train, folds[0], L2, L1, intercept=True)
    rows = [(kind, reg, round(error, 6), zeros) for kind, reg, error, zeros in path]
    return t.spark.createDataFrame(rows, "penalty string, reg double, squared_error double, zero_weights int")


@query(
    "TUN-3 ML-7 EV-4",
    with_views(
        "rentals",
        f""", rows AS (SELECT order_id % {FOLDS} AS fold, CAST(quantity AS DOUBLE) AS a, CAST(discount AS DOUBLE) AS b, target / 1000 AS y
                       FROM rentals),
        m AS (SELECT f.fold, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, covar_pop(a, a) AS aa, covar_pop(b, b) AS bb,
                     covar_pop(a, b) AS ab, covar_pop(a, y) AS ya, covar_pop(b, y) AS yb
              FROM rows r JOIN (SELECT DISTINCT fold FROM rows) f ON r.fold <> f.fold GROUP BY 1),
        fits AS (
          SELECT fold, reg, ma, mb, my,
                 (ya * (bb + reg) - yb * ab) / ((aa + reg) * (bb + reg) - ab * ab) AS wa,
                 (yb * (aa + reg) - ya * ab) / ((aa + reg) * (bb + reg) - ab * ab) AS wb
          FROM m, (VALUES {_values(L2)}) AS g(reg)),
        errors AS (SELECT r.fold, reg, y - my - wa * (a - ma) - wb * (b - mb) AS e FROM rows r JOIN fits USING (fold))
        SELECT CAST(fold AS INTEGER) AS fold, reg, round(avg(e * e), 6) AS squared_error FROM errors GROUP BY 1, 2""",
    ),
)
def ridge_errors_per_fold(t: Tables) -> DataFrame:
    """Each of five folds tested by the models of the other four, for every penalty: one pass."""
    found = moments.fold_errors(_folds(t, ["quantity", "discount"]), L2, intercept=True)
    return t.spark.createDataFrame([(f, reg, round(e, 6)) for f, _, reg, e, _ in found], "fold int, reg double, squared_error double")


@query(
    "DR-1 DR-2",
    with_views("cells", "SELECT CAST(pos AS BIGINT) AS dim, round(var_samp(x), 6) AS variance FROM cells GROUP BY pos"),
)
def variances_by_range_finder(t: Tables) -> DataFrame:
    """The rows' projections on the directions of the range finder give back every column's
    variance: ``V diag(variance of the projections) V'`` has it as its diagonal for eigenvectors only."""
    components, _ = decompose.range_components(t.vectors, 64)
    projected = decompose.project(t.vectors, components).select(F.posexplode("projected").alias("component", "value"))
    sizes = projected.groupBy("component").agg(F.var_samp("value").alias("size"))
    table = decompose.component_table(t.spark, components)
    squared = F.sum(F.col("value") * F.col("value") * F.col("size"))
    return table.join(F.broadcast(sizes), "component").groupBy("dim").agg(F.round(squared, 6).alias("variance"))
