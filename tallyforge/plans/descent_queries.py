"""Descent over the encoded rental rows: five categories as 1-of-k and three numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators import descent, encode
from tallyforge.plans.encode_queries import _RENTAL_DICTS, CATEGORIES
from tallyforge.plans.registry import query
from tallyforge.plans.views import Tables, with_views
from tallyforge.session import written

STEPS, STEP, REG = 4, 0.5, 0.01
#: Numbers and what they are divided by.
SCALES = {"quantity": 50.0, "discount": 0.1, "tax": 0.1}


def _rows(t: Tables) -> tuple[DataFrame, Column, Column, int]:
    """Rows with both targets, their positions and values, and the width."""
    rentals = written(t.rentals.drop("order_id"), "rentals")  # lines meet their orders once
    encoder = encode.MixedEncoder(CATEGORIES, list(SCALES)).fit(rentals)
    rows = encoder.positions(rentals).select(
        "hot", *[(F.col(c).cast("double") / s).alias(c) for c, s in SCALES.items()],
        (F.col("target") / 10000).alias("label"), F.when(F.col("target") > 25000, 1.0).otherwise(0.0).alias("dear"),
    )
    first = encoder.category_width
    at = F.concat(F.col("hot").cast("array<bigint>"), F.array(*[F.lit(first + i).cast("long") for i in range(len(SCALES))]))
    value = F.concat(F.array_repeat(F.lit(1.0), F.size("hot")), F.array(*SCALES))
    return rows, at, value, encoder.width


def _sql(slope: str, label: str, penalty: str | None) -> str:
    """The same descent over (row, position, value) triples, a step in three CTEs."""
    before = [" + ".join(["0", *(f"(SELECT count(*) FROM d_{c})" for c in CATEGORIES[:i])]) for i in range(len(CATEGORIES) + 1)]
    cells = [f"SELECT rid, i_{c} + {before[i]} AS pos, 1.0::DOUBLE AS v FROM r JOIN d_{c} USING ({c})" for i, c in enumerate(CATEGORIES)]
    cells += [f"SELECT rid, {before[-1]} + {i}, {c}::DOUBLE / {s!r} FROM r" for i, (c, s) in enumerate(SCALES.items())]
    sql = f""", {_RENTAL_DICTS}, r AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM rentals),
        cells AS MATERIALIZED ({' UNION ALL '.join(cells)}),
        y AS (SELECT rid, {label} AS y FROM r), w0 AS (SELECT DISTINCT pos, 0.0::DOUBLE AS w FROM cells)"""
    for t in range(1, STEPS + 1):
        rate = STEP / t**0.5
        plain = f"w - {rate!r} * g"
        new = {None: plain, "l2": f"w * (1 - {rate!r} * {REG}) - {rate!r} * g", "l1": f"sign({plain}) * greatest(abs({plain}) - {rate!r} * {REG}, 0)"}
        sql += f""", m{t} AS MATERIALIZED (SELECT rid, sum(v * w) AS m FROM cells JOIN w{t - 1} USING (pos) GROUP BY rid),
        g{t} AS (SELECT pos, sum(({slope}) * v) / (SELECT count(*) FROM r) AS g FROM cells JOIN m{t} USING (rid) JOIN y USING (rid) GROUP BY pos),
        w{t} AS MATERIALIZED (SELECT pos, {new[penalty]} AS w FROM w{t - 1} JOIN g{t} USING (pos))"""
    return with_views("rentals", sql + f" SELECT CAST(pos AS BIGINT) AS position, round(w, 6) AS weight FROM w{STEPS}")


def _fitted(t: Tables, label: str, loss: str, penalty: str | None) -> DataFrame:
    rows, at, value, width = _rows(t)
    if loss != "squared":  # read once a step
        rows = written(rows, "rental-rows")
    model = descent.sparse_descent(rows, at, value, width, label, loss, STEPS, STEP, REG, penalty, tolerance=0.0)
    weights = [(i, round(w, 6) + 0.0) for i, w in enumerate(model.weights)]
    return t.spark.createDataFrame(weights, "position bigint, weight double")


@query("ML-7 FE-3", _sql("m - y", "target / 10000", "l2"))
def encoded_ridge_descent(t: Tables) -> DataFrame:
    return _fitted(t, "label", "squared", "l2")


@query("ML-7 ML-8 FE-3", _sql("m - y", "target / 10000", "l1"))
def encoded_lasso_descent(t: Tables) -> DataFrame:
    return _fitted(t, "label", "squared", "l1")


@query("ML-1 FE-3", _sql("1 / (1 + exp(-m)) - y", "CASE WHEN target > 25000 THEN 1.0 ELSE 0.0 END", "l2"))
def encoded_logistic_descent(t: Tables) -> DataFrame:
    return _fitted(t, "dear", "logistic", "l2")


@query("ML-3 FE-3", _sql("CASE WHEN m * (2 * y - 1) < 1 THEN 1 - 2 * y ELSE 0 END", "CASE WHEN target > 25000 THEN 1.0 ELSE 0.0 END", "l2"))
def encoded_support_vectors(t: Tables) -> DataFrame:
    return _fitted(t, "dear", "hinge", "l2")
