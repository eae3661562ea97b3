"""Clustering and decomposition of vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators import clusters, decompose
from tallyforge.plans.registry import query
from tallyforge.plans.views import Tables, with_views

ROUNDS = 3


def _first_five(t: Tables) -> DataFrame:
    """Given starting centres: the vectors with the five smallest ids."""
    return t.vectors.where(F.col("id") < 5).select("id", "features")


def _lloyd_sql(rounds: int) -> str:
    sql = ", c0 AS (SELECT id AS c, pos, x AS y FROM cells WHERE id < 5)"
    for i in range(rounds + 1):
        sql += f""", d{i} AS (SELECT id, c, sum((x - y) * (x - y)) AS d FROM cells JOIN c{i} USING (pos) GROUP BY id, c),
        a{i} AS (SELECT id, c, d FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, c) AS r FROM d{i}) WHERE r = 1)"""
        if i < rounds:
            sql += f", c{i + 1} AS (SELECT c, pos, avg(x) AS y FROM cells JOIN a{i} USING (id) GROUP BY c, pos)"
    return sql


def _clustered(t: Tables, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    centres = clusters.lloyd(t.vectors, _first_five(t), rounds)
    return clusters.assign(t.vectors, centres), centres


@query(
    "JN-5 FN-15",
    with_views("cells", _lloyd_sql(0) + " SELECT id, c AS cluster, round(d, 6) AS squared, round(sqrt(d), 6) AS distance FROM a0"),
)
def nearest_given_centre(t: Tables) -> DataFrame:
    near = clusters.assign(t.vectors, _first_five(t))
    return near.select(
        "id", "cluster", F.round("squared", 6).alias("squared"), F.round(F.sqrt("squared"), 6).alias("distance")
    )


@query(
    "AGG-17",
    with_views(
        "cells",
        "SELECT CAST(label AS BIGINT) AS id, pos, round(avg(x), 6) AS value FROM cells GROUP BY label, pos",
    ),
)
def mean_vector_per_label(t: Tables) -> DataFrame:
    means = clusters.group_means(t.vectors, "label")
    cells = means.select("id", F.posexplode("features").alias("pos", "value"))
    return cells.select("id", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


@query(
    "CL-2 UDF-3",
    with_views("cells", _lloyd_sql(ROUNDS) + f" SELECT c AS id, pos, round(y, 6) AS value FROM c{ROUNDS}"),
)
def lloyd_centres(t: Tables) -> DataFrame:
    _, centres = _clustered(t)
    cells = centres.select("id", F.posexplode("features").alias("pos", "value"))
    return cells.select("id", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


@query(
    "CL-3",
    with_views(
        "cells items",
        _lloyd_sql(ROUNDS)
        + f""" SELECT id, raw_title, kind, c AS cluster, round(sqrt(d), 6) AS distance
              FROM a{ROUNDS} JOIN items ON item_id = id""",
    ),
)
def cluster_members(t: Tables) -> DataFrame:
    assigned, centres = _clustered(t)
    titles = t.items.select(F.col("item_id").alias("id"), "raw_title", "kind")
    members = clusters.with_distance(assigned, centres).join(titles, "id")
    return members.select("id", "raw_title", "kind", "cluster", F.round("distance", 6).alias("distance"))


@query(
    "CL-4",
    with_views("cells", _lloyd_sql(ROUNDS) + f" SELECT round(sum(d), 5) AS wcss FROM a{ROUNDS}"),
)
def cluster_cost(t: Tables) -> DataFrame:
    assigned, _ = _clustered(t)
    return clusters.wcss(assigned).select(F.round("wcss", 5).alias("wcss"))


@query(
    "SRT-6",
    with_views(
        "cells",
        _lloyd_sql(ROUNDS)
        + f""", r AS (SELECT c AS cluster, id, round(d, 6) AS squared,
                     row_number() OVER (PARTITION BY c ORDER BY round(d, 6), id) AS rank FROM a{ROUNDS})
        SELECT cluster, rank, id, squared FROM r WHERE rank <= 20""",
    ),
)
def nearest_members_of_clusters(t: Tables) -> DataFrame:
    assigned, _ = _clustered(t)
    near = clusters.nearest_members(assigned, 20)
    return near.select("cluster", F.col("rank").cast("long").alias("rank"), "id", "squared")


@query("CL-1")
def kmeans_clusters(t: Tables) -> DataFrame:
    """Cluster sizes and cost of Spark's own k-means with five centres."""
    model = clusters.fit_kmeans(t.vectors, 5, 10)
    assigned = clusters.assign(t.vectors, clusters.centre_table(t.spark, model))
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("squared").alias("cost"))


@query(
    "DR-1",
    with_views(
        "cells",
        """, m AS (SELECT pos, avg(x) AS mu FROM cells GROUP BY pos),
        z AS (SELECT id, pos, x - mu AS x FROM cells JOIN m USING (pos)),
        n AS (SELECT count(DISTINCT id) - 1 AS free FROM cells)
        SELECT a.pos AS i, b.pos AS j, round(sum(a.x * b.x) / max(free), 8) AS covariance
        FROM z a JOIN z b ON a.id = b.id AND a.pos <= b.pos, n GROUP BY 1, 2""",
    ),
)
def vector_covariance(t: Tables) -> DataFrame:
    return decompose.covariance(t.vectors).withColumn("covariance", F.round("covariance", 8))


@query("DR-1")
def principal_component_table(t: Tables) -> DataFrame:
    components, _ = decompose.principal_components(t.vectors, 10)
    return decompose.component_table(t.spark, components)


@query("DR-2")
def projected_vectors(t: Tables) -> DataFrame:
    components, _ = decompose.principal_components(t.vectors, 10)
    return decompose.project(t.vectors, components).select("id", F.posexplode("projected").alias("component", "value"))


@query(
    "DR-2 DR-3",
    with_views(
        "cells",
        "SELECT id, round(sum(x * x), 5) AS energy FROM cells GROUP BY id",
    ),
)
def projection_keeps_length(t: Tables) -> DataFrame:
    """At full rank the rows keep their squared length in the space of V."""
    _, right = decompose.truncated_svd(t.vectors, 64)
    rows = decompose.project(t.vectors, right)
    energy = F.aggregate("projected", F.lit(0.0), lambda acc, x: acc + x * x)
    return rows.select("id", F.round(energy, 5).alias("energy"))


@query("DR-3")
def left_singular_vectors(t: Tables) -> DataFrame:
    values, right = decompose.truncated_svd(t.vectors, 5)
    return decompose.left_vectors(t.vectors, values, right).select("id", F.posexplode("u").alias("component", "value"))


@query(
    "DR-3 DR-4",
    with_views("cells", "SELECT round(sum(x * x), 4) AS energy, CAST(64 AS BIGINT) AS rank FROM cells"),
)
def singular_value_energy(t: Tables) -> DataFrame:
    values, _ = decompose.truncated_svd(t.vectors, 64)
    curve = decompose.singular_curve(t.spark, values)
    return curve.agg(F.round(F.sum(F.col("value") * F.col("value")), 4).alias("energy"), F.max("k").alias("rank"))


@query("DR-4 WIN-3")
def singular_value_curve(t: Tables) -> DataFrame:
    values, _ = decompose.truncated_svd(t.vectors, 64)
    return decompose.singular_curve(t.spark, values)
