"""Nearest centres, Lloyd iterations, cluster reports."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions import arrays
from tallyforge.operators.ordering import top_per_key
from tallyforge.session import written

# Most numbers sent to each task in one pass; more centres simply mean more passes.
MAX_CENTRE_VALUES = 2_000_000


def matrix(column: pa.Array) -> np.ndarray:
    """An Arrow list column of equal lengths as a 2-d array, without copying rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(len(column), 1))


def _closer(features: str, ids: np.ndarray, centres: np.ndarray):
    """Keep, per row, the nearer of the centre found so far and the given ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = matrix(batch.column(features))
            best = batch.column("__d").to_numpy(zero_copy_only=False).copy()
            who = batch.column("__c").to_numpy(zero_copy_only=False).copy()
            for centre_id, centre in zip(ids, centres):
                d = ((x - centre) ** 2).sum(axis=1)
                better = (d < best) | ((d == best) & (centre_id < who))
                best[better], who[better] = d[better], centre_id
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["__d"], columns["__c"] = pa.array(best), pa.array(who)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def assign(
    points: DataFrame,
    centres: DataFrame,
    features: str = "features",
    cluster: str = "cluster",
    squared: str = "squared",
) -> DataFrame:
    """Add the nearest of ``centres(id, features)`` and the squared distance to it.

    The smaller id wins a tie; without any centre the cluster is -1. Centres go to
    the tasks in passes of bounded size, so their number is not limited, and every
    pass is one scan-like map over Arrow batches: no shuffle and no product of rows.
    """
    k = centres.count()
    out = points.withColumns({"__d": F.lit(float("inf")), "__c": F.lit(-1).cast("long")})
    if k:
        width = len(centres.select("features").head()[0])
        passes = max(1, math.ceil(k * width / MAX_CENTRE_VALUES))
        for p in range(passes):
            part = centres.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == p) if passes > 1 else centres
            rows = sorted((r["id"], r["features"]) for r in part.select("id", "features").collect())
            if rows:
                ids = np.array([r[0] for r in rows], dtype=np.int64)
                values = np.array([r[1] for r in rows], dtype=np.float64)
                out = out.mapInArrow(_closer(features, ids, values), out.schema)
    return out.withColumnsRenamed({"__d": squared, "__c": cluster})


def group_means(df: DataFrame, group: str = "cluster", features: str = "features") -> DataFrame:
    """Mean vector and size per group, summed map-side: ``(id, features, size)``."""
    vec = array_to_vector(F.col(features))
    return df.groupBy(F.col(group).cast("long").alias("id")).agg(
        vector_to_array(Summarizer.mean(vec)).alias("features"), F.count(F.lit(1)).alias("size")
    )


def lloyd(points: DataFrame, centres: DataFrame, iterations: int = 10, features: str = "features") -> DataFrame:
    """Centres after a fixed number of rounds from given ones; emptied clusters vanish.

    Each round writes its few rows to the shared folder, so the plan of the next one
    starts from a table.
    """
    data = points.select(features).persist()
    current = centres.select(F.col("id").cast("long").alias("id"), "features")
    for _ in range(iterations):
        means = group_means(assign(data, current, features), features=features)
        current = written(means.select("id", "features"), "centres")
    data.unpersist()
    return current


def wcss(assigned: DataFrame, squared: str = "squared") -> DataFrame:
    """Within-cluster sum of squared distances."""
    return assigned.agg(F.sum(squared).alias("wcss"))


def fit_kmeans(points: DataFrame, k: int = 5, iterations: int = 10, seed: int = 42, features: str = "features"):
    """Spark's k-means on an ``array<double>`` column."""
    data = points.select(array_to_vector(F.col(features)).alias("features"))
    return KMeans(k=k, maxIter=iterations, seed=seed, featuresCol="features").fit(data)


def centre_table(spark, model) -> DataFrame:
    """The k centres of a fitted model as a DataFrame."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("features", T.ArrayType(T.DoubleType()))])
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, schema)


def held_out_wcss(train: DataFrame, test: DataFrame, k: int, iterations: int = 100, seed: int = 42) -> float:
    """Cost of the test rows under centres learnt on the training rows."""
    model = fit_kmeans(train, k, iterations, seed)
    return wcss(assign(test, centre_table(test.sparkSession, model))).first()[0]


def nearest_members(assigned: DataFrame, n: int = 20, key: str = "id", digits: int = 6) -> DataFrame:
    """The ``n`` rows closest to each centre."""
    rounded = assigned.withColumn("squared", F.round("squared", digits))
    return top_per_key(rounded, ["cluster"], ["squared", key], n)


def with_distance(assigned: DataFrame, centres: DataFrame, features: str = "features") -> DataFrame:
    """Distance recomputed from the centre table by an ordinary join, as a cross-check."""
    c = centres.select(F.col("id").alias("cluster"), F.col("features").alias("centre"))
    return assigned.join(c, "cluster").withColumn("distance", arrays.distance(F.col(features), F.col("centre")))
