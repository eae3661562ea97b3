"""Dictionaries, 1-of-k encoding, bags of terms, scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.joins import MAX_BROADCAST_BYTES, lookup_join, measured_bytes
from tallyforge.operators.ordering import global_index, rank_within
from tallyforge.session import written


def dictionary(df: DataFrame, value: str | Column, name: str = "value") -> DataFrame:
    """Sorted distinct values with a dense 0-based index: the same on every run."""
    column = F.col(value) if isinstance(value, str) else value
    return global_index(df.select(column.alias(name)).distinct(), [name])


def with_index(df: DataFrame, dictionary_: DataFrame, column: str, index: str) -> DataFrame:
    """Add the dictionary index of ``column``. Every row stays; a value that the dictionary
    lacks, and null, have a null index."""
    dim = dictionary_.where(F.col("value").isNotNull()).select(F.col("value").alias(column), F.col("idx").alias(index))
    return lookup_join(df, dim, column, "left")


def hot(index: Column, width: int) -> Column:
    """Dense 1-of-k array, all zeros for a null index. ``vector_features`` has the sparse form."""
    places = F.sequence(F.lit(0), F.lit(width - 1)) if width else F.array().cast("array<int>")
    return F.transform(places, lambda i: F.coalesce((i == index).cast("double"), F.lit(0.0)))


class MixedEncoder:
    """Several categorical columns followed by numeric ones.

    Every row is encoded. A null, and a value that ``fit`` has not seen, has no position:
    its block is all zeros.

    ``fit`` builds one dictionary per category; category ``c`` takes the positions
    from its offset on. Dictionaries stay DataFrames; only their sizes are read.
    """

    def __init__(self, categories: Sequence[str], numbers: Sequence[str]):
        self.categories, self.numbers = list(categories), list(numbers)
        self.dictionaries: dict[str, DataFrame] = {}
        self.offsets: dict[str, int] = {}

    def fit(self, df: DataFrame) -> MixedEncoder:
        """All dictionaries from one pass: distinct (column, value) pairs, ranked per column."""
        cells = F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in self.categories]
        )
        pairs = df.select(F.explode(cells).alias("p")).select("p.column", "p.value").where("value IS NOT NULL").distinct()
        ranked = written(rank_within(pairs, ["column"], ["value"], "__rank"), "dictionaries")
        sizes = {r["column"]: r["n"] for r in ranked.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        self.widths = {c: sizes.get(c, 0) for c in self.categories}
        at, small = 0, measured_bytes(ranked) <= MAX_BROADCAST_BYTES
        for c in self.categories:
            self.dictionaries[c] = ranked.where(F.col("column") == c).select("value", (F.col("__rank") - 1).alias("idx"))
            if small:
                self.dictionaries[c] = F.broadcast(self.dictionaries[c])
            self.offsets[c] = at
            at += self.widths[c]
        self.category_width = at
        self.width = at + len(self.numbers)
        return self

    def indexed(self, df: DataFrame) -> DataFrame:
        """``<category>_idx`` columns, each counted inside its own category."""
        for c in self.categories:
            known = self.dictionaries[c].withColumnsRenamed({"value": f"__{c}", "idx": f"{c}_idx"})
            df = df.join(known, F.col(c).cast("string") == F.col(f"__{c}"), "left").drop(f"__{c}")
        return df

    def positions(self, df: DataFrame) -> DataFrame:
        """``hot``: positions of the ones in the whole vector."""
        at = [(F.col(f"{c}_idx") + self.offsets[c]) for c in self.categories]
        return self.indexed(df).withColumn("hot", F.array_compact(F.array(*at)))

    def cells(self) -> tuple[Column, Column]:
        """Positions and values of the rows that :meth:`positions` made."""
        numbers = F.array(*[F.lit(self.category_width + i).cast("long") for i in range(len(self.numbers))])
        values = F.array(*[F.col(n).cast("double") for n in self.numbers])
        return F.concat(F.col("hot").cast("array<bigint>"), numbers), F.concat(F.array_repeat(F.lit(1.0), F.size("hot")), values)

    def dense_features(self, df: DataFrame, name: str = "features") -> DataFrame:
        blocks = [hot(F.col(f"{c}_idx"), self.widths[c]) for c in self.categories]
        tail = [F.array(*[F.col(n).cast("double") for n in self.numbers])] if self.numbers else []
        return self.indexed(df).withColumn(name, F.concat(*blocks, *tail))

    def vector_features(self, df: DataFrame, name: str = "features") -> DataFrame:
        """Sparse vectors for model fitting."""
        indices = [f"{c}_idx" for c in self.categories]
        vectors = [f"{c}_hot" for c in self.categories]
        last = [F.lit(float(max(self.widths[c] - 1, 0))).alias(i) for c, i in zip(self.categories, indices, strict=True)]
        encoder = OneHotEncoder(inputCols=indices, outputCols=vectors, handleInvalid="keep").fit(
            df.sparkSession.range(1).select(*last)
        )
        # a position past the end is the encoder's invalid one, which it drops as the last
        known = {i: F.coalesce(i, F.lit(self.widths[c])) for c, i in zip(self.categories, indices, strict=True)}
        filled = self.indexed(df).withColumns(known)
        assembler = VectorAssembler(inputCols=vectors + self.numbers, outputCol=name)
        return assembler.transform(encoder.transform(filled)).drop(*vectors)


def ordinal_features(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """Raw numbers side by side, for trees."""
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)


def term_dictionary(df: DataFrame, tokens: Column) -> DataFrame:
    """Index of every distinct term."""
    return dictionary(df.select(F.explode(tokens).alias("t")), "t")


def bag_of_terms(df: DataFrame, key: str, tokens: Column, terms: DataFrame) -> DataFrame:
    """Sorted distinct term indices per ``key``: the non-zero positions of its 0/1 vector.
    A row without known terms has an empty list."""
    exploded = df.select(key, F.explode_outer(F.array_distinct(tokens)).alias("value"))
    return (
        lookup_join(exploded, terms, "value", "left")
        .groupBy(key)
        .agg(F.sort_array(F.collect_list("idx")).alias("terms"))
    )


def fit_scaler(df: DataFrame, features: str, with_std: bool = True):
    """Mean and sample deviation learnt on ``df``; apply the result to any set."""
    vec = df.select(array_to_vector(F.col(features)).alias("__raw"))
    scaler = StandardScaler(inputCol="__raw", outputCol="__scaled", withMean=True, withStd=with_std)
    return scaler.fit(vec)


def scaled(df: DataFrame, scaler, features: str, name: str = "scaled") -> DataFrame:
    out = scaler.transform(df.withColumn("__raw", array_to_vector(F.col(features))))
    return out.withColumn(name, vector_to_array("__scaled")).drop("__raw", "__scaled")
