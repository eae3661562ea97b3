"""Canonical inputs of the operators, as views over the driver's tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import dates, text


class Tables:
    """Lazy parquet tables of one data folder, and the views built on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_"):
            raise AttributeError(table)
        return self.read(table)

    @cached_property
    def ratings(self) -> DataFrame:
        """One rating per (user, item), 1 to 5, with the time in epoch seconds."""
        orders = self.orders.select("o_orderkey", "o_custkey", "o_orderdate")
        lines = self.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
        return (
            orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
            .agg(
                F.max(1 + F.col("l_quantity").cast("int") % 5).cast("double").alias("rating"),
                dates.epoch_seconds(F.max("o_orderdate")).alias("ts"),
            )
        )

    @cached_property
    def users(self) -> DataFrame:
        nation = self.nation.select("n_nationkey", "n_name")
        return self.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_mktsegment").alias("occupation"),
            F.col("n_name").alias("zip"),
            F.col("c_acctbal").alias("balance"),
        )

    @cached_property
    def items(self) -> DataFrame:
        year = (F.col("p_size") + 1949).cast("string")
        return self.part.select(
            F.col("p_partkey").alias("item_id"),
            F.concat("p_name", F.lit(" ("), year, F.lit(")")).alias("raw_title"),
            F.when(F.col("p_size") % 10 == 0, "").otherwise(F.concat(F.lit("01-Jan-"), year)).alias("release"),
            F.col("p_type").alias("kind"),
            F.array(*[F.shiftright("p_size", b).bitwiseAND(F.lit(1)) for b in range(6)]).alias("flags"),
        )

    @cached_property
    def years(self) -> DataFrame:
        return self.items.select("item_id", text.release_year(F.col("release")).alias("year"))

    @cached_property
    def purchases(self) -> DataFrame:
        orders = self.orders.select("o_orderkey", "o_custkey")
        lines = self.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice")
        return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
            F.col("o_custkey").alias("user"),
            F.col("l_partkey").alias("product"),
            F.col("l_extendedprice").alias("price"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        return self.documents.select(F.col("doc_id").alias("id"), "text")

    @cached_property
    def vectors(self) -> DataFrame:
        return self.embeddings.select(
            F.col("vec_id").alias("id"),
            F.col("embedding").cast("array<double>").alias("features"),
            F.col("label").cast("double").alias("label"),
        )

    @cached_property
    def labelled(self) -> DataFrame:
        """Two-class documents: a category and raw numeric fields held as text."""
        lines = F.length("text") - F.length(F.translate("text", "\n", ""))
        spaces = F.length("text") - F.length(F.translate("text", " ", ""))
        digits = F.length("text") - F.length(F.translate("text", "0123456789", ""))
        docs = self.documents.select(
            F.col("doc_id").alias("id"),
            F.col("lang").alias("category"),
            F.array(
                F.when(F.col("n_chars") % 7 == 0, "?").otherwise(F.col("n_chars").cast("string")),
                spaces.cast("string"),
                lines.cast("string"),
                (digits - 5).cast("string"),
            ).alias("raw"),
        )
        labels = self.labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("label"))
        return labels.join(docs, "id").select(
            "id", "label", "category", F.transform("raw", text.number_or_zero).alias("numbers")
        )

    @cached_property
    def rentals(self) -> DataFrame:
        """Regression rows: five categories, three numbers, a positive target."""
        orders = self.orders.select("o_orderkey", "o_orderpriority", F.month("o_orderdate").alias("month"))
        lines = self.lineitem.select(
            "l_orderkey", "l_returnflag", "l_linestatus", "l_linenumber",
            "l_quantity", "l_discount", "l_tax", "l_extendedprice",
        )
        return lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_linestatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
            F.col("month").cast("string").alias("month"),
            F.col("l_linenumber").cast("string").alias("line"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_discount").alias("discount"),
            F.col("l_tax").alias("tax"),
            F.col("l_extendedprice").alias("target"),
        )

    @cached_property
    def messages(self) -> DataFrame:
        return self.events.select(
            F.lit("events").alias("topic"),
            (F.col("user_id") % 4).cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("event_type").alias("key"),
            F.col("props").alias("value"),
        )


# The same views in ANSI SQL, used only by the oracle.
VIEW_SQL = {
    "ratings": """ratings AS (
      SELECT o_custkey AS user_id, l_partkey AS item_id,
             CAST(max(1 + CAST(l_quantity AS INTEGER) % 5) AS DOUBLE) AS rating,
             CAST(epoch(max(o_orderdate)) AS BIGINT) AS ts
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)""",
    "users": """users AS (
      SELECT c_custkey AS user_id, c_mktsegment AS occupation, n_name AS zip, c_acctbal AS balance
      FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "items": """items AS (
      SELECT p_partkey AS item_id, p_name || ' (' || (1949 + p_size) || ')' AS raw_title,
             CASE WHEN p_size % 10 = 0 THEN '' ELSE '01-Jan-' || (1949 + p_size) END AS release,
             p_type AS kind, p_size
      FROM part)""",
    "years": """years AS (
      SELECT p_partkey AS item_id, CASE WHEN p_size % 10 = 0 THEN 1900 ELSE 1949 + p_size END AS year FROM part)""",
    "purchases": """purchases AS (
      SELECT o_custkey AS "user", l_partkey AS product, l_extendedprice AS price
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey)""",
    "vectors": """vectors AS (
      SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS features,
             CAST(label AS DOUBLE) AS label FROM embeddings)""",
    "cells": """cells AS (
      SELECT vec_id AS id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
             CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS pos FROM embeddings)""",
    "labelled": """labelled AS (
      SELECT l.doc_id AS id, CAST(quality AS DOUBLE) AS label, lang AS category,
             CASE WHEN n_chars % 7 = 0 THEN 0.0 ELSE CAST(n_chars AS DOUBLE) END AS x0,
             CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS x1,
             CAST(length(text) - length(replace(text, chr(10), '')) AS DOUBLE) AS x2,
             CAST(length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) - 5 AS DOUBLE) AS x3
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id)""",
    "rentals": """rentals AS (
      SELECT l_orderkey AS order_id, l_returnflag AS flag, l_linestatus AS status, o_orderpriority AS priority,
             CAST(month(o_orderdate) AS VARCHAR) AS month, CAST(l_linenumber AS VARCHAR) AS line,
             l_quantity AS quantity, l_discount AS discount, l_tax AS tax, l_extendedprice AS target
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey)""",
    "messages": """messages AS (
      SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
             event_type AS key, props AS value FROM events)""",
}


def with_views(names: str, body: str) -> str:
    """``WITH`` the named views, then ``body`` (which may start with more CTEs and a comma)."""
    ctes = ", ".join(VIEW_SQL[n] for n in names.split())
    body = body.strip()
    return f"WITH {ctes}{body if body.startswith(',') else ' ' + body}"
