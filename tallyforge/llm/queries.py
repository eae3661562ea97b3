"""Registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import (
    bpe,
    decontaminate,
    html_text,
    mining_queries,
    pii,
    quality_model,
    quality_rules,
    simhash,
    token_counts,
    toxicity,
    url_filters,
)
from tallyforge.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**mining_queries.QUERIES}
SQL: dict[str, str] = {**mining_queries.SQL}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    both = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path, ["doc_id"]), path)
    digests = F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")
    return both.select("doc_id", "n_tokens", *digests)


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents")).select("doc_id", *quality_rules.COUNTS)


SQL["op2_quality_rules"] = quality_rules.sql()


def held_out(parts: int, rest: int) -> Column:
    """Whether ``doc_id`` belongs to the rows that labels are never learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == rest, F.lit(False))


def _with_verdict(scores: DataFrame, apart: Column) -> DataFrame:
    return scores.select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, apart = table(spark, sf_dir, "documents"), held_out(5, 0)
    labelled = table(spark, sf_dir, "labels").where(~apart).select("doc_id", F.col("toxic").alias("label"))
    return _with_verdict(toxicity.score(docs, toxicity.fit(docs, labelled)), apart)


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judged(table(spark, sf_dir, "pages"))


@query
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("copy")


@query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    return found.select("doc_id", *(f"n_{k}" for k in pii.BASE), F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, apart = table(spark, sf_dir, "documents"), held_out(3, 1)
    labelled = table(spark, sf_dir, "labels").where(~apart).select("doc_id", F.col("quality").alias("label"))
    return _with_verdict(quality_model.score(docs, *quality_model.fit(docs, labelled)), apart)
