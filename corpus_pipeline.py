"""A corpus pipeline of five stages; each is written as Parquet and read again.

Every stage takes and returns the columns of ``documents``; the last one returns token ids.
Null and empty texts, repeated rows and empty tables are handled as the operators state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import bpe, decontaminate, pii, quality_rules, simhash
from tallyforge.llm.common import table
from tallyforge.llm.queries import vocabulary
from tallyforge.session import written

#: Words that the last stage remembers: a worker of the pipeline has served four stages before.
REMEMBERED = bpe.REMEMBERED // 4

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by gaps."""
    return pii.redact(docs, pii.fit(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, the ids of each text as little-endian unsigned 32-bit
    integers, their number and digest, and the digest of the text they decode to."""
    path = vocabulary("byte_bpe_50k.json")
    both = bpe.decode(bpe.encode(docs, path, ["doc_id", "lang", "source"], REMEMBERED), path)
    digests = F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")
    return both.select("doc_id", "lang", "source", "ids", "n_tokens", *digests)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("pii", personal_data),
    ("bpe", tokens),
]

#: Fingerprints and merges are not for SQL; tests hold ``run`` against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
