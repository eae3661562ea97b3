"""Queries of phrase mining, exact deduplication and hard negatives, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import exact_dedup, hard_negatives, phrases
from tallyforge.llm.common import table


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
  FROM starts, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE i + m - 1 <= len(w)),
counted AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE m > 1 AND f >= 30),
cuts AS (
  SELECT c.*, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 :], ' ') AS tail
  FROM candidates c, (SELECT unnest([1, 2, 3]) AS k) WHERE k < m),
scored AS (
  SELECT c.lang, c.phrase, a, h.f AS l, t.f AS r, k, ((2000000::HUGEINT * a) // (h.f + t.f))::BIGINT AS score
  FROM cuts c JOIN counted h ON h.lang = c.lang AND h.phrase = head JOIN counted t ON t.lang = c.lang AND t.phrase = tail
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
inner_parts AS (
  SELECT DISTINCT lang, a AS longer, array_to_string(w[i : i + s - 1], ' ') AS phrase
  FROM candidates, (SELECT unnest([2, 3]) AS s), (SELECT unnest([1, 2, 3]) AS i) WHERE s < m AND i + s - 1 <= m),
kept AS (
  SELECT * FROM scored s WHERE NOT EXISTS (
    SELECT 1 FROM inner_parts p WHERE p.lang = s.lang AND p.phrase = s.phrase AND 100 * p.longer >= 80 * s.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000"""


def op12_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(spark, f"{sf_dir}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("body_digest").alias("text_sha256"))


OP12_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("id") % 100 == 0)


OP13_SQL = """
WITH whole AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM whole a JOIN whole b ON a.id % 100 = 0 AND a.id <> b.id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
 AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""

QUERIES = {f.__name__: f for f in (op11_phrases, op12_exact_duplicates, op13_hard_negatives)}
SQL = {"op11_phrases": OP11_SQL, "op12_exact_duplicates": OP12_SQL, "op13_hard_negatives": OP13_SQL}
