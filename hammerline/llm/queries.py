"""Queries of the operators over whole tables, with production parameters, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hammerline.llm import conversations, fingerprints, hard_negatives, licences, line_dedup, packing, pieces, pii, quality, repetition, sharding, simhash_dedup, token_files
from hammerline.llm.common import documents


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(documents(spark, sf_dir))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(documents(spark, sf_dir))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's host is its source; its path is the source's part in the document's language."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(documents(spark, sf_dir), labels, F.col("source"), F.col("lang"))


def op5_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_rules(documents(spark, sf_dir))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(documents(spark, sf_dir))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(documents(spark, sf_dir))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh id move up by one; every hundredth id is an anchor."""
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), vec_id % 100 == 0, moved)


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_document_fingerprints, op3_personal_data, op4_quality_classifier, op5_sentencepiece_round_trip,
    op6_quality_rules, op7_licence_scan, op8_token_files, op9_best_fit_packing, op10_sharding,
    op11_conversation_repair, op12_line_dedup, op13_hard_negatives)}

# XXH64, SHA-256 of code-point edits, suffix arrays, tokenizers and trained models have no SQL; their tests use brute force.
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
KEY = LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")

ORACLE_SQL: dict[str, str] = {
    "op12_line_dedup": f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS n FROM split),
keyed AS (SELECT *, {KEY} AS key FROM lines),
held AS (SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT k.*, h.key IS NOT NULL AND k.doc_id <> h.holder AS dropped FROM keyed k LEFT JOIN held h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op13_hard_negatives": """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.q, r.q)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10""",
}
