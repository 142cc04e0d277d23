"""Training corpus from raw documents: quality classifier, quality rules, near-duplicates, personal data, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hammerline.llm import packing, pii, quality, repetition, simhash_dedup
from hammerline.llm.common import documents
from hammerline.session import remove, shared_dir, workspace


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps. Null texts are judged as empty ones, null sources and languages as sites of their own, repeated
    rows each; very long texts are read whole; other columns pass through; no documents give none."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep(docs, labels, F.col("source"), F.col("lang"))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. Null and empty texts fail; repeated rows fare alike; texts are judged whole, however long."""
    return repetition.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the least doc_id, null ids last; of repeated rows one. Null and empty texts are one group."""
    return simhash_dedup.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data masked; null texts stay null, ``n_chars`` follows, other columns pass through."""
    return pii.mask(docs, chars_col="n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences. A null or empty text is its end id alone; long texts are cut, never shortened;
    repeated rows are packed each; no documents give no pieces."""
    return packing.packed(docs)


STAGES = [
    ("quality_classifier", classify_quality),
    ("quality_rules", apply_rules),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack_sequences),
]

# A trained classifier, XXH64 fingerprints and a tokenizer have no SQL; tests/llm/test_pipeline.py checks every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes Parquet to the shared folder, which the next one reads. Only the result is left there."""
    docs, before = documents(spark, sf_dir), None
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}"
        with workspace(spark):  # what a stage has settled goes when its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
