"""The pipeline, stage by stage, against plain versions over each stage's own input."""

import uuid

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hammerline.llm import packing, pii, quality, repetition
from hammerline.session import shared_dir
from tests.llm.conftest import rows_of
from tests.llm.test_pii import plain as plain_spans
from tests.llm.test_repetition import plain as plain_rules
from tests.llm.test_simhash_dedup import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The input of every stage and, last, the result."""
    folder, out = f"{shared_dir(spark)}/stages-{uuid.uuid4().hex}", [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


def pairs(df):
    return sorted(map(tuple, df.select("doc_id", "text").collect()))


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_classifier(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = quality.classify(stages[0], labels, F.col("source"), F.col("lang")).filter("kept")
    assert rows_of(stages[1], "doc_id") == rows_of(kept, "doc_id")
    good = {r["doc_id"] for r in labels.filter("quality = 1").collect()} & {i for i, _ in pairs(stages[0])}
    left = {i for i, _ in pairs(stages[1])}
    assert len(good & left) >= 0.98 * len(good)


def test_rules(stages):
    judged = repetition.quality_rules(stages[1])
    assert pairs(stages[2]) == [p for p in pairs(stages[1]) if p[0] in {r["doc_id"] for r in judged.filter("kept").collect()}]
    assert not any(plain_rules(t)[-1] for _, t in pairs(stages[2]))


def test_near_duplicates(stages):
    rows = pairs(stages[2])
    label = plain_components([plain_fingerprint(t) for _, t in rows])
    assert pairs(stages[3]) == [rows[k] for k in range(len(rows)) if label[k] == k]


def test_masking(stages):
    want = [(i, pii.masked(t, [(pii.KINDS.index(k), s, e) for k, s, e in plain_spans(t)])) for i, t in pairs(stages[3])]
    assert pairs(stages[4]) == want
    assert all(r["n_chars"] == len(r["text"]) for r in stages[4].collect())


def test_packing(stages):
    assert rows_of(stages[5], "doc_id", "piece", "start", "length", "ids_crc32") == rows_of(packing.pieces(stages[4]), "doc_id", "piece", "start", "length", "ids_crc32")


def test_run_gives_the_same_rows(spark, stages):
    assert rows_of(corpus_pipeline.run(spark, SF), "doc_id", "piece", "length", "ids_crc32") == rows_of(stages[5], "doc_id", "piece", "length", "ids_crc32")


def test_edge_documents_pass_through(spark, edge, sample):
    """Nulls, repeated rows and clashing columns go through every stage, beside ordinary documents that share some of their ids."""
    docs, folder = edge.unionByName(sample, allowMissingColumns=True), f"{shared_dir(spark)}/edge-{uuid.uuid4().hex}"
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    assert docs.count() > 0


def test_no_documents(spark, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
