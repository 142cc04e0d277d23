"""Quality classifier: held-out accuracy, shrinkage against a plain version, edge tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hammerline.llm import quality
from tests.llm.conftest import rows_of

SF = "/root/testdata/sf0.01"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    seen, held = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    got = quality.classify(docs, seen, F.col("source"), F.col("lang")).join(held, "doc_id").toPandas()
    assert (got.kept == (got.quality == 1)).mean() >= 0.97
    assert got[got.quality == 1].kept.mean() >= 0.99


def plain_quality(docs, labels):
    """p_quality of documents (host, path, p, label or None), by counting for each of them."""
    soft = [(h, q, p) for h, q, p, _ in docs] + [(h, q, float(x >= 0.5)) for h, q, _, x in docs if x is not None]
    g = sum(e for _, _, e in soft) / len(soft)

    def best(groups):
        return max(quality.STRENGTHS, key=lambda m: sum(quality.log_likelihood(n, good, mean, m) for n, good, mean in groups) - math.log1p(m))

    def counts(key):
        out = {}
        for h, q, e in soft:
            n, good = out.get(key(h, q), (0, 0.0))
            out[key(h, q)] = n + 1, good + e
        return out

    hosts, paths = counts(lambda h, q: h), counts(lambda h, q: (h, q))
    mh = best([(n, good, g) for n, good in hosts.values()])
    mp = best([(n, good, (hosts[h][1] + mh * g) / (hosts[h][0] + mh)) for (h, _), (n, good) in paths.items()])
    out = []
    for h, q, p, _ in docs:
        host = (hosts[h][1] - p + mh * g) / (hosts[h][0] - 1 + mh)
        path = (paths[h, q][1] - p + mp * host) / (paths[h, q][0] - 1 + mp)
        path = min(max(path, quality.EDGE), 1 - quality.EDGE)
        odds = p / (1 - p) * (1 - g) / g * path / (1 - path)
        out.append(odds / (1 + odds))
    return out


def test_quality_against_plain_counting(spark):
    """Shrinkage without the document itself, strengths by likelihood, labels beside soft counts."""
    r = np.random.default_rng(5)
    docs = [(f"h{h}", f"p{q}", float(np.clip(r.normal(0.2 + 0.06 * h, 0.05), 0.01, 0.99)), [None, None, 1.0, 0.0][int(r.integers(4))])
            for h in range(10) for q in range(4) for _ in range(1 + 30 * (q > 0))]
    rows = spark.createDataFrame([(k, h, q, p) for k, (h, q, p, _) in enumerate(docs)], "doc_id long, host string, path string, p_document double")
    found = spark.createDataFrame([(h, q, x) for h, q, _, x in docs if x is not None], "host string, path string, quality double")
    known = quality.sites(rows, found)
    got = rows.join(known, ["host", "path"]).select("doc_id", quality.quality_of(F.col("p_document")).alias("q")).orderBy("doc_id").collect()
    assert [x["q"] for x in got] == pytest.approx(plain_quality(docs, None))
    assert known.first()["host_strength"] < 100


def site_corpus():
    """Good and bad documents of form, and a third form that is good where its site is good; labels on half of them."""
    forms = {"good": "Plain sentences stand here, written with care and ended by stops. The next one goes on about something else entirely, number {}. ",
             "bad": "### {} @@ CLICK!!! ||| $$$ BUY|NOW|{} %%% ", "middle": "short lines of {} words without stops\nand more of {} them\n"}
    r = np.random.default_rng(8)
    docs, labels = [], []
    for host, path, n, share in (("good.example", "a", 150, 0.95), ("good.example", "spam", 80, 0.05), ("bad.example", "a", 150, 0.05), ("sparse.example", "a", 1, 1.0)):
        for _ in range(n):
            is_good = r.random() < share
            form = "middle" if r.random() < 0.4 else "good" if is_good else "bad"
            docs.append((len(docs), forms[form].format(*r.integers(10**5, 10**6, 2)) * 6, host, path, form))
            if r.random() < 0.5:
                labels.append((len(docs) - 1, int(is_good), 0))
    return docs, labels


def test_sites_turn_verdicts(spark):
    docs, labels = site_corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, part string, form string")
    got = quality.classify(df, labels_of(spark, labels), F.col("source"), F.col("part")).toPandas().set_index("doc_id").sort_index()
    got["form"] = [d[4] for d in docs]
    middle = got[got.form == "middle"]
    assert middle.p_document.between(0.1, 0.9).all()
    at_good = (middle.host == "good.example") & (middle.path == "a")
    at_bad = (middle.host == "bad.example") | (middle.path == "spam")
    assert middle[at_good].kept.all() and not middle[at_bad].kept.any()  # the bad host and the bad path of a good host
    assert middle[at_good].path_posterior.min() > 0.75 > 0.25 > middle[at_bad].path_posterior.max()
    assert got.changed.sum() >= 20 and (got.changed == (got.kept != (got.p_document >= 0.5))).all()
    assert got[got.form == "good"].kept.all() and not got[got.form == "bad"].kept.any()
    kept = {r["doc_id"] for r in quality.keep(df, labels_of(spark, labels), F.col("source"), F.col("part")).select("doc_id").collect()}
    assert kept == set(got.index[got.kept])


def test_edges(spark, edge, empty):
    none = labels_of(spark, [])
    got = quality.classify(edge, none, F.col("source"), F.col("lang"))
    assert got.count() == edge.count() and got.filter("kept").count() == edge.count()
    odd = labels_of(spark, [(0, 1, None), (0, 0, None), (None, 1, 0), (3, None, 0), (15, 1, 0), (15, 1, 0), (57, 1, 0), (999, 0, 0)])
    kept = quality.keep(edge, odd, F.col("source"), F.col("lang"))
    assert kept.columns == edge.columns
    assert kept.count() == quality.classify(edge, odd, F.col("source"), F.col("lang")).filter("kept").count()
    assert quality.classify(empty, none, F.col("source"), F.col("lang")).count() == 0
    assert quality.keep(empty, odd, F.col("source"), F.col("lang")).count() == 0


def test_keep_agrees_with_classify(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    assert rows_of(quality.keep(docs, labels, F.col("source"), F.col("lang")), "doc_id") == rows_of(
        quality.classify(docs, labels, F.col("source"), F.col("lang")).filter("kept"), "doc_id")
