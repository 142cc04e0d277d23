"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic model of a document's own form, fitted on labelled documents, gives the evidence of the document. Hosts and their
paths give the rest. A site's counts are the evidence of its documents, as parts of good ones, and the labels of its labelled documents. They
make a posterior good share of every host, shrunk toward the global share, and of every path, shrunk toward its host's. How strongly sites
shrink is the strength at which the counts of all sites of a level are most likely (beta-binomial), with a weak prior against
endless strengths. A document's odds are its likelihood ratio times the odds of its path without the document itself, so its evidence
counts once.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.llm.common import DOC_ID, fresh, map_texts
from hammerline.session import settle

SAMPLE = 20_000  # labelled documents that the model is fitted on, at most; those with the smallest hashes
RIDGE = 1.0
THRESHOLD = 0.5
STRENGTHS = tuple(2.0 * 2**(k / 2) for k in range(40))  # documents' worth of prior, from 2 to some 1.5 million
EDGE = 1e-4  # evidence of a document stays this far from certainty
FEATURES = ("log_words", "word_bytes", "symbols", "capitals", "digits", "stops", "exclaims", "bars", "other", "distinct", "distinct_lines",
            "line_words", "top_word", "short")
# Byte classes that the features count.
CLASSES = {"symbols": b"#*$%&<>@~^=_\\{}[]", "capitals": bytes(range(65, 91)), "digits": b"0123456789", "stops": b".,;:", "exclaims": b"!?", "bars": b"|"}


class Features:
    """Form of UTF-8 texts: shares of kinds of bytes, repetition of words and lines, lengths."""

    def __init__(self):
        self.classes = [np.frombuffer(c, dtype=np.uint8) for c in CLASSES.values()]

    def one(self, text: bytes) -> list[float]:
        words = text.split()
        n, size = len(words), max(1, len(text))
        if not n:
            return [0.0] * (len(FEATURES) - 1) + [1.0]
        counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
        lines = [line for line in text.split(b"\n") if line.strip()]
        often = Counter(words)
        shares = [float(counts[c].sum()) / size for c in self.classes]
        other = float(counts[:9].sum() + counts[127]) / size
        return [math.log1p(n), min(30.0, (len(text) - n) / n), *shares, other, math.log(len(often)) / math.log(n) if n > 1 else 1.0,
                len(set(lines)) / len(lines), math.log1p(n / len(lines)), max(often.values()) / n, float(n < 20)]

    def __call__(self, texts: list[bytes]) -> list[list]:
        return [[self.one(t) for t in texts]]


def fit(rows: np.ndarray, labels: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and coefficients (the intercept last) of a ridge logistic model; Newton steps until they are small.

    Without rows, or with one class only, the model is the smoothed share of good documents."""
    k = rows.shape[1]
    mean = rows.mean(axis=0) if len(rows) else np.zeros(k)
    scale = rows.std(axis=0) if len(rows) else np.ones(k)
    scale = np.where(scale > 1e-12, scale, 1.0)
    share = (labels.sum() + 1) / (len(labels) + 2)
    beta = np.append(np.zeros(k), math.log(share / (1 - share)))
    if len(np.unique(labels)) < 2:
        return mean, scale, beta
    x = np.column_stack([(rows - mean) / scale, np.ones(len(rows))])
    penalty = np.append(np.full(k, ridge), 1e-9)

    def loss(b):
        z = x @ b
        return float(np.logaddexp(0, z).sum() - labels @ z + 0.5 * penalty @ (b * b))

    best = loss(beta)
    while True:
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (labels - p) - penalty * beta)
        size = 1.0
        while (now := loss(beta + size * step)) > best and size > 1e-9:
            size /= 2
        if best - now <= 1e-9 * (1 + abs(best)):  # the loss is convex: no further step lowers it
            return mean, scale, beta
        beta, best = beta + size * step, now


def evidence(features: Column, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Column:
    """Probability of a good document from its features alone."""
    mean, scale, beta = model
    z = F.lit(float(beta[-1] - (beta[:-1] * mean / scale).sum()))
    for k, b in enumerate(beta[:-1] / scale):
        z = z + F.lit(float(b)) * F.element_at(features, k + 1)
    p = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    return F.greatest(F.least(p, F.lit(1 - EDGE)), F.lit(EDGE))


def logit(p):
    return F.log(p / (1 - p))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``rows`` (doc_id, host, path, features) that have a label, with ``quality``. Labels of one document are averaged; null ones don't count."""
    known = labels.select(DOC_ID, F.col("quality").cast("double").alias("quality")).dropna().groupBy(DOC_ID).agg(F.avg("quality").alias("quality"))
    return settle(rows.join(known, DOC_ID).select(DOC_ID, "host", "path", "features", "quality", F.xxhash64(DOC_ID).alias("hash")))


def learn(found: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The document model, from what ``labelled`` gives."""
    share = (sample + 6 * math.sqrt(sample)) / max(1, found.count())
    if share < 1:  # hashes are uniform: somewhat over ``sample`` of them are this small, so few rows reach the driver
        found = found.filter(F.col("hash") < int(share * 2**64) - 2**63)
    taken = found.orderBy("hash", DOC_ID).limit(sample).select("features", "quality").collect()
    x = np.array([r["features"] for r in taken], dtype=float).reshape(-1, len(FEATURES))
    return fit(x, (np.array([r["quality"] for r in taken], dtype=float) >= 0.5).astype(float))


def log_likelihood(n: float, good: float, mean: float, strength: float) -> float:
    """Of a site's counts (parts of documents count as parts), up to a constant, when its prior is worth ``strength`` documents."""
    a, b = strength * mean, strength * (1 - mean)
    return (math.lgamma(a + good) - math.lgamma(a) + math.lgamma(b + n - good) - math.lgamma(b)
            - math.lgamma(strength + n) + math.lgamma(strength))


def strength(sites: DataFrame) -> float:
    """How many documents' worth of prior a site gets, from rows (n, good, mean): the most likely of STRENGTHS, each weighed by 1 / (1 + it).

    Tasks sum the likelihoods over their sites; one row a strength comes back.
    """
    def run(batches):
        sums = np.zeros(len(STRENGTHS))
        for pdf in batches:
            for n, good, mean in pdf[["n", "good", "mean"]].itertuples(index=False):
                sums += [log_likelihood(n, min(max(good, 0.0), n), min(max(mean, EDGE), 1 - EDGE), m) for m in STRENGTHS]
        yield pd.DataFrame({"k": range(len(STRENGTHS)), "v": sums})

    found = dict(sites.select(F.col("n").cast("double").alias("n"), "good", "mean").mapInPandas(run, "k int, v double").groupBy("k").agg(F.sum("v")).collect())
    return max(STRENGTHS, key=lambda m: found.get(STRENGTHS.index(m), 0.0) - math.log1p(m))


def sites(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(host, path, n, good, host_n, host_good, host_strength, path_strength, global_share) from rows (host, path, p_document) and the
    labelled rows: what a document's odds need of its site."""
    soft = rows.select("host", "path", F.col("p_document").alias("good"))
    hard = found.select("host", "path", (F.col("quality") >= 0.5).cast("double").alias("good"))
    paths = settle(soft.unionByName(hard).groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("good").alias("good")))
    hosts = settle(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good")))
    whole = hosts.agg(F.sum("host_good"), F.sum("host_n")).first()
    share = whole[0] / whole[1] if whole[1] else 0.5
    m = strength(hosts.select(F.col("host_n").alias("n"), F.col("host_good").alias("good"), F.lit(share).alias("mean")))
    paths = settle(paths.alias("p").join(hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host"))).select(
        "p.*", "host_n", "host_good", F.lit(m).alias("host_strength"), F.lit(share).alias("global_share")))
    mean = (F.col("host_good") + m * share) / (F.col("host_n") + m)
    return settle(paths.withColumn("path_strength", F.lit(strength(paths.select("n", "good", mean.alias("mean"))))))


def site_posteriors(p: Column, s: str = "") -> tuple[Column, Column]:
    """Posterior good shares of a document's host and path without the document, whose own evidence is ``p``."""
    c = lambda name: F.col(f"{s}{name}")
    host = (c("host_good") - p + c("host_strength") * c("global_share")) / (c("host_n") - 1 + c("host_strength"))
    return host, (c("good") - p + c("path_strength") * host) / (c("n") - 1 + c("path_strength"))


def quality_of(p: Column, s: str = "") -> Column:
    """Probability of a good document from its evidence and the columns of ``sites``."""
    path = F.greatest(F.least(site_posteriors(p, s)[1], F.lit(1 - EDGE)), F.lit(EDGE))
    share = F.greatest(F.least(F.col(f"{s}global_share"), F.lit(1 - EDGE)), F.lit(EDGE))
    return 1 / (1 + F.exp(-(logit(p) - logit(share) + logit(path))))


def _featured(df: DataFrame, text_col: str, *keep: Column) -> DataFrame:
    return map_texts(df.select(*keep, F.col(text_col).cast("binary").alias("text")), "features array<double>", Features)


def classify(df: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = DOC_ID, text_col: str = "text",
             sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, host, path, p_document, host_posterior, path_posterior, p_quality, kept, changed) for every row.

    The posteriors are those of the document's site without the document; ``changed`` says whether its site turned the verdict of its own
    evidence. A null host or path is a site of its own; a null text has the form of an empty one. Repeated rows count as often as they come.
    Without labels every document's own evidence is even, and all are kept. Texts are read whole, however long; other columns are
    left behind; an empty table gives an empty result.
    """
    rows = settle(_featured(df, text_col, F.col(id_col).alias(DOC_ID), host.cast("string").alias("host"), path.cast("string").alias("path")))
    found = labelled(rows, labels)
    rows = rows.withColumn("p_document", evidence(F.col("features"), learn(found, sample))).drop("features")
    p, known = F.col("p_document"), sites(rows, found).alias("s")
    joined = rows.alias("d").join(known, F.col("d.host").eqNullSafe(F.col("s.host")) & F.col("d.path").eqNullSafe(F.col("s.path")))
    at_host, at_path = site_posteriors(p)
    quality = joined.select(DOC_ID, "d.host", "d.path", "p_document", at_host.alias("host_posterior"), at_path.alias("path_posterior"), quality_of(p).alias("p_quality"))
    return quality.withColumn("kept", F.col("p_quality") >= threshold).withColumn("changed", F.col("kept") != (p >= threshold))


def keep(df: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = DOC_ID, text_col: str = "text",
         sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that ``classify`` keeps, with all their columns, nulls, empty texts, repeated rows and empty tables as there.

    Features are taken twice, first for the model and the sites, then beside the rows, so that texts are not shuffled to meet the verdicts.
    """
    rows = settle(_featured(df, text_col, F.col(id_col).alias(DOC_ID), host.cast("string").alias("host"), path.cast("string").alias("path")))
    found = labelled(rows, labels)
    model = learn(found, sample)
    known = sites(rows.withColumn("p_document", evidence(F.col("features"), model)).drop("features"), found).alias("s")
    text, features = fresh(df, "text"), fresh(df, "features")
    site = {c: fresh(df, c) for c in ("host", "path")}
    named = df.withColumns({site["host"]: host.cast("string"), site["path"]: path.cast("string"), text: F.col(text_col).cast("binary")})
    again = map_texts(named, f"`{features}` array<double>", Features).alias("d")
    passed = again.join(known, F.col(f"d.{site['host']}").eqNullSafe(F.col("s.host")) & F.col(f"d.{site['path']}").eqNullSafe(F.col("s.path")))
    passed = passed.filter(quality_of(evidence(F.col(f"d.{features}"), model), "s.") >= threshold)
    return passed.select(*[F.col(f"d.`{c}`") for c in df.columns])
