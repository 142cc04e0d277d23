"""Distributed ranks and quantiles against brute force, with one group holding most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hammerline.functions import ranking


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(5)
    n = 3000
    state = np.where(rng.random(n) < 0.7, "CA", rng.choice(["NV", "TX"], n)).astype(object)
    reserve = rng.integers(1, 60, n).astype(float)
    reserve[rng.random(n) < 0.35] = np.nan
    pdf = pd.DataFrame({"state": state, "reserve": reserve, "id": np.arange(n)})
    extra = pd.DataFrame({"state": ["WY", "OH", "OH", None], "reserve": [5.0, 1.0, np.nan, 2.0], "id": [n, n + 1, n + 2, n + 3]})
    pdf = pd.concat([pdf, extra], ignore_index=True)
    df = spark.createDataFrame(pdf).withColumn("reserve", F.when(~F.isnan("reserve"), F.col("reserve")))
    return pdf, df.withColumn("state", F.when(F.col("state") != "NaN", F.col("state")))


def expected_tiles(pdf):
    tiles = {}
    for _, part in pdf.groupby("state", dropna=False):
        part = part.sort_values(["reserve", "id"], na_position="first")
        for tile, ids in enumerate(np.array_split(part["id"].to_numpy(), 3), start=1):
            tiles.update({int(i): tile for i in ids})
    return tiles


def test_ntile_with_ties_nulls_and_a_hot_group(skewed):
    pdf, df = skewed
    rows = ranking.ntile(df, "state", ["reserve", "id"], 3, "tile").select("id", "tile").collect()
    assert {r.id: r.tile for r in rows} == expected_tiles(pdf)


def test_running_total_spreads_a_group_over_slices(skewed, monkeypatch):
    _, df = skewed
    seen = {}
    original = ranking.settle
    monkeypatch.setattr(ranking, "settle", lambda d: seen.setdefault("df", original(d)))
    # the test rows are few enough for Spark to merge all slices into one task
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    df.sparkSession.conf.set(merging, "false")
    try:
        ranking.running_total(df.withColumn("one", F.lit(1)), ["state"], ["reserve", "id"], "one", "r").count()
    finally:
        df.sparkSession.conf.unset(merging)
    hot = seen["df"].filter("state = 'CA'").select("_slice").distinct().count()
    assert hot > 1


def test_quantiles_equal_linear_interpolation(skewed):
    pdf, df = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.state: r.q for r in ranking.quantiles(df, ["state"], "reserve", probs, "q").collect()}
    for state, part in pdf.groupby("state"):
        assert np.allclose(got[state], np.quantile(part["reserve"].dropna(), probs))


def test_medians(skewed):
    pdf, df = skewed
    got = {r.state: r.m for r in ranking.medians(df, ["state"], {"m": F.col("reserve")}).collect()}
    for state, part in pdf.dropna(subset=["reserve"]).groupby("state"):
        assert got[state] == pytest.approx(part["reserve"].median())


def test_two_smallest(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 1, "x")], "k string, v int, n string")
    out = ranking.two_smallest(df.select("k", F.struct("v", "n").alias("item")), ["k"], "item").collect()
    assert [(r.k, r._first.n, r._second.n) for r in out] == [("a", "y", "z")]
