"""Sums are the same for every order and partitioning of rows, and right to the last digits."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from hammerline.functions import exact
from hammerline.operators import bidders, models


def values(seed=1, n=3000):
    r = random.Random(seed)
    return [r.choice([-1, 1]) * r.random() * 10 ** r.randrange(-9, 12) for _ in range(n)] + [0.1] * 500 + [1e17, -1e17, 0.0]


def test_sums_are_correctly_rounded(spark):
    rows = [(k % 5, v) for k, v in enumerate(values())] + [(7, None), (8, 1e300), (8, 2.0), (9, -3.5), (9, None)]
    got = {r["g"]: r for r in spark.createDataFrame(rows, "g int, v double").groupBy("g").agg(
        exact.exact_sum(F.col("v")).alias("s"), exact.exact_avg(F.col("v")).alias("m")).collect()}
    for g in range(5):
        mine = [v for k, v in rows if k == g]
        assert got[g]["s"] == pytest.approx(math.fsum(mine), rel=1e-15, abs=1e-18 * len(mine))
        assert got[g]["m"] == got[g]["s"] / len(mine)
    assert got[7]["s"] is None and got[7]["m"] is None and got[8]["s"] == 1e300 and got[9]["s"] == -3.5


@pytest.mark.parametrize("sign", [1.0, -1.0])
def test_cancelling_sums(spark, sign):
    rows = [(sign * v,) for v in (2.0**60, 1.0, -(2.0**60), 2.0**-60, 1e-3, -1e-3)]
    got = spark.createDataFrame(rows, "v double").agg(exact.exact_sum(F.col("v"))).first()[0]
    assert got == float(sum(Fraction(v) for v, in rows))


def test_same_bits_on_every_partitioning(spark):
    rows = [(f"e{k % 11}", k % 40, v, abs(v) + 1, 0.3 * abs(v) + 1) for k, v in enumerate(values(2))]
    base = spark.createDataFrame(rows, "bidderemail string, PropertyId long, MaxBid double, Reserve double, StartingBid double").withColumns({
        "WinningBid": F.col("MaxBid") - 0.1, "Winner": F.lit(1), "beds": F.lit(2), "baths": F.col("Reserve") / 7, "lotsize": F.col("Reserve") / 3,
        "yearbuilt": F.lit(1990), "BPO": F.col("Reserve") * 1.1})
    seen = set()
    for parts in (1, 4, 16):
        dealt = base.repartition(parts, F.xxhash64("MaxBid", F.lit(parts)))
        seen.add(tuple(sorted(map(tuple, bidders.bidder_budget(dealt).collect()))))
    assert len(seen) == 1


def test_moments_and_fits_have_the_same_bits(spark):
    r = np.random.default_rng(3)
    rows = [(f"S{k % 3}", k, 1, 1, *map(float, r.normal(size=3) * (1, 1e5, 30) + (0, 2e5, 1950)), float(r.random() < 0.4), float(r.normal() * 1e5)) for k in range(1500)]
    base = spark.createDataFrame(rows, "PropertyState string, PropertyId long, AuctionId long, VenueId long, a double, b double, c double, y double, price double")
    sums, fits, logits = set(), set(), set()
    for parts in (1, 4, 16):
        df = base.repartition(parts, F.xxhash64("PropertyId", F.lit(parts)))
        standard, _ = models.design(df, ["a", "b", "c"], ["y", "price"])
        cells = models.moments(standard, ["a", "b", "c"], ["y", "price"])
        sums.add(tuple(sorted(map(tuple, cells.collect()))))
        fits.add(tuple(sorted(map(tuple, models.ols_per_state(df, ["a", "b", "c"], "price").collect()))))
        logits.add(tuple(sorted(map(tuple, models.ridge_logistic(df, ["a", "b", "c"], ["y"]).collect()))))
    assert len(sums) == len(fits) == 1
    one, *others = logits  # its sums are exact, too; the solver's last digits may still move
    for other in others:
        assert [r[:3] for r in one] == [r[:3] for r in other]
        assert [r[3] for r in one] == pytest.approx([r[3] for r in other], rel=1e-7)
    pdf = standard.toPandas()
    part = pdf[(pdf.PropertyState == "S1") & (pdf._fold == 4)]
    x = np.column_stack([np.ones(len(part)), part[["a", "b", "c", "y_y", "y_price"]]])
    got = {(c.i, c.j): c.v for c in cells.filter("PropertyState = 'S1' AND _fold = 4").collect()}
    for (i, j), v in got.items():
        assert v == pytest.approx(math.fsum(x[:, i] * x[:, j]), rel=1e-9, abs=1e-7 * np.abs(x[:, i]).max() * np.abs(x[:, j]).max())


def test_one_sum_in_other_parts_is_the_same_double(spark):
    r = np.random.default_rng(7)
    rows = []
    for k, (high, middle, low) in enumerate(zip(r.integers(-2**20, 2**20, 300), r.integers(-2**39, 2**39, 300), r.integers(-2**39, 2**39, 300), strict=True)):
        for more, less in ((0, 0), (1, 0), (0, 1), (-3, 2), (5, -7)):
            rows.append((k, int(high) + more, int(middle) - more * 2**40 + less, int(low) - less * 2**40))
    df = spark.createDataFrame(rows, "k int, high long, middle long, low long")
    got = df.groupBy("k").agg(F.count_distinct(exact.joined(F.col("high"), F.col("middle"), F.col("low"))).alias("n"))
    assert got.filter("n > 1").count() == 0


def test_gram_against_fractions():
    r = np.random.default_rng(5)
    a, b = r.normal(size=(9000, 3)) * (1, 1e4, 1e-4), r.normal(size=(9000, 2)) * (1e3, 1)
    g = exact.Gram()
    g.add(a[:5000], b[:5000])
    g.add(a[5000:], b[5000:])
    high, middle, low = g.parts()
    assert np.allclose(high * 2.0**28 + middle * 2.0**-12 + low * 2.0**-52, a.T @ b, rtol=1e-9, atol=1e-6)
    other = exact.Gram()
    for at in range(8999, -1, -1):
        if at % 1000 == 0:
            other.add(a[at:at + 1000], b[at:at + 1000])
    assert all((x == y).all() for x, y in zip(g.parts(), other.parts(), strict=True))
