"""Hard negatives against exact integer brute force; bounds against true scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hammerline.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, positives=5, negatives=10, low=30, high=90):
    live = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) or not math.isfinite(256 * x) for x in v):
            continue
        live.append((i, [math.floor(256 * x) for x in v], label))
    order = lambda s, i: (-s, i is None, i or 0)
    out = []
    for n, (a, q, label) in enumerate(live):
        if a is None or a % 100:
            continue
        scored = [(sum(x * y for x, y in zip(q, p)), i, other == label) for m, (i, p, other) in enumerate(live) if m != n]
        own = sorted((order(s, i), s, i) for s, i, same in scored if same)[:positives]
        for _, ps, p in own:
            found = sorted(order(s, i) for s, i, same in scored if not same and low * ps <= 100 * s <= high * ps)[:negatives]
            out += [(a, p, rank, None if none else i, ps, -s) for rank, (s, none, i) in enumerate(found, 1)]
    return sorted(out, key=repr)


def run(spark, rows, **how):
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted((tuple(r) for r in hn.mine(df, F.col("vec_id") % 100 == 0, F.col("label"), **how).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=repr)


def clustered(n, size, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    v = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, size))
    return [(int(i), [float(x) for x in row], int(rng.integers(0, 4))) for i, row in enumerate(v)]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed, monkeypatch):
    rows = clustered(1200, 12, seed)
    got = run(spark, rows)
    assert got == brute(rows) and len(got) > 100


def test_odd_rows(spark):
    """Nulls, non-finite components, zero and short vectors, repeated rows and ids, rows without id, great components."""
    rows = clustered(300, 4, 3) + [
        (None, [1.0, 2.0, 0.5, 0.1], 1), (400, [None, 1.0, 1.0, 1.0], 1), (401, [float("nan"), 1.0, 1.0, 1.0], 1), (500, [float("inf"), 0.0, 0.0, 0.0], 2),
        (600, [0.0] * 4, 1), (601, [0.0] * 4, 2), (602, [1.0, 2.0], 3), (700, None, 1), (800, [1.0, 1.0, 1.0, 1.0], None), (900, [], 0),
        (100, [0.5, 0.25, 1.0, 2.0], 1), (100, [0.5, 0.25, 1.0, 2.0], 1), (101, [0.5, 0.25, 1.0, 2.0], 2), (101, [0.5, 0.25, 1.0, 2.0], 2), (1000, [1e308, 1.0, 1.0, 1.0], 1),
        (1100, [-1.0, -2.0, 0.0, 0.0], 1), (1200, [3e6, 2e6, 1.0, 5e5], 1), (1201, [2e6, 2e6, 1.0, 5e5], 1), (1202, [2e6, 1e6, 3.0, 5e5], 2)]
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0], 1)]) == []
    clash = "vec_id bigint, embedding array<double>, label int, vector string, `row` string, near string, `group` string, tag string, positives string, anchor string"
    rows = clustered(150, 3, 4)
    assert run(spark, spark.createDataFrame([(*r, *["clash"] * 7) for r in rows], clash)) == brute(rows)


def test_hot_vector(spark):
    """A third of the rows share one vector, so scores tie by the hundred."""
    rows = [(i, [1.0, 0.5, 0.25] if i % 3 == 0 else v, label) for i, v, label in clustered(900, 3, 6)]
    assert run(spark, rows) == brute(rows)


def test_bounds_hold():
    rng = np.random.default_rng(9)
    q = np.floor(256 * rng.normal(size=(400, 5)) * rng.choice([1e-3, 1, 1e4], size=(400, 1)))
    q[:3], q[3:6] = 0, q[6:9]
    u, norm = hn.unit(q)
    found = hn.angles(u, u[20:26])
    least, most = hn.pair_bounds(norm, found, norm, found)
    true = q @ q.T
    assert (least <= true).all() and (true <= most).all() and (most < norm[:, None] * norm[None, :] * 0.9).mean() > 0.2
    low, high = hn.block_bounds(norm, found, norm[50:90], found[50:90])
    assert (low <= true[:, 50:90].min(axis=1)).all() and (high >= true[:, 50:90].max(axis=1)).all()
