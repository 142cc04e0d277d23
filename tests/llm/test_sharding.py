"""Sharding: laws of the result, the tree against a sorted list, and best fit against a plain search."""

import bisect
import random
import zlib

import pandas as pd
from pyspark.sql import functions as F

from hammerline.llm import sharding
from tests.llm.conftest import rows_of


def ids(got):
    return [None if x is None or x != x else int(x) for x in got.doc_id]


def check(df, rows, n):
    got = pd.DataFrame([r.asDict() for r in sharding.shards(df, n=n).collect()]).astype({"doc_id": object})
    size = lambda t: len((t or "").encode()) + 16
    want = sorted(((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    assert sorted(zip(ids(got), got["size"], got.text_crc32), key=repr) == want
    assert set(got.law) == {"bytes"} and got.grown_shard.isna().all() and got.shard.between(0, n - 1).all()
    assert (got.groupby("text_crc32").shard.nunique() == 1).all()
    for _, s in got.groupby("shard"):
        assert sorted(s.slot) == list(range(len(s)))
    return got.groupby("shard")["size"].sum()


def test_edges(edge, edge_rows, empty):
    check(edge, edge_rows, 3)
    assert sharding.shards(empty).count() == 0


def test_sample(spark, sample):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sums = check(docs, [tuple(r) for r in docs.select("doc_id", "text").collect()], 40)
    assert len(sums) == 40 and sums.max() <= 1.02 * sums.mean() + 1


def test_tree_is_a_balanced_sorted_set():
    r, tree, held = random.Random(2), None, []
    for _ in range(3000):
        if held and r.random() < 0.45:
            key = r.choice(held)
            tree = sharding.delete(tree, key)
            held.remove(key)
        else:
            key = (r.randrange(500), r.randrange(10 ** 9))
            tree = sharding.insert(tree, key)
            bisect.insort(held, key)
        probe = (r.randrange(520), -1)
        at = bisect.bisect_left(held, probe)
        assert sharding.ceiling(tree, probe) == (held[at] if at < len(held) else None)

    def height(t):
        return 0 if t is None else 1 + max(height(t.left), height(t.right))
    assert height(tree) <= 2 * len(held).bit_length() + 1


def test_best_fit_takes_the_tightest():
    r = random.Random(4)
    sizes = sorted((r.randrange(1, 60) for _ in range(80)), reverse=True)
    bins, want = [100] * 60, []
    for s in sizes:
        room = min((b, k) for k, b in enumerate(bins) if b >= s)
        bins[room[1]] -= s
        want.append(room[1])
    assert sharding.best_fit(sizes, 100, 60) == want
    assert sharding.best_fit([101], 100, 60) is None


def test_groups_are_never_divided(spark):
    rows = [(k, "hot text " * 50) for k in range(400)] + [(1000 + k, f"text {k} " * (k % 30)) for k in range(600)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), rows, 7)
    assert rows_of(sharding.shards(spark.createDataFrame(rows[:1], "doc_id bigint, text string")), "shard", "slot") == [(0, 0)]


def balanced(sums, groups, n):
    """All shards in use where there are groups for them; those that no oversize group has to itself lie close together."""
    assert len(sums) == min(n, len(groups))
    loads, sizes = sorted(sums, reverse=True), sorted(groups, reverse=True)
    own = 0
    while own < min(len(sizes), n - 1) and sizes[own] * (n - own) >= sum(sizes[own:]):
        own += 1
    assert loads[:own] == sizes[:own] or sorted(loads)[-own:] == sorted(sizes[:own])
    rest = loads[own:]
    if len(sizes) - own >= 4 * (n - own):
        assert max(rest) <= 1.02 * sum(rest) / len(rest) + sizes[min(len(sizes) - 1, own + 3 * (n - own))]


def test_a_large_group_leaves_no_shard_empty(spark):
    for texts in (["x" * 984] + [f"{k:04d}" for k in range(400)], ["hot " * 30] * 300 + [f"text {k} " * (1 + k % 9) for k in range(900)]):
        rows = list(enumerate(texts))
        sums = check(spark.createDataFrame(rows, "doc_id bigint, text string"), rows, 40)
        groups = {}
        for t in texts:
            groups[t] = groups.get(t, 0) + len(t) + 16
        balanced(sums.tolist(), list(groups.values()), 40)


def test_parcels_are_as_even(spark):
    rows = [(k, f"text {k} " * (1 + k % 40)) for k in range(30_000)]
    got = sharding.shards(spark.createDataFrame(rows, "doc_id bigint, text string"), exact=0).groupBy("shard").sum("size").toPandas()["sum(size)"]
    assert len(got) == 40 and got.max() <= 1.02 * got.mean()


def test_small_and_large_inputs_go_by_one_rule(spark):
    """A table of few groups is gathered into parcels as one of many is."""
    texts = [f"text {k} " * (1 + k % 40) for k in range(12_000)]
    few = list(enumerate(texts))
    gathered = sharding.shards(spark.createDataFrame(few, "doc_id bigint, text string"))
    # groups of one parcel, all far under the share of a shard that makes an item of its own, stay together
    least = sum(len(t) + 16 for t in texts) / (sharding.SHARDS * sharding.FINE)
    parcel = F.pmod(F.xxhash64(F.sha2(F.encode("text", "utf-8"), 256)), F.lit(sharding.SHARDS * sharding.PARCELS))
    small = gathered.filter(F.col("size") <= least).select("doc_id", "shard").join(
        spark.createDataFrame(few, "doc_id bigint, text string").select("doc_id", parcel.alias("parcel")), "doc_id")
    spread = small.groupBy("parcel").agg(F.count("*").alias("n"), F.count_distinct("shard").alias("shards")).toPandas()
    assert (spread.n > 1).sum() > 100 and (spread.shards == 1).all()


def test_assign_against_bounds():
    r = random.Random(8)
    for _ in range(150):
        bins = r.randrange(1, 12)
        sizes = [r.choice([1, 2, 5, 50, r.randrange(1, 400)]) for _ in range(r.randrange(0, 60))]
        found = sharding.assign(list(enumerate(sizes)), bins)
        loads = [0] * bins
        for k, b in found.items():
            loads[b] += sizes[k]
        assert len(found) == len(sizes) and sum(x > 0 for x in loads) == min(bins, len(sizes))
        # the emptiest bin could take no item of the fullest one without becoming as full
        if sizes and sum(1 for b in found.values() if b == loads.index(max(loads))) > 1:
            assert min(loads) + min(sizes[k] for k, b in found.items() if b == loads.index(max(loads))) >= max(loads)


def test_sample_of_the_smallest_tables(sample):
    rows = [tuple(r) for r in sample.select("doc_id", "text").collect()]
    sums = check(sample, rows, 40)
    assert len(sums) == 40
