"""Bounded groups of 64-bit fingerprints in which every pair within a Hamming radius meets, and components of pairs.

Two fingerprints that differ in at most r bits agree on one of r + 1 disjoint blocks of bits. Each distinct
fingerprint therefore goes to r + 1 tables keyed by (block, value). A key with more than ``SHARD`` fingerprints is
keyed again by the r + 1 blocks of its other bits, by the same argument; a key that is still larger is cut
into shards by hash, and each pair of its shards meets in a tile. No pair is lost and none is emitted for a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerline.session import settle

SHARD = 2048  # fingerprints of one shard, about
BITS = 64
KEY = ["block", "value", "inner", "inner_value"]


def cuts(bits: list[int], parts: int) -> list[list[int]]:
    """``bits`` dealt into ``parts`` runs of near-equal length."""
    return [list(map(int, run)) for run in np.array_split(bits, parts)]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def blocks_of(radius: int) -> list[tuple[list[int], list[list[int]]]]:
    """For each block its bits, and the inner blocks of the bits that it leaves."""
    outer = cuts(list(range(BITS)), radius + 1)
    return [(bits, cuts([b for b in range(BITS) if b not in set(bits)], radius + 1)) for bits in outer]


def tiles(fps: DataFrame, radius: int, shard: int = SHARD) -> DataFrame:
    """(block, inner, members, others) for distinct non-null fingerprints in column ``fp``.

    ``inner`` is -1 where the block alone keys the group. ``others`` is null for a shard that meets itself;
    otherwise each member is to meet each of the others.
    """
    plan = blocks_of(radius)
    first = F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(_mask(bits)).cast("long")).alias("value"))
                      for i, (bits, _) in enumerate(plan)])
    keyed = fps.select("fp", F.inline(first))
    large = keyed.groupBy("block", "value").count().filter(F.col("count") > shard).select("block", "value")
    large = settle(large)
    cold = keyed.join(large, ["block", "value"], "left_anti").select(
        "fp", "block", "value", F.lit(-1).alias("inner"), F.lit(0).cast("long").alias("inner_value"))
    second = F.array(*[F.when(F.col("block") == i, F.array(*[
        F.struct(F.lit(j).alias("inner"), F.col("fp").bitwiseAND(F.lit(_mask(bits)).cast("long")).alias("inner_value"))
        for j, bits in enumerate(inner)])) for i, (_, inner) in enumerate(plan)])
    hot = keyed.join(large, ["block", "value"], "left_semi").select("fp", "block", "value", F.inline(F.flatten(F.filter(second, lambda a: a.isNotNull()))))
    hot = settle(hot)
    parts = hot.groupBy(*KEY).agg(F.ceil(F.count("*") / shard).alias("shards"))
    hot = hot.join(parts, KEY).withColumn("shard", F.pmod(F.xxhash64("fp"), F.col("shards")))
    hot = settle(hot.groupBy(*KEY, "shards", "shard").agg(F.collect_list("fp").alias("members")))
    alone = cold.groupBy(*KEY).agg(F.collect_list("fp").alias("members")).unionByName(hot.select(*KEY, "members"))
    alone = alone.filter(F.size("members") > 1).select("block", "inner", "members", F.lit(None).cast("array<bigint>").alias("others"))
    right = hot.filter("shards > 1").select(*KEY, F.col("shard").alias("other"), F.col("members").alias("others"))
    met = hot.filter("shards > 1").join(right, KEY).filter("shard < other").select("block", "inner", "members", "others")
    return alone.unionByName(met)


def tiles_of(batches, most: int = 1 << 16):
    """Tiles as lists of arrays (members, others), some at a time: about ``most`` fingerprints, or one tile."""
    def arrays(column: pa.ListArray) -> list:
        flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
        missing = column.is_null().to_numpy(zero_copy_only=False)
        return [None if gone else flat[a:b] for a, b, gone in zip(ends[:-1], ends[1:], missing, strict=True)]

    for batch in batches:
        members, others, held = [], [], 0
        for m, o in zip(arrays(batch.column("members")), arrays(batch.column("others")), strict=True):
            members.append(m)
            others.append(o)
            held += len(m) + (0 if o is None else len(o))
            if held >= most:
                yield members, others
                members, others, held = [], [], 0
        if members:
            yield members, others


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give every node of a component the least label in it, for the links (a, b); in place."""
    while True:
        la, lb = labels[a], labels[b]
        low = np.minimum(la, lb)
        if (la == lb).all():
            return
        np.minimum.at(labels, la, low)
        np.minimum.at(labels, lb, low)
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the least node that links reach.

    Alternating large-star and small-star steps: each is a minimum by node (combined in the tasks before the shuffle)
    and a join back, so a node with very many links is never gathered. Ends when a round changes nothing.
    """
    edges = settle(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark[0] == 0 or tuple(mark) == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = tuple(mark)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = settle(large.filter("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            least.select("a", F.col("low").alias("b")))
        edges = settle(small.filter("a <> b").distinct())
