"""Sharding by best-fit decreasing: indivisible groups of equal texts enter the tightest shard that still holds them.

Groups over 1 / ``FINE`` of a shard are packed one by one (there are at most ``FINE`` x shards of them); smaller ones are first gathered
by hash into ``PARCELS`` parcels a shard, each an item in its own right. That is so for every input, small or large. What reaches
the driver is bounded by those parameters, whatever the corpus holds, and no group is ever divided. A parcel holds about 1 / ``PARCELS`` of
a shard, so gathering costs no more than some such parts of balance. Shards are as even as the groups allow: a group larger than
a fair share has a shard of its own, and the other shards share the rest evenly.
"""

from __future__ import annotations

import bisect
import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerline.llm.common import DOC_ID, rank_within
from hammerline.session import settle

SHARDS = 40
FINE = 200  # a group over this part of a shard is an item of its own
PARCELS = 200  # parcels of smaller groups for each shard
OVERHEAD = 16


@dataclass
class Node:
    """A node of an AA tree: a binary search tree that skews and splits keep balanced."""

    key: tuple[int, int]
    level: int = 1
    left: Node | None = None
    right: Node | None = None


def _skew(t: Node) -> Node:
    if t.left and t.left.level == t.level:
        low = t.left
        t.left, low.right = low.right, t
        return low
    return t


def _split(t: Node) -> Node:
    if t.right and t.right.right and t.right.right.level == t.level:
        high = t.right
        t.right, high.left = high.left, t
        high.level += 1
        return high
    return t


def insert(t: Node | None, key: tuple[int, int]) -> Node:
    if t is None:
        return Node(key)
    if key < t.key:
        t.left = insert(t.left, key)
    else:
        t.right = insert(t.right, key)
    return _split(_skew(t))


def delete(t: Node | None, key: tuple[int, int]) -> Node | None:
    if t is None:
        return None
    if key < t.key:
        t.left = delete(t.left, key)
    elif key > t.key:
        t.right = delete(t.right, key)
    elif t.left is None or t.right is None:
        return t.left or t.right
    else:
        nearest = t.right
        while nearest.left:
            nearest = nearest.left
        t.key, t.right = nearest.key, delete(t.right, nearest.key)
    low = min(t.left.level if t.left else 0, t.right.level if t.right else 0) + 1
    if low < t.level:
        t.level = low
        if t.right and t.right.level > low:
            t.right.level = low
    t = _skew(t)
    if t.right:
        t.right = _skew(t.right)
        if t.right.right:
            t.right.right = _skew(t.right.right)
    t = _split(t)
    if t.right:
        t.right = _split(t.right)
    return t


def ceiling(t: Node | None, key: tuple[int, int]) -> tuple[int, int] | None:
    """The least key of the tree that is at least ``key``."""
    best = None
    while t:
        if t.key >= key:
            best, t = t.key, t.left
        else:
            t = t.right
    return best


def best_fit(sizes: list[int], capacity: int, bins: int) -> list[int] | None:
    """Bin of each of ``sizes`` (descending), all of which fit in ``bins`` of ``capacity``; None if they don't fit."""
    tree = None
    for b in range(bins):
        tree = insert(tree, (capacity, b))
    out = []
    for size in sizes:
        room = ceiling(tree, (size, -1))
        if room is None:
            return None
        out.append(room[1])
        tree = insert(delete(tree, room), (room[0] - size, room[1]))
    return out


def _packed(sizes: list[int], bins: int) -> list[int]:
    """Bin of each of ``sizes`` (descending, none above the mean), at the least capacity found: from the mean up, to a 2,000th of it."""
    mean = -(-sum(sizes) // bins)
    low = max([mean, *sizes[:1]])
    step = max(1, mean // 2000)
    found, high = best_fit(sizes, low, bins), low
    while found is None:  # grow until it fits, then halve the last step
        low, high = high, high + step
        step *= 2
        found = best_fit(sizes, high, bins)
    while high - low > max(1, mean // 2000):
        middle = (low + high) // 2
        if (better := best_fit(sizes, middle, bins)) is None:
            low = middle
        else:
            found, high = better, middle
    return found


def _level(sizes: list[int], found: list[int], bins: int) -> list[int]:
    """Moves the smallest item of the fullest bin to the emptiest one as long as that brings the two nearer."""
    loads, held = [0] * bins, [[] for _ in range(bins)]
    for k, b in enumerate(found):
        loads[b] += sizes[k]
        held[b].append(k)  # descending sizes: the smallest is the last
    found = list(found)
    fullest, emptiest = [(-load, b) for b, load in enumerate(loads)], [(load, b) for b, load in enumerate(loads)]
    heapq.heapify(fullest)
    heapq.heapify(emptiest)
    while True:
        while -fullest[0][0] != loads[fullest[0][1]]:
            heapq.heappop(fullest)
        while emptiest[0][0] != loads[emptiest[0][1]]:
            heapq.heappop(emptiest)
        high, low = fullest[0][1], emptiest[0][1]
        if not held[high] or loads[low] + sizes[held[high][-1]] >= loads[high]:
            return found
        k = held[high].pop()
        found[k] = low
        bisect.insort(held[low], k)
        loads[high] -= sizes[k]
        loads[low] += sizes[k]
        for b in (high, low):
            heapq.heappush(fullest, (-loads[b], b))
            heapq.heappush(emptiest, (loads[b], b))


def assign(items: list[tuple], bins: int) -> dict:
    """Bin of each (key, size).

    An item as large as the mean of what is left, or larger, has a bin of its own; that lowers the mean of the others, which are
    packed best-fit decreasing into a capacity near it and then levelled, so that no bin stays empty while another one has two items.
    """
    items = sorted(items, key=lambda x: (-x[1], x[0]))
    sizes = [s for _, s in items]
    left, own = sum(sizes), 0
    while own < min(len(sizes), bins - 1) and sizes[own] * (bins - own) >= left:
        left -= sizes[own]
        own += 1
    rest = sizes[own:]
    found = [*range(own), *(own + b for b in _level(rest, _packed(rest, bins - own), bins - own))]
    return {key: b for (key, _), b in zip(items, found, strict=True)}


def shards(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text", n: int = SHARDS, exact: bool = False) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) under the law ``bytes``; rows with equal texts share a shard.

    Size is the UTF-8 bytes of the text plus 16. Null texts count as empty texts and belong with them. Slots run from 0 in every shard. Only sizes and digests of texts move, however long they are.
    Repeated rows and null ids are rows like any other; an empty table gives an empty result. ``exact`` packs every group one by one and gathers
    none, which brings all groups to the driver: the caller's choice, never the input's.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = settle(df.select(F.col(id_col).alias(DOC_ID), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                            F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("equal")))
    groups = settle(rows.groupBy("equal").agg(F.sum("size").alias("size")))
    total = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    least, parcels = 0 if exact else total / (n * FINE), n * PARCELS
    parcel = F.pmod(F.xxhash64("equal"), F.lit(parcels)).cast("int")
    large = [(r["equal"], r["size"]) for r in groups.filter(F.col("size") > least).collect()]
    small = [(r["parcel"], r["size"]) for r in groups.filter(F.col("size") <= least).groupBy(parcel.alias("parcel")).agg(F.sum("size").alias("size")).collect()]
    placed = assign([(("group", k), s) for k, s in large] + [(("parcel", str(k)), s) for k, s in small], n)
    by_group = spark.createDataFrame([(k, b) for (kind, k), b in placed.items() if kind == "group"], "equal string, group_shard int")
    by_parcel = spark.createDataFrame([(int(k), b) for (kind, k), b in placed.items() if kind == "parcel"], "parcel int, parcel_shard int")
    # unless ``exact``, the tables have at most n * FINE and n * PARCELS rows
    dealt = rows.withColumn("parcel", parcel).join(F.broadcast(by_group), "equal", "left").join(F.broadcast(by_parcel), "parcel", "left")
    dealt = dealt.select(DOC_ID, "size", "text_crc32", F.coalesce("group_shard", "parcel_shard").alias("shard"))
    return rank_within(dealt, "shard", [DOC_ID, "text_crc32", "size"], "slot").select(
        DOC_ID, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
