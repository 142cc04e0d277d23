"""SimHash near-deduplication with sharded BK-trees.

A fingerprint bit is 1 if it is set in more than half of the hashes of a text's shingles. Equal fingerprints are
folded first. The distinct ones are dealt into bounded shards in which every pair within the radius meets
(hamming.py). A shard's BK-tree keys the children of a node by their integer distance to it; a tree goes as one row
to each task that queries it (to the shards of the same hot key, or to its own members), and a query follows
only the edges within the radius. Found links are reduced to a forest in the task, and components of the forests are found by
rounds of joins, so neither links nor fingerprints meet on the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerline.llm import hamming
from hammerline.llm.common import DOC_ID, fresh, map_texts, narrow
from hammerline.session import settle

SEED = 42
SHINGLE = 3
RADIUS = 3
QUERIES = 256  # queries that walk a tree side by side


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles of a UTF-8 text; 0 if it has no word."""
    words = text.lower().split()  # of bytes: only A-Z and the six ASCII spaces
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, SEED) for p in parts), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(df: DataFrame, shingle: int = SHINGLE, drop_text: bool = True) -> DataFrame:
    """``df``, whose last column is a binary text, with the text's fingerprint in place of (or after) it."""
    return map_texts(df, "fp bigint", lambda: lambda texts: [[fingerprint(t, shingle) for t in texts]], drop_text)


class Forest:
    """BK-trees over several shards at once, as arrays: node i's child at distance d is child[i, d], or -1."""

    def __init__(self, values: np.ndarray, tree: np.ndarray, n_trees: int):
        self.values = values
        self.child = np.full((len(values), hamming.BITS + 1), -1, dtype=np.int32)
        self.roots = np.full(n_trees, -1, dtype=np.int64)
        items = np.arange(len(values))
        firsts, at = np.unique(tree, return_index=True)
        self.roots[firsts] = items[at]
        rest = np.delete(items, at)
        node = self.roots[tree[rest]]
        while len(rest):  # every item goes down one edge; the first to come to a free edge becomes its child
            d = np.bitwise_count(values[rest] ^ values[node])
            free = self.child[node, d] < 0
            edge = node[free] * (hamming.BITS + 1) + d[free]
            _, at = np.unique(edge, return_index=True)
            placed = rest[free][at]
            self.child.reshape(-1)[edge[at]] = placed
            node = self.child[node, d].astype(np.int64)
            stay = node != rest
            rest, node = rest[stay], node[stay]

    def within(self, queries: np.ndarray, tree: np.ndarray, radius: int):
        """Pairs (query, node) of at most ``radius`` bits, level by level."""
        q = np.arange(len(queries))
        node = self.roots[tree]
        while len(q):
            d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
            near = d <= radius
            yield q[near], node[near]
            reach = d[:, None] + np.arange(-radius, radius + 1)
            below = np.where((reach >= 0) & (reach <= hamming.BITS), self.child[node[:, None], np.clip(reach, 0, hamming.BITS)], -1)
            at, edge = np.nonzero(below >= 0)
            q, node = q[at], below[at, edge].astype(np.int64)


def _forest(members: list, others: list, radius: int):
    """Nodes of the tiles and, for each node, the place of the one that stands for all it is linked with."""
    sizes = np.array([len(m) for m in members])
    own = np.cumsum([0, *sizes[:-1]])
    values = np.concatenate(members)
    forest = Forest(values.view(np.uint64), np.repeat(np.arange(len(members)), sizes), len(members))
    # queries of a shard on itself are its own nodes; those of another shard come after all members
    asked, places, of, end = [], [], [], len(values)
    for k, (m, o) in enumerate(zip(members, others, strict=True)):
        start = own[k] if o is None else end
        end += 0 if o is None else len(o)
        asked.append(m if o is None else o)
        places.append(np.arange(start, start + len(asked[-1])))
        of.append(np.full(len(asked[-1]), k))
    queries, places, of = map(np.concatenate, (asked, places, of))
    nodes = np.empty(end, dtype=np.int64)
    nodes[places], nodes[:len(values)] = queries, values
    labels = np.arange(end)
    step = QUERIES if sizes.max() > QUERIES else 1 << 14
    for at in range(0, len(queries), step):
        for q, node in forest.within(queries[at:at + step].view(np.uint64), of[at:at + step], radius):
            hamming.merge(labels, places[at:at + step][q], node)
    return nodes, labels


def _links(radius: int):
    """Tiles to forests: (a, b) joins a fingerprint to one that stands for all it reaches in its tile."""
    def run(batches):
        for members, others in hamming.tiles_of(batches):
            nodes, labels = _forest(members, others, radius)
            moved = np.flatnonzero(labels != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[labels[moved]])], names=["a", "b"])
    return run


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): enough pairs within ``radius`` bits to join every two distinct fingerprints that a chain of such pairs joins."""
    return hamming.tiles(fps, radius).mapInArrow(_links(radius), "a bigint, b bigint")


def classes(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) for rows (doc_id, fp): the least doc_id that links of at most ``radius`` bits reach.

    Null ids never are the least; a component without any other id has a null component_id.
    """
    distinct = settle(fps.groupBy("fp").agg(F.min(DOC_ID).alias("least")))
    roots = settle(hamming.components(links(distinct.select("fp"), radius)))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row for each row of ``df``.

    Nulls and texts without a word have fingerprint 0, linked like any other; fewer words than a shingle are one shingle.
    Repeated rows repeat their result; an empty table gives an empty result; other columns are ignored.
    """
    fps = settle(with_fingerprint(narrow(df, id_col, text_col, binary=True), shingle))
    found = fps.join(classes(fps, radius), "fp")
    return found.select(DOC_ID, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``df`` with one row of each near-duplicate component: that of the least doc_id, null ids last, then any one.

    Rows are numbered in a settled copy, so that repeated rows, which nothing else tells apart, leave one behind.
    Rows meet those numbers in a merge join at every size: numbers are even, and disk use is the same share of small and large tables.
    """
    row, text, fp = fresh(df, "row"), fresh(df, "bytes"), fresh(df, "fp")
    numbered = df.withColumn(row, F.monotonically_increasing_id()).withColumn(text, F.col(text_col).cast("binary"))
    copy = settle(map_texts(numbered, f"`{fp}` bigint", lambda: lambda texts: [[fingerprint(t, shingle) for t in texts]]))
    fps = copy.select(F.col(id_col).alias(DOC_ID), F.col(fp).alias("fp"), F.col(row).alias("row"))
    first = fps.join(classes(fps, radius), "fp").groupBy("root").agg(
        F.min(F.struct(F.col(DOC_ID).isNull(), DOC_ID, "row")).alias("first"))
    stay = settle(first.select(F.col("first.row").alias(row)))
    return copy.join(stay.hint("merge"), row, "left_semi").select(*df.columns)
