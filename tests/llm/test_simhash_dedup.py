"""SimHash near-duplicates against a plain reading of the definition."""

import random
import re

import numpy as np
import pytest
import xxhash

from hammerline.llm import hamming, simhash_dedup
from tests.llm.conftest import rows_of


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) > 3 else [" ".join(words)] if words else []
    votes = [0] * 64
    for p in parts:
        h = xxhash.xxh64(p.encode(), seed=42).intdigest()
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(parts))


def plain_components(fps, radius=3):
    """Least place reachable for each place."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for a in range(len(fps)):
            for b in range(a):
                if label[a] != label[b] and (fps[a] ^ fps[b]).bit_count() <= radius:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    label = plain_components(fps)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[k] and rows[j][0] is not None]
        out.append((i, f"{fps[k]:016x}", min(ids, default=None)))
    return sorted(out, key=repr)


def test_definition(spark, edge, edge_rows):
    assert rows_of(simhash_dedup.near_duplicates(edge), "doc_id", "fingerprint", "component_id") == expected(edge_rows)


def test_sample(sample):
    rows = [tuple(r) for r in sample.select("doc_id", "text").collect()]
    assert rows_of(simhash_dedup.near_duplicates(sample), "doc_id", "fingerprint", "component_id") == expected(rows)


def test_empty(empty):
    assert simhash_dedup.near_duplicates(empty).count() == 0
    assert simhash_dedup.keep_one(empty).count() == 0


def test_keep_one(edge, edge_rows):
    kept = simhash_dedup.keep_one(edge)
    assert kept.columns == edge.columns
    label = plain_components([plain_fingerprint(t) for _, t in edge_rows])
    groups = [[edge_rows[j][0] for j in range(len(label)) if label[j] == k] for k in set(label)]
    first = [min((i for i in g if i is not None), default=None) for g in groups]
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(first, key=repr)


def clustered(seed, groups, near):
    r = random.Random(seed)
    out = set()
    for _ in range(groups):
        centre = r.getrandbits(64)
        for _ in range(near):
            x = centre
            for _ in range(r.randint(0, 5)):
                x ^= 1 << r.randrange(64)
            out.add(x - (1 << 64) if x >> 63 else x)
    return sorted(out)


@pytest.mark.parametrize("shard", [4, 16, 2048])
def test_components_of_hot_blocks(spark, shard):
    """Small shards send fingerprints through inner blocks and tiles of shards; the classes stay the same."""
    values = clustered(7, 6, 60)
    fps = spark.createDataFrame([(v,) for v in values], "fp bigint")
    links = hamming.tiles(fps, 3, shard).mapInArrow(simhash_dedup._links(3), "a bigint, b bigint")
    roots = dict(map(tuple, hamming.components(links).collect()))
    label = plain_components([v & (2 ** 64 - 1) for v in values])
    assert [roots.get(v, v) for v in values] == [values[k] for k in label]


def test_tree_follows_edges_within_radius():
    values = np.array([v & (2 ** 64 - 1) for v in clustered(3, 5, 40)], dtype=np.uint64)
    forest = simhash_dedup.Forest(values, np.zeros(len(values), dtype=np.int64), 1)
    below = {(i, int(d)): int(forest.child[i, d]) for i in range(len(values)) for d in range(65) if forest.child[i, d] >= 0}
    assert sorted(below.values()) == sorted(set(range(len(values))) - {int(forest.roots[0])})
    for (i, d), child in below.items():
        assert (int(values[i]) ^ int(values[child])).bit_count() == d
    found = {(int(a), int(b)) for q, n in forest.within(values, np.zeros(len(values), dtype=np.int64), 3) for a, b in zip(q, n)}
    assert found == {(a, b) for a in range(len(values)) for b in range(len(values)) if (int(values[a]) ^ int(values[b])).bit_count() <= 3}


def test_long_chain(spark):
    """A chain of 300 links ends in one component."""
    links = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001)], "a bigint, b bigint")
    roots = dict(map(tuple, hamming.components(links).collect()))
    assert {roots[k] for k in range(301)} == {0} and roots[1001] == 1000
