"""Line dedup against brute force over whole texts."""

import random
from collections import defaultdict

import numpy as np
import pytest

from hammerline.llm import line_dedup

BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least_chars=40, least_docs=5):
    holders = defaultdict(list)
    for n, (i, text) in enumerate(rows):
        for key in {line.strip(BLANK).translate(LOWER) for line in (text or "").split("\n")}:
            if len(key) >= least_chars:
                holders[key].append((n, i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keep = []
        for line in lines:
            held = holders.get(line.strip(BLANK).translate(LOWER), [])
            best = max((h for _, h in held if h is not None), default=None)
            if len(held) < least_docs or i == best:
                keep.append(line)
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=repr)


def run(df, **how):
    return sorted((tuple(r) for r in line_dedup.dedup_lines(df, **how).select("doc_id", "n_lines", "n_dropped", "text").collect()), key=repr)


def corpus(n=300, seed=5):
    rng = random.Random(seed)
    shared = ["  The Passage number %d, straße %s that many hold\r" % (k, "é" * (k % 9 + 1)) for k in range(30)]
    edges = ["x" * 39, "y" * 40, "é" * 39, "ü" * 40, "", " \t ", "\x1c" + "z" * 40]
    rows = []
    for i in range(n):
        lines = [rng.choice([rng.choice(shared), rng.choice(shared).upper(), rng.choice(edges), "own line %d %s" % (rng.random() * 1e9, "w" * 40)]) for _ in range(rng.randrange(8))]
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("bits", [2**28, 2**20, 1])
def test_matches_brute_force_at_every_filter_size(spark, bits):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    got = run(df, most_bits=bits)
    assert got == brute(rows) and sum(r[2] for r in got) > 100


def test_edges(spark, edge, edge_rows, empty, sample):
    assert run(edge) == brute(edge_rows)
    assert run(empty) == []
    assert run(sample) == brute([(r.doc_id, r.text) for r in sample.collect()])


def test_hot_line(spark):
    """One line in every document, among them rows of the same id and without one."""
    rows = [(k % 900, f"{'All documents hold this very same line, ' * 2}\nown {k}") for k in range(2000)] + [(None, "All documents hold this very same line, " * 2)]
    got = run(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got == brute(rows) and sum(r[2] == 0 for r in got) == 2


def test_filters_name_every_repeat():
    hashes = np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64)
    f = line_dedup.Filter(2)
    f.add(hashes)
    assert f.has(hashes).all()
    others = np.random.default_rng(2).integers(0, 2**63, 20_000).astype(np.uint64)
    assert f.has(others).mean() < 0.01
