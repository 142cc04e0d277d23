"""Quality rules against plain counting."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from hammerline.llm import repetition
from tests.llm.conftest import rows_of


def plain_repeats(words, least):
    n, out = len(words), []
    for i in range(n):
        longest = 0
        for j in range(n):
            if i != j:
                k = 0
                while max(i, j) + k < n and words[i + k] == words[j + k]:
                    k += 1
                longest = max(longest, k)
        out.append(longest if longest >= least else 0)
    return out


@settings(max_examples=120, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=40), min_size=1, max_size=4), st.sampled_from([1, 2, 3, 5, 8]))
def test_suffix_array(texts, least):
    sizes = [len(t) for t in texts]
    codes, stops = np.array([c for t in texts for c in t], dtype=np.int64), np.cumsum(sizes)
    got = repetition.longest_repeats(codes, np.repeat(stops, sizes), least)
    assert got.tolist() == [x for t in texts for x in plain_repeats(t, least)]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k:k + 8]), []).append(k)
    hit = {k + d for at in windows.values() if len(at) > 1 for k in at for d in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base(edge, edge_rows):
    got = repetition.quality_rules(edge)
    assert rows_of(got, *COLUMNS) == sorted(((i, *plain(t)) for i, t in edge_rows), key=repr)
    assert got.filter("base_failed AND kept").count() == 0


def test_sample(sample):
    rows = [tuple(r) for r in sample.select("doc_id", "text").collect()]
    assert rows_of(repetition.quality_rules(sample), *COLUMNS) == sorted(((i, *plain(t)) for i, t in rows), key=repr)


def test_limits():
    unique = [f"u{k}" for k in range(1000)]
    passage = [f"p{k}" for k in range(210)]
    text = " ".join(passage + unique + passage).encode()
    row = dict(zip([f.split()[0] for f in repetition.Rules.FIELDS.split(", ")], (c[0] for c in repetition.Rules()([text]))))
    assert row["longest_repeat"] == 210 and not row["base_failed"] and not row["kept"]
    assert repetition.Rules(longest_repeat=300)([text])[6] == [True]
    assert repetition.Rules(longest_repeat=300, most_covered=0.2)([text])[6] == [False]
    said = " ".join(w for k, w in enumerate(("This", "thhant", "ouen", "oredat", "nterti", "erea")) for _ in range(6 + k % 3)).encode()
    assert repetition.Rules()([said])[5:8] == [[False], [False], [1.0]]


def plain_method(text):
    """Covered fraction, longest repeat and verdict from every pair of places."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    found = plain_repeats(words, repetition.FEWEST)
    inside = {k + d for k, length in enumerate(found) for d in range(length)}
    size = [len(w.encode()) for w in words]
    fraction = sum(size[k] for k in inside) / sum(size) if words else 0.0
    kept = not plain(text)[-1] and fraction <= repetition.MOST_COVERED and max(found, default=0) <= repetition.LONGEST_REPEAT
    return fraction, max(found, default=0), kept


def test_method_against_brute_force():
    import random
    r = random.Random(7)
    texts = [" ".join(r.choice(["aa", "b", "ccc", "d", "éé", "f" * 9, *(f"w{r.randrange(60)}" for _ in range(r.randrange(12)))]) for _ in range(r.randrange(0, 120))) for _ in range(150)]
    texts += [" ".join(["x"] * 45), "", " ".join(f"u{k}" for k in range(60))]
    got = repetition.Rules()([t.encode() for t in texts])
    want = [plain_method(t) for t in texts]
    assert got[7] == [float(f) for f, _, _ in want] or all(abs(a - f) < 1e-12 for a, (f, _, _) in zip(got[7], want, strict=True))
    assert got[8] == [n for _, n, _ in want] and got[6] == [k for _, _, k in want]
    assert 10 < sum(got[6]) < 140


def test_keep(edge, empty):
    kept = repetition.keep(edge)
    ids = repetition.quality_rules(edge).filter("kept").count()
    assert kept.columns == edge.columns and kept.count() == ids
    assert repetition.keep(empty).count() == 0 and repetition.quality_rules(empty).count() == 0
