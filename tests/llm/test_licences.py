"""Licence scans against plain phrase counting, and the expression parser."""

import re

import pytest

from hammerline.llm import licences
from tests.llm.conftest import rows_of


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        at = [k for k in range(len(words)) if words[k:k + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
TEXTS = [
    "MIT License mit license MIT  LICENSE", "the general public license, the mit license; apache-license", "mit licenses, submit license",
    "Licensed under the Apache License, Version 2.0", "general public general public license", "mit license " * 3000, "ümit license MIT Licenseü",
]


def test_base(spark, edge, edge_rows, empty):
    assert rows_of(licences.licence_scan(edge), *COLUMNS) == sorted(((i, *plain(t)) for i, t in edge_rows), key=repr)
    more = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    assert rows_of(licences.licence_scan(more), *COLUMNS) == sorted(((i, *plain(t)) for i, t in enumerate(TEXTS)), key=repr)
    assert licences.licence_scan(empty).count() == 0


def test_sample(sample):
    rows = [tuple(r) for r in sample.select("doc_id", "text").collect()]
    assert rows_of(licences.licence_scan(sample), *COLUMNS) == sorted(((i, *plain(t)) for i, t in rows), key=repr)


@pytest.mark.parametrize("expression, families, met", [
    ("MIT", {"mit"}, True), ("GPL-3.0-only", {"gpl"}, False), ("MIT OR GPL-2.0+", {"mit", "gpl"}, True), ("MIT AND GPL-2.0-or-later", {"mit", "gpl"}, False),
    ("GPL-2.0-only OR MIT AND Apache-2.0", {"gpl", "mit", "apache"}, True), ("(GPL-2.0-only OR MIT) AND GPL-3.0-only", {"gpl", "mit"}, False),
    ("Apache-2.0 WITH LLVM-exception", {"apache"}, True), ("Apache-2.0 WITH unheard-of", {"apache"}, False), ("LicenseRef-own", {"licenseref-own"}, False),
    ("GPL-2.0-only WITH Linux-syscall-note", {"gpl"}, False), ("Artistic-2.0 AND WTFPL", {"artistic", "wtfpl"}, False), ("Apache-2.0.", {"apache"}, True), ("CC-BY-NC-SA-4.0", {"cc-by-nc-sa"}, False),
    ("BSD-4-Clause OR GPL-1.0+", {"bsd", "gpl"}, True), ("ODbL-1.0 and JPNIC", {"odbl", "jpnic"}, False),
    ("MIT and this is prose that goes on", {"mit"}, False), ("((MIT))", {"mit"}, True),
])
def test_expressions(expression, families, met):
    assert licences.evaluate(expression) == (families, met)


@pytest.mark.parametrize("expression", ["", "AND MIT", "MIT OR", "(MIT", "MIT AND OR GPL-3.0-only"])
def test_broken_expressions(expression):
    with pytest.raises(licences.ExpressionError):
        licences.evaluate(expression)


def test_tag_in_text():
    got = dict(zip([f.split()[0] for f in licences.FIELDS.split(", ")], (c[0] for c in licences.Scanner()([b"# SPDX-License-Identifier: MIT OR GPL-3.0-only\ncode"]))))
    assert got["labels"] == "gpl,mit" and got["base_labels"] == "" and got["score"] == 1.0 and got["permitted"] and got["expressions"] == ["MIT OR GPL-3.0-only"]


def scan(text):
    return dict(zip([f.split()[0] for f in licences.FIELDS.split(", ")], (c[0] for c in licences.Scanner()([text.encode()]))))


def test_nothing_is_cut_or_swallowed():
    many = scan("SPDX-License-Identifier: " + " OR ".join(f"GPL-{k}.0" for k in range(200)) + " OR MIT")
    assert many["labels"] == "gpl,mit" and many["permitted"]
    two = scan("SPDX-License-Identifier: MIT x SPDX-License-Identifier: GPL-3.0-only")
    assert two["labels"] == "gpl,mit" and two["permitted"] is False and two["expressions"] == ["MIT x", "GPL-3.0-only"]
    assert scan("License-Expression: Apache-2.0.")["labels"] == "apache"
    broken = scan("SPDX-License-Identifier: (MIT OR GPL-3.0-only")
    assert broken["labels"] == "gpl,mit" and broken["permitted"] is False


@pytest.mark.parametrize("text, labels", [
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("CC-BY-SA 3.0", "cc-by-sa"), ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "cc-by-nc-sa"),
    ("Creative Commons Attribution 4.0", "cc-by"), ("Artistic License 2.0", "artistic"), ("plain prose by cc", ""),
])
def test_notices(text, labels):
    assert scan(text)["labels"] == labels


NOTICE = {**{p: (label, licences.STRENGTH["base"]) for p, label in licences.BASE.items()}}


def plain_labels(text):
    """Labels and score by looking at every word and every phrase; of notices that begin at one word the longest counts."""
    words = text.encode().translate(licences.WORDS).decode().split()
    labels, score = set(), 0.0
    for k in range(len(words)):
        here = [p.split() for p in licences.NOTICES if words[k:k + len(p.split())] == p.split()]
        found = [licences.NOTICES[" ".join(max(here, key=len))]] if here else []
        found += [v for p, v in NOTICE.items() if words[k:k + len(p.split())] == p.split()]
        for label, strength in found:
            labels.add(label)
            score = max(score, strength)
    return ",".join(sorted(labels)), score


def test_labels_against_plain_search():
    import random
    r = random.Random(6)
    phrases = [*licences.BASE, *licences.NOTICES]
    for _ in range(600):
        text = " ".join(r.choice([r.choice(phrases), r.choice(phrases).split()[0], "word", "of", "CC-BY", "4.0."]) for _ in range(r.randrange(1, 9)))
        got = scan(text)
        assert (got["labels"], got["score"]) == plain_labels(text), text
