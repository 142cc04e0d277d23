"""Licence scans: an Aho-Corasick automaton finds notice phrases and identifier tags in one pass over a text's words; the
expression after a tag goes through a shunting-yard parser, which evaluates its with, and, and or.

A text is lower-cased (A-Z), and everything that is no word becomes one space, so that a phrase stands as its words between spaces.
A tag's expression is read from the text itself, as its dots, signs and parentheses matter.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from hammerline.llm.common import DOC_ID, map_texts, narrow

# Base phrases, the notices that add labels of their own, and the words of a tag.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {
    "bsd license": ("bsd", 0.7), "isc license": ("isc", 0.7), "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8), "lesser general public license": ("lgpl", 0.9), "affero general public license": ("agpl", 0.9),
    "boost software license": ("bsl", 0.8), "european union public licence": ("eupl", 0.8), "common development and distribution license": ("cddl", 0.8),
    "artistic license": ("artistic", 0.7), "open software license": ("osl", 0.7), "academic free license": ("afl", 0.7), "sil open font license": ("ofl", 0.8),
    "zlib license": ("zlib", 0.7), "postgresql license": ("postgresql", 0.7), "python software foundation license": ("psf", 0.8),
    "microsoft public license": ("ms-pl", 0.8), "microsoft reciprocal license": ("ms-rl", 0.8), "universal permissive license": ("upl", 0.8),
    "server side public license": ("sspl", 0.8), "business source license": ("busl", 0.8), "open database license": ("odbl", 0.8),
    "open data commons attribution license": ("odc-by", 0.8), "free documentation license": ("gfdl", 0.8), "do what the fuck you want to public license": ("wtfpl", 0.9),
    "cc0 1 0 universal": ("cc0", 0.9), "cc by": ("cc-by", 0.7), "cc by sa": ("cc-by-sa", 0.7), "cc by nd": ("cc-by-nd", 0.7), "cc by nc": ("cc-by-nc", 0.7),
    "cc by nc sa": ("cc-by-nc-sa", 0.7), "cc by nc nd": ("cc-by-nc-nd", 0.7),
    "creative commons attribution": ("cc-by", 0.7), "creative commons attribution sharealike": ("cc-by-sa", 0.8), "creative commons attribution share alike": ("cc-by-sa", 0.8),
    "creative commons attribution noderivatives": ("cc-by-nd", 0.8), "creative commons attribution no derivatives": ("cc-by-nd", 0.8),
    "creative commons attribution noncommercial": ("cc-by-nc", 0.8), "creative commons attribution non commercial": ("cc-by-nc", 0.8),
    "creative commons attribution noncommercial sharealike": ("cc-by-nc-sa", 0.8), "creative commons attribution non commercial share alike": ("cc-by-nc-sa", 0.8),
    "creative commons attribution noncommercial noderivatives": ("cc-by-nc-nd", 0.8), "creative commons attribution non commercial no derivatives": ("cc-by-nc-nd", 0.8),
    "licensed under the apache license version 2 0": ("apache", 1.0), "gnu general public license": ("gpl", 0.9),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 1.0),
    "redistribution and use in source and binary forms with or without modification": ("bsd", 1.0),
    "permission to use copy modify and or distribute this software": ("isc", 1.0),
    "this is free and unencumbered software released into the public domain": ("unlicense", 1.0),
}
TAGS = ("spdx license identifier", "license expression")
# Families by the beginning of an identifier, up to a version; the longest beginning counts.
FAMILIES = (
    "0bsd=bsd", "afl", "agpl", "apache", "apsl", "artistic", "bsd", "bsl", "busl", "cc0", "cc-by", "cc-by-nc", "cc-by-nc-nd", "cc-by-nc-sa", "cc-by-nd", "cc-by-sa", "cddl", "cecill",
    "cpal", "cpl", "curl", "ecl", "epl", "eupl", "gfdl", "gpl", "hpnd", "ijg", "ipl", "isc", "lgpl", "libpng", "lppl", "mit", "mpl", "ms-pl", "ms-rl", "ncsa", "ntp", "odbl", "odc-by", "ofl",
    "openssl", "osl", "php", "postgresql", "psf", "python=psf", "qpl", "ruby", "sspl", "unicode", "unlicense", "upl", "vim", "w3c", "wtfpl", "x11", "zlib", "zpl",
)
FAMILY = {k: v or k for k, _, v in (f.partition("=") for f in FAMILIES)}
STRENGTH = {"base": 0.6, "tag": 1.0}
PERMISSIVE = frozenset({"mit", "apache", "bsd", "isc", "bsl", "unlicense", "cc0", "zlib"})
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

# every byte that is no part of a word becomes a space; A-Z become a-z
WORDS = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
TAG = re.compile(r"(?:SPDX-License-Identifier|License-Expression)[ \t]*:[ \t]*", re.I)
LINE_END = re.compile(r"[\r\n]|$")
TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+:-]+")
EXCEPTION = re.compile(r".*-(exception|note)(-[0-9.]+)?")
# a licence name outside the table: a sign or digit in it, or capitals; plain words of prose are none
NAME = re.compile(r"(?=.*([0-9-]|[A-Z].*[A-Z]))[A-Za-z0-9][A-Za-z0-9.+:-]*")


def family(identifier: str) -> str | None:
    """The family of a licence identifier: of the table, or, if it is well-formed, the identifier itself in small letters."""
    name = re.sub(r"(-only|-or-later|\+)$", "", identifier.lower())
    parts = name.split("-")
    for k in range(len(parts), 0, -1):
        if found := FAMILY.get("-".join(parts[:k])):
            return found
    return name if NAME.fullmatch(identifier) else None


class ExpressionError(ValueError):
    """A licence expression that cannot be parsed."""


def postfix(expression: str) -> list[str]:
    """Shunting-yard: a licence expression in postfix order; ``with`` binds before ``and``, ``and`` before ``or``."""
    out, waiting, operand = [], [], True
    for token in TOKEN.findall(expression):
        token = token.rstrip(".:")  # a sentence may end after an identifier
        low = token.lower()
        if not token:
            break
        if low in PRECEDENCE:
            if operand:
                raise ExpressionError(f"{token} has no left side")
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[low]:
                out.append(waiting.pop())
            waiting.append(low)
            operand = True
        elif low == "(":
            if not operand:
                break  # prose goes on after the expression
            waiting.append(low)
        elif low == ")":
            if operand or "(" not in waiting:
                break
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif operand:
            out.append(token)
            operand = False
        else:
            break
    if operand or "(" in waiting:
        raise ExpressionError("the expression is not complete")
    return out + waiting[::-1]


def evaluate(expression: str, allowed: frozenset[str] = PERMISSIVE) -> tuple[set[str], bool]:
    """Families that the expression names, and whether it can be met with the ``allowed`` ones.

    ``or`` needs one side and ``and`` both; ``with`` adds an exception to the licence on its left, whose family stays named. What is
    no exception by its form is not allowed; neither is a licence outside the table, which names itself if it is well-formed.
    """
    stack: list[tuple[set[str], bool, str]] = []
    for token in postfix(expression):
        if token not in PRECEDENCE:
            named = family(token)
            stack.append(({named} if named else set(), named in allowed, token.lower()))
            continue
        if len(stack) < 2:
            raise ExpressionError(f"{token} lacks a side")
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left[0], left[1] and EXCEPTION.fullmatch(right[2]) is not None, left[2]))
        else:
            met = left[1] or right[1] if token == "or" else left[1] and right[1]
            stack.append((left[0] | right[0], met, ""))
    if len(stack) != 1:
        raise ExpressionError("the expression is not complete")
    return stack[0][0], stack[0][1]


def tagged(text: str, allowed: frozenset[str]) -> list[tuple[str, set[str], bool]]:
    """(expression, families, permitted) of every tag. An expression ends at the next tag or the end of its line; one that cannot be
    parsed still names the licences of the table that stand in it, and is not permitted."""
    tags, out = list(TAG.finditer(text)), []
    for k, m in enumerate(tags):
        end = LINE_END.search(text, m.end()).start()
        expression = text[m.end():min(end, tags[k + 1].start()) if k + 1 < len(tags) else end].strip()
        try:
            out.append((expression, *evaluate(expression, allowed)))
        except ExpressionError:
            known = {f for t in TOKEN.findall(expression) if (f := family(t.rstrip(".:"))) in KNOWN}
            if known:
                out.append((expression, known, False))
    return out


KNOWN = frozenset(FAMILY.values())
FIELDS = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
          "expressions array<string>, permitted boolean")


class Scanner:
    def __init__(self, allowed: frozenset[str] = PERMISSIVE):
        import ahocorasick

        self.allowed, self.automaton = allowed, ahocorasick.Automaton()
        marks: dict[str, list[tuple]] = {}
        for phrase, label in BASE.items():
            marks.setdefault(phrase, []).append(("base", label, STRENGTH["base"]))
        for phrase, (label, strength) in NOTICES.items():
            marks.setdefault(phrase, []).append(("notice", label, strength))
        for phrase in TAGS:
            marks.setdefault(phrase, []).append(("tag", "", 0.0))
        for phrase, found in marks.items():
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, found))
        self.automaton.make_automaton()

    def __call__(self, texts: list[bytes]) -> list[list]:
        return [list(c) for c in zip(*map(self._scan, texts), strict=True)]

    def _scan(self, text: bytes) -> tuple:
        words = text.translate(WORDS).split()
        line = f" {b' '.join(words).decode()} "
        places, base, labels, score, tags = [], set(), set(), 0.0, False
        notices: dict[int, tuple[int, str, float]] = {}  # the longest that begins at a place
        word, at = 0, 0  # spaces before a place, counted on from the place before
        for end, (length, found) in self.automaton.iter(line):
            start = end - length + 1
            for kind, label, strength in found:
                if kind == "tag":
                    tags = True
                elif kind == "notice":
                    if length > notices.get(start, (0,))[0]:
                        notices[start] = (length, label, strength)
                else:
                    labels.add(label)
                    base.add(label)
                    score = max(score, strength)
                    word += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
                    at = start
                    places.append(word)
        for _, label, strength in notices.values():
            labels.add(label)
            score = max(score, strength)
        expressions, permitted = [], None
        if tags:
            for expression, named, met in tagged(text.decode(), self.allowed):
                expressions.append(expression)
                labels |= named
                permitted = met if permitted is None else permitted and met
                score = max(score, STRENGTH["tag"] if named else 0.0)
        if permitted is None and labels:
            permitted = labels <= self.allowed
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), score, expressions, permitted)


def licence_scan(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text", allowed: frozenset[str] = PERMISSIVE) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, permitted) for every row.

    ``score`` is the strength of the strongest evidence: 0 without any, 1 for a tag or a full notice. ``permitted`` says whether all expressions
    (or else all labels) are among the ``allowed`` families; null without any. Null texts are empty; rows stand alone, repeated ones
    too; expressions and texts are read whole, however long; other columns are left behind; an empty table gives an empty result.
    """
    return map_texts(narrow(df, id_col, text_col, binary=True), FIELDS, lambda: Scanner(allowed))
