"""Personal data: base patterns, and bootstrapped contextual extraction for what they miss.

Base spans (email, ip, card, phone) are the seeds. One pass over the texts gives them, the other tokens (or adjacent groups of digits)
that could be identifiers of a kind, and the lexical patterns of both: the word before, the word after, both, and a label written before the value.
Patterns and instances make a graph with a row per distinct edge, on which Spark scores both sides in turn: a pattern by the share of its
distinct instances that are trusted, an instance by the best of its patterns. A pattern is confident once ``SUPPORT`` trusted
instances stand in it and its share reaches ``CONFIDENT``; its other instances are trusted from then on, and so support further patterns.
Trust only grows, and the rounds end when a round trusts nothing new. A trusted instance has its kind wherever it stands. A candidate
never displaces a base span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hammerline.llm.common import DOC_ID, fresh, map_texts, narrow, slices
from hammerline.session import settle

KINDS = ("email", "ip", "card", "phone")
SUPPORT, CONFIDENT = 5, 0.8

# The base patterns. Possessive runs and a start at the beginning of a run find the same matches in linear time.
LOCAL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
EMAIL, EMAIL_AT = re.compile(r"(?<![A-Za-z0-9._%+-])" + LOCAL), re.compile(LOCAL)
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
SEPARATORS = str.maketrans("", "", " -().+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = ".,;:!?()[]{}<>\"'"
LABEL = re.compile(r"([A-Za-z_-]++)[=:](?=.)")
GROUP = re.compile(r"[().+-]*+[0-9][0-9().+-]*+")
FEWEST, MOST = 7, 19  # digits of a phone, of a card


def emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := (at and EMAIL_AT.match(text, at)) or EMAIL.search(text, at):  # an address may begin where the last one ended
        yield m.span()
        at = m.end()


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2] + [sum(divmod(2 * v, 10)) for v in values[1::2]]) % 10 == 0


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        if all(len(part := p.lstrip("0")) <= 3 and int(part or "0") <= 255 for p in m[0].split(".")):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind and start."""
    out = []
    if "@" in text:
        out += [(0, *s) for s in emails(text)]
    if DIGIT.search(text):
        out += [(1, *s) for s in ips(text)] + [(2, *s) for s in cards(text)]
        if "+" in text:
            out += [(3, *s) for s in phones(text)]
    return out


def could_be(token: str) -> list[int]:
    """Kinds whose shape a token has, loosely."""
    digits = sum("0" <= c <= "9" for c in token)
    kinds = []
    if "@" in token[1:-1] and digits + sum(c.isalpha() for c in token) >= 5:
        kinds.append(0)
    if digits >= 4 and token.count(".") + token.count(":") >= 3 and set(token) <= set("0123456789.:"):
        kinds.append(1)
    bare = token.translate(SEPARATORS)
    if bare and len(bare) == digits:
        if 12 <= digits <= 19:
            kinds.append(2)
        if 7 <= digits <= 15:
            kinds.append(3)
    return kinds


def digits_on(text: str, tokens: list[tuple[int, int]], k: int, start: int, before: int) -> int:
    """End of the number that begins at ``start`` in token ``k``: of the token itself if it has digits enough, else of
    the groups that follow it, one space apart, as long as all have at most MOST digits and end ``before`` the next base span."""
    end = tokens[k][1]
    count = lambda a, b: sum("0" <= c <= "9" for c in text[a:b])
    held = count(start, end)
    if held >= FEWEST:
        return end
    while k + 1 < len(tokens):
        a, b = tokens[k + 1]
        trimmed = b - (len(text[a:b]) - len(text[a:b].rstrip(EDGES.replace(")", ""))))
        more = count(a, trimmed)
        if a != end + 1 or text[end] != " " or b > before or not more or held + more > MOST or not GROUP.fullmatch(text, a, trimmed):
            break
        held, end, k = held + more, b, k + 1
        if trimmed < b:  # a full stop or comma ends the number
            break
    return end


def contexts(text: str, spans: list[tuple[int, int, int]]) -> list[tuple]:
    """(start, end, surface, kind or None, possible kinds, patterns) of base spans and of candidates among the other tokens."""
    if not spans and "@" not in text and not DIGIT.search(text):
        return []
    tokens = [(m.start(), m.end()) for m in WORD.finditer(text)]
    taken = sorted((s, e, k) for k, s, e in spans)
    out, at, end_of_taken = [], 0, 0
    clean = lambda k: text[slice(*tokens[k])].strip(EDGES).lower() if 0 <= k < len(tokens) else ""

    def around(first: int, last: int, inner: str) -> list[str]:
        before, after = inner or clean(first - 1), clean(last + 1)
        return [p for p in (f"L {before}" if before else "", f"R {after}" if after else "", f"B {before} {after}" if before and after else "") if p]

    k = 0
    while k < len(tokens):
        start, end = tokens[k]
        inside = []
        while at < len(taken) and taken[at][0] < end:
            inside.append(taken[at])
            end_of_taken = max(end_of_taken, taken[at][1])
            at += 1
        for s, e, kind in inside:
            last = k
            while last + 1 < len(tokens) and tokens[last + 1][0] < e:
                last += 1
            label = LABEL.fullmatch(text[start:s])
            out.append((s, e, text[s:e].lower(), kind, [kind], around(k, last, label[1].lower() + "=" if label else "")))
        if not inside and start >= end_of_taken:
            piece, shift = text[start:end], 0
            if (label := LABEL.match(piece)):
                shift = label.end()
            last, stop = k, end
            if GROUP.fullmatch(text, start + shift, end):
                stop = digits_on(text, tokens, k, start + shift, taken[at][0] if at < len(taken) else len(text))
                while tokens[last][1] < stop:
                    last += 1
            value = text[start + shift:stop]
            left = len(value) - len(value.lstrip(EDGES))
            if ")" in value[left:] and value[:left].endswith("("):
                left -= 1  # the bracket belongs to the number
            value = value[left:].rstrip(EDGES)
            if value and (kinds := could_be(value)):
                s = start + shift + left
                out.append((s, s + len(value), value.lower(), None, kinds, around(k, last, label[1].lower() + "=" if label else "")))
                k = last
        k += 1
    return out


OCCURRENCE = "array<struct<start:bigint,end:bigint,surface:string,kind:int,kinds:array<int>,patterns:array<string>>>"
FOUND = f"base array<struct<kind:int,start:bigint,end:bigint>>, occurrences {OCCURRENCE}"


def _find(texts: list[str]) -> list[list]:
    spans = [base_spans(t) for t in texts]
    keys = ("start", "end", "surface", "kind", "kinds", "patterns")
    return [[[dict(zip(("kind", "start", "end"), s, strict=True)) for s in found] for found in spans],
            [[dict(zip(keys, o, strict=True)) for o in contexts(t, found)] for t, found in zip(texts, spans, strict=True)]]


def bootstrapped(occurrences: DataFrame, support: int = SUPPORT, confident: float = CONFIDENT) -> tuple[DataFrame, DataFrame]:
    """Confident (pattern, kind, confidence) and trusted (surface, kind, trust), from rows (surface, kind, kinds, patterns).

    A round is two grouped aggregates over the distinct edges; whether it trusted something new is all that comes back.
    """
    edges = occurrences.select("surface", "kind", F.explode("kinds").alias("as"), "patterns")
    edges = edges.select("surface", "kind", "as", F.explode("patterns").alias("pattern"))
    edges = settle(edges.groupBy("pattern", "as", "surface").agg(F.max(F.when(F.col("kind") == F.col("as"), 1).otherwise(0)).alias("seed")))
    # a pattern with fewer distinct instances than its support needs can never be confident
    wide = settle(edges.groupBy("pattern", "as").agg(F.count("*").alias("n")).filter(F.col("n") >= support))
    graph = settle(edges.join(wide, ["pattern", "as"]))
    seeds = graph.filter("seed = 1").select("surface", "as").distinct().withColumn("trust", F.lit(1.0))
    trusted, before = settle(seeds), -1
    while (now := trusted.count()) != before:
        before = now
        scored = graph.join(trusted, ["surface", "as"], "left").groupBy("pattern", "as").agg(
            (F.sum(F.coalesce("trust", F.lit(0.0))) / (F.max("n") + 1)).alias("confidence"), F.count("trust").alias("held"))
        patterns = settle(scored.filter((F.col("held") >= support) & (F.col("confidence") >= confident)).drop("held"))
        named = graph.join(patterns, ["pattern", "as"]).select("surface", "as", F.col("confidence").alias("trust"))
        trusted = settle(seeds.unionByName(named).groupBy("surface", "as").agg(F.max("trust").alias("trust")))
    return patterns.withColumnRenamed("as", "kind"), trusted.withColumnRenamed("as", "kind")


def discovered(rows: DataFrame, key: list[str]) -> DataFrame:
    """(key, start, end, kind, confidence) of the candidates that stand in a confident pattern, or are trusted from elsewhere; ``rows`` has ``occurrences``."""
    occurrences = settle(rows.filter(F.size("occurrences") > 0).select(*key, F.inline("occurrences")))
    patterns, trusted = bootstrapped(occurrences)
    held = occurrences.filter("kind IS NULL").select(*key, "start", "end", "surface", F.explode("kinds").alias("kind"), "patterns")
    placed = held.select(*key, "start", "end", "kind", F.explode("patterns").alias("pattern")).join(patterns, ["pattern", "kind"])
    known = held.join(trusted.withColumnRenamed("trust", "confidence"), ["surface", "kind"])
    columns = [*key, "start", "end", "kind", "confidence"]
    named = placed.select(*columns).unionByName(known.select(*columns)).groupBy(*columns[:-1]).agg(F.max("confidence").alias("confidence"))
    # one kind a candidate: the one most trusted, of equals the first
    best = F.max(F.struct("confidence", (-F.col("kind")).alias("k"))).alias("best")
    return named.groupBy(*key, "start", "end").agg(best).select(
        *key, "start", "end", (-F.col("best.k")).alias("kind"), F.col("best.confidence").alias("confidence"))


def _joined(spans: str):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans): base spans, and all spans with those discovered.

    Positions are code points, ends exclusive. A null or empty text has no spans. Rows are told apart by a number in a settled
    copy, so that repeated rows and null ids get a row each; an empty table gives an empty result.
    """
    found = map_texts(narrow(df, id_col, text_col, binary=False), FOUND, lambda: _find)
    found = settle(found.withColumn("row", F.monotonically_increasing_id()))
    more = discovered(found, ["row"]).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    rows = found.select("row", DOC_ID, "base").join(settle(more), "row", "left")
    spans = F.concat("base", F.coalesce("more", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return rows.select(DOC_ID, *[count(k) for k in range(4)], F.sha2(_joined("base"), 256).alias("base_sha256"),
                       _joined(spans).alias("spans"), F.size(spans).cast("long").alias("n_spans"))


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every span replaced by its kind in brackets; of overlapping spans, the first and then the longest."""
    out, at = [], 0
    for start, end, kind in sorted(((s, e, k) for k, s, e in spans), key=lambda x: (x[0], -x[1])):
        if start < at:
            if end > at:  # what sticks out of an earlier span goes with it
                at = end
            continue
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def mask(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """``df`` with personal data masked in its texts (and ``chars_col`` set to the new length); null texts stay null.

    Base spans are found again while a text is masked; what was discovered comes by a join on (doc_id, hash of the text), a small table.
    """
    text, more = fresh(df, "text"), fresh(df, "more")
    base = df.select(F.col(id_col).alias(DOC_ID), F.xxhash64(F.col(text_col)).alias("hash"), F.col(text_col).cast("string").alias("text"))
    found = settle(map_texts(base, FOUND, lambda: _find).filter(F.size("occurrences") > 0))
    extra = settle(discovered(found, [DOC_ID, "hash"]).groupBy(DOC_ID, "hash").agg(F.collect_set(F.struct("kind", "start", "end")).alias(more)))
    keyed = df.join(extra, df[id_col].eqNullSafe(extra[DOC_ID]) & (F.xxhash64(df[text_col]) == extra["hash"]), "left").select(
        *[df[c] for c in df.columns], more, df[text_col].cast("string").alias(text))
    at, chars = df.columns.index(text_col), df.columns.index(chars_col) if chars_col else None

    def run(batches):
        for part in slices(batches):
            columns = list(part.columns[:-2])
            new, lengths = [], []
            for t, extras in zip(part.column(part.num_columns - 1).to_pylist(), part.column(part.num_columns - 2).to_pylist(), strict=True):
                spans = [] if t is None else base_spans(t) + [(e["kind"], e["start"], e["end"]) for e in extras or []]
                new.append(masked(t, spans) if spans else t)
                lengths.append(len(new[-1]) if spans else None)
            columns[at] = pa.array(new, part.schema.field(at).type)
            if chars is not None:
                same = part.column(chars).to_pylist()
                columns[chars] = pa.array([old if n is None else n for n, old in zip(lengths, same, strict=True)], part.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(part.schema)[:-2]))

    return keyed.mapInArrow(run, StructType(df.schema.fields))
