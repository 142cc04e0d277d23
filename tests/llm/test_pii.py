"""Personal data: base spans against the literal patterns, bootstrapping on a planted corpus, masking."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hammerline.llm import pii
from tests.llm.conftest import PII, rows_of

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"\D", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@-_+ 0123456789()", max_size=60))
def test_base_spans(text):
    assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(text)] == plain(text)


@pytest.mark.parametrize("text", ["a" * 300_000 + " @", "1" * 300_000, "1." * 150_000, "+1" * 100_000, "a@" * 100_000, "1 " * 150_000 + "x", "a@b." * 50_000])
def test_very_long_runs(text):
    pii.base_spans(text)
    pii.contexts(text, pii.base_spans(text))


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def expected(rows):
    return sorted(((i, *[sum(s[0] == k for s in plain(t)) for k in PATTERNS], digest(plain(t))) for i, t in rows), key=repr)


COLUMNS = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def test_rows(edge, edge_rows, empty):
    got = pii.personal_data(edge)
    assert rows_of(got, *COLUMNS) == expected(edge_rows)
    assert pii.personal_data(empty).count() == 0


def test_sample(sample):
    rows = [tuple(r) for r in sample.select("doc_id", "text").collect()]
    assert rows_of(pii.personal_data(sample), *COLUMNS) == expected(rows)


def corpus():
    texts = [f"please call phone: +1 (555) 0{k}{k}-42{k}1 today, thanks" for k in range(10, 30)]
    texts += ["please call phone: 555-0199-777 today, thanks"]
    texts += [f"order number 20{k}000{k} was sent on its way" for k in range(10, 40)]
    return list(enumerate(texts))


def test_contexts_find_more(spark):
    """A number in the place where only phone numbers stand is found; numbers in other places are not."""
    got = pii.personal_data(spark.createDataFrame(corpus(), "doc_id bigint, text string")).toPandas().set_index("doc_id").sort_index()
    text = corpus()[20][1]
    at = text.index("555-0199-777")
    assert got.loc[20, "spans"] == f"phone:{at}:{at + 12}" and got.loc[20, "n_phone"] == 0
    assert (got.loc[21:, "spans"] == "").all() and (got.loc[:19, "n_phone"] == 1).all()


def test_mask(spark, edge, edge_rows, empty):
    masked = pii.mask(spark.createDataFrame(corpus(), "doc_id bigint, text string"))
    texts = dict(map(tuple, masked.collect()))
    assert texts[20] == "please call phone: [PHONE] today, thanks" and texts[21] == corpus()[21][1]
    out = pii.mask(edge, chars_col="n_chars")
    assert out.columns == edge.columns and out.schema == edge.schema
    assert rows_of(out, "doc_id", "text") == sorted(((i, t if t is None else pii.masked(t, pii.base_spans(t))) for i, t in edge_rows), key=repr)
    assert pii.masked(PII, pii.base_spans(PII)) == "Write to [EMAIL] or [PHONE], host [IP], card [CARD]."
    assert pii.mask(empty).count() == 0


def spans_of(spark, texts):
    got = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    return {r["doc_id"]: [tuple(x.split(":")[:1]) + tuple(map(int, x.split(":")[1:])) for x in r["spans"].split(",") if x] for r in got.collect()}


def test_discovered_numbers_support_further_patterns(spark):
    """Base phones make "phone:" confident; numbers found there stand after "mobile>", too, which makes that confident for others."""
    texts = [f"please call phone: +1 (555) {k}-42{k % 10}1 today, thanks" for k in range(100, 400)]
    numbers = [f"555-01{k}-77{k}" for k in range(10, 40)]
    texts += [f"please call phone: {n} today, thanks" for n in numbers]
    texts += [f"note: mobile> {n} is in use" for n in numbers]
    texts += [f"note: mobile> 555-02{k}-88{k} is in use" for k in range(10, 12)]
    texts += [f"once more {numbers[0]} by itself", "in order 555-0110-1111 came"]
    got = spans_of(spark, texts)
    found = {i: [texts[i][s:e] for k, s, e in spans if k == "phone"] for i, spans in got.items()}
    assert all(found[300 + k] == [numbers[k]] and found[330 + k] == [numbers[k]] for k in range(30))
    assert found[360] == ["555-0210-8810"] and found[361] == ["555-0211-8811"]
    assert found[362] == [numbers[0]] and found[363] == []


def test_numbers_in_groups_are_found_whole(spark):
    texts = [f"please call phone: +1 (555) 0{k}{k}-42{k}1 today, thanks" for k in range(10, 60)]
    texts += ["please call phone: 555 019 9777 today, thanks", "please call phone: (555) 123-4567 today, thanks", "please call phone: (555) 123 4567. Then write"]
    found = {i: [texts[i][s:e] for _, s, e in spans] for i, spans in spans_of(spark, texts).items()}
    assert found[50] == ["555 019 9777"] and found[51] == ["(555) 123-4567"] and found[52] == ["(555) 123 4567"]
    masked = dict(map(tuple, pii.mask(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()))
    assert masked[51] == "please call phone: [PHONE] today, thanks"


def plain_bootstrap(texts):
    """Spans by sets in plain code, from the same occurrences."""
    held = [(i, o) for i, t in enumerate(texts) for o in pii.contexts(t, pii.base_spans(t))]
    graph = {}
    for _, (_, _, surface, kind, kinds, patterns) in held:
        for k in kinds:
            for p in patterns:
                seeds = graph.setdefault((p, k), {})
                seeds[surface] = seeds.get(surface, False) or kind == k
    graph = {k: v for k, v in graph.items() if len(v) >= pii.SUPPORT}
    trust = {(s, k): 1.0 for (_, k), v in graph.items() for s, seed in v.items() if seed}
    seeds = dict(trust)
    while True:
        good = {}
        for (p, k), v in graph.items():
            mine = [trust[s, k] for s in v if (s, k) in trust]
            if len(mine) >= pii.SUPPORT and sum(mine) / (len(v) + 1) >= pii.CONFIDENT:
                good[p, k] = sum(mine) / (len(v) + 1)
        new = dict(seeds)
        for (p, k), c in good.items():
            for s in graph[p, k]:
                new[s, k] = max(new.get((s, k), 0), c)
        if len(new) == len(trust):
            break
        trust = new
    out = {i: sorted(pii.base_spans(t)) for i, t in enumerate(texts)}
    for i, (start, end, surface, kind, kinds, patterns) in held:
        named = [(c, -k) for k in kinds for c in [*[good[p, k] for p in patterns if (p, k) in good], *([new[surface, k]] if (surface, k) in new else [])]]
        if kind is None and named:
            out[i] = sorted([*out[i], (-max(named)[1], start, end)])
    return {i: [(pii.KINDS[k], s, e) for k, s, e in spans] for i, spans in out.items()}


def test_spans_against_plain_bootstrap(spark):
    import random
    r = random.Random(12)
    heads, tails = ["phone:", "tel=", "ring", "order", "card", "from", "id", "mobile>"], ["now", "today", "please", "shipped"]
    values = [lambda: f"+1 (555) {r.randrange(100, 999)}-{r.randrange(1000, 1200)}", lambda: f"555-{r.randrange(100, 130)}-{r.randrange(1000, 1010)}", lambda: f"{r.randrange(10**6, 10**6 + 60)}9",
              lambda: f"u{r.randrange(40)}@mail.example.com", lambda: f"u{r.randrange(40)}@local", lambda: f"10.0.{r.randrange(30)}.7"]
    weights = {"phone:": [8, 2, 0, 0, 0, 0], "tel=": [3, 6, 0, 0, 0, 0], "mobile>": [0, 5, 0, 0, 0, 0], "order": [0, 0, 5, 0, 0, 0], "from": [0, 0, 0, 8, 1, 0]}
    texts = []
    for _ in range(500):
        h = r.choice(heads)
        texts.append(" ".join(f"{h}{'' if h == 'tel=' else ' '}{r.choices(values, weights.get(h, [1] * 6))[0]()} {r.choice(tails)}" for _ in range(r.randrange(1, 3))))
    got, want = spans_of(spark, texts), plain_bootstrap(texts)
    assert got == want
    assert sum(map(len, want.values())) > sum(len(pii.base_spans(t)) for t in texts) + 5
