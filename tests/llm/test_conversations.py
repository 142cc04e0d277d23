"""Conversation repair against a search over all edits, row by row."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from hammerline.llm import conversations as cv

BLANK = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repaired(rows):
    """(faults, cost, audit, digest) of one conversation's ordered rows, by states of what was written last and whole letter strings."""
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(BLANK)[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None)
        seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    ways = {"": (0, "", ())}

    def least(options):
        out = {}
        for state, way in options:
            if state not in out or way[:2] < out[state][:2]:
                out[state] = way
        return out

    def inserted(ways):
        options = list(ways.items())
        for state, (cost, audit, kept) in ways.items():
            for _ in range(3):
                role = "a" if state == "u" else "u"
                state, cost, audit, kept = step[state, role], cost + 5, audit + "I", (*kept, ("user:" if role == "u" else "assistant:"))
                options.append((state, (cost, audit, kept)))
        return least(options)

    for (_, role, text), fault in zip(rows, faults, strict=True):
        options = []
        for state, (cost, audit, kept) in inserted(ways).items():
            options.append((state, (cost + 2, audit + "D", kept)))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if role and (state, role[0]) in step:
                    options.append((step[state, role[0]], (cost + more, audit + "K", (*kept, f"{role}:{text}"))))
                for name in ("user", "assistant"):
                    if (state, name[0]) in step:
                        options.append((step[state, name[0]], (cost + 1 + more, audit + "R", (*kept, f"{name}:{text}"))))
        ways = least(options)
    cost, audit, kept = min(way for state, way in inserted(ways).items() if state in ("", "a"))
    return faults, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()


def brute(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in damaged(rows):
        groups[conv].append((turn, role, text))
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, cost, audit, digest = repaired(own)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest))
    return sorted(out, key=repr)


def run(df, **how):
    return sorted((tuple(r) for r in cv.repair_damaged(df, **how).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()), key=repr)


def corpus(n, seed, longest=12):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        turn = rng.randrange(3)
        for _ in range(rng.randrange(longest)):
            rows.append((conv, rng.choice([turn, turn, turn, None]) if rng.random() < 0.1 else turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "u2", None]),
                         rng.choice(["Yes.", "No!", "cut off", "", " \n", "Why?\t", "é.", None, "end\x1c", f"text {rng.randrange(9)}."])))
            turn += rng.choice([0, 1, 1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(400, seed)
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_long_conversations_climb_the_tree(spark):
    """Blocks of a few rows and a narrow tree give the same result."""
    rows = corpus(40, 7) + [(100 + k % 2, k // 2, *random.Random(k).choice([("user", "Yes."), ("assistant", "No!"), ("system", "cut"), ("tool", "Go."), ("user", f"text {k}."), ("assistant", f"cut {k}")])) for k in range(3000)]
    assert run(spark.createDataFrame(rows, SCHEMA), block_rows=7, fan=3) == brute(rows)


def test_blocks_and_tree_functions():
    """Any cut into blocks, multiplied in steps, gives the matrix of the whole."""
    rng = random.Random(3)
    for _ in range(60):
        symbols = "".join(rng.choice("012345678") for _ in range(rng.randrange(2, 40)))
        whole = cv.solve([symbols])[0]
        cuts = sorted(rng.sample(range(1, len(symbols)), min(len(symbols) - 1, rng.randrange(1, 5))))
        blocks = [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)], strict=True)]
        parts = cv.solve(blocks)
        costs = [[e and e[0] for e in m] for m in parts]
        ranks = [cv.order_of([e and str(e[1]) for e in m]) for m in parts]
        got_costs, got_ranks = cv.multiply(costs, ranks)
        assert got_costs == [e and e[0] for e in whole]
        assert got_ranks == cv.order_of([e and str(e[1]) for e in whole])


def test_grammar_gives_the_sequences_back():
    rng = random.Random(4)
    sequences = ["".join(rng.choice("0248") for _ in range(rng.randrange(1, 30))) for _ in range(200)] + ["2" * 57, "24" * 40]
    rules, compressed = cv.re_pair(sequences)

    def spelled(k):
        return str(k) if k < 9 else spelled(rules[k - 9][0]) + spelled(rules[k - 9][1])

    assert ["".join(map(spelled, c.tolist())) for c in compressed] == sequences
    assert sum(map(len, compressed)) < sum(map(len, sequences)) / 3


def test_edges(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (3, None, "user", None), (3, None, "user", None), (4, 1, "user", "x" * 50_000 + "."),
            (4, 2, "assistant", "y" * 50_000)] + [(6, t, "user", "same.") for t in range(60)]
    clash = SCHEMA + ", key string, `row` string, fault string, unit string, part string"
    assert run(spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], clash)) == brute(rows)
    assert run(spark.createDataFrame([], SCHEMA)) == []


def test_hot_conversation(spark):
    """A conversation with nearly all rows, one of them repeated by the thousand, is cut into many blocks."""
    rows = [(1, k // 3, "user" if k % 2 else "assistant", f"text {k}." if k % 5 else "the same.") for k in range(9000)] + [(1, 5, "user", "again.")] * 3000 + corpus(20, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    assert run(df) == brute(rows)
