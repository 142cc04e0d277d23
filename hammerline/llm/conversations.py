"""Conversation structure repair: the cheapest edits that turn damaged conversations into alternating ones.

A row becomes one of nine symbols (role class and fault). A symbol, and any sequence of symbols, is a 4 x 4 min-plus matrix over the states
of the wanted form ``(s?(ua)+)?``: cheapest cost from state to state, and the letters of its edits as a rope. Equal sequences of symbols
are solved once for all conversations; tasks compress batches of distinct sequences by Re-Pair, evaluate one matrix for each
rule bottom-up, and multiply what is left.

Conversations of any length: rows are range-sorted by (conversation, turn) and cut into blocks of bounded size. Blocks of one conversation
are multiplied in a tree that carries costs and the order of the letters, not the letters, and the chosen states go down the same tree.
This is exact: an edit sequence fixes the states it passes, so the letters of two ways through a block differ inside that block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hammerline.session import settle

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
STOPS = (".", "!", "?")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs
BLOCK_ROWS, BLOCK_BYTES = 4096, 4 * 2**20
BATCH_SYMBOLS = 2**17  # symbols of the sequences that share a grammar
FAN = 1024  # blocks that one step of the tree multiplies
START, SYSTEM, USER, ASSISTANT = range(4)  # what was written last
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
TURN = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # the role that an inserted or re-roled row gets
NAMES = {"u": "user", "a": "assistant"}
TAIL = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # rows to insert at the end
CLASSES = ("s", "u", "a", "")
GONE = "8"  # the symbol of a row that has to go; others are 2 * class + truncated


class Rope:
    """Letters of joined ropes, written out only when asked for."""

    __slots__ = ("left", "right", "text")

    def __init__(self, left, right=None):
        self.left, self.right, self.text = left, right, left if right is None else None

    def __str__(self) -> str:
        if self.text is None:
            out, stack = [], [self]
            while stack:
                rope = stack.pop()
                if rope.text is not None:
                    out.append(rope.text)
                else:
                    stack += (rope.right, rope.left)
            self.text = "".join(out)
        return self.text


Matrix = list  # 16 entries (cost, Rope) or None, row by row


def better(a, b):
    """The cheaper of two ways, of equal ones that with the ASCII-least letters."""
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if str(a[1]) <= str(b[1]) else b


def times(x: Matrix, y: Matrix) -> Matrix:
    out: Matrix = [None] * 16
    for i in range(4):
        for j in range(4):
            if (first := x[4 * i + j]) is None:
                continue
            for k in range(4):
                if (second := y[4 * j + k]) is not None:
                    have, cost = out[4 * i + k], first[0] + second[0]
                    if have is None or cost <= have[0]:
                        out[4 * i + k] = better(have, (cost, Rope(first[1], second[1])))
    return out


@cache
def symbol_matrix(symbol: str) -> tuple:
    """Insertions before the row, then its edit."""
    out: Matrix = [None] * 16
    kind, truncated = divmod(int(symbol), 2)
    for i in range(4):
        state, cost, before = i, 0, ""
        for _ in range(3):
            ways = [("D", state, DELETE)]
            if symbol != GONE:
                if (kept := NEXT.get((state, CLASSES[kind]))) is not None:
                    ways.append(("K", kept, KEEP + TRUNCATED * truncated))
                ways.append(("R", NEXT[state, TURN[state]], REROLE + TRUNCATED * truncated))
            for letter, j, price in ways:
                out[4 * i + j] = better(out[4 * i + j], (cost + price, Rope(before + letter)))
            state, cost, before = NEXT[state, TURN[state]], cost + INSERT, before + "I"
    return tuple(out)


def re_pair(sequences: Sequence[str]) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """Rules (pairs of symbols or earlier rules, numbered from 9) and the sequences in terms of them; no pair is left that stands twice.

    A round replaces the frequent pairs that cannot overlap each other, at least half as frequent as the most frequent one.
    """
    text = np.frombuffer("\n".join([*sequences, ""]).encode(), dtype=np.uint8).astype(np.int64) - ord("0")
    text[text < 0] = -1
    rules: list[tuple[int, int]] = []
    while len(text) > 1:
        top = 9 + len(rules)
        twin = text[:-1] == text[1:]
        spot = np.arange(len(twin))
        starts = np.maximum.accumulate(np.where(twin & ~np.concatenate([[False], twin[:-1]]), spot, 0))
        free = (text[:-1] >= 0) & (text[1:] >= 0) & (~twin | ((spot - starts) % 2 == 0))  # every other place of a run
        codes = np.where(free, text[:-1] * top + text[1:], -1)
        found, counts = np.unique(codes[codes >= 0], return_counts=True)
        if not len(found) or counts.max() < 2:
            break
        lefts, rights, chosen = set(), set(), {}
        for k in np.argsort(-counts, kind="stable").tolist():
            left, right = divmod(int(found[k]), top)
            if counts[k] < max(2, counts.max() / 2):
                break
            if left == right:
                if not chosen:
                    chosen[int(found[k])] = top
                    rules.append((left, right))
                    break
            elif left not in rights and right not in lefts:
                lefts.add(left)
                rights.add(right)
                chosen[int(found[k])] = 9 + len(rules)
                rules.append((left, right))
        at = np.flatnonzero(np.isin(codes, list(chosen)))
        text[at] = [chosen[c] for c in codes[at].tolist()]
        text = np.delete(text, at + 1)
    ends = np.flatnonzero(text == -1)
    return rules, [text[a + 1:b] for a, b in zip([-1, *ends[:-1]], ends, strict=True)]


def solve(sequences: Sequence[str]) -> list[Matrix]:
    """The matrix of each sequence, those of shared rules computed once."""
    rules, compressed = re_pair(sequences)
    matrices: list[Matrix] = [symbol_matrix(str(k)) for k in range(9)]
    for left, right in rules:
        matrices.append(times(matrices[left], matrices[right]))
    out = []
    for sequence in compressed:
        product = matrices[sequence[0]]
        for k in sequence[1:].tolist():
            product = times(product, matrices[k])
        out.append(product)
    return out


def order_of(audits: Sequence[str | None]) -> list[int | None]:
    """Place of each way's letters among the ways from the same state."""
    ranks: list[int | None] = [None] * 16
    for i in range(4):
        for rank, j in enumerate(sorted((j for j in range(4) if audits[4 * i + j] is not None), key=lambda j: audits[4 * i + j])):
            ranks[4 * i + j] = rank
    return ranks


SOLVED = "symbols string, costs array<bigint>, ranks array<int>, audits array<string>"


def _solve(batches):
    def out(sequences):
        rows = [(s, [e and e[0] for e in m], [e and str(e[1]) for e in m]) for s, m in zip(sequences, solve(sequences), strict=True)]
        return pa.RecordBatch.from_arrays([
            pa.array([s for s, _, _ in rows]), pa.array([c for _, c, _ in rows], pa.list_(pa.int64())),
            pa.array([order_of(a) for _, _, a in rows], pa.list_(pa.int32())), pa.array([a for _, _, a in rows], pa.list_(pa.string()))],
            names=["symbols", "costs", "ranks", "audits"])

    held, size = [], 0
    for batch in batches:
        for symbols in batch.column("symbols").to_pylist():
            held.append(symbols)
            size += len(symbols)
            if size >= BATCH_SYMBOLS:
                yield out(held)
                held, size = [], 0
    if held:
        yield out(held)


def damage(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) after reproducible damage: by the CRC-32 of ``conv_id:turn`` modulo 20, 0 drops a row, 1 empties its text, 2 takes
    its stops away, 3 repeats it, 4 makes it the user's. Nulls count as one space, but a null conv_id or turn stays null as such."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(blank(conv_id), F.lit(":"), blank(turn)), "UTF-8")) % 20
    said = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(blank(text), "".join(STOPS), "")).otherwise(blank(text))
    rows = df.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(blank(role)).alias("role"),
                     said.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("times", "copy")


def conversation_key(conv_id: Column) -> Column:
    """Text that is never null, for joins in which a null conversation is one of its own."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


class BlockBuilder:
    """Rows of one conversation, in order, until the block is full."""

    FIELDS = ("key string, part int, seq int, symbols string, roles array<string>, texts array<string>, blank bigint, duplicate bigint, truncated bigint, "
              "illegal bigint, turns bigint, least bigint, most bigint, first_turn bigint, last_turn bigint, first_role string, last_role string")

    def __init__(self, key: str, part: int, seq: int, before: tuple | None, rows: int):
        self.key, self.part, self.seq, self.rows = key, part, seq, rows
        self.before = before  # (turn, initial) of the row before it in this partition
        self.symbols, self.roles, self.texts, self.bytes = [], [], [], 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.least = self.most = self.first = None

    def add(self, turn, role, text, fault) -> None:
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before[1] + initial not in ("su", "ua", "au")
        self.turns += turn is not None and (self.before is None or self.before[0] != turn)
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.most = turn
        self.before = (turn, initial)
        self.first = self.first or self.before
        if fault:
            self.faults[fault] += 1
        kind = CLASSES.index(initial) if initial and initial in "sua" else 3
        self.symbols.append(GONE if fault in ("blank", "duplicate") else str(2 * kind + (fault == "truncated")))
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text)

    def full(self) -> bool:
        return len(self.symbols) >= self.rows or self.bytes >= BLOCK_BYTES

    def record(self) -> tuple:
        return (self.key, self.part, self.seq, "".join(self.symbols), self.roles, self.texts, *self.faults.values(), self.illegal, self.turns, self.least, self.most,
                *(x for pair in zip(self.first, self.before, strict=True) for x in pair))


def _batched(records: Iterable[tuple], names: list[str], types: list[pa.DataType], rows: int = 512, size: int = BLOCK_BYTES, weigh=lambda r: 0) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for record in records:
        held.append(record)
        weight += weigh(record)
        if len(held) >= rows or weight >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


BLOCK_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), *[pa.int64()] * 9, pa.string(), pa.string()]


def _blocks(block_rows: int):
    """Rows come sorted by conversation and place."""
    def records(batches):
        part, block = TaskContext.get().partitionId(), None
        for batch in batches:
            for key, turn, role, text, fault in zip(*(batch.column(c).to_pylist() for c in ("key", "turn", "role", "text", "fault")), strict=True):
                if block is None or block.key != key:
                    if block is not None:
                        yield block.record()
                    block = BlockBuilder(key, part, 0, None, block_rows)
                elif block.full():
                    yield block.record()
                    block = BlockBuilder(key, part, block.seq + 1, block.before, block_rows)
                block.add(turn, role, text, fault)
        if block is not None:
            yield block.record()

    names = [f.split()[0] for f in BlockBuilder.FIELDS.split(", ")]
    return lambda batches: _batched(records(batches), names, BLOCK_TYPES, weigh=lambda r: sum(map(len, r[5])))


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` (with key, turn, role, text, row) and ``fault``: the first of blank, duplicate, truncated that a row has, or null."""
    end = F.substring(F.rtrim("text", F.lit(BLANK)), -1, 1)
    same = ["key", "role", "digest"]
    told = rows.withColumn("digest", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
    firsts = told.groupBy(*same).agg(F.min(F.struct("turn", "row")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    met = told.join(settle(firsts.select(*same, F.col("first.row").alias("first_row"))), same, "left")
    fault = F.when(end == "", "blank").when(F.col("row") != F.col("first_row"), "duplicate").when(~end.isin(*STOPS), "truncated")
    return met.withColumn("fault", fault).drop("digest", "first_row")


def _array(rows: list, kind) -> np.ndarray:
    return np.array([[np.inf if x is None else x for x in r] for r in rows], dtype=kind).reshape(-1, 4, 4)


def _suffix(costs: np.ndarray, ranks: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Cheapest cost from each state to ``end`` over all blocks, and the state that each block leads to from each state."""
    rest = np.full(4, np.inf)
    rest[end] = 0
    choice = np.zeros((len(costs), 4), dtype=np.int64)
    for n in range(len(costs) - 1, -1, -1):
        total = costs[n] + rest[None, :]
        least = total.min(axis=1)
        tied = np.where((total == least[:, None]) & np.isfinite(total), ranks[n], np.inf)
        choice[n], rest = tied.argmin(axis=1), least
    return rest, choice


def multiply(costs: list, ranks: list) -> tuple[list, list]:
    """Costs and order of letters of the product of consecutive blocks."""
    c, r = _array(costs, float), _array(ranks, float)
    out_costs: list = [None] * 16
    paths: list = [None] * 16
    for end in range(4):
        total, choice = _suffix(c, r, end)
        for i in range(4):
            if np.isfinite(total[i]):
                out_costs[4 * i + end] = int(total[i])
                state, path = i, []
                for n in range(len(c)):
                    state_next = int(choice[n, state])
                    path.append(r[n, state, state_next])
                    state = state_next
                paths[4 * i + end] = path
    return out_costs, order_of(paths)


def _grouped(batch_rows: dict[str, list], order: str) -> dict[str, list]:
    at = sorted(range(len(batch_rows[order])), key=batch_rows[order].__getitem__)
    return {k: [v[n] for n in at] for k, v in batch_rows.items()}


def _up(fan: int):
    def run(table: pa.Table) -> pa.Table:
        rows = _grouped(table.to_pydict(), "unit")
        costs, ranks = multiply(rows["costs"], rows["ranks"])
        return pa.table({"key": rows["key"][:1], "unit": [rows["unit"][0] // fan], "units": [-(-rows["units"][0] // fan)],
                         "costs": pa.array([costs], pa.list_(pa.int64())), "ranks": pa.array([ranks], pa.list_(pa.int32()))})
    return run


def _down(table: pa.Table) -> pa.Table:
    rows = _grouped(table.to_pydict(), "unit")
    _, choice = _suffix(_array(rows["costs"], float), _array(rows["ranks"], float), rows["leaves"][0])
    states = [rows["enters"][0]]
    for n in range(len(choice)):
        states.append(int(choice[n, states[-1]]))
    return pa.table({"key": rows["key"], "unit": rows["unit"], "enters": pa.array(states[:-1], pa.int32()), "leaves": pa.array(states[1:], pa.int32())})


UNIT = "key string, unit bigint, units bigint, costs array<bigint>, ranks array<int>"
STATES = "key string, unit bigint, enters int, leaves int"


def chosen_states(units: DataFrame, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(key, unit, enters, leaves) of every block on the best way, and (key, leaves, cost) of every conversation.

    ``units`` has one matrix a block. Conversations of one block are decided at once, longer ones climb the tree ``fan`` blocks a step.
    """
    levels = [settle(units)]
    while levels[-1].filter("units > 1").limit(1).count():
        several = levels[-1].filter("units > 1").withColumn("above", F.floor(F.col("unit") / fan))
        levels.append(settle(several.groupBy("key", "above").applyInArrow(_up(fan), UNIT)))
    ways = [F.struct((F.col("costs")[j] + INSERT * TAIL[j]).alias("cost"), F.col("ranks")[j].alias("rank"), F.lit(j).alias("leaves")) for j in range(4)]
    best = F.array_min(F.filter(F.array(*ways), lambda w: w["cost"].isNotNull()))
    roots = [level.filter("units = 1").select("key", "unit", F.lit(0).alias("enters"), best.alias("best")).select("key", "unit", "enters", "best.leaves", "best.cost") for level in levels]
    ends = roots[0]
    for root in roots[1:]:
        ends = ends.unionByName(root)
    states = roots[-1].drop("cost")
    for k in range(len(levels) - 2, -1, -1):
        above = states.withColumnRenamed("unit", "above")
        met = levels[k].filter("units > 1").withColumn("above", F.floor(F.col("unit") / fan)).join(above, ["key", "above"])
        states = settle(met.groupBy("key", "above").applyInArrow(_down, STATES).unionByName(roots[k].drop("cost")))
    return states, ends.select("key", "leaves", "cost")


REPAIRED = "key string, unit bigint, place int, role string, text string"


def _repair(batches):
    def records():
        for batch in batches:
            for key, unit, enters, audit, tail, roles, texts in zip(*(batch.column(c).to_pylist() for c in ("key", "unit", "enters", "audit", "tail", "roles", "texts")), strict=True):
                state, n, place = enters, 0, 0
                for letter in audit + tail:
                    if letter == "D":
                        n += 1
                        continue
                    initial = roles[n][:1] if letter == "K" else TURN[state]
                    yield (key, unit, place, roles[n] if letter == "K" else NAMES[initial], "" if letter == "I" else texts[n])
                    state, n, place = NEXT[state, initial], n + (letter != "I"), place + 1

    return _batched(records(), [f.split()[0] for f in REPAIRED.split(", ")], [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()],
                    rows=4096, weigh=lambda r: len(r[4]))


def repair(df: DataFrame, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """What was wrong and the cheapest repair: one row a conversation, and the rows of the repaired conversations.

    ``df`` has conv_id, turn (bigint), role and text, of which role and text are not null. Rows are taken by turn, nulls first; rows of one turn by role and text, so
    equal rows stand together. The first result has (key, gaps, blank, duplicate, truncated, illegal, cost, audit), the second (key, unit,
    place, role, text) to be read in the order of unit and place; ``key`` is ``conversation_key(conv_id)``. A null conv_id is a conversation.
    Conversations without a row in ``df`` are in neither; a conversation that is repaired to nothing is in the first only. Very long
    texts and conversations are whole. A role that does not start with s, u or a, the empty one too, can't be kept. An empty table gives empty results.
    """
    rows = settle(df.select(conversation_key(F.col("conv_id")).alias("key"), "turn", "role", "text", F.monotonically_increasing_id().alias("row")))
    order = [F.col(c).asc_nulls_first() for c in ("key", "turn", "role", "text", "row")]
    blocks = settle(with_faults(rows).repartitionByRange(*order).sortWithinPartitions(*order).select("key", "turn", "role", "text", "fault")
                    .mapInArrow(_blocks(block_rows), BlockBuilder.FIELDS))
    solved = settle(blocks.select("symbols").distinct().repartitionByRange("symbols").sortWithinPartitions("symbols").mapInArrow(_solve, SOLVED))
    # blocks of a conversation are numbered through, over the partitions that it lies in
    parts = blocks.groupBy("key", "part").agg(F.count("*").alias("n"), *[F.min_by(c, "seq").alias(c) for c in ("first_turn", "first_role")],
                                              *[F.max_by(c, "seq").alias(c) for c in ("last_turn", "last_role")])
    whole, upto = Window.partitionBy("key"), Window.partitionBy("key").orderBy("part")
    seam = F.concat(F.lag("last_role").over(upto), F.col("first_role"))
    parts = settle(parts.select("key", "part", (F.sum("n").over(upto) - F.col("n")).alias("offset"), F.sum("n").over(whole).alias("units"),
                                (~seam.isin("su", "ua", "au")).cast("int").alias("illegal"), (F.lag("last_turn").over(upto) == F.col("first_turn")).cast("int").alias("turns")))
    numbered = blocks.join(parts.select("key", "part", "offset", "units"), ["key", "part"]).withColumn("unit", F.col("offset") + F.col("seq")).drop("offset")
    states, ends = chosen_states(numbered.select("key", "unit", "units", "symbols").join(solved.drop("audits"), "symbols").select("key", "unit", "units", "costs", "ranks"), fan)
    tail = F.element_at(F.array(*[F.lit("I" * TAIL[j]) for j in range(4)]), F.col("leaves") + 1)
    told = numbered.select("key", "unit", "units", "symbols").join(states, ["key", "unit"]).join(solved.select("symbols", "audits"), "symbols")
    told = settle(told.select("key", "unit", "enters", F.element_at("audits", 4 * F.col("enters") + F.col("leaves") + 1).alias("audit"),
                              F.when(F.col("unit") == F.col("units") - 1, tail).otherwise("").alias("tail")))
    audits = told.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("unit", F.concat("audit", "tail").alias("letters")))).alias("ways"))
    audits = audits.select("key", F.array_join("ways.letters", "").alias("audit"))
    seams = parts.groupBy("key").agg(F.coalesce(F.sum("illegal"), F.lit(0)).alias("more_illegal"), F.coalesce(F.sum("turns"), F.lit(0)).alias("fewer_turns"))
    sums = blocks.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns")], F.min("least").alias("least"), F.max("most").alias("most"))
    found = sums.join(seams, "key").join(ends.select("key", "cost"), "key").join(audits, "key").select(
        "key", F.coalesce(F.col("most") - F.col("least") + 1 - (F.col("turns") - F.col("fewer_turns")), F.lit(0)).alias("gaps"),
        "blank", "duplicate", "truncated", (F.col("illegal") + F.col("more_illegal")).alias("illegal"), "cost", "audit")
    repaired = numbered.select("key", "unit", "roles", "texts").join(told, ["key", "unit"]).mapInArrow(_repair, REPAIRED)
    return found, repaired


def _digest(batches):
    """Rows come sorted by conversation and place; a conversation streams through its hash and is never held."""
    def records():
        at, digest = None, None
        for batch in batches:
            for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "role", "text")), strict=True):
                if key != at:
                    if at is not None:
                        yield at, digest.hexdigest()
                    at, digest = key, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
        if at is not None:
            yield at, digest.hexdigest()

    return _batched(records(), ["key", "repaired_sha256"], [pa.string(), pa.string()])


def digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation as ``role:text`` lines."""
    return repaired.repartition("key").sortWithinPartitions("key", "unit", "place").select("key", "role", "text").mapInArrow(_digest, "key string, repaired_sha256 string")


def repair_damaged(df: DataFrame, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """One row for every conv_id of ``df``: its faults after ``damage``, the cheapest repair, and the digest of the repaired text.

    A conversation that loses all its rows has zeros, no letters and the digest of nothing. Other columns are left behind, whatever their names.
    """
    found, repaired = repair(damage(df), block_rows, fan)
    every = df.select("conv_id").distinct().withColumn("key", conversation_key(F.col("conv_id")))
    out = every.join(found, "key", "left").join(digests(repaired), "key", "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
