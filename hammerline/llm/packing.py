"""Best-fit packing of documents into fixed-length sequences, by large-item matching.

How many pieces have each length is all that packing depends on, and there are at most ``capacity`` lengths, however many
documents there are. The plan is made from those counts: pieces above one third of the capacity are
matched in pairs, at most two to a sequence (the longest with the longest that still fits), and shorter ones, longest first, go to
the tightest remaining gap. The plan says which ranks of which length go to which sequences; Spark ranks the
pieces within their length and each task looks its pieces up.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hammerline.llm import tokens
from hammerline.llm.common import DOC_ID, narrow, rank_within, slices
from hammerline.session import settle

CAPACITY = 4096
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and the end id, cut only where longer than ``capacity``.

    A null text is empty (one piece, the end id); repeated rows and null ids have pieces of their own.
    """
    path = tokenizer or tokens.default_path()

    def run(batches):
        encode = tokens.encoder(path).encode
        for part in slices(batches):
            out = []
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode([t or b"" for t in part.column("text").to_pylist()]), strict=True):
                whole = tokens.with_end(ids)
                out += [(doc_id, k, at, len(cut := whole[at:at + capacity]), zlib.crc32(cut)) for k, at in enumerate(range(0, len(whole), capacity))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return narrow(df, id_col, text_col, binary=True).mapInArrow(run, PIECES)


class Plan:
    """Entries (length, first rank, copies a sequence, first sequence, sequences, offset) of a packing."""

    def __init__(self, capacity: int):
        self.capacity, self.entries, self.sequences = capacity, [], 0
        self.taken: dict[int, int] = {}
        self.open: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of (first sequence, sequences)
        self.gaps: list[int] = []

    def _put(self, length: int, per: int, first: int, n: int, offset: int) -> None:
        rank = self.taken.get(length, 0)
        self.entries.append((length, rank, per, first, n, offset))
        self.taken[length] = rank + per * n

    def _leave(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in self.open:
                self.open[gap] = []
                insort(self.gaps, gap)
            self.open[gap].append((first, n))

    def start(self, lengths: list[tuple[int, int]], n: int) -> None:
        """``n`` new sequences that all begin with these (length, copies)."""
        offset = 0
        for length, per in lengths:
            self._put(length, per, self.sequences, n, offset)
            offset += per * length
        self._leave(self.capacity - offset, self.sequences, n)
        self.sequences += n

    def fill(self, length: int, n: int) -> None:
        """``n`` pieces of one length into the tightest gaps, then into new sequences."""
        while n:
            at = bisect_left(self.gaps, length)
            if at == len(self.gaps):
                per = self.capacity // length
                if n >= per:
                    self.start([(length, per)], n // per)
                if n % per:
                    self.start([(length, n % per)], 1)
                return
            gap = self.gaps[at]
            first, sequences = self.open[gap].pop()
            if not self.open[gap]:
                del self.open[gap]
                self.gaps.pop(at)
            # the tightest gap stays the tightest until no further piece of this length fits
            per = gap // length
            full, rest = min(sequences, n // per), 0
            if full:
                self._put(length, per, first, full, self.capacity - gap)
                self._leave(gap - per * length, first, full)
            if full < sequences and 0 < n - full * per < per:
                rest = n - full * per
                self._put(length, rest, first + full, 1, self.capacity - gap)
                self._leave(gap - rest * length, first + full, 1)
            used = full + bool(rest)
            self._leave(gap, first + used, sequences - used)
            n -= full * per + rest


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """A packing of ``counts`` pieces by length into sequences of ``capacity``."""
    made, left = Plan(capacity), dict(counts)
    large = sorted(k for k in left if 3 * k > capacity)
    while large:
        longest = large[-1]
        at = bisect_left(large, capacity - longest + 1) - 1
        if at < 0:
            made.start([(longest, 1)], left.pop(large.pop()))
            continue
        partner = large[at]
        n = left[longest] // 2 if partner == longest else min(left[longest], left[partner])
        if partner == longest and n == 0:  # one is left of the length that would pair with itself: a shorter partner may do
            if at:
                partner, n = large[at - 1], 1
            else:
                made.start([(longest, 1)], left.pop(large.pop()))
                continue
        made.start([(longest, 2)] if partner == longest else [(longest, 1), (partner, 1)], n)
        for length in (longest, partner):
            left[length] -= n
        for length in {longest, partner}:
            if left[length] == 0:
                large.remove(length)
                del left[length]
    for length in sorted(left, reverse=True):
        made.fill(length, left[length])
    return made


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (settled; columns of ``pieces``) with ``sequence_id`` and ``offset``.

    Only the counts by length (at most ``capacity`` numbers) reach the driver, and only the plan made from them goes out.
    """
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    made = plan(counts, capacity)
    entries = np.array(sorted(made.entries) or np.empty((0, 6)), dtype=np.int64)
    keys = (entries[:, 0] << 44) + entries[:, 1]

    def place(batches):
        for part in slices(batches, 1 << 16):
            length, rank = (part.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            _, first_rank, per, first, _, offset = entries[at].T
            within = rank - first_rank
            kept = [c for n, c in zip(part.schema.names, part.columns, strict=True) if n != "rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(first + within // per), pa.array(offset + within % per * length)],
                                             names=[*[n for n in part.schema.names if n != "rank"], "sequence_id", "offset"])

    ranked = rank_within(rows, "length", ["doc_id", "piece", "ids_crc32", "start"])
    fields = [f for f in ranked.schema.fields if f.name != "rank"]
    return ranked.mapInArrow(place, StructType([*fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]))


def packed(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Every piece of every document with its sequence and its place there. An empty table gives an empty result."""
    return pack(settle(pieces(df, id_col, text_col, capacity, tokenizer)), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
