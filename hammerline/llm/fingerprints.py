"""Document fingerprints: weighted terms vote on signed bits; permuted block tables find neighbours.

Terms are the pairs of adjacent words of a text (the word itself if it has one). A term weighs
(1 + ln count) * ln(1 + bytes): repeats count less and less, and long terms, which are rare in any language, more
than the short ones that every text has. So a fingerprint depends on its text alone, never on the corpus, and
equal texts have equal fingerprints. Each term's hash adds its weight to the bits it sets and takes it from the others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hammerline.llm import hamming
from hammerline.llm.common import DOC_ID, bucket_bounds, bucket_of, map_texts, n_buckets, narrow, slices
from hammerline.session import settle

RADIUS = 3
SEED = 42
SPREAD = np.uint64(0x9E3779B97F4A7C15)  # an odd number without pattern
SCALE, CHUNK = 16, 1024  # a chunk's votes stay below 2^24, which 32-bit floats add exactly
REMEMBERED = 500_000


_hashes: dict[bytes, int] = {}  # of words that this Python worker has met


def _word_hashes(words: list[bytes]) -> np.ndarray:
    new = set(words).difference(_hashes)
    if new:
        if len(_hashes) > REMEMBERED:
            _hashes.clear()
            new = set(words)
        _hashes.update((w, xxhash.xxh64_intdigest(w, SEED)) for w in new)
    return np.fromiter(map(_hashes.__getitem__, words), dtype="<u8", count=len(words))


def fingerprint(text: str) -> int:
    """Signed 64-bit SimHash of the weighted terms of a text; 0 without a word."""
    words = text.encode().lower().split()
    if not words:
        return 0
    hashes = _word_hashes(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    if len(words) > 1:
        # a pair's hash: its words' hashes, the second one turned and spread, mixed
        first, second = hashes[:-1], hashes[1:] * SPREAD
        hashes = (first ^ (second << np.uint64(31)) ^ (second >> np.uint64(33))) * SPREAD
        hashes ^= hashes >> np.uint64(29)
        sizes = sizes[:-1] + sizes[1:] + 1
    hashes, at, counts = np.unique(hashes, return_index=True, return_counts=True)
    # in small whole numbers: sums are exact, in whatever order
    weights = np.rint((1 + np.log(counts)) * np.log1p(sizes[at]) * SCALE)
    ones = np.zeros(64)
    for start in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[start:start + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += weights[start:start + CHUNK].astype(np.float32) @ bits.astype(np.float32)
    return int(np.packbits(2 * ones > weights.sum(), bitorder="little").view("<i8")[0])


def likeness(a: int, b: int) -> float:
    """Share of equal bits, 0 to 1."""
    return 1 - ((a ^ b) & (2 ** 64 - 1)).bit_count() / 64


def hexed(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def fingerprints(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fp) for every row; a null text counts as empty, with fingerprint 0."""
    return map_texts(narrow(df, id_col, text_col, binary=False), "n_chars bigint, fp bigint",
                     lambda: lambda texts: [[len(t) for t in texts], [fingerprint(t) for t in texts]])


def _count_near(radius: int):
    plan = hamming.blocks_of(radius)

    def masks(block: int, inner: int) -> list[np.uint64]:
        """Bits of the tables that come before this one: a pair that agrees on one of them is counted there."""
        runs = [bits for bits, _ in plan[:block]]
        if inner >= 0:
            runs += plan[block][1][:inner]
        return [np.uint64(sum(1 << b for b in run)) for run in runs]

    def pairs(a: np.ndarray, b: np.ndarray, earlier: list[np.uint64]) -> np.ndarray:
        x = a ^ b
        near = np.bitwise_count(x) <= radius
        at = np.nonzero(near)
        found = x[at]
        for m in earlier:
            near[at] &= (found & m) != 0
        return near

    def run(batches):
        for batch in batches:
            keys = zip(batch.column("block").to_pylist(), batch.column("inner").to_pylist(), strict=True)
            tiles = ((m, o) for ms, os in hamming.tiles_of(iter([batch])) for m, o in zip(ms, os, strict=True))
            found: dict[int, int] = {}
            for (block, inner), (m, o) in zip(keys, tiles, strict=True):
                earlier, a = masks(block, inner), np.sort(m.view(np.uint64))
                b = a if o is None else np.sort(o.view(np.uint64))
                rows, columns = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
                for at in range(0, len(a), 256):
                    near = pairs(a[at:at + 256, None], b[None, :], earlier)
                    rows[at:at + 256] += near.sum(axis=1)
                    columns += near.sum(axis=0)
                if o is None and not earlier:  # a shard on itself: in the first table each fingerprint has met itself as well
                    rows -= 1
                for values, counts in ((a, rows),) if o is None else ((a, rows), (b, columns)):
                    some = np.flatnonzero(counts > 0)
                    for v, c in zip(values[some].view(np.int64).tolist(), counts[some].tolist(), strict=True):
                        found[v] = found.get(v, 0) + c
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["fp", "near"])
    return run


def neighbours(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, near): how many other distinct fingerprints lie within ``radius`` bits; those with none are left out.

    Each block table holds the fingerprints with that block of bits in front, grouped by its value and sorted, and
    compares the groups in their tasks. A pair that agrees on several blocks is counted in the first.
    """
    counted = hamming.tiles(fps.select("fp").distinct(), radius).mapInArrow(_count_near(radius), "fp bigint, near bigint")
    return counted.groupBy("fp").agg(F.sum("near").alias("near"))


def _edit(batches):
    """Each document with the one after it: rows come sorted by bucket, and a bucket ends with its successor's first text."""
    held = None
    for part in slices(batches):
        out = []
        for bucket, guest, doc_id, text, fp in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if held is not None and held[0] == bucket:
                _, key, own, mine = held
                cut = len(own) // 4
                edited = own[:len(own) - cut] + text[:cut]
                changed = fingerprint(edited)
                out.append((key, len(own), hashlib.sha256(edited.encode()).hexdigest(), mine, changed, likeness(mine, changed), likeness(mine, fp)))
            held = None if guest else (bucket, doc_id, text, fp)
        columns = list(zip(*out, strict=True)) or [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
            pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)],
            names=["doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "near_edited", "near_next"])


EDITED = "doc_id bigint, n_chars bigint, edited_sha256 string, fp bigint, edited_fp bigint, near_edited double, near_next double"


def edited(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text") -> DataFrame:
    """Every document beside its edited text: its last quarter replaced by the beginning of the next document.

    The next one is that of the next doc_id; the first follows the last. Null ids come last; rows of one id follow each
    other by text. A single document follows itself; an empty table gives an empty result. Texts are shuffled once, into buckets of
    consecutive ids; the first text of a bucket is sent along to the bucket before it.
    """
    spark, base = df.sparkSession, narrow(df, id_col, text_col, binary=False).withColumn("text", F.coalesce("text", F.lit("")))
    buckets = n_buckets(spark)
    bounds = bucket_bounds(base, DOC_ID, buckets)

    def placed(batches):
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket_of(part.column("doc_id"), bounds)), part.column("doc_id"), part.column("text"), pa.array([fingerprint(t) for t in texts], pa.int64())],
                names=["bucket", "doc_id", "text", "fp"])

    # the least id of each bucket (as many rows as there are buckets), then the least text of that id
    ids = base.select(DOC_ID).mapInArrow(_bucketed(bounds), "bucket int, doc_id bigint")
    firsts = sorted(tuple(r) for r in ids.groupBy("bucket").agg(F.min(DOC_ID)).collect())
    schema = StructType.fromDDL("bucket int, doc_id bigint")
    before = [firsts[k - 1][0] for k in range(len(firsts))]
    wanted = spark.createDataFrame([(b, key) for b, (_, key) in zip(before, firsts, strict=True)], schema)
    guests = base.join(F.broadcast(wanted), base[DOC_ID].eqNullSafe(wanted[DOC_ID])).select("bucket", wanted[DOC_ID], "text")
    guests = guests.groupBy("bucket", DOC_ID).agg(F.min("text").alias("text")).mapInArrow(_guest, "bucket int, doc_id bigint, text string, fp bigint")
    own = base.mapInArrow(placed, "bucket int, doc_id bigint, text string, fp bigint")
    rows = own.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    rows = rows.select("bucket", "guest", "doc_id", "text", "fp").repartition(max(1, buckets // 4), "bucket")
    return rows.sortWithinPartitions("bucket", "guest", F.col("doc_id").asc_nulls_last(), "text").mapInArrow(_edit, EDITED)


def _bucketed(bounds: np.ndarray):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(batch.column(0), bounds)), batch.column(0)], names=["bucket", "doc_id"])
    return run


def _guest(batches):
    for part in slices(batches):
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array([fingerprint(t) for t in part.column("text").to_pylist()], pa.int64())],
                                         names=["bucket", "doc_id", "text", "fp"])


def compare_edits(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """``edited`` with hexadecimal fingerprints and ``n_near``: other distinct fingerprints within ``radius`` bits."""
    rows = settle(edited(df, id_col, text_col))
    near = settle(neighbours(rows.select("fp"), radius))
    return rows.join(near, "fp", "left").select(
        "doc_id", "n_chars", "edited_sha256", hexed("fp").alias("fingerprint"), hexed("edited_fp").alias("edited_fingerprint"),
        "near_edited", "near_next", F.coalesce("near", F.lit(0)).alias("n_near"))
