"""Lines that many documents share stay in one of them.

Two Bloom filters say which long lines may stand in more than one document: the first takes the hash of every line once seen, the second
those seen again. Tasks fill their own pair over their texts; pairs merge chunk by chunk, where a bit that two tasks have in their first
filters goes to the second. The merged second filter reaches every task, and only lines in it ("suspects") are shuffled, as digests, to be
counted exactly. A line that the filter names wrongly is counted once and stays, so the filters decide what travels, never the result.

The filters have 8 bits for each line that the texts can hold, at most MOST_BITS: that bounds what is broadcast. Past that size the
filters fill and more lines are suspected; results are the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerline.llm.common import DOC_ID, narrow, slices
from hammerline.session import settle

LEAST_CHARS = 40
LEAST_DOCS = 5
CHUNK_BITS = 20
MOST_BITS = 2**28  # 32 MB, the most that is broadcast
PROBES = 3  # bits a hash sets, all in one chunk
BLANK = b" \t\n\x0b\x0c\r"


def long_lines(text: bytes, least_chars: int) -> Iterator[tuple[int, bytes]]:
    """(line number, key) of the lines whose keys have at least ``least_chars`` code points."""
    for n, line in enumerate(text.split(b"\n")):
        if len(line) >= least_chars:
            key = line.strip(BLANK).lower()  # bytes: A-Z alone
            if len(key) >= least_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= least_chars):
                yield n, key


class Filter:
    """A Bloom filter of 2**20 bits a chunk; the top of a hash chooses the chunk, its low 60 bits three places there."""

    def __init__(self, chunks: int):
        self.bits = np.zeros((chunks, 2**CHUNK_BITS // 8), dtype=np.uint8)

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        """Numbers of the bits of each hash. Multiplying spreads the hash, so that chunk and places do not share bits."""
        chunk = ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & (len(self.bits) - 1)
        for k in range(PROBES):
            yield (chunk << CHUNK_BITS) + ((hashes >> np.uint64(CHUNK_BITS * k)) & np.uint64(2**CHUNK_BITS - 1)).astype(np.int64)

    def add(self, hashes: np.ndarray) -> None:
        if len(hashes):
            places = np.unique(np.concatenate(list(self._places(hashes))))
            values, starts = np.left_shift(1, places & 7).astype(np.uint8), np.flatnonzero(np.diff(places >> 3, prepend=-1))
            self.bits.reshape(-1)[places[starts] >> 3] |= np.bitwise_or.reduceat(values, starts)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found, bits = np.ones(len(hashes), dtype=bool), self.bits.reshape(-1)
        for places in self._places(hashes):
            found &= (bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)
        return found


def _fill(chunks: int, least_chars: int):
    def run(batches):
        once, twice = Filter(chunks), Filter(chunks)
        for part in slices(batches):
            hashes = [xxhash.xxh3_64_intdigest(key) for text in part.column("text").to_pylist() if text for key in {key for _, key in long_lines(text, least_chars)}]
            found, times = np.unique(np.array(hashes, dtype=np.uint64), return_counts=True)
            twice.add(found[(times > 1) | once.has(found)])
            once.add(found)
        pack = zstandard.ZstdCompressor(level=1).compress
        for k in np.flatnonzero(once.bits.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pack(once.bits[k].tobytes())]), pa.array([pack(twice.bits[k].tobytes())])],
                                             names=["chunk", "once", "twice"])
    return run


def _merge(batches):
    """Chunks come sorted: one pair of chunk filters is held at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    pack = zstandard.ZstdCompressor(level=1).compress
    at, once, twice = None, None, None

    def closed():
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([pack(twice.tobytes())])], names=["chunk", "twice"])

    for batch in batches:
        for chunk, packed_once, packed_twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if chunk != at:
                if at is not None:
                    yield closed()
                at, once, twice = chunk, np.zeros(2**CHUNK_BITS // 8, np.uint8), np.zeros(2**CHUNK_BITS // 8, np.uint8)
            other = np.frombuffer(unpack(packed_once), np.uint8)
            twice |= np.frombuffer(unpack(packed_twice), np.uint8) | (once & other)
            once |= other
    if at is not None:
        yield closed()


def repeat_filter(texts: DataFrame, least_chars: int = LEAST_CHARS, most_bits: int = MOST_BITS) -> Filter:
    """The filter of lines that stand in two documents or more; at most ``most_bits`` bits come to the driver."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = 8 * size // (least_chars + 1)
    chunks = 1 << max(0, (min(bits, most_bits) >> CHUNK_BITS).bit_length() - (bits >= most_bits))
    pairs = texts.select("text").mapInArrow(_fill(chunks, least_chars), "chunk int, once binary, twice binary")
    merged = pairs.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_merge, "chunk int, twice binary")
    found = Filter(chunks)
    for chunk, packed in merged.collect():
        found.bits[chunk] = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return found


def _suspects(shared, least_chars: int):
    def run(batches):
        twice = Filter(0)
        twice.bits = np.stack([np.frombuffer(zstandard.ZstdDecompressor().decompress(c), np.uint8) for c in shared.value])
        for part in slices(batches):
            rows, keys, lines = [], [], []
            for row, text in zip(part.column("row").to_pylist(), part.column("text").to_pylist(), strict=True):
                places: dict[bytes, list[int]] = {}
                for n, key in long_lines(text or b"", least_chars):
                    places.setdefault(key, []).append(n)
                rows += [row] * len(places)
                keys += places
                lines += places.values()
            named = np.flatnonzero(twice.has(np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64))).tolist()
            ids = dict(zip(part.column("row").to_pylist(), part.column(DOC_ID).to_pylist(), strict=True))
            yield pa.RecordBatch.from_arrays([
                pa.array([rows[k] for k in named], pa.int64()), pa.array([ids[rows[k]] for k in named], part.schema.field(DOC_ID).type),
                pa.array([hashlib.blake2b(keys[k], digest_size=16).digest() for k in named], pa.binary()),
                pa.array([lines[k] for k in named], pa.list_(pa.int32()))], names=["row", DOC_ID, "line", "places"])
    return run


def _drop(batches):
    for part in slices(batches):
        ids, texts, places = (part.column(c) for c in (DOC_ID, "text", "places"))
        counts, dropped, kept = [], [], []
        for text, gone in zip(texts.to_pylist(), places.to_pylist(), strict=True):
            lines = (text or b"").split(b"\n")
            out = set(gone or ())
            counts.append(len(lines))
            dropped.append(len(out))
            kept.append(b"\n".join(line for n, line in enumerate(lines) if n not in out) if out else text or b"")
        yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                                         names=[DOC_ID, "n_lines", "n_dropped", "text"])


def dedup_lines(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS,
                most_bits: int = MOST_BITS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) of every row, texts without the lines that they share with a larger doc_id.

    A line's key is the line without the blanks at its ends, A-Z lower-cased. A key of at least ``least_chars`` code points that stands in
    ``least_docs`` rows or more keeps its lines (all of them) in the rows of the largest doc_id that holds it and loses them elsewhere.
    Null and empty texts are one empty line. A null doc_id is below all others; each row counts as a document, so repeated rows count
    each, and all rows of the largest doc_id keep the line. Very long texts are read whole; other columns are left behind, whatever
    their names; an empty table gives an empty result.
    """
    spark = df.sparkSession
    rows = settle(narrow(df, id_col, text_col, binary=True).select(F.monotonically_increasing_id().alias("row"), DOC_ID, "text"))
    found = repeat_filter(rows, least_chars, most_bits)
    pack = zstandard.ZstdCompressor(level=1).compress
    shared = spark.sparkContext.broadcast([pack(chunk.tobytes()) for chunk in found.bits])
    id_type = rows.schema[DOC_ID].dataType.simpleString()
    suspects = settle(rows.mapInArrow(_suspects(shared, least_chars), f"row bigint, {DOC_ID} {id_type}, line binary, places array<int>"))
    held = settle(suspects.groupBy("line").agg(F.count("*").alias("docs"), F.max(DOC_ID).alias("holder")).filter(F.col("docs") >= least_docs).drop("docs"))
    gone = suspects.join(held, "line").filter(~F.col(DOC_ID).eqNullSafe(F.col("holder"))).groupBy("row").agg(F.flatten(F.collect_list("places")).alias("places"))
    # one plan at every size: whole texts are neither broadcast nor hashed into memory
    met = rows.join(settle(gone).hint("merge"), "row", "left").select(DOC_ID, "text", "places")
    return met.mapInArrow(_drop, f"{DOC_ID} {id_type}, n_lines bigint, n_dropped bigint, text string")
