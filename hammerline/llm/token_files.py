"""Token files: one zstandard frame a document, a seek table at the end, a checksum on every frame.

Layout of a file, which any zstandard decoder can read as a whole:

    frame of document 0 | frame of document 1 | ... | skippable frame: index | skippable frame: seek table

The index holds a JSON header (bucket, part, width of an id in bytes) and the doc_ids as signed 64-bit integers. The seek table
has for each frame its compressed and decompressed size and the low 32 bits of the XXH64 of its content, then the number of frames, a
descriptor and the seekable magic number, as in the public seekable format: they are the last bytes of the file, where its readers look.
Files are written as rows of Spark's text writer, so they reach any store that Spark can write, and a task that is run again
leaves no second copy. That writer ends a row with a separator; it is set to the one byte with which the magic number ends.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hammerline.llm import tokens
from hammerline.llm.common import DOC_ID, bucket_bounds, bucket_of, n_buckets, narrow, slices
from hammerline.session import settle, shared_dir

FILE_BYTES = 32 << 20  # a file is closed once it holds as many compressed bytes
WIDTH = 2
# Magic numbers of the public formats.
SKIP_INDEX, SKIP_SEEK = 0x184D2A50, 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKED = 0x80
LAST = bytes([SEEKABLE >> 24])  # the byte that the writer adds


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


class FileBuilder:
    """Collects documents of one bucket; ``close`` gives the file without the writer's last byte."""

    def __init__(self, bucket: int, part: int):
        self.bucket, self.part = bucket, part
        self.frames, self.entries, self.ids, self.size = [], [], [], 0
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.compressor.compress(ids)
        self.frames.append(frame)
        self.entries.append(struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.ids.append(doc_id)
        self.size += len(frame)

    def close(self) -> bytes:
        header = json.dumps({"bucket": self.bucket, "part": self.part, "width": WIDTH, "missing": [k for k, i in enumerate(self.ids) if i is None]}).encode()
        index = struct.pack("<I", len(header)) + header + np.array([i or 0 for i in self.ids], dtype="<i8").tobytes()
        seek = b"".join(self.entries) + struct.pack("<IBI", len(self.entries), CHECKED, SEEKABLE)
        return b"".join(self.frames) + _skippable(SKIP_INDEX, index) + _skippable(SKIP_SEEK, seek)[:-1]


class FileReader:
    """Reads a token file; ``document`` decompresses only the frame asked for and checks both its checksums."""

    def __init__(self, content: bytes):
        if len(content) < 17:
            raise ValueError("not a token file: the end is missing")
        self.content = memoryview(content)
        n, descriptor, magic = struct.unpack("<IBI", content[-9:])
        if magic != SEEKABLE or descriptor != CHECKED:
            raise ValueError("not a token file: no seek table")
        table = len(content) - 9 - 12 * n
        self.table = np.frombuffer(content, dtype="<u4", count=3 * n, offset=table).reshape(n, 3)
        if struct.unpack("<II", content[table - 8:table]) != (SKIP_SEEK, 12 * n + 9):
            raise ValueError("the seek table is damaged")
        self.offsets = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        at = int(self.offsets[-1])
        magic, size = struct.unpack("<II", content[at:at + 8])
        if magic != SKIP_INDEX or at + 8 + size != table - 8:
            raise ValueError("the index is damaged")
        length, = struct.unpack("<I", content[at + 8:at + 12])
        self.header = json.loads(content[at + 12:at + 12 + length])
        ids = np.frombuffer(content, dtype="<i8", count=n, offset=at + 12 + length).tolist()
        missing = set(self.header["missing"])
        self.doc_ids = [None if k in missing else i for k, i in enumerate(ids)]
        self.decompressor = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.table)

    def lengths(self) -> np.ndarray:
        """Ids of each document, from the seek table alone."""
        return self.table[:, 1].astype(np.int64) // self.header["width"]

    def document(self, k: int) -> np.ndarray:
        ids = self.decompressor.decompress(self.content[self.offsets[k]:self.offsets[k + 1]])
        if len(ids) != self.table[k, 1] or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"document {k} does not match its checksum")
        return np.frombuffer(ids, dtype="<u2").astype("<u4")


def _encode(path: str, bounds: np.ndarray):
    def run(batches):
        encode = tokens.encoder(path).encode
        end = np.uint16(tokens.END_ID).tobytes()
        for part in slices(batches):
            ids = [i + end for i in encode([t or b"" for t in part.column("text").to_pylist()])]
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(part.column("doc_id"), bounds)), part.column("doc_id"), pa.array(ids, pa.binary())],
                                             names=["bucket", "doc_id", "ids"])
    return run


def _build(file_bytes: int):
    def run(batches):
        build = None

        def closed(b):
            return pa.RecordBatch.from_arrays([pa.array([b.close()], pa.binary())], names=["file"])

        for part in slices(batches):
            for bucket, doc_id, ids in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if build and (build.bucket != bucket or build.size >= file_bytes):
                    yield closed(build)
                    build = FileBuilder(bucket, build.part + 1 if build.bucket == bucket else 0)
                build = build or FileBuilder(bucket, 0)
                build.add(doc_id, ids)
        if build:
            yield closed(build)
    return run


def write(df: DataFrame, path: str, id_col: str = DOC_ID, text_col: str = "text", tokenizer: str | None = None, file_bytes: int = FILE_BYTES) -> None:
    """Encode every text and write token files under ``path``, documents in ascending doc_id within and across files.

    Null texts are empty (their one id is the end id); null doc_ids come last; rows of one doc_id all get a frame.
    An empty table leaves a folder without token files.
    """
    base = narrow(df, id_col, text_col, binary=True)
    buckets = n_buckets(df.sparkSession)
    rows = base.mapInArrow(_encode(tokenizer or tokens.default_path(), bucket_bounds(base, DOC_ID, buckets)), "bucket int, doc_id bigint, ids binary")
    rows = rows.repartition(max(1, buckets // 4), "bucket").sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_last(), "ids")
    files = rows.mapInArrow(_build(file_bytes), "file binary").select(F.col("file").cast("string").alias("value"))
    files.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", LAST.decode("ISO-8859-1")).option("compression", "none").text(path)


def _read(batches):
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
            if not content:
                continue
            reader = FileReader(content)
            n = len(reader)
            starts = np.cumsum(reader.lengths()) - reader.lengths()
            sums = [zlib.crc32(reader.document(k).tobytes()) for k in range(n)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, reader.header["bucket"], dtype=np.int32)), pa.array(np.full(n, reader.header["part"], dtype=np.int32)), pa.array(reader.doc_ids, pa.int64()),
                pa.array(starts), pa.array(reader.lengths()), pa.array(sums, pa.int64())],
                names=["bucket", "part", "doc_id", "start", "n_tokens", "ids_crc32"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files under ``path``; start counts the ids of all files before."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    rows = settle(found.mapInArrow(_read, "bucket int, part int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))
    # a bucket's total, of which there are as many as buckets; then the files of each bucket
    files = rows.groupBy("bucket", "part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = files.groupBy("bucket").agg(F.sum("n").alias("n"))
    totals = totals.select("bucket", F.coalesce(F.sum("n").over(earlier.orderBy("bucket")), F.lit(0)).alias("bucket_start"))
    files = files.join(totals, "bucket").select("bucket", "part", (F.col("bucket_start") + F.coalesce(
        F.sum("n").over(earlier.partitionBy("bucket").orderBy("part")), F.lit(0))).alias("file_start"))
    return rows.join(files, ["bucket", "part"]).select("doc_id", (F.col("file_start") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def read_document(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """(doc_id, ids) of the documents with this id; every other frame is left compressed."""
    def run(batches):
        for batch in batches:
            for content in batch.column("content").to_pylist():
                if content:
                    reader = FileReader(content)
                    ids = [reader.document(k).tolist() for k, i in enumerate(reader.doc_ids) if i == doc_id]
                    yield pa.RecordBatch.from_arrays([pa.array([doc_id] * len(ids), pa.int64()), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInArrow(run, "doc_id bigint, ids array<bigint>")


def write_and_read(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Write token files to the shared folder and read them back."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write(df, path, id_col, text_col, tokenizer)
    return read(df.sparkSession, path)
