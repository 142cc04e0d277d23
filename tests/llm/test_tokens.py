"""Ids, token files and packing against the tokenizers library and plain sums."""

import struct
import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from hammerline.llm import packing, token_files, tokens
from hammerline.session import shared_dir
from tests.llm.conftest import rows_of


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_path())
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aB'st'll 3.\n\té́ßΣİſ<|endoftext|>\x1c\x85 "), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_encoder(library, text):
    assert tokens.with_end(tokens.encoder(tokens.default_path()).encode([text.encode()])[0]).tolist() == library(text)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def ids_of(got):
    return [None if x is None or x != x else int(x) for x in got.doc_id]


def check_files(df, rows, library):
    got = token_files.write_and_read(df).toPandas()
    assert len(got) == len(rows)
    assert sorted(zip(ids_of(got), got.n_tokens, got.ids_crc32), key=repr) == sorted(
        ((i, len(x := library(t)), crc(x)) for i, t in rows), key=repr)
    got = got.sort_values("start")
    assert got.start.tolist() == (got.n_tokens.cumsum() - got.n_tokens).tolist()
    ids = got.doc_id.fillna(1 << 60).tolist()
    assert ids == sorted(ids)


def test_files(edge, edge_rows, library):
    check_files(edge, edge_rows, library)


def test_files_of_sample(sample, library):
    check_files(sample, [tuple(r) for r in sample.select("doc_id", "text").collect()], library)


def test_many_small_files(spark, sample, library, tmp_path):
    path = f"{shared_dir(spark)}/small-files-{tmp_path.name}"
    token_files.write(sample, path, file_bytes=5000)
    rows = ordered([tuple(r) for r in sample.select("doc_id", "text").collect()])
    at, want = 0, []
    for i, t in rows:
        ids = library(t)
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert rows_of(token_files.read(spark, path), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    assert spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).count() > 40
    one = token_files.read_document(spark, path, 7).collect()
    assert [r["ids"] for r in one] == [library(dict(rows)[7])]


def test_file_is_plain_zstandard_and_checked():
    build = token_files.FileBuilder(3, 0)
    parts = [np.array(x, dtype="<u2").tobytes() for x in ([1], [5, 6, 7, 1], list(range(500)))]
    for k, p in enumerate(parts):
        build.add(k, p)
    content = build.close() + token_files.LAST
    assert zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read() == b"".join(parts)
    # the public seekable format: the footer is the end of the file, and the table lies before it
    n, descriptor, magic = struct.unpack("<IBI", content[-9:])
    assert (n, descriptor, magic) == (3, 0x80, 0x8F92EAB1) and content[-9 - 12 * n - 8:-9 - 12 * n] == struct.pack("<II", 0x184D2A5E, 12 * n + 9)
    at = 0
    for k in range(n):
        packed, plain, _ = struct.unpack("<III", content[-9 - 12 * (n - k):][:12])
        assert zstandard.ZstdDecompressor().decompress(content[at:at + packed]) == parts[k] and plain == len(parts[k])
        at += packed
    reader = token_files.FileReader(content)
    assert reader.document(1).tolist() == [5, 6, 7, 1] and reader.lengths().tolist() == [1, 4, 500]
    broken = bytearray(content)
    broken[reader.offsets[1] + 7] ^= 1
    assert token_files.FileReader(bytes(broken)).document(2).tolist() == list(range(500))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.FileReader(bytes(broken)).document(1)
    for cut in (content[:-1], content[:40], content[9:]):
        with pytest.raises(Exception):
            token_files.FileReader(cut)


def test_empty_table(spark, empty):
    assert token_files.write_and_read(empty).count() == 0
    assert packing.packed(empty).count() == 0


def check_packing(df, rows, library, capacity):
    got = packing.packed(df, capacity=capacity).toPandas()
    want = []
    for i, t in rows:
        ids = library(t)
        want += [(i, k, at, len(ids[at:at + capacity]), crc(ids[at:at + capacity])) for k, at in enumerate(range(0, len(ids), capacity))]
    columns = zip(ids_of(got), got.piece, got.start, got.length, got.ids_crc32)
    assert sorted(columns, key=repr) == sorted(want, key=repr)
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == (s.length.cumsum() - s.length).tolist() and s.length.sum() <= capacity
    return got.sequence_id.nunique(), -(-got.length.sum() // capacity)


def test_packing(edge, edge_rows, sample, library):
    check_packing(edge, edge_rows, library, 64)
    check_packing(edge, edge_rows, library, 4096)
    n, least = check_packing(sample, [tuple(r) for r in sample.select("doc_id", "text").collect()], library, 4096)
    assert n <= least + 1


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 30), max_size=25))
def test_plan(counts):
    """Every piece has one place, no sequence is over-full or has a gap, and the number is near the bound."""
    made = packing.plan(counts, 60)
    ranks, filled = {}, {}
    for length, rank, per, first, n, offset in made.entries:
        for k in range(per * n):
            ranks.setdefault(length, []).append(rank + k)
            filled.setdefault(first + k // per, []).append((offset + k % per * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert sorted(filled) == list(range(made.sequences))
    for spans in filled.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 60
        assert sum(3 * length > 60 for _, length in spans) <= 2
    large = sum(n for k, n in counts.items() if 2 * k > 60)
    total = sum(k * n for k, n in counts.items())
    assert made.sequences <= max(large, 11 * (total // 60 + 1) // 9 + 1) + sum(n for k, n in counts.items() if 20 < k <= 30) // 2 + 1


def test_matching_is_as_large_as_can_be():
    """Large pieces alone: pairs against the best of all matchings, found by trying every one."""
    from functools import lru_cache

    @lru_cache(None)
    def best(items):
        if not items:
            return 0
        rest = items[1:]
        found = best(rest)
        for k, x in enumerate(rest):
            if items[0] + x <= 60:
                found = max(found, 1 + best(rest[:k] + rest[k + 1:]))
        return found

    r = np.random.default_rng(1)
    for _ in range(60):
        items = tuple(sorted(r.integers(21, 50, 9).tolist()))
        counts = {x: items.count(x) for x in items}
        assert packing.plan(counts, 60).sequences == len(items) - best(items)


def test_plain_words_are_remembered_without_their_marks(library):
    """One library call a word: a task that meets a word between ever new marks remembers the word, not each chunk."""
    encoder = tokens.Encoder(tokens.default_path())
    texts = [f"{a}Größe{b} {b}mist{a}, l'été 'so ('re ''d x's 3a a3" for a in ("", "(", '"', "-'", "''") for b in ("", ".", "',", "'")]
    got = encoder.encode([t.encode() for t in [*texts, "", " \x0b", "<|endoftext|> mist."]])
    assert [tokens.with_end(ids).tolist() for ids in got] == [library(t) for t in [*texts, "", " \x0b", "<|endoftext|> mist."]]
    assert not {c for c in encoder.chunks if c.endswith("Größe.") and "'" not in c or c == "(Größe"}
    assert {"größe", "mist"} <= set(encoder.words)
