"""SentencePiece: a plain Viterbi per word, the library under its unigram search, and exact round trips."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hammerline.llm import pieces
from tests.llm.conftest import rows_of


@pytest.fixture(scope="module")
def model():
    return pieces.pieces(pieces.default_path())


def plain(model, text):
    """Segmentation of a whole marked text at once."""
    if not text:
        return []
    s = pieces.MARK + text.replace(pieces.MARK, pieces.HELD).replace(" ", pieces.MARK)
    best = [(0.0, None)] + [None] * len(s)
    for end in range(1, len(s) + 1):
        for start in range(end):
            p = model.scores.get(s[start:end])
            options = [] if p is None else [(best[start][0] + p[0], (start, p[1]))]
            if start == end - 1 and p is None:
                options.append((best[start][0] + model.unknown, (start, None)))
            for o in options:
                if best[end] is None or o[0] > best[end][0]:
                    best[end] = o
    out, at = [], len(s)
    while at:
        start, piece = best[at][1]
        out[:0] = [piece] if piece is not None else [model.bytes[b] for b in s[start:at].replace(pieces.HELD, pieces.MARK).encode()]
        at = start
    return out


def ids(model, text):
    return np.frombuffer(model.encode([text])[0], dtype="<u4")


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abetn the  ▁\ue000\n.é"), st.characters(exclude_categories=["Cs"])), max_size=30))
def test_search_and_round_trip(model, text):
    got = ids(model, text)
    assert got.tolist() == plain(model, text)
    assert model.decode(got) == text


def test_agrees_with_the_library(model):
    """The library finds the same ids when the vocabulary's kind is set to the one that it searches this way."""
    from sentencepiece import SentencePieceProcessor
    raw = open(pieces.default_path(), "rb").read()
    spm = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = spm.ModelProto.FromString(raw)
    proto.trainer_spec.model_type = 1
    library = SentencePieceProcessor(model_proto=proto.SerializeToString())
    for text in ("The quick brown fox jumps over the lazy dog.", "des mots français ordinaires", "internationalization of words"):
        assert ids(model, text).tolist() == library.encode(text)


def test_rows(edge, edge_rows, model):
    want = sorted(((i, len(x := ids(model, t or "")), zlib.crc32(x.tobytes()), len(t or ""), hashlib.sha256((t or "").encode()).hexdigest(), True)
                   for i, t in edge_rows), key=repr)
    assert rows_of(pieces.round_trip(edge), "doc_id", "n_pieces", "ids_crc32", "n_chars", "decoded_sha256", "same") == want


def test_encode_then_decode(edge, edge_rows, empty):
    back = pieces.decoded(pieces.encoded(edge))
    assert rows_of(back, "doc_id", "text") == sorted(((i, t or "") for i, t in edge_rows), key=repr)
    assert pieces.decoded(pieces.encoded(empty)).count() == 0


def test_sample(sample):
    assert pieces.round_trip(sample).filter("NOT same").count() == 0
