"""SentencePiece encoding and decoding by a Viterbi search that words with a common beginning share.

A text is marked (a space before it and every space become the word mark) and falls into marked words: runs of marks and what
follows them. No piece of a vocabulary crosses from a word's last letter to the next mark, so the best segmentation of a text
is that of its words in a row. A task sorts its distinct words, which lays out their trie depth-first, and keeps
the forward scores of the current path: a word computes only what it doesn't share with the one before.

The best segmentation has the greatest sum of the model's own scores; of equal sums, the one whose last piece is longest. A character
that no piece covers costs ten less than the lowest score and becomes its UTF-8 bytes' pieces. So does a word mark of the text itself,
which makes decoding exact for every text.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame

from hammerline.llm.common import DOC_ID, map_texts, narrow

MARK = "▁"
HELD = "\ud800"  # stands for a mark of the text itself while it is segmented; half a surrogate pair stands in no text
WORDS = 400_000
BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.bytes = {int(m[1], 16): i for i, p in enumerate(names) if model.is_byte(i) and (m := BYTE.fullmatch(p))}
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        if any(MARK in names[i].lstrip(MARK) for i in plain):
            raise ValueError("a piece of this vocabulary crosses words")
        self.scores = {names[i]: (model.get_score(i), i) for i in plain}
        # every ending of a piece, so that a search backwards from a place stops where no piece goes on
        self.endings = {p[k:]: None for p in self.scores for k in range(1, len(p))} | self.scores
        self.unknown = min(s for s, _ in self.scores.values()) - 10
        of_byte, kept = {i: b for b, i in self.bytes.items()}, set(plain)
        self.content = [bytes([of_byte[i]]) if i in of_byte else names[i].replace(MARK, " ").encode() if i in kept else b"" for i in range(size)]
        self.known: dict[str, bytes] = {}
        self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall

    def segment(self, words) -> dict[str, bytes]:
        """Ids (little-endian unsigned 32 bits) of each distinct word."""
        out, path, scores = {}, "", [0.0]
        back: list[tuple[int, int | None]] = [(0, None)]
        get, nothing = self.endings.get, ()
        for word in sorted(words):
            shared = 0
            for a, b in zip(word, path):
                if a != b:
                    break
                shared += 1
            del scores[shared + 1:], back[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                start = end - 1
                piece = get(word[start])
                # a character without a piece of its own
                best, found = (None, None) if piece else (scores[start] + self.unknown, (start, None))
                while True:
                    if piece and (best is None or scores[start] + piece[0] >= best):  # of equals the longer
                        best, found = scores[start] + piece[0], (start, piece[1])
                    start -= 1
                    if start < 0 or (piece := get(word[start:end], nothing)) is nothing:
                        break
                scores.append(best)
                back.append(found)
            path, at, ids = word, len(word), []
            while at:
                start, piece = back[at]
                if piece is None:
                    ids += [self.bytes[b] for b in reversed(word[start:at].replace(HELD, MARK).encode())]
                else:
                    ids.append(piece)
                at = start
            out[word] = array("I", reversed(ids)).tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > WORDS:
            self.known.clear()
        marked = [self.words(MARK + t.replace(MARK, HELD).replace(" ", MARK)) if t else [] for t in texts]
        self.known.update(self.segment({w for m in marked for w in m}.difference(self.known)))
        return [b"".join(map(self.known.__getitem__, m)) for m in marked]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join([self.content[i] for i in ids.tolist()])
        return text[1:].decode()


_models: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The model of this Python worker, which later tasks find warm."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


FIELDS = "n_pieces bigint, ids_crc32 bigint, pieces binary"


def encoded(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text", model: str | None = None) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, pieces): ids of every text as little-endian unsigned 32-bit integers.

    Null and empty texts have no piece. Every row of the input, repeated or not, has a row.
    """
    path = model or default_path()

    def make():
        encode = pieces(path).encode

        def fn(texts):
            ids = encode(texts)
            return [len(i) // 4 for i in ids], [zlib.crc32(i) for i in ids], ids
        return fn

    return map_texts(narrow(df, id_col, text_col, binary=False), FIELDS, make)


def decoded(df: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, pieces) as ``encoded`` gives them."""
    path = model or default_path()
    rows = df.select(DOC_ID, "pieces")
    return map_texts(rows, "text string", lambda: lambda ids: [[pieces(path).decode(np.frombuffer(i, dtype="<u4")) for i in ids]])


def round_trip(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text", model: str | None = None) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, n_chars, decoded_sha256, same): encode, decode, and compare with the text."""
    path = model or default_path()

    def make():
        both = pieces(path)

        def fn(texts):
            ids = both.encode(texts)
            back = [both.decode(np.frombuffer(i, dtype="<u4")) for i in ids]
            return ([len(i) // 4 for i in ids], [zlib.crc32(i) for i in ids], [len(b) for b in back],
                    [hashlib.sha256(b.encode()).hexdigest() for b in back], [a == b for a, b in zip(texts, back, strict=True)])
        return fn

    return map_texts(narrow(df, id_col, text_col, binary=False),
                     "n_pieces bigint, ids_crc32 bigint, n_chars bigint, decoded_sha256 string, same boolean", make)
