"""Token ids of whole texts from the tokenizers library, one library call for each distinct word of a task.

The word BPE drops white space and never joins what it separates, so the ids of a text are those of its
white-space-separated chunks in a row. The distinct chunks of some texts are taken apart in Arrow, each word is encoded once and
remembered, and the ids are put in a row by the places of the chunks.
Texts that hold the string of a special token, which the library finds before it looks at words, are encoded whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 1
CHUNKS, WORDS = 400_000, 600_000  # remembered at most, then forgotten: bounds a worker's memory
SPECIAL = b"<|"
# The tokenizer's own split of a chunk, and the characters for which its normalisation is lower-casing alone.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = "[!-~¡-¬®-įĲ-ſ]+"
PLAIN_RANGES = (("!", "~"), ("¡", "¬"), ("®", "į"), ("Ĳ", "ſ"))
APOSTROPHE = "'"  # what follows it may be a word of its own, as in 's


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()  # to_pylist makes a scalar of each first


class Encoder:
    """``encode`` gives the ids of UTF-8 texts as little-endian unsigned 16-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        # the same merges on words that are split and mapped to the byte alphabet already
        self.merges = Tokenizer(self.whole.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.zeros(self.whole.get_vocab_size(), dtype=bool)
        if len(self.ends) > 1 << 16:
            raise ValueError("this encoder keeps ids in 16 bits")
        for token, i in self.whole.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith("</w>")
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.alphabet = {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}
        self.split, self.plain = regex.compile(SPLIT).findall, regex.compile(PLAIN).fullmatch
        plain = [chr(c) for first, last in PLAIN_RANGES for c in range(ord(first), ord(last) + 1)]
        letters = "".join(c for c in plain if regex.fullmatch(r"\p{L}", c))
        marks = [c for c in plain if not regex.fullmatch(r"[\p{L}\p{N}]", c)]
        before, after = ("".join(f"\\{c}" if c.isascii() else c for c in m) for m in ([c for c in marks if c != APOSTROPHE], marks))
        self.simple = f"^(?P<head>[{before}]*)(?P<body>[{letters}]+)(?P<tail>[{after}]*)$"
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _library(self, text: bytes) -> bytes:
        ids = self.whole.encode(text.decode(), add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u2").tobytes()

    def _learn_words(self, words: list[str], at_once: int = 256) -> None:
        mapped = [w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.alphabet) for w in words]
        for at in range(0, len(words), at_once):
            part = words[at:at + at_once]
            found, = self.merges.encode_batch_fast([" ".join(mapped[at:at + at_once])], add_special_tokens=False)
            ids = np.asarray(found.ids, dtype="<u2")
            stops, raw = (2 * np.flatnonzero(self.ends[ids]) + 2).tolist(), ids.tobytes()
            if len(stops) != len(part):
                raise ValueError("the vocabulary does not mark the ends of words")
            self.words.update((w, raw[start:stop]) for w, start, stop in zip(part, [0, *stops[:-1]], stops, strict=True))

    def _ids_of_words(self, words: list[str]) -> list[bytes]:
        if new := [w for w in words if w and w not in self.words]:
            self._learn_words(new)
        known = self.words
        return [known[w] if w else b"" for w in words]

    def _split(self, chunk: str) -> list[str] | None:
        """The tokenizer's words of a chunk; None where normalisation could do more than lower-case it."""
        if not (chunk.isascii() or self.plain(chunk)):
            return None
        if chunk.isalpha():
            return [chunk.lower()]
        if chunk[:-1].isalpha() and chunk[-1] in ".,":
            return [chunk[:-1].lower(), chunk[-1]]
        return self.split(chunk.lower())

    def _learn(self, chunks: list[str]) -> None:
        split = {}
        for c in chunks:
            if (words := self._split(c)) is None:
                self.chunks[c] = self._library(c.encode())
            else:
                split[c] = words
        words = list({w for found in split.values() for w in found})
        known = dict(zip(words, self._ids_of_words(words), strict=True))
        self.chunks.update((c, b"".join([known[w] for w in words])) for c, words in split.items())

    def _ids_of_chunks(self, chunks: pa.Array) -> pa.Array:
        """Ids of distinct chunks, each in one cell; most are a run of plain letters between marks and need no look at each."""
        parts = pc.extract_regex(chunks, self.simple)
        simple = parts.is_valid()
        head, body, tail = parts.filter(simple).flatten()
        words = pa.concat_arrays([head, pc.utf8_lower(body), tail]).dictionary_encode()
        ids = pa.array(self._ids_of_words(_strings(words.dictionary)), pa.large_binary()).take(words.indices)
        n = len(body)
        plain = pc.binary_join_element_wise(ids[:n], ids[n:2 * n], ids[2 * n:], pa.scalar(b"", pa.large_binary()))
        others = _strings(chunks.filter(pc.invert(simple)))
        if new := [c for c in others if c not in self.chunks]:
            self._learn(new)
        rest = pa.array([self.chunks[c] for c in others], pa.large_binary())
        mask = simple.to_numpy(zero_copy_only=False)
        return pa.concat_arrays([plain, rest]).take(pa.array(np.where(mask, np.cumsum(mask) - 1, n + np.cumsum(~mask) - 1)))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.chunks) > CHUNKS:
            self.chunks.clear()
        if len(self.words) > WORDS:
            self.words.clear()
        special = [SPECIAL in text for text in texts]
        found = pc.ascii_split_whitespace(pa.array([b"" if s else text for s, text in zip(special, texts, strict=True)], pa.binary()).cast(pa.string()))
        chunks = found.flatten().dictionary_encode()
        ids = self._ids_of_chunks(chunks.dictionary).take(chunks.indices)
        _, places, raw = ids.buffers()
        at = np.frombuffer(places, dtype=np.int64, count=len(ids) + 1)[found.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(texts) + 1)
        raw = memoryview(raw or b"")
        return [self._library(text) if s else bytes(raw[start:stop]) for s, text, start, stop in zip(special, texts, at[:-1], at[1:], strict=True)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which later tasks of the worker find warm."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def with_end(ids: bytes, end_id: int = END_ID) -> np.ndarray:
    """Ids and the end id, as little-endian unsigned 32-bit integers."""
    return np.append(np.frombuffer(ids, dtype="<u2"), np.uint16(end_id)).astype("<u4")
