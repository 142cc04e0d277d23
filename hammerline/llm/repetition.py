"""Quality rules from a suffix array over the words of a text.

Suffixes are sorted by prefix doubling, many texts side by side: after k rounds suffixes are ranked by
their first 2^k words, and only those that still share a rank go on. Neighbours in the suffix array that
share at least ``FEWEST`` words bound the longest-common-prefix intervals; a suffix's deepest interval is the longer of its two
neighbours' prefixes and gives the longest repeat that begins at it. The union of these spans is what repeats in the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerline.llm.common import DOC_ID, fresh, map_texts, narrow, slices

MIN_WORDS = 8  # of the windows that the base rule counts
FEWEST = 3  # shortest repeat that counts as covered
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of words in repeated windows
MOST_COVERED = 0.4  # part of the bytes of words that repeats may cover; labelled good documents stay under 0.28
LONGEST_REPEAT = 200  # words
BATCH_WORDS = 200_000
# Characters that count as symbols, and the white space that parts words.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"


def longest_repeats(codes: np.ndarray, ends: np.ndarray, least: int = FEWEST) -> np.ndarray:
    """For each word the length of the longest substring from it on that occurs elsewhere in its text; 0 under ``least``.

    ``codes`` are word codes of texts in a row, ``ends`` the end of the text that each word belongs to.
    """
    n = len(codes)
    out = np.zeros(n, dtype=np.int64)
    if n == 0:
        return out
    # first ranks: the place of the first suffix of the same text that begins with the same word
    order = np.lexsort((codes, ends))
    starts = np.concatenate([[True], (ends[order][1:] != ends[order][:-1]) | (codes[order][1:] != codes[order][:-1])])
    levels, width = [], 1
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    alone = starts & np.append(starts[1:], True)
    active = order[~alone]
    floor = None  # the suffixes whose first words, as many as the greatest power of two up to ``least``, occur again
    while True:
        levels.append(rank)
        if 2 * width > least and floor is None:
            floor = active
        if not len(active):
            break
        after = active + width
        second = np.where(after < ends[active], rank[np.minimum(after, n - 1)] + 1, 0)
        first = rank[active]
        by = np.lexsort((second, first))
        active, first, second = active[by], first[by], second[by]
        at = np.arange(len(active))
        group = np.concatenate([[True], first[1:] != first[:-1]])
        part = group | np.concatenate([[True], second[1:] != second[:-1]])
        rank = rank.copy()
        rank[active] = first + np.maximum.accumulate(np.where(part, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        active = active[~(part & np.append(part[1:], True))]
        width *= 2
    if floor is None or not len(floor):
        return out
    array = floor[np.argsort(rank[floor], kind="stable")]  # the part of the suffix array in which long repeats lie
    left, right = array[:-1], array[1:]
    a, b, shared = left.copy(), right.copy(), np.zeros(len(left), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < ends[left]) & (b < ends[right])
        same = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        step = np.where(same, 1 << k, 0)
        a, b, shared = a + step, b + step, shared + step
    np.maximum.at(out, left, shared)
    np.maximum.at(out, right, shared)
    out[out < least] = 0
    return out


def covered(at: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words lie in one of the spans."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


class Rules:
    """Measures and verdicts of a list of UTF-8 texts."""

    FIELDS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, "
              "kept boolean, covered_fraction double, longest_repeat bigint")

    def __init__(self, most_covered: float = MOST_COVERED, longest_repeat: int = LONGEST_REPEAT):
        self.most_covered, self.longest_repeat = most_covered, longest_repeat
        self.spaces = np.frombuffer(SPACES, dtype=np.uint8)
        self.symbols = np.frombuffer(SYMBOLS, dtype=np.uint8)

    def __call__(self, texts: list[bytes]) -> list[list]:
        rows, held, words_held = [], [], 0
        for text in texts:
            held.append((text, words := text.split()))
            words_held += len(words)
            if words_held >= BATCH_WORDS:
                rows += self._some(held)
                held, words_held = [], 0
        rows += self._some(held)
        return [list(c) for c in zip(*rows, strict=True)]

    def _some(self, held: list[tuple[bytes, list[bytes]]]) -> list[tuple]:
        number: dict[bytes, int] = {}
        for _, words in held:
            for w in set(words).difference(number):
                number[w] = len(number)
        sizes = [len(words) for _, words in held]
        codes = np.fromiter((c for _, words in held for c in map(number.__getitem__, words)), dtype=np.int64, count=sum(sizes))
        stops = np.cumsum(sizes, dtype=np.int64)
        repeats = longest_repeats(codes, np.repeat(stops, sizes))
        return [self._verdict(text, words, repeats[stop - size:stop]) for (text, words), stop, size in zip(held, stops, sizes, strict=True)]

    def _verdict(self, text: bytes, words: list[bytes], repeats: np.ndarray) -> tuple:
        n = len(words)
        counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
        chars = len(text) - int(counts[0x80:0xC0].sum()) - int(counts[self.spaces].sum())
        lines = [line for line in text.split(b"\n") if line.strip()]
        at, windows = np.flatnonzero(repeats), np.flatnonzero(repeats >= MIN_WORDS)
        in_windows = fraction = longest = 0
        if len(at):
            in_windows = int(covered(windows, np.full(len(windows), MIN_WORDS), n).sum())
            size = np.fromiter(map(len, words), dtype=np.int64, count=n)
            fraction = float(size[covered(at, repeats[at], n)].sum() / size.sum())
            longest = int(repeats.max())
        failed = n < LEAST_WORDS or 100 * in_windows > MOST_REPEATED * n
        kept = not failed and fraction <= self.most_covered and longest <= self.longest_repeat
        return n, chars, int(counts[self.symbols].sum()), len(lines) - len(set(lines)), in_windows, failed, kept, float(fraction), longest


def quality_rules(df: DataFrame, id_col: str = DOC_ID, text_col: str = "text") -> DataFrame:
    """(doc_id, measures, base_failed, kept, covered_fraction, longest_repeat) for every row.

    ``covered_fraction`` is the part of the bytes of words that lies in a maximal repeat of ``FEWEST`` words or more, so a text of a few words said
    over and over fails as one with long repeats does. A null or empty text has no words and fails. Rows stand alone: repeated rows
    repeat their result; very long texts are taken whole; other columns are left behind; an empty table gives an empty result.
    """
    return map_texts(narrow(df, id_col, text_col, binary=True), Rules.FIELDS, Rules)


def keep(df: DataFrame, text_col: str = "text", rules=Rules) -> DataFrame:
    """The rows of ``df`` whose text passes the rules, with all their columns; decided inside the tasks, without a shuffle.

    Null and empty texts fail; repeated rows pass or fail alike; an empty table stays empty.
    """
    name = fresh(df, "bytes")

    def run(batches):
        judge = rules()
        for part in slices(batches):
            kept = judge([t or b"" for t in part.column(part.num_columns - 1).to_pylist()])[6]
            yield pa.RecordBatch.from_arrays(part.columns[:-1], schema=pa.schema(list(part.schema)[:-1])).filter(pa.array(kept))

    return df.withColumn(name, F.col(text_col).cast("binary")).mapInArrow(run, df.schema)
