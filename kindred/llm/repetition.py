"""Suffix-array repetition rules.

The words of many documents form one array in which ranks of different documents never agree.  Prefix doubling
sorts its suffixes, re-sorting only those that are still tied; the ranks of each doubling give the longest common
prefix of neighbours by binary lifting.  Intervals of common prefixes are the maximal repeated substrings of each
document; the union of their spans and the longest of them decide.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kindred.llm.common import map_slices, text_bytes

# repeats shorter than this many words are common phrases
MIN_REPEAT = 10
# share of a document's words that longer repeats may cover
MAX_COVERED = 0.3
# words of the longest repeat that is still accepted
MAX_LONGEST = 100
MIN_WORDS = 50
SPACES = tuple(bytes([c]) for c in b" \t\n\v\f\r")
SYMBOLS = tuple(bytes([c]) for c in b"#*$%&|<>")


@dataclass
class SuffixArray:
    """Suffixes of concatenated word sequences, sorted within each sequence, and prefixes shared with the one before."""

    order: np.ndarray  # positions, sorted
    lcp: np.ndarray  # words that order[i] shares with order[i - 1]; 0 between sequences


def suffix_array(codes: np.ndarray, starts: np.ndarray) -> SuffixArray:
    """``codes`` are non-negative word numbers; sequence i is ``codes[starts[i]:starts[i + 1]]``."""
    n = len(codes)
    if not n:
        return SuffixArray(np.zeros(0, np.int64), np.zeros(0, np.int64))
    lengths = np.diff(np.append(starts, n))
    end = np.repeat(np.append(starts[1:], n), lengths)
    key = np.repeat(np.arange(len(starts), dtype=np.int64), lengths) * (int(codes.max()) + 1) + codes
    order = np.argsort(key, kind="stable")
    # a rank is the place of the first suffix of its group of ties, so refining one group leaves the others alone
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(key[order][1:], key[order][:-1], out=new[1:])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    levels, step = [rank.astype(np.int32)], 1
    while True:
        bounds = np.flatnonzero(np.append(new, True))
        tied = np.repeat(np.diff(bounds) > 1, np.diff(bounds))
        places = np.flatnonzero(tied)
        if not len(places):
            break
        at = order[places]
        after = at + step
        inside = after < end[at]
        tail = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[at] * (n + 2) + tail
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[places] = at
        fresh = np.empty(len(at), bool)
        fresh[0] = True
        np.not_equal(key[1:], key[:-1], out=fresh[1:])
        new[places] = fresh
        rank = rank.copy()
        rank[at] = places[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        levels.append(rank.astype(np.int32))
        step *= 2
    lcp = np.zeros(n, np.int64)
    pairs = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b = order[pairs], order[pairs - 1]
    shared = np.zeros(len(pairs), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        fits = (x < end[a]) & (y < end[b])
        same = fits & (levels[level][np.minimum(x, n - 1)] == levels[level][np.minimum(y, n - 1)])
        shared[same] += 1 << level
    lcp[pairs] = shared
    return SuffixArray(order, lcp)


def reach(array: SuffixArray) -> np.ndarray:
    """For each position, the words of the longest substring that starts there and occurs elsewhere in its sequence."""
    out = np.zeros(len(array.order), np.int64)
    out[array.order] = np.maximum(array.lcp, np.append(array.lcp[1:], 0)) if len(out) else 0
    return out


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Positions in the union of the spans of repeats of at least ``least`` words."""
    n = len(longest)
    edges = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(longest >= least)
    np.add.at(edges, at, 1)
    np.subtract.at(edges, at + longest[at], 1)
    return np.cumsum(edges[:-1]) > 0


def maximal_repeats(array: SuffixArray, codes: np.ndarray, starts: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(first position, words, occurrences) of each repeat of at least ``least`` words that cannot be extended.

    Intervals of neighbours that share a prefix are closed from the deepest out.  Their right ends differ by
    construction; an interval whose occurrences all follow one word is part of a longer repeat and left out.
    """
    order, lcp = array.order, array.lcp
    before = np.where(np.isin(np.arange(len(codes)), starts), -1, np.concatenate([[-1], codes[:-1]])) if len(codes) else codes
    deep = np.flatnonzero(lcp >= least)
    if not len(deep):
        return
    for run in np.split(deep, np.flatnonzero(np.diff(deep) > 1) + 1):
        # open intervals: shared words, first place, smallest position, word before all occurrences (or None)
        stack: list[list] = []
        places = [int(run[0]) - 1, *run.tolist()]
        depths = [*lcp[run].tolist(), 0]  # depth between place i and place i + 1

        def left(place: int) -> int | None:
            word = int(before[order[place]])
            return word if word >= 0 else None

        for place, depth in zip(places, depths, strict=True):
            start, low, word = place, int(order[place]), left(place)
            pending = [place, low, word]
            while stack and stack[-1][0] > depth:
                words, start, low, word = stack.pop()
                # the closing place belongs to the interval
                low, word = min(low, pending[1]), word if word == pending[2] else None
                if word is None:
                    yield low, words, place - start + 1
                pending = [start, low, word]
            if depth:
                if stack and stack[-1][0] == depth:
                    stack[-1][2] = min(stack[-1][2], pending[1])
                    stack[-1][3] = stack[-1][3] if stack[-1][3] == pending[2] else None
                else:
                    stack.append([depth, *pending])


def encode_words(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all texts in one array, where each text starts, and how many words it has."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.fromiter((number[w] for text in words for w in text), np.int64, int(lengths.sum()))
    return codes, np.cumsum(lengths) - lengths, lengths


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def _maxima(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths), np.int64)
    full = np.flatnonzero(lengths)
    if len(full):
        out[full] = np.maximum.reduceat(values, (np.cumsum(lengths) - lengths)[full])
    return out


RESULT = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(), "n_covered": pa.int64(), "longest_repeat": pa.int64(), "base_failed": pa.bool_(),
    "kept": pa.bool_(),
}
RESULT_SQL = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_covered long, "
    "longest_repeat long, base_failed boolean, kept boolean"
)


def measure(
    texts: list[bytes | None], min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST,
    min_words: int = MIN_WORDS,
) -> dict[str, np.ndarray]:
    """The figures and the verdict for each text; a null text counts as one without words."""
    plain = [t or b"" for t in texts]
    codes, starts, n = encode_words([t.split() for t in plain])
    longest = reach(suffix_array(codes, starts[n > 0]))
    triple = _sums(covered_window(longest, 3), n)
    span = _sums(covered(longest, min_repeat), n)
    most = _maxima(longest, n)
    base = (n < min_words) | (100 * triple > 50 * n)
    kept = ~base & (span <= max_covered * n) & (most <= max_longest)

    def dup_lines(text: bytes) -> int:
        lines = [x for x in text.split(b"\n") if x.strip()]
        return len(lines) - len(set(lines))

    points = np.array([len(t.decode()) for t in plain], np.int64)
    spaces = np.array([sum(map(t.count, SPACES)) for t in plain], np.int64)
    return {
        "n_words": n, "word_chars": points - spaces,
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in plain], np.int64),
        "n_dup_lines": np.array([dup_lines(t) for t in plain], np.int64),
        "n_repeat_words": triple, "n_covered": span, "longest_repeat": most, "base_failed": base, "kept": kept,
    }


def covered_window(longest: np.ndarray, words: int) -> np.ndarray:
    """Positions in a window of exactly ``words`` words that occurs again."""
    return covered(np.where(longest >= words, words, 0), words)


def repetition(docs: DataFrame, **limits: float) -> DataFrame:
    """Figures and verdict per row of (doc_id, text).

    ``n_covered`` words lie in repeats of at least ``min_repeat`` words, ``longest_repeat`` is the longest repeat of any
    length.  A row is kept if it passes the base rule, at most ``max_covered`` of its words are covered and no repeat
    is longer than ``max_longest`` words.  A null or empty text has no words and fails the base rule; equal
    rows give equal results; other columns are ignored; no rows in, no rows out.
    """

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = measure(text_bytes(batch), **limits)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(got[k], t) for k, t in RESULT.items())], names=["doc_id", *RESULT]
        )

    cut = docs.select("doc_id", docs["text"].cast("string"))
    return map_slices(cut, "text", f"doc_id {cut.schema['doc_id'].dataType.simpleString()}, {RESULT_SQL}", kernel)


def keep_unrepetitive(docs: DataFrame, **limits: float) -> DataFrame:
    """The rows whose text is kept, with all their columns; a map over the partitions, without a shuffle."""

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(measure(text_bytes(batch), **limits)["kept"]))

    return map_slices(docs, "text", docs.schema, kernel)


def repeated_substrings(docs: DataFrame, least: int = MIN_REPEAT) -> DataFrame:
    """Each maximal repeated substring of at least ``least`` words: (doc_id, first_word, n_words, occurrences)."""

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, starts, n = encode_words([(t or b"").split() for t in text_bytes(batch)])
        own, ids = starts[n > 0], batch.column("doc_id").to_pylist()
        rows = [i for i, m in enumerate(n) if m]
        out: dict[str, list] = {"doc_id": [], "first_word": [], "n_words": [], "occurrences": []}
        for at, words, times in maximal_repeats(suffix_array(codes, own), codes, own, least):
            row = int(np.searchsorted(own, at, side="right")) - 1
            for k, v in zip(out, (ids[rows[row]], at - int(own[row]), words, times), strict=True):
                out[k].append(v)
        return pa.RecordBatch.from_pydict(
            out, schema=pa.schema([batch.schema.field("doc_id"), *((k, pa.int64()) for k in list(out)[1:])])
        )

    cut = docs.select("doc_id", docs["text"].cast("string"))
    kind = cut.schema["doc_id"].dataType.simpleString()
    return map_slices(cut, "text", f"doc_id {kind}, first_word long, n_words long, occurrences long", kernel)
