"""Repetition inside a text from its suffix array.

The words of a batch of documents form one sequence in which a word is a different symbol in every document, so a
shared prefix never crosses documents. Prefix doubling sorts the suffixes, Kasai's idea (here vectorised over the
doubling's own ranks) gives the longest common prefix (LCP) of neighbours. An LCP interval, a stretch of neighbours
with at least ``min_words`` in common, is a repeated substring; it is maximal where it can be extended neither to the
right (the interval's LCP) nor to the left (different words before its occurrences). The union of the maximal repeats'
spans and the longest of them decide whether a document is kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from learnlake.llm.common import SPACES, in_slices

SLICE_BYTES = 600_000
WINDOW_WORDS = 8
# The base rules.
MIN_DOCUMENT_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "covered_words long, longest_repeat long, n_repeats long, kept boolean"
)


@dataclass(frozen=True)
class Limits:
    """What the suffix array may show: repeats count from ``min_words`` words on."""

    min_words: int = 5
    max_covered: float = 0.3
    max_longest: int = 50


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of a sequence of non-negative integers and the LCP of each suffix with the one before it.

    Doubling sorts only suffixes whose place is still open. The ranks of every round are kept, so the LCP follows
    from binary descent over the rounds, without a loop over positions.
    """
    n = len(symbols)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(symbols)
    fresh = np.concatenate(([True], symbols[order][1:] != symbols[order][:-1]))
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    rounds, width = [rank.copy()], 1
    while not fresh.all():
        # Positions of the array that share their rank with a neighbour.
        open_at = np.flatnonzero(~fresh | np.concatenate((~fresh[1:], [False])))
        suffixes = order[open_at]
        after = suffixes + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        sort = np.argsort(rank[suffixes] * (n + 1) + second + 1)
        order[open_at] = suffixes[sort]
        suffixes, second = suffixes[sort], second[sort]
        group = rank[suffixes]
        same = (group[1:] == group[:-1]) & (second[1:] == second[:-1])
        fresh[open_at[1:][~same]] = True
        start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        rank = rank.copy()
        rank[suffixes] = start[open_at]
        rounds.append(rank)
        width *= 2
    lcp = np.zeros(n, np.int64)
    here, there = order[1:].copy(), order[:-1].copy()
    for k in reversed(range(len(rounds))):
        inside = (here < n) & (there < n)
        equal = np.zeros(len(here), bool)
        equal[inside] = rounds[k][here[inside]] == rounds[k][there[inside]]
        # Equal ranks of round k mean 2**k equal symbols.
        lcp[1:][equal] += 1 << k
        here[equal] += 1 << k
        there[equal] += 1 << k
    return order, lcp


def maximal_repeats(symbols: np.ndarray, order: np.ndarray, lcp: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """LCP intervals of at least ``least`` symbols that are maximal to the left as well: (first, last, length).

    ``first`` and ``last`` are places in the suffix array. One pass with a stack over the places whose LCP reaches
    ``least``; stretches below it close everything.
    """
    places = np.flatnonzero(lcp >= least)
    before = np.where(order > 0, symbols[order - 1], -1)
    # Whether the word before changes between neighbours, summed up: a stretch is left-maximal if it changes inside.
    changes = np.concatenate(([0], np.cumsum(before[1:] != before[:-1])))
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []

    def close(to: int, height: int) -> int:
        left = to
        while stack and stack[-1][1] > height:
            left, length = stack.pop()
            if changes[to] > changes[left]:
                found.append((left, to, length))
        return left

    last = -2
    for i in places.tolist():
        if i != last + 1:
            close(last, 0)
        height = int(lcp[i])
        left = min(close(i - 1, height), i - 1)
        if not stack or stack[-1][1] < height:
            stack.append((left, height))
        last = i
    close(last, 0)
    return found


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in a span."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + lengths, -1)
    return np.cumsum(edges[:-1]) > 0


def _repeated_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def measure(texts: list[str], limits: Limits) -> dict[str, np.ndarray]:
    """The columns of ``SCHEMA`` for a batch of texts."""
    # The bytes' split knows exactly the six separators.
    words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    total, rows = int(n_words.sum()), len(texts)
    row = np.repeat(np.arange(rows), n_words)
    every = list(chain.from_iterable(words))
    codes = dict(zip(dict.fromkeys(every), range(total), strict=False))
    coded = np.fromiter(map(codes.__getitem__, every), np.int64, total)
    # A symbol per word and document.
    symbols = row * np.int64(len(codes) or 1) + coded
    order, lcp = suffix_array(symbols)
    longest = np.zeros(total, np.int64)
    if total:
        longest[order] = np.maximum(lcp, np.concatenate((lcp[1:], [0])))
    windows = np.flatnonzero(longest >= WINDOW_WORDS)
    in_window = _covered(windows, np.full(len(windows), WINDOW_WORDS), total)

    # A suffix's longest repeat lies in a maximal one, and every maximal repeat is the longest of its suffixes: the
    # union of both kinds of spans is the same.
    repeated = np.flatnonzero(longest >= limits.min_words)
    covered = _covered(repeated, longest[repeated], total)
    n_repeats = np.zeros(rows, np.int64)
    longest_repeat = np.zeros(rows, np.int64)
    if repeats := maximal_repeats(symbols, order, lcp, limits.min_words):
        first, _, length = np.array(repeats, np.int64).T
        n_repeats += np.bincount(row[order[first]], minlength=rows)
        np.maximum.at(longest_repeat, row[order[first]], length)

    def per_row(flags: np.ndarray) -> np.ndarray:
        return np.bincount(row[flags], minlength=rows).astype(np.int64)

    n_repeat_words, covered_words = per_row(in_window), per_row(covered)
    failed = (n_words < MIN_DOCUMENT_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)
    good = (covered_words <= limits.max_covered * n_words) & (longest_repeat <= limits.max_longest)
    return {
        "n_words": n_words,
        "word_chars": np.array([len(t) - sum(map(t.count, SPACES)) for t in texts], np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([_repeated_lines(t) for t in texts], np.int64),
        "n_repeat_words": n_repeat_words, "base_failed": failed, "covered_words": covered_words,
        "longest_repeat": longest_repeat, "n_repeats": n_repeats, "kept": ~failed & good,
    }


def repetition(docs: DataFrame, keys: list[str], limits: Limits = Limits()) -> DataFrame:
    """``keys`` and the measures of every whole text; a null text has no words and, like an empty one, is not kept.

    ``covered_words`` are the words inside maximal repeats of at least ``limits.min_words`` words, ``longest_repeat``
    the longest one, ``n_repeats`` their number. A document is kept if it passes the base rules and both limits.
    """
    source = docs.select(*keys, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text", SLICE_BYTES):
            found = measure([t or "" for t in batch.column("text").to_pylist()], limits)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keys], *map(pa.array, found.values())], names=[*keys, *found])

    return source.mapInArrow(run, f"{fields}, {SCHEMA}")


def quality_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id and the measures, with the production limits."""
    return repetition(docs, ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered_words", "longest_repeat", "n_repeats")


def unrepetitive(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Documents, all columns, that ``repetition`` keeps."""

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text", SLICE_BYTES):
            yield batch.filter(pa.array(measure([t or "" for t in batch.column("text").to_pylist()], limits)["kept"]))

    return docs.mapInArrow(keep, docs.schema)
