"""Quality rules on repetition inside a document, found with suffix arrays over words.

The suffixes of all words of a slice of texts are sorted by prefix doubling; only suffixes that still share their
prefix with another one of the same text are sorted again, so the work falls fast with the prefix length. The
longest common prefixes of neighbours come from the kept ranks, and the intervals of that array are the maximal
repeated substrings. The longest repeat that starts at a suffix is the larger of its two neighbouring common prefixes; one
such span a suffix covers what all occurrences of all maximal repeats cover, so these are never listed. A document passes
if the spans cover at most a given fraction of its words and none is longer than a given number of words. Memory is a fixed
number of bytes per word and doubling, also for a long text of one repeated word.

Rules for odd input: a null or empty text has no words and fails the base rule; repeated rows are judged row by
row; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lapwise.llm.text import Texts, U, mix, slices

# A repeat counts from this many words on.
MIN_REPEAT = 5
# Base rule: least number of words, and the largest percentage of words inside repeats.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# The suffix-array rule: largest covered fraction of the words, and longest repeat in words.
MAX_COVERED = 0.2
MAX_LONGEST = 100

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, covered_fraction double, longest_repeat long, n_maximal_repeats long"
)


@dataclass
class Suffixes:
    """Suffix array of many short sequences at once; sequences share no order beyond standing together."""

    order: np.ndarray  # suffixes in sorted order
    common: np.ndarray  # words that each shares with the one before it in ``order``


def suffix_array(symbols: np.ndarray, counts: np.ndarray, least: int = 1) -> Suffixes:
    """Sort the suffixes of every sequence; ``counts`` are the sequence lengths, ``symbols`` their words' hashes.

    Common prefixes shorter than ``least`` words are given as 0.
    """
    n = len(symbols)
    owner = np.repeat(np.arange(len(counts)), counts)
    end = np.repeat(np.cumsum(counts), counts)
    _, rank = np.unique(mix(symbols ^ mix(owner.astype(U) + U(1))), return_inverse=True)
    sizes = np.bincount(rank, minlength=1)
    rank = (np.cumsum(sizes) - sizes)[rank]  # place of the first suffix of the same class
    active = np.flatnonzero(_shared(rank, n))
    levels = [rank.astype(_kind(n))]
    step = 1
    while len(active):
        there = active + step
        inside = there < end[active]
        second = np.where(inside, rank[np.where(inside, there, 0)] + 1, 0)
        key = rank[active] * np.int64(n + 1) + second
        sort = np.argsort(key)
        key = key[sort]
        fresh = np.empty(len(key), bool)
        fresh[0], fresh[1:] = True, key[1:] != key[:-1]
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))
        group = rank[active[sort]]
        fresh_group = np.empty(len(key), bool)
        fresh_group[0], fresh_group[1:] = True, group[1:] != group[:-1]
        group_start = np.maximum.accumulate(np.where(fresh_group, np.arange(len(key)), 0))
        rank = rank.copy()
        rank[active[sort]] = group + start - group_start
        levels.append(rank.astype(_kind(n)))
        active = active[_shared(rank[active], n)]
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return Suffixes(order, _common(order, end, levels, least))


def _kind(n: int) -> type:
    return np.int32 if n < 2**31 else np.int64


def _shared(rank: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rank, minlength=n)[rank] > 1


def _common(order: np.ndarray, end: np.ndarray, levels: list[np.ndarray], least: int) -> np.ndarray:
    """Common prefix of neighbours: add the powers of two whose ranks agree, from the largest down."""
    n = len(order)
    common = np.zeros(n, np.int64)
    if n < 2:
        return common
    known = min(max(least, 1).bit_length() - 1, len(levels) - 1)
    place = np.flatnonzero(levels[known][order[1:]] == levels[known][order[:-1]]) + 1
    left, right = order[place - 1], order[place]
    length = np.zeros(len(place), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        open_ = (left < end[order[place - 1]]) & (right < end[order[place]])
        same = np.zeros(len(place), bool)
        same[open_] = levels[k][left[open_]] == levels[k][right[open_]]
        step = same.astype(np.int64) << k
        length, left, right = length + step, left + step, right + step
    common[place] = np.where(length >= least, length, 0)
    return common


def lcp_intervals(common: np.ndarray) -> np.ndarray:
    """Rows (first, last, length): suffixes first to last in sorted order share ``length`` words, no wider run does."""
    found, heights, lefts = array("q"), array("q"), array("q")

    def close(last: int) -> int:
        left = lefts.pop()
        found.extend((left, last, heights.pop()))
        return left

    previous = -2
    for place in np.flatnonzero(common).tolist():
        if place != previous + 1:
            while heights:
                close(previous)
        height, left = int(common[place]), place - 1
        while heights and heights[-1] > height:
            left = close(place - 1)
        if not heights or heights[-1] < height:
            heights.append(height)
            lefts.append(left)
        previous = place
    while heights:
        close(previous)
    return np.array(found, np.int64).reshape(-1, 3)


@dataclass
class Repeats:
    """What repeats in many sequences at once."""

    spans: np.ndarray  # rows (first word, end): for each suffix its longest repeat, if it has one
    heads: np.ndarray  # one word inside each maximal repeated substring's sequence


def maximal_repeats(symbols: np.ndarray, counts: np.ndarray, least: int) -> Repeats:
    """Repeated substrings of at least ``least`` words; maximal ones are extended by no word on either side."""
    found = suffix_array(symbols, counts, least)
    order, common = found.order, found.common
    longest = np.maximum(common, np.append(common[1:], 0))
    place = np.flatnonzero(longest)
    spans = np.stack([order[place], order[place] + longest[place]], 1)
    intervals = lcp_intervals(common)
    first = np.zeros(len(symbols), bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    # A repeat extends to the left when one and the same word stands before all its occurrences.
    before = np.where(first[order], 0, symbols[order - 1]) if len(order) else order
    varied = np.zeros(len(order) + 1, np.int64)
    varied[2:] = np.cumsum((before[1:] != before[:-1]) | first[order[1:]] | first[order[:-1]])
    low, high, _ = intervals.T
    return Repeats(spans, order[low[varied[high + 1] > varied[low + 1]]])


def covered(spans: np.ndarray, n: int) -> np.ndarray:
    """Marks the words inside the union of the spans."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, spans[:, 0], 1)
    np.add.at(edges, spans[:, 1], -1)
    return np.cumsum(edges[:n]) > 0


def measure(part: Texts) -> dict[str, np.ndarray]:
    """All measures of the rules for each text."""
    first, last = part.words()
    counts = part.counts(first)
    symbols = part.hashes(first, last)
    repeats = maximal_repeats(symbols, counts, MIN_REPEAT)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    inside = np.concatenate([[0], np.cumsum(covered(repeats.spans, len(symbols)))])
    longest = np.zeros(len(part), np.int64)
    text_of = np.searchsorted(bounds, repeats.spans[:, 0], side="right") - 1
    np.maximum.at(longest, text_of, repeats.spans[:, 1] - repeats.spans[:, 0])

    in_word = np.zeros(len(part.data) + 1, np.int64)
    np.add.at(in_word, first, 1)
    np.add.at(in_word, last, -1)
    points = (np.cumsum(in_word[:-1]) > 0) & ((part.data & 0xC0) != 0x80)
    return {
        "n_words": counts,
        "word_chars": part.total(points),
        "n_symbols": part.total(_SYMBOL[part.data]),
        "n_dup_lines": _repeated_lines(part, first),
        "n_repeat_words": inside[bounds[1:]] - inside[bounds[:-1]],
        "longest_repeat": longest,
        "n_maximal_repeats": np.bincount(np.searchsorted(bounds, repeats.heads, side="right") - 1, minlength=len(part)),
    }


def _repeated_lines(part: Texts, words: np.ndarray) -> np.ndarray:
    first, last = part.lines()
    worded = np.searchsorted(words, last) > np.searchsorted(words, first)
    first, last = first[worded], last[worded]
    owner = np.searchsorted(part.bounds, first, side="right") - 1
    line = mix(part.hashes(first, last) ^ mix(owner.astype(U) + U(1)))
    _, earliest = np.unique(line, return_index=True)
    again = np.ones(len(line), bool)
    again[earliest] = False
    return np.bincount(owner[again], minlength=len(part))


def verdicts(found: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The base rule and the suffix-array rule."""
    words, repeated = found["n_words"], found["n_repeat_words"]
    failed = (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)
    fraction = repeated / np.maximum(words, 1)
    kept = ~failed & (fraction <= MAX_COVERED) & (found["longest_repeat"] <= MAX_LONGEST)
    return found | {"base_failed": failed, "covered_fraction": fraction, "kept": kept}


def score(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: its key, the measures and both verdicts."""
    names = [part.split(" ")[0] for part in COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, part in slices(batch, text):
                found = verdicts(measure(part))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(key), *[pa.array(found[name]) for name in names]], [key, *names]
                )

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, {COLUMNS}")


def keep(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text passes both rules, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, part in slices(batch, text):
                yield rows.filter(pa.array(verdicts(measure(part))["kept"]))

    return df.mapInArrow(run, df.schema)
