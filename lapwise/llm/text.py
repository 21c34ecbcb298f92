"""Words, lines and hashes of whole Arrow batches of texts, without a Python object per word.

A word is a run of bytes other than space and U+0009 to U+000D. Words are known by a 64-bit polynomial hash of
their bytes, taken from one running sum per batch; 64 random bits stand for a word everywhere here, so two
different words are taken for one with a chance of about 2^-60 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in slices of about this many bytes; one longer text is a slice of its own.
SLICE_BYTES = 2_000_000

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes every output bit."""
    x = x.astype(U)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = U(0xD1342543DE82EF95)
_INVERSE = U(pow(int(_BASE), -1, 2**64))
_powers = (np.ones(1, U), np.ones(1, U))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, kept for the longest slice so far."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        grown = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, U)
            steps[0] = 1
            grown.append(np.cumprod(steps))
        if n > 4 * SLICE_BYTES:  # one very long text: do not hold its tables for good
            return grown[0], grown[1]
        _powers = (grown[0], grown[1])
    return _powers


@dataclass
class Texts:
    """Bytes of consecutive texts; text i is ``data[bounds[i]:bounds[i + 1]]``."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def hashes(self, first: np.ndarray, last: np.ndarray, fold: bool = False) -> np.ndarray:
        """Hashes of the spans ``data[first:last]``."""
        up, down = _power(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, U)
        np.cumsum((_FOLDED if fold else _BYTE)[self.data] * up[: len(self.data)], out=sums[1:])
        return mix((sums[last] - sums[first]) * down[first])

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of marked bytes; a text's end also ends a run."""
        edge = np.zeros(len(inside) + 1, bool)
        edge[self.bounds] = True
        before = np.empty(len(inside), bool)
        before[:1], before[1:] = False, inside[:-1]
        after = np.empty(len(inside), bool)
        after[-1:], after[:-1] = False, inside[1:]
        first = np.flatnonzero(inside & (~before | edge[:-1]))
        last = np.flatnonzero(inside & (~after | edge[1:])) + 1
        return first, last

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of every word."""
        return self.spans(~_SPACE[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of every line with at least one byte."""
        return self.spans(self.data != 10)

    def counts(self, positions: np.ndarray) -> np.ndarray:
        """How many of the sorted byte positions lie in each text."""
        return np.diff(np.searchsorted(positions, self.bounds))

    def total(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each text."""
        sums = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=sums[1:])
        return np.diff(sums[self.bounds])


def texts(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The texts of an Arrow column; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    return Texts(data[bounds[0] : bounds[-1]], bounds - bounds[0])


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut a batch at row borders into parts of about ``limit`` bytes of text, without copying it."""
    whole = texts(batch.column(column))
    row = 0
    while row < len(whole):
        end = int(np.searchsorted(whole.bounds, whole.bounds[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(whole))
        low, high = whole.bounds[row], whole.bounds[end]
        yield batch.slice(row, end - row), Texts(whole.data[low:high], whole.bounds[row : end + 1] - low)
        row = end


def windows(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words inside one text, and how many each text has."""
    n = np.maximum(counts - size + 1, 0)
    if not n.sum():
        return np.zeros(0, U), n
    total = np.zeros(max(len(hashes) - size + 1, 0), U)
    for step in range(size):
        total += hashes[step : step + len(total)] * U(2 * pow(0x9E3779B97F4A7C15, step + 1, 2**63) + 1)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    keep = np.repeat(starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    return mix(total[keep]), n
