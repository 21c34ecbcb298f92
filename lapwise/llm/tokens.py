"""Token ids of whole batches of texts under a byte-level BPE tokenizer file.

The tokenizer splits a text into pre-tokens and encodes each on its own, so equal pre-tokens have equal ids. The
split is done here for a slice of texts at once, on arrays of code points; each distinct pre-token is then encoded
once by the tokenizer itself and its ids are placed wherever it occurs.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import regex
from tokenizers import Tokenizer

from lapwise.llm.text import Texts, U, mix

# Distinct pre-tokens whose ids a worker keeps between slices.
CACHE = 400_000

_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_STEP = U(0xD1342543DE82EF95)
_BACK = U(pow(int(_STEP), -1, 2**64))


@functools.cache
def _kinds() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    kinds = np.zeros(0x110000, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, name in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\p{White_Space}+")):
        for found in regex.finditer(name, points):
            low, high = ord(found[0][0]), ord(found[0][-1])
            kinds[low : high + 1] = kind
    kinds[0xD800:0xE000] = _OTHER
    return kinds


def pretoken_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pre-tokens start; ``first`` marks the first code point of every text."""
    n = len(points)
    kind = _kinds()[points]
    run = first.copy()
    run[1:] |= kind[1:] != kind[:-1]
    last = np.ones(n, bool)  # last code point of a text
    last[:-1] = first[1:]
    space = kind == _SPACE
    starts = run.copy()
    # The last white space before another kind goes to that run if it is a blank, else it stands alone.
    follows = np.flatnonzero(run & ~space & ~first)
    after_space = follows[space[follows - 1]]
    starts[after_space - 1] = True
    blank = after_space[points[after_space - 1] == 32]
    starts[blank] = False
    # Contractions: an apostrophe that starts a pre-token takes one of a few endings with it.
    quote = np.flatnonzero(starts & (points == 39) & ~last)
    for ending in ("s", "t", "m", "d", "re", "ve", "ll"):
        fits = quote[quote + len(ending) < n]
        for step, letter in enumerate(ending, 1):
            fits = fits[(points[fits + step] == ord(letter)) & ~first[fits + step]]
        starts[fits + 1] = False
        rest = fits + 1 + len(ending)
        rest = rest[rest < n]
        starts[rest[~first[rest] & (kind[rest] == _LETTER)]] = True
    return starts


class Encoder:
    """Encodes slices of texts; keeps the ids of pre-tokens seen."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[int, int] = {}
        self.pool = np.zeros(1024, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def _slots(self, hashes: np.ndarray, spans: np.ndarray, text: str) -> np.ndarray:
        """Places of the pre-tokens in the pool, after encoding those not seen before."""
        if len(self.slots) > CACHE:
            self._clear()
        names = hashes.tolist()
        fresh = [i for i, name in enumerate(names) if name not in self.slots]
        if fresh:
            strings = [text[a:b] for a, b in spans[fresh].tolist()]
            ids = [x.ids for x in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
            known = len(self.ends) - 1
            self.slots.update((names[i], known + k) for k, i in enumerate(fresh))
            used = int(self.ends[-1])
            self.ends = np.concatenate([self.ends, used + np.cumsum([len(x) for x in ids])])
            if self.ends[-1] > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros(2 * int(self.ends[-1]), np.uint32)])
            self.pool[used : self.ends[-1]] = np.concatenate([np.array(x, np.uint32) for x in ids])
        return np.array([self.slots[name] for name in names], np.int64)

    def encode(self, part: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and how many each has."""
        bounds = np.zeros(len(part.data) + 1, np.int64)
        np.cumsum((part.data & 0xC0) != 0x80, out=bounds[1:])
        bounds = bounds[part.bounds]
        raw = part.data.tobytes()
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            texts = [raw[a:b].decode(errors="replace") for a, b in zip(part.bounds[:-1], part.bounds[1:])]
            text, bounds = "".join(texts), np.concatenate([[0], np.cumsum([len(x) for x in texts])])
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(points)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(part), np.int64)
        first = np.zeros(n + 1, bool)
        first[bounds] = True
        starts = np.flatnonzero(pretoken_starts(points, first[:n]))
        ends = np.append(starts[1:], n)

        up = np.full(n, _STEP, U)
        up[0] = 1
        up = np.cumprod(up)
        sums = np.zeros(n + 1, U)
        np.cumsum((points.astype(U) + U(1)) * up, out=sums[1:])
        down = np.full(n, _BACK, U)
        down[0] = 1
        down = np.cumprod(down)
        hashes = mix((sums[ends] - sums[starts]) * down[starts])

        names, where, which = np.unique(hashes, return_index=True, return_inverse=True)
        slots = self._slots(names, np.stack([starts[where], ends[where]], 1), text)[which]
        sizes = (self.ends[1:] - self.ends[:-1])[slots]
        ahead = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.ends[slots] - (ahead - sizes), sizes) + np.arange(ahead[-1])]
        total = np.concatenate([[0], ahead])
        return ids, np.diff(total[np.searchsorted(starts, bounds)])


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)
