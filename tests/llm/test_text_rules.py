"""Words, repetition rules and tokens against plain Python."""

import collections
import random
import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lapwise.llm import repetition, text, tokens

WORD = re.compile("[^\x20\x09-\x0D]+")
ODD = [
    None, "", " ", "\n\n \t", "x", "a a a a a a a a a a a a", "a b c d e f a b c d e f", "é" * 3 + " b\n" * 30,
    "1 2 3 4 5 9 1 2 3 4 5 8 2 3 4 5 9 1 2 3 4", "long " * 5000, "#*$%&|<>[] w",
]


def plain(value):
    words = WORD.findall(value or "")
    runs = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = [False] * len(words)
    for i in range(len(words) - 4):
        if runs[tuple(words[i : i + 5])] > 1:
            inside[i : i + 5] = [True] * 5
    seen, again = set(), 0
    for line in (value or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    longest, size = 0, 5
    while size < len(words) < 2000:
        if max(collections.Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)).values()) < 2:
            break
        longest, size = size, size + 1
    symbols = sum((value or "").count(s) for s in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, again, sum(inside), longest


def measured(values, limit):
    found = []
    for _, part in text.slices(pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["text"]), "text", limit):
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat")
        found += list(zip(*[repetition.measure(part)[n].tolist() for n in names]))
    return found


@pytest.mark.parametrize("limit", [1, 300, 10**6])
def test_measures(limit):
    rng = random.Random(3)
    values = ODD + [
        " ".join(rng.choices("abcd", k=rng.randint(0, 60))) + rng.choice(["", "\nab c", "\n\n"]) for _ in range(200)
    ]
    for value, found in zip(values, measured(values, limit)):
        want = plain(value)
        assert found[:5] == want[:5], value
        if want[0] < 2000:
            assert found[5] == want[5], value


def test_suffix_order_and_intervals():
    rng = np.random.default_rng(1)
    counts = np.array([0, 40, 1, 25])
    symbols = rng.integers(0, 3, counts.sum()).astype(np.uint64)
    found = repetition.suffix_array(symbols, counts)
    ends = np.repeat(np.cumsum(counts), counts)
    for place in range(1, len(symbols)):
        i, j = found.order[place - 1], found.order[place]
        common = 0
        while ends[i] == ends[j] and i + common < ends[i] and j + common < ends[j] and (
            symbols[i + common] == symbols[j + common]
        ):
            common += 1
        assert found.common[place] == common
    for low, high, length in repetition.lcp_intervals(found.common).tolist():
        inner = found.common[low + 1 : high + 1]
        assert inner.min() == length
        assert low == 0 or found.common[low] < length
        assert high + 1 == len(symbols) or found.common[high + 1] < length


def test_maximal_repeats_are_counted():
    rng = random.Random(9)
    for _ in range(60):
        words = rng.choices("abc", k=rng.randint(0, 40))
        want, n = set(), len(words)
        for size in range(2, n):
            places = collections.defaultdict(list)
            for i in range(n - size + 1):
                places[tuple(words[i : i + size])].append(i)
            for run, at in places.items():
                left = {words[i - 1] if i else None for i in at}
                right = {words[i + size] if i + size < n else None for i in at}
                want |= {run} if len(at) > 1 and (len(left) > 1 or None in left) and (len(right) > 1 or None in right) else set()
        symbols = np.array([ord(w) for w in words], np.uint64)
        found = repetition.maximal_repeats(symbols, np.array([n]), 2)
        assert len(found.heads) == len(want), words


CYCLES = """
import resource, sys
import pyarrow as pa
from lapwise.llm import repetition, text
words = {"one": ["ab"], "two": ["ab", "cd"], "fibonacci": None}[sys.argv[1]]
if words is None:
    one, words = ["a"], ["a", "b"]
    while len(words) < 2_500_000:
        one, words = words, words + one
whole = (" ".join(words) + " ") * (1 + 5_000_000 // (3 * len(words)))
batch = pa.RecordBatch.from_arrays([pa.array([whole[:5_000_000]])], ["text"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
(_, part), = text.slices(batch, "text")
found = repetition.measure(part)
assert found["n_repeat_words"][0] == found["n_words"][0] > 1_000_000
assert found["longest_repeat"][0] > 500_000
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""


@pytest.mark.parametrize("kind", ["one", "two", "fibonacci"])
def test_long_repetitive_texts_take_bounded_memory(kind):
    root = Path(__file__).resolve().parents[2]
    run = subprocess.run([sys.executable, "-c", CYCLES, kind], cwd=root, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout.split()[-1]) < 1_000_000  # kB


def test_rules_on_frames(spark, rows):
    clean = " ".join(f"w{i}" for i in range(60))
    df = rows(
        "doc_id long, text string, kept string, n_words int",
        (1, clean, "x", 1), (2, (clean + " ") * 2, "y", 2), (3, None, None, None), (None, "one two", "z", 3),
        (1, clean, "x", 1),
    )
    found = [(r["doc_id"], r["n_words"], r["base_failed"], r["kept"]) for r in repetition.score(df).collect()]
    assert found == [
        (1, 60, False, True), (2, 120, True, False), (3, 0, True, False), (None, 2, True, False), (1, 60, False, True)
    ]
    assert repetition.keep(df).collect() == df.filter("doc_id = 1").collect()
    assert repetition.score(df.limit(0)).count() == 0


def test_long_repeat_is_rejected():
    passage = " ".join(f"p{i}" for i in range(repetition.MAX_LONGEST + 1))
    rest = " ".join(f"r{i}" for i in range(5000))
    batch = pa.RecordBatch.from_arrays([pa.array([f"{passage} {rest} {passage}"])], ["text"])
    (_, part), = text.slices(batch, "text")
    found = repetition.verdicts(repetition.measure(part))
    assert not found["base_failed"][0] and not found["kept"][0]


def test_tokens_equal_the_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain_tokenizer = Tokenizer.from_file(path)
    plain_tokenizer.encode_special_tokens = True
    rng = random.Random(5)
    values = ["", None, "don't 's I'll 'status 'tis \n\n foo\n  bar\t\tx y's'd ''s 12'm", "<|endoftext|> hi", "'", "a\n's"]
    values += ["".join(rng.choices("ab 'stdmrevl\n\t1½é中🙂.,!  _-'́", k=rng.randint(0, 30))) for _ in range(3000)]
    want = [x.ids for x in plain_tokenizer.encode_batch([v or "" for v in values], add_special_tokens=False)]
    coder, found = tokens.encoder(path), []
    for _, part in text.slices(pa.RecordBatch.from_arrays([pa.array(values)], ["text"]), "text", 500):
        ids, counts = coder.encode(part)
        found += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert found == want
