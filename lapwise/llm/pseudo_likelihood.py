"""Document scores by masked pseudo-likelihood under a small bidirectional window network.

Every word is hidden in turn and predicted from the ``REACH`` words on both sides; a document's score is the sum of
the conditional log-probabilities of its words. A word's probability is that of its class, from the network, times its
own share of the class, from counts over all words of all documents. The most frequent words (``VOCABULARY``, more as
the number of different words grows) have entries; the first ``OWN`` are classes of their own, the others share
``BANDS`` classes of about equal mass. All rarer words fall by hash into ``BUCKETS`` entries and ``RARE`` classes; as
words, each keeps its own count.

The counts stay a partitioned table. The ``HEAD`` most frequent words go to the tasks with their counts; the distinct
other words of each document, none of them frequent, meet the table in a join. The result is the same for any ``HEAD`` that
holds the vocabulary.

The network adds one vector per offset and entry, bends the sum by tanh and weighs the hidden units per class. It is
trained in numpy with Adagrad on minibatches. Every round takes an equal part of the documents, dealt by the hash of
their text: each task starts from the common weights, learns from all its words, and returns how far every vector it
used has moved. The moves, weighted by use, are averaged by Spark; the driver gets the new weights only. After
``PARTS`` rounds every word of the corpus has been learned from once. Whole texts are scored, row by row.

Rules for odd input: a null or empty text has no words, score 0 and no mean; repeated rows are scored row by row; a word
that was not counted is taken as one seen once; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.llm.text import Texts, slices
from lapwise.operators.staging import stage

VOCABULARY = 4_096
OWN, BANDS, RARE = 48, 15, 17
CLASSES = OWN + BANDS + RARE
BUCKETS = 4_096
# Words whose counts go to the tasks.
HEAD = 262_144
REACH = 2
# Different words up to which the vocabulary keeps its size; beyond, it grows with their square root up to LARGEST.
FIRST, LARGEST = 250_000, 65_536
HIDDEN = 32
# Parts in which the documents are learned from, and rounds over parts.
PARTS = 4
ROUNDS = 4
# Words a round that a task learns from at least, on average, when a table has many small partitions.
TASK = 250_000
# Words of a minibatch, rate of learning and the squared gradient that every weight starts with.
MINIBATCH = 2_048
RATE, DAMPING = 0.1, 0.01
# Words that one step of scoring takes, and the smallest chance of a class.
STEP = 4_096
LEAST = 1e-30

OFFSETS = [*range(-REACH, 0), *range(1, REACH + 1)]


def word_ids(part: Texts, vocabulary: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entry of every word (by hash behind the vocabulary's where it has none), words per text, and the words.

    ``vocabulary`` is sorted; ``order`` gives the entries.
    """
    first, last = part.words()
    words = part.hashes(first, last, fold=True).view(np.int64)
    at, inside = lookup(vocabulary, words)
    ids = len(vocabulary) + words % BUCKETS
    ids[inside] = order[at[inside]]
    return ids, part.counts(first), words


def lookup(known: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each word among the sorted known ones, and whether it is there."""
    if not len(known):
        return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    return at, known[at] == words


def contexts(ids: np.ndarray, counts: np.ndarray, edge: int) -> np.ndarray:
    """The words at the offsets around each word, ``edge`` beyond the ends of its text."""
    n = len(ids)
    start = np.repeat(np.cumsum(counts) - counts, counts)
    end = np.repeat(np.cumsum(counts), counts)
    place = np.arange(n)
    found = np.empty((n, len(OFFSETS)), np.int64)
    for i, offset in enumerate(OFFSETS):
        at = place + offset
        inside = (at >= start) & (at < end)
        found[:, i] = np.where(inside, ids[np.clip(at, 0, max(n - 1, 0))], edge)
    return found


def sums(entries: np.ndarray, rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ones of the sorted ``entries``, their numbers, and the sums of their ``rows`` of ``values``.

    Most entries have one row, which needs no summing.
    """
    first = np.flatnonzero(np.append(True, entries[1:] != entries[:-1]))
    n = np.diff(np.append(first, len(entries)))
    found = np.take(values, rows[first], axis=0)
    several = n > 1
    if several.any():
        members = np.take(values, rows[np.repeat(several, n)], axis=0)
        ends = np.cumsum(n[several])
        found[several] = np.add.reduceat(members, ends - n[several], axis=0)
    return entries[first], n, found


@dataclass
class Network:
    """Vectors per offset and entry, and weights per class. The last hidden unit is always 1."""

    tables: np.ndarray
    output: np.ndarray

    def hidden(self, context: np.ndarray) -> np.ndarray:
        found = np.take(self.tables[0], context[:, 0], axis=0)
        for i in range(1, len(OFFSETS)):
            found += np.take(self.tables[i], context[:, i], axis=0)
        np.tanh(found, out=found)
        found[:, -1] = 1
        return found

    def chances(self, hidden: np.ndarray) -> np.ndarray:
        """Probability of every class (rows) for every word (columns)."""
        found = self.output @ hidden.T
        found -= found.max(axis=0)
        np.exp(found, out=found)
        found *= 1 / found.sum(axis=0)
        return found

    def slopes(self, context: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient of the summed loss by each word's sum of vectors, and by the output weights."""
        hidden = self.hidden(context)
        missed = self.chances(hidden)
        missed[own, np.arange(len(own))] -= 1
        outer = missed @ hidden
        # The constant unit has slope 0.
        np.multiply(hidden, hidden, out=hidden)
        np.subtract(1, hidden, out=hidden)
        hidden *= missed.T @ self.output
        return hidden, outer


class Learner:
    """A copy of a network that learns by Adagrad, and how often it used each vector."""

    def __init__(self, net: Network) -> None:
        self.start = net
        self.net = Network(net.tables.copy(), net.output.copy())
        self.past = Network(np.full_like(net.tables, DAMPING), np.full_like(net.output, DAMPING))
        self.used = np.zeros(net.tables.shape[:2], np.int64)
        self.words = 0

    def learn(self, context: np.ndarray, own: np.ndarray) -> None:
        inner, outer = self.net.slopes(context, own)
        # Small integers are sorted by radix, in linear time.
        small = context.astype(np.uint16) if self.used.shape[1] <= 1 << 16 else context
        self.past.output += outer * outer
        self.net.output -= RATE * outer / np.sqrt(self.past.output)
        for i in range(len(OFFSETS)):
            order = np.argsort(small[:, i], kind="stable")
            entry, n, slope = sums(np.take(context[:, i], order), order, inner)
            past = np.take(self.past.tables[i], entry, axis=0)
            past += slope * slope
            self.past.tables[i][entry] = past
            np.sqrt(past, out=past)
            slope *= RATE
            slope /= past
            self.net.tables[i][entry] = np.take(self.net.tables[i], entry, axis=0) - slope
            self.used[i][entry] += n
        self.words += len(own)

    def moves(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the weights that were used, how often, and how far they have moved."""
        rows = np.flatnonzero(self.used.ravel())
        tables = (self.net.tables - self.start.tables).reshape(-1, HIDDEN)[rows]
        output = self.net.output - self.start.output
        classes = np.arange(len(output)) + self.used.size
        weight = np.concatenate([self.used.ravel()[rows], np.full(len(output), self.words)])
        return np.concatenate([rows, classes]), weight, np.concatenate([tables, output])


@dataclass
class Model:
    """Vocabulary, class and log share of every entry, and the network.

    The log share of a bucket is that of a word seen once. ``head`` has the sorted words that go to the tasks and
    ``head_log`` the logarithms of their counts; ``counted`` has the words (word, n) that are not among them.
    """

    vocabulary: np.ndarray
    order: np.ndarray
    word_class: np.ndarray
    log_share: np.ndarray
    net: Network
    head: np.ndarray
    head_log: np.ndarray
    counted: DataFrame | None

    def log_probabilities(self, context: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Conditional log-probability of each word given its context; words without entry as if seen once."""
        found = np.empty(len(ids))
        for low in range(0, len(ids), STEP):
            words = ids[low : low + STEP]
            chance = self.net.chances(self.net.hidden(context[low : low + STEP]))
            own = chance[self.word_class[words], np.arange(len(words))].astype(np.float64)
            found[low : low + STEP] = np.log(np.maximum(own, LEAST)) + self.log_share[words]
        return found

    def score(self, part: Texts) -> tuple[np.ndarray, np.ndarray, pa.ListArray, pa.ListArray]:
        """Number of words and summed log-probability of each text, and its words whose counts are not in the head."""
        ids, counts, words = word_ids(part, self.vocabulary, self.order)
        found = self.log_probabilities(contexts(ids, counts, edge(self.vocabulary)), ids)
        rare = np.flatnonzero(ids >= len(self.vocabulary))
        at, inside = lookup(self.head, words[rare])
        found[rare[inside]] += self.head_log[at[inside]]
        sums = np.concatenate([[0.0], np.cumsum(found)])
        ends = np.cumsum(counts)
        total = np.where(counts > 0, sums[ends] - sums[ends - counts], 0.0)
        left = rare[~inside]
        owner, word = np.repeat(np.arange(len(part)), counts)[left], words[left]
        sort = np.lexsort((word, owner))
        owner, word = owner[sort], word[sort]
        new = np.ones(len(word), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (word[1:] != word[:-1])
        starts = np.flatnonzero(new)
        times = np.diff(np.append(starts, len(word)))
        bounds = pa.array(np.searchsorted(owner[starts], np.arange(len(part) + 1)).astype(np.int32))
        return (
            counts, total, pa.ListArray.from_arrays(bounds, pa.array(word[starts])),
            pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))),
        )


def edge(vocabulary: np.ndarray) -> int:
    """The entry that stands beyond the ends of a text."""
    return len(vocabulary) + BUCKETS


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (word, n) of all words of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in slices(batch, text, 8_000_000):
                words, n = np.unique(part.hashes(*part.words(), fold=True).view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n.astype(np.int64))], ["word", "n"])

    return docs.select(text).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def classes(counts: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class and log share of every entry, for entries sorted by count, and the words of each class.

    ``rare`` has the number of words of each rare class.
    """
    mass = np.cumsum(counts[OWN:]) - counts[OWN:] / 2
    shared = OWN + np.minimum(BANDS * mass // max(counts[OWN:].sum(), 1), BANDS - 1).astype(np.int64)
    found = np.concatenate([np.arange(min(OWN, len(counts))), shared, OWN + BANDS + np.arange(BUCKETS) % RARE])
    total = np.bincount(found[: len(counts)], counts, minlength=CLASSES)
    total[OWN + BANDS :] = rare
    number = np.concatenate([np.maximum(counts, 1), np.ones(BUCKETS)])
    return found, np.log(number / np.maximum(total[found], 1)), total


def fresh(entries: int, share: np.ndarray) -> Network:
    """The network before the first round: small random vectors, and the overall share of each class."""
    rng = np.random.default_rng(0)
    tables = rng.normal(0, 0.1, (len(OFFSETS), entries, HIDDEN)).astype(np.float32)
    output = rng.normal(0, 0.1, (len(share), HIDDEN)).astype(np.float32)
    output[:, -1] = np.log(share)
    return Network(tables, output)


def trained(
    docs: DataFrame, text: str, vocabulary: np.ndarray, order: np.ndarray, word_class: np.ndarray, net: Network,
    tasks: int | None = None,
) -> Network:
    """The network after a round over ``docs``: every vector moved by the mean of its moves, weighted by use.

    ``tasks`` joins the partitions of a table to so many, without a shuffle, if it has more.
    """
    outside = edge(vocabulary)
    names = [f"v{j}" for j in range(HIDDEN)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, rng = Learner(net), np.random.default_rng(1)
        for batch in batches:
            for _, part in slices(batch, text):
                ids, n, _ = word_ids(part, vocabulary, order)
                around, own = contexts(ids, n, outside), word_class[ids]
                mixed = rng.permutation(len(ids))
                for low in range(0, len(ids), MINIBATCH):
                    some = mixed[low : low + MINIBATCH]
                    learner.learn(np.take(around, some, axis=0), own[some])
        if learner.words:
            rows, weight, moved = learner.moves()
            for low in range(0, len(rows), 16_384):
                at = slice(low, low + 16_384)
                weighted = (moved[at] * weight[at, None]).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[at]), pa.array(weight[at]), *[pa.array(weighted[:, j]) for j in range(HIDDEN)]],
                    ["row", "n", *names],
                )

    dealt = docs.select(text) if tasks is None else docs.select(text).coalesce(tasks)
    moves = dealt.mapInArrow(run, ", ".join(["row long, n long", *[f"{v} float" for v in names]]))
    mean = moves.groupBy("row").agg(*[(F.sum(v) / F.sum("n")).cast("float").alias(v) for v in names])
    found = mean.toArrow()  # one row per weight vector, LARGEST + BUCKETS entries at most
    weights = np.concatenate([net.tables.reshape(-1, HIDDEN), net.output])
    rows = found.column("row").to_numpy()
    for j, v in enumerate(names):
        weights[rows, j] += found.column(v).to_numpy()
    split = net.tables.shape[0] * net.tables.shape[1]
    return Network(weights[:split].reshape(net.tables.shape), weights[split:])


def vocabulary_size(different: int) -> int:
    """Words with own entries when the corpus has that many different words."""
    return min(int(VOCABULARY * max(1.0, (different / FIRST) ** 0.5)), max(VOCABULARY, LARGEST), max(VOCABULARY, HEAD))


def train(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> Model:
    """Count all words and train the network. More rounds than ``PARTS`` learn from documents again."""
    counted = stage(word_counts(docs, text))
    # As many rows as there are different counts, at most about the root of twice the number of words.
    kinds = counted.groupBy("n").agg(F.count("*").alias("kinds")).toArrow()
    levels = np.argsort(-kinds.column("n").to_numpy())
    inside = np.cumsum(kinds.column("kinds").to_numpy()[levels]) <= HEAD
    least = int(kinds.column("n").to_numpy()[levels][inside].min(initial=np.iinfo(np.int64).max))
    top = counted.filter(F.col("n") >= least).toArrow()  # HEAD rows at most
    words, counts = top.column("word").to_numpy(), top.column("n").to_numpy()
    sort = np.argsort(words)
    head, head_log = words[sort], np.log(counts[sort])
    different = int(kinds.column("kinds").to_numpy().sum())
    first = np.lexsort((words, -counts))[: vocabulary_size(different)]
    words, counts = words[first], counts[first].astype(np.float64)
    order = np.argsort(words)
    vocabulary = words[order]

    rare = np.zeros(RARE)
    bucket = F.pmod(F.pmod("word", F.lit(BUCKETS)), F.lit(RARE))
    for row in counted.groupBy(bucket.alias("rare")).agg(F.sum("n").alias("n")).collect():  # RARE rows
        rare[row["rare"]] = row["n"]
    rare -= np.bincount(words % BUCKETS % RARE, counts, minlength=RARE)
    word_class, log_share, total = classes(counts, rare)

    # A class without words has no chance worth naming.
    net = fresh(edge(vocabulary) + 1, np.maximum(total, 1e-6) / max(total.sum(), 1))
    part = F.pmod(F.xxhash64(text), F.lit(PARTS))
    tasks = -(-int(total.sum()) // (PARTS * TASK)) + 8
    for i in range(rounds):
        net = trained(docs.filter(part == i % PARTS), text, vocabulary, order, word_class, net, tasks)
    rest = counted.filter((F.col("n") < least) & (F.col("n") > 1))
    return Model(vocabulary, order, word_class, log_share, net, head, head_log, rest)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_words, pseudo_log_likelihood and its mean per word."""
    net = replace(model, counted=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, part in slices(batch, text):
                n, total, words, times = net.score(part)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("_row"), rows.column(key), pa.array(n.astype(np.int64)), pa.array(total), words, times],
                    ["_row", key, "n_words", "_total", "_words", "_times"],
                )

    schema = T.StructType([
        *T.StructType.fromDDL("_row long").fields, docs.schema[key],
        *T.StructType.fromDDL("n_words long, _total double, _words array<long>, _times array<int>").fields,
    ])
    found = stage(docs.select(F.monotonically_increasing_id().alias("_row"), key, text).mapInArrow(run, schema))
    # Each distinct word of a document once, and no frequent word; both sides grow with the corpus.
    others = found.select("_row", F.inline(F.arrays_zip(F.col("_words").alias("word"), F.col("_times").alias("times"))))
    added = (
        others.hint("merge").join(model.counted, "word")
        .groupBy("_row").agg(F.sum(F.col("times") * F.log("n")).alias("_added"))
    )
    total = F.col("_total") + F.coalesce("_added", F.lit(0.0))
    return found.join(added.hint("merge"), "_row", "left").select(
        key, "n_words", total.alias("pseudo_log_likelihood"),
        F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_likelihood"),
    )
