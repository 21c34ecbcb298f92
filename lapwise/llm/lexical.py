"""Exact ranked search over texts: MaxScore whose bounds come from pairs of terms.

A document's score for an item is a sum of contributions, one per shared term, that depend on term and document only. A
task cuts its documents into blocks and makes an index of each: for every term of the items its documents and
contributions with their maximum, and for chosen pairs of terms the intersection of their lists with the joint
contributions and their maximum. An item's terms are paired by falling document frequency, most frequent with next, since
long lists are the ones to skip. What a pair can add to any document is the largest of its joint maximum and the two
single maxima, which is less than the sum of these where the terms seldom have their maxima together.

An item then runs over its units (pairs and left-over terms) by falling bound. Units whose bounds add up to less than
the score of its tenth document so far cannot lift a document into the result alone: their lists are not read as a
whole, only looked up for documents found in the others, and no longer once a document's sum and the bounds left stay
below. If all units are of that kind the block is skipped. Nothing below the bound can be among the ten, so the result is
exact. A task returns at most ``k`` rows an item, which are ranked in two levels.

Items come in blocks of at most ``ITEMS`` items and about ``TERMS`` terms; only such a block is sent to the tasks, and
each costs two passes over the documents: document frequencies and lengths, then scores. Terms are known by 64-bit hashes.

Rules for odd input: a null or empty text has no term; items without known terms have no rows; rows that repeat an
item_id are one item with the terms of all of them; rows that repeat a doc_id are documents of their own; a null doc_id
comes last among equals; equal scores go by doc_id; an empty table on either side gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapwise.llm.text import Texts, U, slices, texts

TOP = 10
# Items and terms sent to the tasks at once; a longer item is a block of its own.
ITEMS = 2_000
TERMS = 200_000
# Documents and bytes of text in one block of the index.
BLOCK_DOCS = 16_384
BLOCK_BYTES = 64_000_000
# A task's results are ranked in so many groups before the last ranking.
SLOTS = 64
# Fixed values of the score: percentages of the length norm, scale of contributions.
NORM, SLOPE = 100, 90

_TERM = np.ones(256, bool)
_TERM[:128] = False
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = True


def terms(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms in order, and how many each text has."""
    first, last = part.spans(_TERM[part.data])
    return part.hashes(first, last, fold=True), part.counts(first)


@dataclass
class Items:
    """A block of items: ids, and the sorted hashes of their distinct terms, of all and of each."""

    ids: list
    each: list[np.ndarray]
    vocabulary: np.ndarray = field(default_factory=lambda: np.zeros(0, U))

    def places(self) -> list[np.ndarray]:
        return [np.searchsorted(self.vocabulary, own) for own in self.each]


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[Items]:
    """Items in the order of their ids, block by block; rows of one id stand together."""
    block, size = Items([], []), 0
    named = items.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text")).orderBy("_id")
    for row in named.toLocalIterator():
        own = np.unique(terms(texts(pa.array([row["_text"]], pa.large_string())))[0])
        if block.ids and block.ids[-1] == row["_id"]:
            block.each[-1] = np.union1d(block.each[-1], own)
        else:
            if block.ids and (len(block.ids) >= ITEMS or size + len(own) > TERMS):
                yield _closed(block)
                block, size = Items([], []), 0
            block.ids.append(row["_id"])
            block.each.append(own)
        size += len(own)
    if block.ids:
        yield _closed(block)


def _closed(block: Items) -> Items:
    block.vocabulary = np.unique(np.concatenate(block.each))
    return block


def postings(part: Texts, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Term, text and frequency of every posting in the vocabulary, by term and text; and terms per text."""
    hashes, counts = terms(part)
    owner = np.repeat(np.arange(len(part)), counts)
    if not len(vocabulary):
        return owner[:0], owner[:0], owner[:0], counts
    place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = vocabulary[place] == hashes
    both, tf = np.unique(place[known] * np.int64(len(part)) + owner[known], return_counts=True)
    return both // len(part), both % len(part), tf, counts


def statistics(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms in all, and the document frequency of each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, length = np.zeros(len(vocabulary), np.int64), 0, 0
        for batch in batches:
            for _, part in slices(batch, "_text"):
                term, _, _, counts = postings(part, vocabulary)
                df += np.bincount(term, minlength=len(vocabulary))
                docs += int((counts > 0).sum())
                length += int(counts.sum())
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -2, *found.tolist()]), pa.array([docs, length, *df[found].tolist()])], ["place", "n"]
        )

    sums = docs.select("_text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    df, totals = np.zeros(len(vocabulary), np.int64), {-1: 0, -2: 0}
    for row in sums.collect():  # at most the block's terms
        if row["place"] < 0:
            totals[row["place"]] = row["n"]
        else:
            df[row["place"]] = row["n"]
    return totals[-1], totals[-2], df


def weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)


def paired(places: np.ndarray, df: np.ndarray, weight: np.ndarray) -> list[tuple[int, ...]]:
    """The units of an item: terms that count, paired by falling document frequency; a rest stays alone."""
    counted = places[(df[places] > 0) & (weight[places] > 0)]
    ordered = counted[np.lexsort((counted, -df[counted]))].tolist()
    return [tuple(ordered[i : i + 2]) for i in range(0, len(ordered), 2)]


class Index:
    """Lists of one block of documents, and the intersection lists of the pairs asked for."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, contribution: np.ndarray, n_terms: int, n_docs: int):
        order = np.lexsort((doc, term))
        self.doc, self.contribution, self.n_docs = doc[order], contribution[order], n_docs
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.pairs: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, int]] = {}

    def list_of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self.start[term], self.start[term + 1])
        return self.doc[span], self.contribution[span]

    def most(self, term: int) -> int:
        contribution = self.list_of(term)[1]
        return int(contribution.max()) if len(contribution) else 0

    def pair(self, one: int, other: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents with both terms, what these add together, and the most of it; made once a block."""
        if (one, other) not in self.pairs:
            docs, value = self.list_of(one)
            found, second = look_up(docs, *self.list_of(other))
            joint = value[found] + second[found]
            self.pairs[one, other] = docs[found], joint, int(joint.max()) if len(joint) else 0
        return self.pairs[one, other]

    def bound(self, unit: tuple[int, ...]) -> int:
        """The most a unit adds to any document of the block."""
        single = max(self.most(term) for term in unit)
        return max(single, self.pair(*unit)[2]) if len(unit) == 2 else single


def look_up(wanted: np.ndarray, docs: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which wanted documents stand in a list, and their values there (0 elsewhere)."""
    if not len(docs):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    place = np.minimum(np.searchsorted(docs, wanted), len(docs) - 1)
    found = docs[place] == wanted
    return found, np.where(found, value[place], 0)


def candidates(index: Index, units: list[tuple[int, ...]], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the block that score ``least`` or more (and above 0), with their full scores."""
    bounds = np.array([index.bound(unit) for unit in units], np.int64)
    order = np.argsort(bounds, kind="stable")
    below = np.cumsum(bounds[order])  # the most that all units up to here add
    skipped = int(np.searchsorted(below, least)) if least > 0 else 0
    score = np.zeros(index.n_docs, np.int64)
    for place in order[skipped:]:
        for term in units[place]:
            docs, value = index.list_of(term)
            score[docs] += value
    found = np.flatnonzero(score)
    score = score[found]
    for number in range(skipped - 1, -1, -1):
        alive = score + below[number] >= least
        found, score = found[alive], score[alive]
        if not len(found):
            break
        unit = units[order[number]]
        if len(unit) == 2:
            both, joint = look_up(found, *index.pair(*unit)[:2])
            score = score + joint
            rest = ~both
            for term in unit:
                score[rest] += look_up(found[rest], *index.list_of(term))[1]
        else:
            score = score + look_up(found, *index.list_of(unit[0]))[1]
    alive = score >= max(least, 1)
    return found[alive], score[alive]


class Best:
    """The best documents of an item so far: score, whether the id is null, id."""

    def __init__(self, k: int):
        self.k = k
        self.rows = np.zeros((3, 0), np.int64)

    @property
    def least(self) -> int:
        """The score a document needs to have a chance, 0 while there is room."""
        return int(self.rows[0, -1]) if self.rows.shape[1] == self.k else 0

    def add(self, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.stack([score, null.astype(np.int64), ids])], axis=1)
        self.rows = rows[:, np.lexsort((rows[2], rows[1], -rows[0]))[: self.k]]


def _ranked(docs: DataFrame, block: Items, k: int, id_type: str) -> DataFrame:
    n, length, df = statistics(docs, block.vocabulary)
    weight = weights(n, df)
    units = [paired(places, df, weight) for places in block.places()]
    vocabulary, ids = block.vocabulary, block.ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in units]
        held: list[tuple] = []
        n_docs = n_bytes = 0

        def search() -> None:
            term, doc, value, null, keys = (np.concatenate(part) for part in zip(*held))
            index = Index(term, doc, value, len(vocabulary), n_docs)
            for item, own in enumerate(units):
                if own:
                    found, score = candidates(index, own, best[item].least)
                    if len(found):
                        best[item].add(score, null[found], keys[found])

        for batch in batches:
            for rows, part in slices(batch, "_text"):
                term, doc, tf, counts = postings(part, vocabulary)
                norm = NORM - SLOPE + (SLOPE * counts * n) // max(length, 1)
                value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * norm[doc]))
                keys = rows.column("_id")
                null = np.asarray(keys.is_null())
                held.append((term, doc + n_docs, value, null, np.asarray(keys.fill_null(0))))
                n_docs, n_bytes = n_docs + len(part), n_bytes + len(part.data)
                if n_docs >= BLOCK_DOCS or n_bytes >= BLOCK_BYTES:
                    search()
                    held, n_docs, n_bytes = [], 0, 0
        if held:
            search()
        slot = TaskContext.get().partitionId() % SLOTS
        for item, own in enumerate(best):
            score, null, keys = own.rows
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(score), item, np.int32)), pa.array(np.full(len(score), slot, np.int32)),
                        pa.array(keys, mask=null.astype(bool)), pa.array(score),
                    ],
                    ["_item", "_slot", "doc_id", "score"],
                )

    found = docs.mapInArrow(run, "_item int, _slot int, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    near = found.withColumn("_n", F.row_number().over(Window.partitionBy("_item", "_slot").orderBy(*order)))
    rank = F.row_number().over(Window.partitionBy("_item").orderBy(*order))
    top = near.filter(F.col("_n") <= k).withColumn("rank", rank).filter(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame(list(enumerate(ids)), f"_item int, item_id {id_type}")
    return top.join(names, "_item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(
    df: DataFrame, items: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank from 1, doc_id, score."""
    docs = df.select(F.col(f"`{key}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text"))
    kind = items.schema[item].dataType.simpleString()
    result = df.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for number, block in enumerate(item_blocks(items, item, item_text)):
        ranked = _ranked(docs, block, k, kind)
        result = result.union(ranked) if number else ranked
    return result
