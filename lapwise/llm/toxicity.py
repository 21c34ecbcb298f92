"""Toxicity scores by logistic regression, trained with FTRL-proximal on hashed word n-grams and skip-grams.

A document is the set of its words, word pairs and pairs with one or two words between them, hashed to 2^20
coordinates. Every coordinate has its own learning rate, and L1 keeps all but a few hundred weights at zero, so the
model that goes to the tasks is small whatever the corpus. The sum of weights is calibrated to a probability by a
slope and an offset fitted with smoothed targets. Words are runs of letters, digits and non-ASCII bytes, in
lower case.

The model is fitted on at most ``SAMPLE`` labelled documents of the two classes (those with the smallest hashes of their
ids), each class weighted by its share among all labelled documents for the calibration. Whole texts are scored, row
by row, without a shuffle.

Rules for odd input: a null or empty text has no feature and gets the score of the bias; a document with several
labels is toxic if one says so; null labels are ignored; without labels the score is 1/3; repeated rows are scored row
by row; an empty table gives an empty result; other columns are ignored or passed on, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.llm.text import Texts, U, mix, slices

BITS = 20
# Labelled documents that the model is fitted on, at most: clean ones and toxic ones.
SAMPLE = (5_000, 3_000)
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 1.0

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Row and coordinate of all n-grams and skip-grams, with repeats."""
    first, last = part.spans(_WORD[part.data])
    row = np.repeat(np.arange(len(part)), part.counts(first))
    words = part.hashes(first, last, fold=True)
    rows, grams = [row], [words]
    for gap in (1, 2, 3):
        same = row[gap:] == row[: len(row) - gap]
        pair = words[: len(words) - gap] * U(2 * gap + 1) + mix(words[gap:] + U(gap))
        rows.append(row[gap:][same])
        grams.append(mix(pair[same]))
    return np.concatenate(rows), (np.concatenate(grams) >> U(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    """Weights that are not zero, by coordinate, and the bias."""

    places: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, part: Texts) -> np.ndarray:
        dense = np.zeros(1 << BITS, np.float64)
        dense[self.places] = self.weights
        row, place = features(part)
        used = dense[place] != 0
        pairs = np.unique(row[used] << BITS | place[used])
        total = np.bincount(pairs >> BITS, dense[pairs & ((1 << BITS) - 1)], minlength=len(part)) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(sets: list[np.ndarray], labels: np.ndarray, n_toxic: int, n_clean: int) -> Model:
    """FTRL-proximal over sets of distinct coordinates in the given order, several times."""
    z, n = np.zeros((2, (1 << BITS) + 1))
    bias = 1 << BITS
    for _ in range(EPOCHS):
        for places, label in zip(sets, labels):
            at = np.append(places.astype(np.int64), bias)
            zs, ns = z[at], n[at]
            root = np.sqrt(ns)
            pull = np.sign(zs) * L1
            pull[-1] = 0
            w = np.where(np.abs(zs) > np.abs(pull), (pull - zs) / ((BETA + root) / ALPHA + L2), 0)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            z[at] += g - (np.sqrt(ns + g * g) - root) / ALPHA * w
            n[at] += g * g
    w = np.where(np.abs(z) > L1, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0)
    places = np.flatnonzero(w[:-1])
    if not len(labels):
        return Model(places, w[places], float(np.log(0.5)))
    sums = np.array([w[places_].sum() for places_ in sets])
    slope, offset = calibrated(sums, labels, n_toxic, n_clean)
    return Model(places, slope * w[places], offset)


def calibrated(sums: np.ndarray, labels: np.ndarray, n_toxic: int, n_clean: int) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the sums of weights, by Newton steps on smoothed targets."""
    toxic = max(labels.sum(), 1)
    clean = max(len(labels) - labels.sum(), 1)
    weight = np.where(labels > 0, max(n_toxic, 1) / toxic, max(n_clean, 1) / clean)
    goal = np.where(labels > 0, (toxic + 1) / (toxic + 2), 1 / (clean + 2))
    x = np.stack([sums, np.ones(len(sums))], 1)
    at = np.array([1.0, np.log((n_toxic + 0.5) / (n_clean + 1.0))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        gradient = x.T @ (weight * (p - goal)) + 1e-3 * (at - [1.0, at[1]])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        at = at - np.clip(np.linalg.solve(curve, gradient), -1, 1)
    return float(max(at[0], 0.0)), float(at[1])


def held_out(key: Column) -> Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("_label"))
        .withColumn("_order", F.xxhash64("doc_id"))
    )
    totals = {row["_label"]: row["n"] for row in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    sides = [
        known.filter(F.col("_label") == label).orderBy("_order", "doc_id").limit(SAMPLE[label]) for label in (0, 1)
    ]
    chosen = sides[0].union(sides[1]).select(F.col("doc_id").alias("_id"), "_label", "_order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, part in slices(batch, "text"):
                row, place = features(part)
                found = np.unique(row << BITS | place)
                cuts = np.searchsorted(found >> BITS, np.arange(len(part) + 1))
                flat = (found & ((1 << BITS) - 1)).astype(np.uint32)
                sets = [flat[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("_label"), rows.column("_order"), pa.array(sets, pa.binary())],
                    ["_label", "_order", "_set"],
                )

    sampled = (
        docs.select(F.col(key).alias("_id"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), "_id")  # sum(SAMPLE) rows at most
        .select("_label", "_order", "text")
        .mapInArrow(run, "_label int, _order long, _set binary")
        .dropDuplicates(["_order"])  # one text of each labelled document
        .toArrow()
    )
    # Both classes were taken from the low end of the hashes; another hash mixes them evenly.
    order = np.argsort(mix(sampled.column("_order").to_numpy()), kind="stable")
    labels = sampled.column("_label").to_numpy()[order].astype(np.float64)
    packed = pa.concat_arrays(sampled.column("_set").chunks or [pa.array([], pa.binary())])
    del sampled
    # The sets stay in one buffer; each is read in place.
    raw = packed.buffers()[2] if len(packed) else None
    flat = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
    ends = np.cumsum([0, *pc.binary_length(packed).to_pylist()])
    sets = [flat[ends[i] : ends[i + 1]].view(np.uint32) for i in order.tolist()]
    return fit(sets, labels, totals.get(1, 0), totals.get(0, 0))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, held_out, score and predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, part in slices(batch, text):
                found = model.score(part)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(key), rows.column("held_out"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                    [key, "held_out", "score", "predicted"],
                )

    schema = T.StructType([
        docs.schema[key], *T.StructType.fromDDL("held_out boolean, score double, predicted int").fields
    ])
    return docs.select(key, text, held_out(F.col(key)).alias("held_out")).mapInArrow(run, schema)


def keep(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, part in slices(batch, text):
                yield rows.filter(pa.array(model.score(part) < 0.5))

    return docs.mapInArrow(run, docs.schema)
