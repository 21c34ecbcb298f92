"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A sketch has ``COORDINATES`` places. In round i every shingle of a document is hashed to a place and a value
in [i, i + 1); a place keeps its smallest value, and rounds end once every place is filled. From round
``COORDINATES`` on, round i serves place i - COORDINATES alone, so every place is filled for certain. Places of two
documents agree with the probability of their similarity, with the concentration of independent trials, at a cost
of n + t log t hashes instead of n * t.

``ROWS`` places form a band. Documents that agree in a band are candidates; two of similarity 0.8 share none of the
64 bands with a chance of 8e-6, of 0.85 with 5e-9. Candidates are confirmed on their full shingle sets:

1. Documents with equal sets are one vertex, known by its smallest doc_id.
2. In every bucket of a band each member is compared with the smallest one, the leader. This gives most links.
3. Two linked documents differ by at most 0.2, so in a bucket they share, both have at least 0.4 in common with the
   leader, or both have less than 0.6. The first kind lie in one cluster (component by similarities of 0.4 to leaders),
   the second among the bucket's far members. Clusters and sets of far members that hold several components are
   compared pair by pair: cut into blocks of members, a task takes two blocks and counts all their intersections at
   once; only links leave it. So no pair that agrees in a band stays unchecked, no group is capped, no task holds a
   group, and pairs are not listed.

Rules for odd input: a null or empty text has an empty set and is linked with nothing; rows that repeat a doc_id are
one document with several texts, linked if any of them is; a row without doc_id is linked with nothing and kept; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.llm.components import components
from lapwise.llm.text import Texts, U, mix, slices, texts, windows
from lapwise.operators.staging import remove, stage

COORDINATES = 512
ROWS = 8
SHINGLE = 5
# Two documents are linked from 100 * intersection >= PERCENT * union on.
PERCENT = 80
# Similarity to the leader, in percent, from which a member is in its cluster, and below which it is far.
NEAR, FAR = 40, 60
# About so many members of a group are compared with as many others in one go, on so many shingles at a time.
BLOCK = 128
COLUMNS = 50_000

_ROUND = mix(np.arange(1, 2 * COORDINATES + 1, dtype=U) * U(0x9E3779B97F4A7C15))
_ROW = mix(np.arange(101, 101 + ROWS, dtype=U)) | U(1)
_BAND = mix(np.arange(1, COORDINATES // ROWS + 1, dtype=U) + U(7_000_003))
_EMPTY = U(2**64 - 1)


def shingle_sets(part: Texts, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; with fewer words than ``size``, all of them as one shingle."""
    first, last = part.words()
    counts = part.counts(first)
    words = part.hashes(first, last, fold=True)
    found, n = windows(words, counts, size)
    ends = np.cumsum(n)
    word_ends = np.cumsum(counts)
    sets = []
    for i in range(len(part)):
        if n[i]:
            sets.append(np.unique(found[ends[i] - n[i] : ends[i]]))
        elif counts[i]:
            short, _ = windows(words[word_ends[i] - counts[i] : word_ends[i]], counts[i : i + 1], int(counts[i]))
            sets.append(short + U(counts[i]))
        else:
            sets.append(np.zeros(0, U))
    return sets


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The smallest (round, value) at each place, for a set that is not empty."""
    found = np.full(COORDINATES, _EMPTY)
    block = -(-8 * COORDINATES // len(shingles))
    done = 0
    while done < 2 * COORDINATES:
        until = min(done + block, 2 * COORDINATES, COORDINATES if done < COORDINATES else 2 * COORDINATES)
        rounds = np.arange(done, until, dtype=U)[:, None]
        hashed = mix(shingles[None, :] ^ _ROUND[done:until, None])
        value = (rounds << U(32)) | (hashed & U(0xFFFFFFFF))
        if done < COORDINATES:
            place = ((hashed >> U(32)) * U(COORDINATES) >> U(32)).astype(np.int64)
            np.minimum.at(found, place.ravel(), value.ravel())
        else:
            place = np.arange(done - COORDINATES, until - COORDINATES)
            found[place] = np.minimum(found[place], value.min(axis=1))
        done = until
        if not (found == _EMPTY).any():
            break
    return found


def band_keys(places: np.ndarray) -> np.ndarray:
    """One key per band."""
    return mix((mix(places).reshape(-1, ROWS) * _ROW).sum(axis=1, dtype=U) ^ _BAND).view(np.int64)


def _sketched(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Per row: set size, two fingerprints of the set, and the band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, part in slices(batch, text):
                sets = shingle_sets(part, size)
                marks = np.array([[mix(s).sum(dtype=U), mix(s ^ U(0xA5A5)).sum(dtype=U)] for s in sets], U)
                keys = [band_keys(sketch(s)) if len(s) else np.zeros(0, np.int64) for s in sets]
                ends = np.cumsum([0, *map(len, keys)])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(key),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(marks[:, 0].view(np.int64)),
                        pa.array(marks[:, 1].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys))),
                    ],
                    [key, "n_shingles", "mark", "check", "bands"],
                )

    schema = T.StructType([
        df.schema[key], *T.StructType.fromDDL("n_shingles long, mark long, check long, bands array<long>").fields
    ])
    return df.select(key, text).mapInArrow(run, schema)


def _compared(pairs: DataFrame, sides: DataFrame, size: int) -> DataFrame:
    """The pairs (a, b) with their similarity in percent, rounded down; ``sides`` has (node, text) of all nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, left in slices(batch, "text_a", 500_000):
                right = texts(rows.column("text_b"))
                percent = []
                for one, other in zip(shingle_sets(left, size), shingle_sets(right, size)):
                    both = len(np.intersect1d(one, other, assume_unique=True))
                    percent.append(100 * both // max(len(one) + len(other) - both, 1))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("a"), rows.column("b"), pa.array(percent, pa.int32())], ["a", "b", "percent"]
                )

    left = sides.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = sides.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a long, b long, percent int").groupBy("a", "b").agg(F.max("percent").alias("percent"))


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of different sets."""
    found = np.zeros((len(sets), len(sets)), np.float64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    sort = np.argsort(column, kind="stable")
    owner, column = owner[sort], column[sort]
    for low in range(0, int(shared.sum()), COLUMNS):
        left, right = np.searchsorted(column, [low, low + COLUMNS])
        marks = np.zeros((len(sets), COLUMNS), np.float32)
        marks[owner[left:right], column[left:right] - low] = 1
        found += marks @ marks.T
    return found.astype(np.int64)


def _late_links(members: DataFrame, sides: DataFrame, size: int) -> DataFrame:
    """Links (a, b) between members (grp, node, component) of one group that lie in different components."""
    groups = members.groupBy("grp").agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    spread = (
        members.join(groups.filter("low < high").select("grp", "n").hint("merge"), "grp")
        .withColumn("block", F.pmod(F.xxhash64("node"), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("grp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "component")
    )

    def run(table: pa.Table) -> pa.Table:
        nodes, component = table.column("node").to_numpy(), table.column("component").to_numpy()
        links = np.zeros((0, 2), np.int64)
        if len(np.unique(component)) > 1:
            sets = shingle_sets(texts(table.column("text")), size)
            both = intersections(sets)
            sizes = np.array([len(s) for s in sets])
            linked = 100 * both >= PERCENT * (sizes[:, None] + sizes[None, :] - both)
            linked &= (component[:, None] != component[None, :]) & (nodes[:, None] < nodes[None, :])
            links = nodes[np.argwhere(linked)]
        return pa.table({"a": links[:, 0], "b": links[:, 1]})

    return spread.join(sides, "node").groupBy("grp", "i", "j").applyInArrow(run, "a long, b long").distinct()


def near_duplicates(df: DataFrame, size: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: key, n_shingles, component_id and kept."""
    base = stage(_sketched(df, key, text, size))
    known = base.filter((F.col("n_shingles") > 0) & F.col(key).isNotNull())
    vertices = stage(known.groupBy("mark", "check").agg(F.min(key).alias("node"), F.count("*").alias("rows")))
    banded = stage(
        known.withColumn("node", F.col(key))
        .join(vertices.select("mark", "check", "node").hint("merge"), ["mark", "check", "node"], "left_semi")
        .select("node", F.explode("bands").alias("bucket"))
    )
    buckets = banded.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    members = stage(banded.join(buckets.select("bucket", "low").hint("merge"), "bucket").filter("low < node"))
    remove(banded)
    pairs = stage(members.select(F.col("low").alias("a"), F.col("node").alias("b")).distinct())
    # The merge hints keep one plan at every size: these sides grow with the documents and must never be broadcast.
    named = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().hint("merge")
    sides = stage(df.select(F.col(key).alias("node"), F.col(text).alias("text")).join(named, "node", "left_semi"))
    compared = stage(_compared(pairs, sides, size))
    links = compared.filter(F.col("percent") >= PERCENT).select("a", "b")
    labels = components(links)

    clusters = components(compared.filter(F.col("percent") >= NEAR)).select(
        F.concat(F.lit("c"), "component").alias("grp"), "node"
    )
    far = members.join(
        compared.filter(F.col("percent") < FAR).select(F.col("a").alias("low"), F.col("b").alias("node")), ["low", "node"]
    ).select(F.concat(F.lit("b"), "bucket").alias("grp"), "node").distinct()
    grouped = stage(
        clusters.union(far).join(labels, "node", "left").select("grp", "node", F.coalesce("component", "node").alias("component"))
    )
    late = stage(_late_links(grouped, sides, size))
    if not late.isEmpty():
        labels = components(links.union(late))

    groups = stage(
        vertices.join(labels, "node", "left")
        .filter("rows > 1 or component is not null")
        .select("mark", "check", F.coalesce("component", "node").alias("group"))
    )
    for done in (members, pairs, sides, compared, grouped, late, vertices):
        remove(done)
    found = base.join(groups.hint("merge"), ["mark", "check"], "left")
    linked = (F.col("n_shingles") > 0) & F.col(key).isNotNull()
    component = F.when(linked, F.coalesce("group", key)).otherwise(F.col(key))
    return found.select(key, "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("component_id") == F.col(key), F.lit(True))
    )
