"""Exact top-k search by inner product with a table of distances to pivots.

Vectors are turned into integers, so scores are exact. With d the Euclidean distance of q and x, their inner product
is (|q|^2 + |x|^2 - d^2) / 2, and by the triangle inequality d is at least |d(q, p) - d(x, p)| for every pivot p. The
largest of these lower bounds gives an upper bound of the score.

The vectors are sorted by nearest pivot and distance to it and cut into blocks of ``BLOCK``; a block also keeps the
range of its distances to each pivot. A query first searches its own block, whose k-th score is its threshold. It then
goes to every other block whose best possible score reaches that threshold. Inside a block it takes candidates in the
order of their bounds and stops at the first that cannot reach the k-th score any more. Nothing else is left out, so
the result is exact. A task holds one block and at most about ``QUERIES`` queries; equal vectors are cut into blocks
like any others.

Rules for odd input: vectors that are null, empty, hold null or non-finite numbers or have another length than most
take no part, nor do rows without id; rows that share the query's id are its own; repeated rows are candidates each;
equal scores go to the smaller id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.operators.staging import remove, stage

PIVOTS = 32
# Vectors that the pivots are chosen among, at most.
SAMPLE = 1_000
BLOCK = 2_048
QUERIES = 512
SCALE = 1024
# Candidates evaluated between two looks at the threshold.
STEP = 128


def _matrix(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0), kind)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def choose(vectors: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Pivots far from each other: each is the vector farthest from those before it."""
    if not len(vectors):
        return vectors
    chosen = [0]
    nearest = np.linalg.norm(vectors - vectors[0], axis=1)
    while len(chosen) < min(count, len(vectors)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, np.linalg.norm(vectors - vectors[chosen[-1]], axis=1))
    return vectors[chosen]


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distance of every vector to every pivot."""
    return np.stack([np.linalg.norm(vectors - p, axis=1) for p in pivots], 1)


def bounds(query: np.ndarray, square: float, table: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores of all candidates of a table, with room for rounding."""
    apart = np.abs(table - query).max(axis=1)
    apart = np.maximum(apart - 1e-9 * (table.max(axis=1) + query.max()), 0)
    return (square + squares - apart * apart) / 2 + 1e-9 * (square + squares) + 1e-3


def search(
    query: np.ndarray, name: int, limits: np.ndarray, names: np.ndarray, vectors: np.ndarray, k: int, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """The best k candidates of a block that reach ``least``; stops once no bound reaches the k-th score."""
    order = np.argsort(-limits, kind="stable")
    best, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for start in range(0, len(order), STEP):
        step = order[start : start + STEP]
        if limits[step[0]] < least:
            break
        step = step[names[step] != name]
        best = np.concatenate([best, names[step]])
        score = np.concatenate([score, vectors[step] @ query]).astype(np.int64)
        top = np.lexsort((best, -score))[:k]
        best, score = best[top], score[top]
        if len(top) == k:
            least = max(least, score[-1])
    reach = score >= least
    return best[reach], score[reach]


def _quantised(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows that take part, with integer components."""
    kind = df.schema[vector].dataType.elementType.simpleString()
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if kind not in ("float", "double"):
        finite = F.forall(vector, lambda x: x.isNotNull())
    rows = df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & finite).select(
        F.col(key).cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("vec"),
    )
    usual = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vec") == (usual["n"] if usual else 0))


def _blocks(table: DataFrame) -> DataFrame:
    """Cut sorted partitions into blocks; the first row of a block also has its ranges."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            held.append(batch)
            while sum(map(len, held)) >= BLOCK:
                whole = pa.Table.from_batches(held).combine_chunks()
                yield block(whole.slice(0, BLOCK), (part << 32) + number)
                number, held = number + 1, whole.slice(BLOCK).to_batches()
        if sum(map(len, held)):
            yield block(pa.Table.from_batches(held), (part << 32) + number)

    def block(rows: pa.Table, name: int) -> pa.RecordBatch:
        dist = _matrix(rows.column("dist"), np.float64)
        empty = [None] * (len(rows) - 1)
        return pa.RecordBatch.from_arrays(
            [
                *[rows.column(c).combine_chunks() for c in ("id", "vec", "dist", "square")],
                pa.array(np.full(len(rows), name)),
                pa.array([dist.min(axis=0).tolist(), *empty], pa.list_(pa.float64())),
                pa.array([dist.max(axis=0).tolist(), *empty], pa.list_(pa.float64())),
                pa.array([float(rows.column("square").to_numpy().max()), *empty], pa.float64()),
            ],
            ["id", "vec", "dist", "square", "block", "low", "high", "largest"],
        )

    return table.mapInArrow(
        cut,
        "id long, vec array<long>, dist array<double>, square double, block long, low array<double>, "
        "high array<double>, largest double",
    )


def _searched(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Search blocks: ``queries`` has rows (id, vec, dist, square, least, chunk, block)."""
    wanted = queries.select(F.col("block").alias("_block"), F.col("chunk").alias("_chunk")).distinct()
    rows = candidates.select("id", "vec", "dist", "square", F.col("block").alias("_block")).join(wanted, "_block")

    def run(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        if len(held):
            names, table = held.column("id").to_numpy(), _matrix(held.column("dist"), np.float64)
            squares = held.column("square").to_numpy()
            vectors, wants = _matrix(held.column("vec"), np.int64), _matrix(asked.column("vec"), np.int64)
            largest = float(np.abs(vectors).max()) * float(np.abs(wants).max()) * vectors.shape[1]
            if largest < 2**53:  # sums are exact in doubles, which multiply faster
                vectors, wants = vectors.astype(np.float64), wants.astype(np.float64)
            near = _matrix(asked.column("dist"), np.float64)
            least = asked.column("least").fill_null(-np.inf).to_numpy()
            for i, name in enumerate(asked.column("id").to_pylist()):
                limits = bounds(near[i], asked.column("square")[i].as_py(), table, squares)
                found.append((name, *search(wants[i], name, limits, names, vectors, k, least[i])))
        return pa.table({
            "query_id": np.repeat(np.array([f[0] for f in found], np.int64), [len(f[1]) for f in found]),
            "vec_id": np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)]),
            "score": np.concatenate([f[2] for f in found] or [np.zeros(0, np.int64)]),
        })

    return queries.groupBy("block", "chunk").cogroup(rows.groupBy("_block", "_chunk")).applyInArrow(
        run, "query_id long, vec_id long, score long"
    )


def top_k(
    df: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The k best other rows for every row of ``df`` for which ``is_query``, a condition on ``id``, holds."""
    rows = stage(_quantised(df, key, vector))
    sample = rows.select("vec", F.xxhash64("id").alias("order"), "id").orderBy("order", "id").limit(SAMPLE)
    pivots = choose(_matrix(sample.select("vec").toArrow().column(0), np.float64))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = _matrix(batch.column("vec"), np.float64)
            dist = distances(vectors, pivots)
            near = dist.argmin(axis=1)
            ends = np.arange(0, dist.size + 1, dist.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("vec"), pa.ListArray.from_arrays(pa.array(ends), pa.array(dist.ravel())),
                    pa.array((vectors * vectors).sum(axis=1)), pa.array(near), pa.array(dist.min(axis=1)),
                ],
                ["id", "vec", "dist", "square", "near", "close"],
            )

    table = rows.mapInArrow(
        measure, "id long, vec array<long>, dist array<double>, square double, near long, close double"
    )
    order = ["near", "close", "id"]
    blocks = stage(_blocks(table.repartitionByRange(*order).sortWithinPartitions(*order)))
    remove(rows)

    asked = blocks.filter(is_query).select("id", "vec", "dist", "square", "block")
    chunks = -(-asked.count() // QUERIES)
    asked = stage(
        asked.withColumn("least", F.lit(None).cast("double"))
        .withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(max(chunks, 1))))
    )
    own = stage(_searched(asked, blocks, k))
    threshold = own.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).cast("double").alias("least")
    )

    ranges = blocks.filter("low is not null").select(
        F.col("block").alias("other"), "low", "high", "largest",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(chunks, 1) - 1).cast("long"))).alias("chunk"),
    )
    apart = F.array_max(F.zip_with(
        F.arrays_zip("low", "high"), "dist", lambda r, d: F.greatest(d - r["high"], r["low"] - d, F.lit(0.0))
    ))
    limit = (F.col("square") + F.col("largest") - F.pow(F.greatest(apart - 1e-3, F.lit(0.0)), 2)) / 2
    room = 1e-9 * (F.col("square") + F.col("largest")) + 1e-3
    rest = stage(
        asked.drop("least").join(threshold.withColumnRenamed("query_id", "id"), "id", "left")
        .join(ranges, "chunk")
        .filter("block <> other").filter(F.col("least").isNull() | (limit + room >= F.col("least")))
        .select("id", "vec", "dist", "square", "least", "chunk", F.col("other").alias("block"))
    )
    found = own.union(_searched(rest, blocks, k))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
