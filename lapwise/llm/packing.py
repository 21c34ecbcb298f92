"""Packing of tokenized documents into as few sequences as possible.

Only counts per piece length decide: at most 1,024 numbers, whatever the size of the corpus. On them the Martello-
Toth reduction fixes sequences for good. A set of pieces that contains a largest piece j dominates every other set
with j if the other set's remaining pieces can be spread over its own, each part no longer than the piece it goes to;
some best packing then contains the dominating set. The remainder is packed best-fit, longest pieces first, each
into the fullest sequence that has room, all equal pieces at once. The finished plan says which ranks of each length
go to which sequences and places; pieces learn their rank from counts per input part, so no piece is sorted or moved
for it, and a third of all pieces may have one length.

Rules for odd input: a null or empty text is a document of the end token alone; repeated rows are packed row by row;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.llm.text import slices
from lapwise.llm.tokens import encoder
from lapwise.operators.staging import stage

CAPACITY = 1024
END = 2
TOKENIZER = "byte_bpe_50k.json"

Pattern = tuple[tuple[int, int], ...]  # (length, how many) in their order inside a sequence


def cut(total: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, piece number, start and length of all pieces of documents with ``total`` tokens each (at least 1)."""
    pieces = -(-total // capacity)
    row = np.repeat(np.arange(len(total)), pieces)
    number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    head = total - capacity * (pieces - 1)
    start = np.where(number > 0, head[row] + (number - 1) * capacity, 0)
    return row, number, start, np.where(number > 0, capacity, head[row])


def reachable(counts: np.ndarray, room: int) -> int:
    """Largest total of pieces that is at most ``room``; each length is used as often as it is counted."""
    sums, mask = 1, (1 << (room + 1)) - 1
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        left, chunk = min(int(counts[length]), room // length), 1
        while left > 0:
            take = min(chunk, left)
            sums |= (sums << (take * length)) & mask
            left -= take
            chunk *= 2
        if sums >> room & 1:
            return room
    return sums.bit_length() - 1


def reduced(counts: np.ndarray) -> tuple[list[tuple[Pattern, int]], np.ndarray]:
    """Sequences that a best packing contains, and the counts that remain; ``counts`` is indexed by length."""
    capacity = len(counts) - 1
    left = counts.copy()
    fixed: list[tuple[Pattern, int]] = []
    changed = True
    while changed:
        changed = False
        for j in np.flatnonzero(left)[::-1].tolist():
            while left[j]:
                found = _dominating(left, j, capacity - j)
                if found is None:
                    break
                times = min(int(left[length]) // many for length, many in found)
                for length, many in found:
                    left[length] -= times * many
                fixed.append((found, times))
                changed = True
    return fixed, left


def _dominating(left: np.ndarray, j: int, room: int) -> Pattern | None:
    """A set of up to three pieces with j that dominates all sets with j, if one is known."""
    others = left.copy()
    others[j] -= 1
    fitting = np.flatnonzero(others[: room + 1])
    if not len(fitting):
        return ((j, 1),)
    k = int(fitting[-1])
    # One piece takes the place of any others if they are together no longer.
    if k == room or reachable(others, room) == k:
        return ((j, 2),) if k == j else ((j, 1), (k, 1))
    # Two pieces r >= s: where at most two fit, every pair has a longer piece <= r, and a shorter one <= s is enough.
    small = int(fitting[0])
    third = np.repeat(fitting[:3], np.minimum(others[fitting[:3]], 3))[:3].sum()
    if len(np.repeat(fitting[:3], np.minimum(others[fitting[:3]], 3))) >= 3 and third <= room:
        return None
    others[k] -= 1
    rest = np.flatnonzero(others[: room - k + 1])
    others[k] += 1
    if not len(rest) or small > room - k:
        return None
    s = int(rest[-1])
    half = np.flatnonzero(others[: room // 2 + 1])[::-1].tolist()
    for shorter in half:
        partner = others[shorter : room - shorter + 1].copy()
        partner[0] -= 1
        if partner.any():
            if shorter > s:
                return None
            break
    lengths: dict[int, int] = {}
    for length in (j, k, s):
        lengths[length] = lengths.get(length, 0) + 1
    return tuple(lengths.items())


@dataclass
class _Open:
    """Sequences under way by free room; equal ones are counted together."""

    groups: dict[int, list[tuple[Pattern, int]]] = field(default_factory=dict)

    def put(self, room: int, pattern: Pattern, times: int) -> None:
        if times:
            self.groups.setdefault(room, []).append((pattern, times))


def best_fit(counts: np.ndarray) -> list[tuple[Pattern, int]]:
    """Longest pieces first, each into the sequence with the least room that takes it."""
    capacity = len(counts) - 1
    under_way = _Open()
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            room = min((r for r in under_way.groups if r >= length), default=None)
            if room is None:
                room, pattern, times = capacity, (), left
            else:
                pattern, times = under_way.groups[room].pop()
                if not under_way.groups[room]:
                    del under_way.groups[room]
            many = room // length
            full = min(times, left // many)
            under_way.put(room - many * length, (*pattern, (length, many)), full)
            left -= full * many
            times = times - full if pattern else min(1, left)
            if left and times:
                under_way.put(room - left * length, (*pattern, (length, left)), 1)
                left, times = 0, times - 1
            if pattern:
                under_way.put(room, pattern, times)
    return [group for groups in under_way.groups.values() for group in groups]


def plan(counts: np.ndarray) -> np.ndarray:
    """Rows (length, first rank, per sequence, first sequence, offset), sorted: where the ranks of each length go."""
    fixed, rest = reduced(counts)
    used = np.zeros(len(counts), np.int64)
    rows, sequence = [], 0
    for pattern, times in fixed + best_fit(rest):
        offset = 0
        for length, many in pattern:
            rows.append((length, used[length], many, sequence, offset))
            used[length] += many * times
            offset += length * many
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces(df: DataFrame, path: str, capacity: int, end: int, key: str, text: str, ids: bool) -> DataFrame:
    """One row per piece with its rank among the pieces of its length in its input part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part_id = encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows, part in slices(batch, text):
                flat, counts = coder.encode(part)
                flat = np.insert(flat, np.cumsum(counts), np.uint32(end)).astype("<u4")
                total = counts + 1
                row, number, start, length = cut(total, capacity)
                first = (np.cumsum(total) - total)[row] + start
                view = memoryview(flat).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist())]
                sort = np.argsort(length, kind="stable")
                heads = np.searchsorted(length[sort], length[sort])
                rank = np.empty(len(length), np.int64)
                rank[sort] = np.arange(len(length)) - heads
                rank += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                columns = [
                    rows.column(key).take(pa.array(row)), pa.array(number, pa.int32()), pa.array(start),
                    pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(row), part_id), pa.int64()),
                    pa.array(rank),
                ]
                if ids:
                    ends = np.append(first, len(flat)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names)

    extra = "piece int, start long, length long, ids_crc32 long, part long, rank long" + ", ids array<long>" * ids
    schema = T.StructType([df.schema[key], *T.StructType.fromDDL(extra).fields])
    names = schema.names
    return df.select(key, text).mapInArrow(run, schema)


def pack(
    df: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    key: str = "doc_id",
    text: str = "text",
    ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: where it starts there, its length, and its sequence and place in it.

    ``tokenizer`` is the path of a tokenizer file on every machine. With ``ids`` the token ids are returned too.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    items = stage(pieces(df, path, capacity, end, key, text, ids))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = stage(
        items.groupBy("length", "part").agg(F.count("*").alias("n"))
        .select("length", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    )
    counts = np.zeros(capacity + 1, np.int64)
    for row in cells.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row per length
        counts[row["length"]] = row["n"]
    rules = plan(counts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("place").to_numpy()
            at = _rule(rules, length, rank)
            _, low, many, sequence, offset = rules[at].T
            shift = rank - low
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in kept],
                    pa.array(sequence + shift // np.maximum(many, 1)),
                    pa.array(offset + shift % np.maximum(many, 1) * length),
                ],
                [*kept, "sequence_id", "offset"],
            )

    kept = [key, "piece", "start", "length", "ids_crc32"] + ["ids"] * ids
    schema = T.StructType([
        *[items.schema[name] for name in kept], *T.StructType.fromDDL("sequence_id long, offset long").fields
    ])
    ranked = items.join(cells.select("length", "part", "ahead"), ["length", "part"])
    return ranked.select(*kept, (F.col("ahead") + F.col("rank")).alias("place")).mapInArrow(place, schema)


def _rule(rules: np.ndarray, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The row of the plan that holds each (length, rank)."""
    at = np.empty(len(length), np.int64)
    sort = np.lexsort((rank, length))
    names = np.concatenate([rules[:, 0], length[sort]])
    ranks = np.concatenate([rules[:, 1], rank[sort]])
    both = np.lexsort((np.arange(len(names)), ranks, names))
    is_rule = both < len(rules)
    last = np.maximum.accumulate(np.where(is_rule, both, -1))
    at[sort[both[~is_rule] - len(rules)]] = last[~is_rule]
    return at
