"""How filters interact: every order of the filters, from one wide integer per set of failed filters.

A document is its mask, the set of filters it fails. For each mask one big integer is made beforehand whose 64-bit fields
are the outcomes of all orders and steps: field (order, step) is 1 if the filter at that step removes such a document;
the last field is always 1 and counts documents. A task adds the integers of its documents per part (all documents,
those of good quality and the toxic ones apart), the tasks' sums are added in two levels, and every count of the report is
read from the fields. A field cannot overflow: it counts rows, and a table has fewer than 2^63.

The filters A to D look at one text. E compares texts over the whole table: the smallest id per text hash (128 bits) is
an aggregation, and rows meet it by hash and id together, so a text that fills a third of the table is no hot key.

Rules for odd input: a null text is empty; null ``lang`` is the part '' like an empty one; a row without id has no labels
and never fails E; rows that repeat an id are rows of their own, all or none of them the first of their text; a document is
good or toxic if any of its label rows says so; an empty table gives an empty report; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.llm.text import Texts, U, mix, slices
from lapwise.operators.staging import stage

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in itertools.permutations(FILTERS)]
STEPS = len(FILTERS)
FIELDS = len(ORDERS) * STEPS + 1
FIELD_BYTES = 8
# Limits of the filters.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 3
SYMBOLS = b"#$%&*|"
# Tasks' sums of one part are added in so many groups before the last addition.
SLOTS = 64
# A task passes its sums on when it holds so many parts.
PARTS_HELD = 500

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True

SUMS = "part string, slot int, documents binary, good binary, toxic binary"
REPORT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def packed(mask: int) -> int:
    """The wide integer of a mask: at each order the first failed filter's field, and the counter of documents."""
    value = 1 << (8 * FIELD_BYTES * (FIELDS - 1))
    for number, order in enumerate(ORDERS):
        for step, name in enumerate(order):
            if mask >> FILTERS.index(name) & 1:
                value |= 1 << (8 * FIELD_BYTES * (number * STEPS + step))
                break
    return value


def unpacked(value: int) -> tuple[np.ndarray, int]:
    """Removed documents by order and step, and the number of documents."""
    fields = np.frombuffer(value.to_bytes(FIELDS * FIELD_BYTES, "little"), np.int64)
    return fields[:-1].reshape(len(ORDERS), STEPS), int(fields[-1])


def text_masks(part: Texts) -> np.ndarray:
    """Which of the filters A to D each text fails."""
    first, last = part.words()
    counts = part.counts(first)
    owner = np.repeat(np.arange(len(part)), counts)
    known = np.unique(mix(part.hashes(first, last) ^ mix(owner.astype(U) + U(1))), return_index=True)[1]
    distinct = np.bincount(owner[known], minlength=len(part))
    points = part.total((part.data & 0xC0) != 0x80)
    return (
        (counts < MIN_WORDS).astype(np.int32)
        | (100 * distinct < MIN_DISTINCT_PERCENT * counts).astype(np.int32) << 1
        | (100 * part.total(_UPPER[part.data]) > MAX_UPPER_PERCENT * points).astype(np.int32) << 2
        | (part.total(_SYMBOL[part.data]) > 0).astype(np.int32) << 3
    )


def masks(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One narrow row per row of ``df``: part, mask of all five filters, good, toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, "_text"):
                kept = [rows.column(name) for name in ("_id", "_part", "_h", "_g")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(text_masks(texts))], ["_id", "_part", "_h", "_g", "_mask"])

    texts = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    given = df.select(
        F.col(f"`{key}`").alias("_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("_part"),
        F.xxhash64(texts).alias("_h"), F.xxhash64(F.lit(11), texts).alias("_g"), texts.alias("_text"),
    )
    kind = df.schema[key].dataType.simpleString()
    rows = stage(given.mapInArrow(run, f"_id {kind}, _part string, _h long, _g long, _mask int"))
    known = rows.filter("_id IS NOT NULL")
    earliest = known.groupBy("_h", "_g").agg(F.min("_id").alias("_id")).withColumn("_earliest", F.lit(True))
    marked = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("_toxic"),
    )
    repeats = F.when(F.col("_earliest").isNull(), F.lit(1 << 4)).otherwise(F.lit(0))
    judged = known.join(earliest, ["_h", "_g", "_id"], "left").join(marked, "_id", "left").select(
        "_part", (F.col("_mask").bitwiseOR(repeats)).alias("_mask"),
        *[F.coalesce(name, F.lit(False)).alias(name) for name in ("_good", "_toxic")],
    )
    nameless = rows.filter("_id IS NULL").select("_part", "_mask", F.lit(False).alias("_good"), F.lit(False).alias("_toxic"))
    return judged.union(nameless)


def _bytes(value: int) -> bytes:
    return value.to_bytes(FIELDS * FIELD_BYTES, "little")


def _record(part: str, slot: int, sums: list[int]) -> pa.RecordBatch:
    arrays = [pa.array([part], pa.string()), pa.array([slot], pa.int32())]
    arrays += [pa.array([_bytes(value)], pa.binary()) for value in sums]
    return pa.RecordBatch.from_arrays(arrays, ["part", "slot", "documents", "good", "toxic"])


def counters(rows: DataFrame) -> DataFrame:
    """Per part and slot the sums of the wide integers of all documents, of the good ones and of the toxic ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [packed(mask) for mask in range(1 << STEPS)]
        slot = TaskContext.get().partitionId() % SLOTS
        sums: dict[str, list[int]] = {}
        for batch in batches:
            alike = pa.Table.from_batches([batch]).group_by(["_part", "_mask", "_good", "_toxic"]).aggregate([([], "count_all")])
            for row in alike.to_pylist():
                wide = row["count_all"] * table[row["_mask"]]
                own = sums.setdefault(row["_part"], [0, 0, 0])
                own[0] += wide
                own[1] += wide * row["_good"]
                own[2] += wide * row["_toxic"]
            if len(sums) > PARTS_HELD:
                for part, found in sums.items():
                    yield _record(part, slot, found)
                sums = {}
        for part, found in sums.items():
            yield _record(part, slot, found)

    return rows.mapInArrow(run, SUMS)


def _added(table: pa.Table) -> list[int]:
    return [
        sum(int.from_bytes(value, "little") for value in table.column(name).to_pylist())
        for name in ("documents", "good", "toxic")
    ]


def report(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """All orders and steps of the filters, per part."""

    def halfway(table: pa.Table) -> pa.Table:
        part, slot = table.column("part")[0].as_py(), table.column("slot")[0].as_py()
        return pa.Table.from_batches([_record(part, slot, _added(table))])

    def outcomes(table: pa.Table) -> pa.Table:
        removed, good, toxic = (unpacked(value) for value in _added(table))
        rows = pa.Table.from_pylist(list(outcome_rows(table.column("part")[0].as_py(), removed, good, toxic)))
        return rows.cast(pa.schema([
            ("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
            *[(name, pa.int64()) for name in rows.column_names[3:]],
        ]))

    sums = counters(masks(df, labels, key, text, part))
    partial = sums.groupBy("part", "slot").applyInArrow(halfway, SUMS)
    return partial.groupBy("part").applyInArrow(outcomes, REPORT)


def outcome_rows(part: str, removed: tuple, good: tuple, toxic: tuple) -> Iterator[dict]:
    """The report of one part from its unpacked sums."""
    gone, documents = removed
    fails, alone, total = {}, {}, dict.fromkeys(FILTERS, 0)
    for number, order in enumerate(ORDERS):
        fails[order[0]] = int(gone[number, 0])  # first in an order, a filter removes all that fail it
        alone[order[-1]] = int(gone[number, -1])  # last in an order, only what fails nothing else
        for step, name in enumerate(order):
            total[name] += int(gone[number, step])
    for number, order in enumerate(ORDERS):
        left = documents
        for step, name in enumerate(order):
            here = int(gone[number, step])
            left -= here
            yield {
                "part": part, "filter_order": order, "step": step + 1, "kept": left, "removed": here,
                "redundant": fails[name] - here, "unique_fails": alone[name], "good_lost": int(good[0][number, step]),
                "toxic_lost": int(toxic[0][number, step]), "shapley": total[name],
            }
