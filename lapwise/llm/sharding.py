"""Shards of equal row counts from a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a ring. A row hashes to a place on the ring and asks the first point clockwise; a
shard takes rows up to its bound, the rest goes on clockwise to the next shard with room. The bounds are the mean
rounded up or down, so counts differ by one at most, and a row moves only where a shard on its way fills earlier.

Rows between two points are alike, so only their number decides which go on: the walk runs over one count per arc
(shards * points numbers at most) and gives, per arc, ranges of ranks with their shard. Equal rows (key, size, checksum)
are counted first, and a group of more than ``BLOCK`` is cut into blocks. Ranks follow from a sum per arc and salt, the
salt being a hash of the row and its block, so an arc or a row that holds a third of the table is numbered in many tasks
and the result does not depend on the order or the files of the table.

Rules for odd input: a null text has no bytes and checksum 0; rows without doc_id share one place on the ring; equal
rows are placed one by one; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.operators.staging import stage

SHARDS = 40
# Points of each shard on the ring, and parts in which an arc is numbered.
POINTS = 64
SALTS = 64
# Bits of a place on the ring, and of the stretch in which a row looks for its next point.
PLACE_BITS, STRETCH_BITS = 48, 12
# Equal rows that are ranked as one.
BLOCK = 4_096

Segment = tuple[int, int, int, int, int]


def place_of(name: str) -> int:
    """Place of a name on the ring."""
    return int(hashlib.md5(name.encode()).hexdigest()[: PLACE_BITS // 4], 16)


def _place(name: Column) -> Column:
    return F.conv(F.substring(F.md5(name), 1, PLACE_BITS // 4), 16, 10).cast("long")


def ring(shards: int) -> list[tuple[int, int]]:
    """Points (place, shard) in clockwise order."""
    return sorted((place_of(f"shard {s} point {v}"), s) for s in range(shards) for v in range(POINTS))


def walk(demand: list[int], points: list[tuple[int, int]], bounds: list[int]) -> list[Segment]:
    """Segments (arc, first rank, end rank, shard, first slot) for the rows waiting before each point.

    In every round each arc's waiting rows ask the next shard clockwise that has room, arcs in ring order.
    """
    taken = [0] * len(bounds)
    done = [0] * len(points)
    ahead = list(range(len(points)))
    segments: list[Segment] = []
    waiting = [arc for arc, rows in enumerate(demand) if rows]
    while waiting:
        for arc in waiting:
            while taken[points[ahead[arc]][1]] >= bounds[points[ahead[arc]][1]]:
                ahead[arc] = (ahead[arc] + 1) % len(points)
            shard = points[ahead[arc]][1]
            rows = min(demand[arc] - done[arc], bounds[shard] - taken[shard])
            segments.append((arc, done[arc], done[arc] + rows, shard, taken[shard]))
            done[arc] += rows
            taken[shard] += rows
        waiting = [arc for arc in waiting if done[arc] < demand[arc]]
    return segments


def _table(df: DataFrame, rows: list, schema: str) -> DataFrame:
    """A small table from the driver as one literal."""
    literal = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return df.sparkSession.range(1).select(F.inline(literal))


def assign(df: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: key, size, checksum of the text, law, shard and its slot there."""
    points = ring(shards)
    shift = PLACE_BITS - STRETCH_BITS
    stretches: list[list[int]] = [[] for _ in range(1 << STRETCH_BITS)]
    for place, _ in points:
        stretches[place >> shift].append(place)
    ahead = accumulate(map(len, stretches), initial=0)
    owner = _table(
        df, [{"_stretch": i, "_before": n, "_points": p} for i, (n, p) in enumerate(zip(ahead, stretches))],
        "_stretch:long,_before:int,_points:array<long>",
    )
    # The first point at or after the place of a row.
    passed = F.col("_before") + F.size(F.filter("_points", lambda p: p < F.col("_place")))

    groups = df.select(
        key,
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text)), F.lit(0)).cast("long").alias("text_crc32"),
    ).groupBy(key, "size", "text_crc32").agg(F.count("*").alias("_all"))
    blocks = groups.select(
        "*",
        _place(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("_place"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_all - 1) div {BLOCK}"))).alias("_block"),
    )
    rows = stage(
        blocks.withColumn("_stretch", F.shiftright("_place", shift))
        .join(F.broadcast(owner), "_stretch")  # 2 ** STRETCH_BITS rows
        .select(
            key, "size", "text_crc32", "_block",
            (passed % len(points)).alias("arc"),
            F.pmod(F.xxhash64(key, "size", "text_crc32", "_block"), F.lit(SALTS)).alias("_salt"),
            F.least(F.lit(BLOCK), F.col("_all") - F.col("_block") * BLOCK).alias("_n"),
        )
    )
    before = Window.partitionBy("arc").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = stage(
        rows.groupBy("arc", "_salt").agg(F.sum("_n").alias("_n"))
        .withColumn("_ahead", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    )
    demand = [0] * len(points)
    for arc, n in cells.groupBy("arc").agg(F.sum("_n")).collect():  # at most shards * POINTS rows
        demand[arc] = n
    least, more = divmod(sum(demand), shards)
    bounds = [least + (s < more) for s in range(shards)]
    names = ("arc", "_from", "_until", "shard", "_slot")
    segments = _table(
        df, [dict(zip(names, x)) for x in walk(demand, points, bounds)],
        "arc:int,_from:long,_until:long,shard:int,_slot:long",
    )

    inside = (
        Window.partitionBy("arc", "_salt").orderBy(key, "text_crc32", "size", "_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = rows.withColumn("_inner", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(
        cells.select("arc", "_salt", "_ahead"), ["arc", "_salt"]
    ).withColumn("_rank", F.col("_ahead") + F.col("_inner"))
    low, end = F.greatest("_rank", "_from"), F.least(F.col("_rank") + F.col("_n"), "_until")
    first = F.col("_slot") + low - F.col("_from")
    return (
        ranked.join(F.broadcast(segments), "arc")  # a few rows per arc
        .filter(low < end)
        .select(
            key, "size", "text_crc32", F.lit("rows").alias("law"), "shard",
            F.explode(F.sequence(first, first + end - low - 1)).alias("slot"),  # BLOCK rows at most
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
