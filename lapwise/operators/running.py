"""Ordered numbering and frames that do not need a whole group in one task.

A window function sorts one key's rows in one task. That is right where the domain bounds a group (laps of a driver in
a race, lines of an order) and wrong for a key that may hold a third of a 100 TB table. The functions here always take
the split form: each group is cut along its sort order into cells, every cell is numbered on its own, and the totals
of the preceding cells are added from a small table of per-cell sums. The plan is the same at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows per block of a split frame.
BLOCK_ROWS = 100_000


def running_totals(
    df: DataFrame, keys: list[str], order: list[Column], totals: dict[str, Column], splits: list[Column]
) -> DataFrame:
    """Add running sums (current row included) of integer columns per group, in ``order``.

    ``totals`` maps each new column to the integer it sums; ``F.lit(1)`` gives a row number. ``splits`` cut
    the order into cells, coarse to fine; each must be non-decreasing along ``order`` within the ones before.
    Key and split columns must not be null, and ``order`` must be total for a repeatable result.
    """
    cuts = [f"_cut{i}" for i in range(len(splits))]
    parts = {name: f"_part_{name}" for name in totals}
    rows = df.withColumns(dict(zip(cuts, splits)))
    cells = rows.groupBy(*keys, *cuts).agg(*[F.sum(value).alias(parts[name]) for name, value in totals.items()])

    carry = _carries(cells, keys, cuts, parts)
    inside = Window.partitionBy(*keys, *cuts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumns({name: F.sum(value).over(inside) for name, value in totals.items()})
        .join(carry, keys + cuts, "left")
        .withColumns({name: F.col(name) + F.coalesce(F.col(part), F.lit(0)) for name, part in parts.items()})
        .select(*df.columns, *totals)
    )


def _carries(cells: DataFrame, keys: list[str], cuts: list[str], parts: dict[str, str]) -> DataFrame:
    """Sum of all cells before each cell: before it under its parent cut, plus before that parent."""
    before = Window.partitionBy(*keys, *cuts[:-1]).orderBy(cuts[-1]).rowsBetween(Window.unboundedPreceding, -1)
    own = cells.select(
        *keys, *cuts, *[F.coalesce(F.sum(p).over(before), F.lit(0)).alias(p) for p in parts.values()]
    )
    if len(cuts) == 1:
        return own
    parents = cells.groupBy(*keys, *cuts[:-1]).agg(*[F.sum(p).alias(p) for p in parts.values()])
    upper = _carries(parents, keys, cuts[:-1], parts)
    upper = upper.withColumnsRenamed({p: f"_up{p}" for p in parts.values()})
    return own.join(upper, keys + cuts[:-1]).select(
        *keys, *cuts, *[(F.col(p) + F.col(f"_up{p}")).alias(p) for p in parts.values()]
    )


def row_numbers(df: DataFrame, keys: list[str], order: list[Column], name: str, splits: list[Column]) -> DataFrame:
    """Add a row number per group in ``order``."""
    return running_totals(df, keys, order, {name: F.lit(1).cast("long")}, splits)


def framed(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    preceding: int,
    following: int,
    frames: dict[str, Column],
    splits: list[Column],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add aggregates over the frame of rows ``-preceding .. following`` per group, ``following`` <= 0.

    Rows are numbered and cut into blocks of ``block_rows`` rows, and the last ``preceding`` rows of a block are also
    given to the next one, so every frame is whole inside its block.
    """
    if following > 0 or preceding > block_rows:
        raise ValueError("the frame must end at or before the current row and fit in a block")
    numbered = row_numbers(df, keys, order, "_n", splits)
    block = F.floor((F.col("_n") - 1) / block_rows)
    in_tail = (F.col("_n") - 1) % block_rows >= block_rows - preceding
    targets = F.when(in_tail, F.array(block, block + 1)).otherwise(F.array(block))
    spread = numbered.withColumn("_home", block).withColumn("_block", F.explode(targets))
    frame = Window.partitionBy(*keys, "_block").orderBy("_n").rowsBetween(-preceding, following)
    return (
        spread.withColumns({name: agg.over(frame) for name, agg in frames.items()})
        .filter(F.col("_block") == F.col("_home"))
        .select(*df.columns, *frames)
    )
