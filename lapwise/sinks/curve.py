"""Clustering on several columns at once along a Z-order curve, so that files can be skipped by each of them.

Every column is turned into ranks by cut points at its quantiles, which come from one mergeable aggregation over the table,
so a skewed column still uses all ranks. The ranks' bits are interleaved into one number; rows are ranged by it and each
file covers a small box in all columns. All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bits of a column's rank; with many columns fewer, so that the curve fits in a long.
RANK_BITS = 8
CURVE_BITS = 62
# Relative accuracy of the quantiles.
ACCURACY = 10_000


def ordinal(name: str, kind: T.DataType) -> Column:
    """A number that follows the column's order; of texts their first six bytes."""
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.hex(F.substring(column.cast("binary"), 1, 6))
        return F.conv(F.rpad(head, 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return column.cast("int").cast("double") if isinstance(kind, T.BooleanType) else column.cast("double")
    raise ValueError(f"{name} of type {kind.simpleString()} has no order to cluster by")


def cut_points(df: DataFrame, columns: list[str], bits: int) -> dict[str, list[float]]:
    """The 2 ** ``bits`` - 1 inner quantiles of every column; empty for a column without values."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(
        *[F.percentile_approx(ordinal(c, df.schema[c].dataType), shares, ACCURACY).alias(f"c{i}") for i, c in enumerate(columns)]
    ).first()
    return {c: list(found[f"c{i}"] or []) for i, c in enumerate(columns)}


def rank(value: Column, cuts: list[float], bits: int) -> Column:
    """How many cut points are not above the value, by halving; null ranks first."""
    if not cuts:
        return F.lit(0)
    points = F.array(*[F.lit(cut) for cut in cuts])
    steps = F.array(*[F.lit(1 << bit) for bit in range(bits - 1, -1, -1)])

    def halve(found: Column, step: Column) -> Column:
        return found + F.when(F.get(points, found + step - 1) <= value, step).otherwise(F.lit(0))

    return F.aggregate(steps, F.lit(0), halve)


def interleaved(ranks: list[Column], bits: int) -> Column:
    """One number with the ranks' bits in turn, highest first."""
    place, total = bits * len(ranks), F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for value in ranks:
            place -= 1
            one = F.shiftright(value, bit).bitwiseAND(F.lit(1)).cast("long")
            total = total.bitwiseOR(F.shiftleft(one, place))
    return total


def position(df: DataFrame, columns: list[str]) -> Column:
    """Where a row of ``df`` lies on the curve through ``columns``; reads ``df`` once."""
    if not columns:
        raise ValueError("no column to cluster by")
    bits = max(1, min(RANK_BITS, CURVE_BITS // len(columns)))
    cuts = cut_points(df, columns, bits)
    # The ranks become a column first, so that each is computed once for all its bits.
    ranks = F.array(*[rank(ordinal(c, df.schema[c].dataType), cuts[c], bits) for c in columns])
    spread = F.transform(F.array(ranks), lambda r: interleaved([F.get(r, i) for i in range(len(columns))], bits))
    return F.get(spread, 0)


def along_curve(
    df: DataFrame, columns: list[str], partition_by: list[str] | None = None, partitions: int | None = None
) -> DataFrame:
    """Rows of a stored table ranged and sorted along the curve, inside each partition value if given.

    Rows at one place of the curve are told apart by row number, so a combination of values that is very frequent
    still spreads over several files.
    """
    placed = df.withColumns({"_curve": position(df, columns), "_tie": F.monotonically_increasing_id()})
    order = [*(partition_by or []), "_curve", "_tie"]
    ranged = placed.repartitionByRange(partitions, *order) if partitions else placed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).drop("_curve", "_tie")
