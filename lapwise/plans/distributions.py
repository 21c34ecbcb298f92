"""Distributions as stored sketches: quantiles of any grouping without reading the rows again.

A quantile sketch of ``k`` levels keeps a bounded sample of a group's values with weights. Sketches of parts merge to the
sketch of the whole with the same bound, so they are kept at the finest grain, per circuit, team and season, and rolled up
to any coarser one. A quantile read from a sketch is a value of the group whose rank differs from the wanted one by more than
``rank_error(k)`` of the rows with a chance of about 1 %. Groups of at most ``k`` values are exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = 400
SHARES = (0.05, 0.25, 0.5, 0.75, 0.95)


def rank_error(k: int = LEVELS) -> float:
    """Normalised rank error of one quantile at 99 % confidence: a fixed formula of these sketches."""
    return 2.296 / k**0.9723


def sketches(rows: DataFrame, value: str, keys: list[str], k: int = LEVELS) -> DataFrame:
    """One sketch of an integer column per group, with its number of values and extremes; null values take no part.

    Partial sketches are merged, so a hot group is summed up where its rows lie.
    """
    return rows.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.kll_sketch_agg_bigint(F.col(value).cast("long"), F.lit(k)).alias("sketch"),
        F.count(F.lit(1)).alias("n"), F.min(value).cast("long").alias("low"), F.max(value).cast("long").alias("high"),
    )


def rolled_up(stored: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups from stored ones."""
    return stored.groupBy(*keys).agg(
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
    )


def quantiles(stored: DataFrame, shares: tuple[float, ...] = SHARES) -> DataFrame:
    """A row per group and share with the sketch's quantile; shares 0 and 1 are the extremes."""

    def at(share: float) -> Column:
        return F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(share))).alias("quantile")

    cells = F.array(*[F.struct(F.lit(float(s)).alias("share"), at(s)) for s in shares])
    keys = [c for c in stored.columns if c not in ("sketch", "low", "high")]
    return stored.select(*keys, F.inline(cells))


def by_dimension(stored: DataFrame, dimensions: list[str]) -> DataFrame:
    """Rolled-up sketches of each dimension alone, as rows (dimension, value, sketch, n, low, high)."""
    parts = [
        rolled_up(stored, [name]).select(F.lit(name).alias("dimension"), F.col(name).cast("string").alias("value"), "sketch", "n",
                                         "low", "high")
        for name in dimensions
    ]
    return reduce(DataFrame.unionByName, parts)


def rank_bounds(rows: DataFrame, value: str, found: DataFrame, dimensions: list[str]) -> DataFrame:
    """The true share of rows below each quantile and up to it, from exact counts.

    Rows are counted per dimension and value before they meet the few quantiles of their group.
    """
    sides = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions])
    counted = (
        rows.filter(F.col(value).isNotNull())
        .select(F.inline(sides), F.col(value).alias("_v"))
        .groupBy("dimension", "value", "_v").agg(F.count(F.lit(1)).alias("rows"))
    )
    quantile = F.col("quantile")
    return (
        counted.join(found, ["dimension", "value"])
        .groupBy("dimension", "value", "share", "n", "quantile")
        .agg(
            F.coalesce(F.sum(F.when(F.col("_v") < quantile, F.col("rows"))), F.lit(0)).alias("below"),
            F.coalesce(F.sum(F.when(F.col("_v") <= quantile, F.col("rows"))), F.lit(0)).alias("upto"),
        )
    )
