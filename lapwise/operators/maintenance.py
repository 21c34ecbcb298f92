"""Stored aggregations kept up to date from changed rows alone.

A stored aggregation has keys, sums and extremes. Changed rows come as two versions: ``removed`` holds what they were
(deleted rows, and updated rows before), ``added`` what they are (inserted rows, and updated rows after). Both are summed up per
key, and a stored sum moves by the difference. A minimum or maximum can only be taken over when no removed row reached it;
the few groups where one did are recomputed from the current rows, and only these. A group without rows left disappears.

Besides the visible columns the stored state has the number of rows of a group and, per sum, how many values were not null, so
that a sum over nulls alone is null again after a retraction. Sums of integers and decimals, and of doubles that are
multiples of a power of two in a small range such as points, equal a full recomputation exactly; of other doubles up to rounding.
Keys may be null.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.operators.staging import stage
from lapwise.sources.readers import read_table

ROWS = "_rows"


@dataclass(frozen=True)
class Stored:
    """What is kept per key: ``sums`` and ``counts`` move both ways, ``lows`` and ``highs`` are minima and maxima.

    ``counts`` are 0 where nothing matches, ``sums`` null where all values are null.
    """

    keys: list[str]
    sums: dict[str, Column] = field(default_factory=dict)
    counts: dict[str, Column] = field(default_factory=dict)
    lows: dict[str, Column] = field(default_factory=dict)
    highs: dict[str, Column] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.counts, *self.sums, *self.lows, *self.highs]

    def compute(self, rows: DataFrame) -> DataFrame:
        """The state of ``rows``, in one aggregation with partial sums."""
        return rows.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias(ROWS),
            *[F.coalesce(F.sum(value.cast("long")), F.lit(0)).alias(name) for name, value in self.counts.items()],
            *[F.sum(value).alias(name) for name, value in self.sums.items()],
            *[F.count(value).alias(f"_n_{name}") for name, value in self.sums.items()],
            *[F.min(value).alias(name) for name, value in self.lows.items()],
            *[F.max(value).alias(name) for name, value in self.highs.items()],
        )

    def visible(self, state: DataFrame) -> DataFrame:
        return state.select(*self.columns)

    def changes(self, state: DataFrame, removed: DataFrame, added: DataFrame, current: DataFrame) -> DataFrame:
        """The new state of every group that a changed row belongs to; a group that is gone has no rows.

        ``current`` are all rows after the change. It is read for the groups alone whose minimum or maximum left, and not
        at all if there are none. The result is staged.
        """
        before, after = self._named(self.compute(removed), "r_"), self._named(self.compute(added), "a_")
        moved = before.join(after, self._same("r_", "a_"), "full_outer")
        keys = [F.coalesce(f"r_{k}", f"a_{k}").alias(k) for k in self.keys]
        delta = moved.select(*keys, *[c for c in moved.columns if c[2:] not in self.keys])
        old = self._named(state, "s_")
        # One row a group on both sides; the stored side keeps only groups that changed.
        joined = delta.join(old, self._same("", "s_"), "left")
        merged = stage(joined.select(*self.keys, *self._moved(), self._lost().alias("_lost")))
        lost = merged.filter("_lost").select(*[F.col(k).alias(f"l_{k}") for k in self.keys])
        sound = merged.filter("NOT _lost").drop("_lost")
        if lost.isEmpty():
            return stage(sound)
        again = stage(self.compute(current.join(lost, self._same("", "l_"), "left_semi")))
        gone = merged.filter("_lost").join(self._named(again, "g_"), self._same("", "g_"), "left_anti").drop("_lost")
        return stage(sound.unionByName(again).unionByName(gone.withColumn(ROWS, F.lit(0).cast("long"))))

    def applied(self, state: DataFrame, changes: DataFrame) -> DataFrame:
        """The state after the changes."""
        touched = self._named(changes.select(*self.keys), "c_")
        kept = state.join(touched, self._same("", "c_"), "left_anti")
        return kept.unionByName(changes.filter(F.col(ROWS) > 0))

    def _named(self, df: DataFrame, prefix: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])

    def _same(self, one: str, other: str) -> Column:
        """Equal keys under the prefixes of both sides; null equals null."""
        return reduce(lambda a, b: a & b, [F.col(f"{one}{key}").eqNullSafe(F.col(f"{other}{key}")) for key in self.keys])

    def _moved(self) -> list[Column]:
        def shifted(name: str) -> Column:
            parts = [F.coalesce(f"{side}{name}", F.lit(0)) for side in ("s_", "a_", "r_")]
            return parts[0] + parts[1] - parts[2]

        left = shifted(ROWS)
        result = [left.alias(ROWS)] + [shifted(name).alias(name) for name in self.counts]
        for name in self.sums:
            result.append(F.when(shifted(f"_n_{name}") > 0, shifted(name)).alias(name))
            result.append(shifted(f"_n_{name}").alias(f"_n_{name}"))
        result += [F.least(f"s_{name}", f"a_{name}").alias(name) for name in self.lows]
        result += [F.greatest(f"s_{name}", f"a_{name}").alias(name) for name in self.highs]
        return result

    def _lost(self) -> Column:
        """Whether a removed row may have held an extreme of a group that still has rows, without an equal or better one
        among the added rows."""
        found = F.lit(False)
        for name in self.lows:
            left = F.col(f"r_{name}") <= F.col(f"s_{name}")
            found = found | (left & ~F.coalesce(F.col(f"a_{name}") <= F.col(f"s_{name}"), F.lit(False)))
        for name in self.highs:
            left = F.col(f"r_{name}") >= F.col(f"s_{name}")
            found = found | (left & ~F.coalesce(F.col(f"a_{name}") >= F.col(f"s_{name}"), F.lit(False)))
        rest = F.coalesce(f"s_{ROWS}", F.lit(0)) + F.coalesce(f"a_{ROWS}", F.lit(0)) - F.coalesce(f"r_{ROWS}", F.lit(0))
        return F.coalesce(found, F.lit(False)) & (rest > 0)


def refresh_stored(
    spark: SparkSession, stored: Stored, path: str, new_path: str, removed: DataFrame, added: DataFrame, current: DataFrame,
    partition_by: str | None = None,
) -> DataFrame:
    """Write the next snapshot of a stored aggregation and return the changed groups.

    The state has one row a group, so writing it again is little; the rows it sums up are not read but for lost extremes.
    A snapshot never replaces the one it is built from.
    """
    if path == new_path:
        raise ValueError("a snapshot must not replace the one it is built from")
    state = read_table(spark, path)
    changes = stored.changes(state, removed, added, current)
    writer = stored.applied(state, changes).write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(new_path)
    return changes
