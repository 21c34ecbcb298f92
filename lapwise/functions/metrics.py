"""Derived measures shared by the gold tables. Division by zero gives null, but in ``quotient``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lapwise import constants as C


def ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def quotient(top: Column, bottom: Column) -> Column:
    """Floating-point division as in SQL over doubles: by zero it is infinite, and NaN for 0 / 0. Null stays null."""
    return F.when(bottom == 0, top.cast("double") * F.lit(float("inf"))).otherwise(ratio(top, bottom))


def nearest(value: Column, places: int) -> Column:
    """A double rounded by scaling, half away from zero, as SQL engines do; ``F.round`` reads its decimal digits, which makes
    a tie of a value just below one."""
    return F.round(value * 10.0**places) / 10.0**places


def count_where(test: Column) -> Column:
    return F.count_if(test)


def sample_variance(count: Column, total: Column, squares: Column) -> Column:
    """Sample variance from mergeable sums; null below two values.

    Sums add up across any grouping, so a coarser table can be rolled up from a finer one.
    """
    n, s, q = count.cast("double"), total.cast("double"), squares.cast("double")
    return F.when(count > 1, F.greatest(F.lit(0.0), q - F.try_divide(s * s, n)) / (n - 1))


def consistency(stddev: Column, mean: Column) -> Column:
    return F.when(stddev.isNotNull(), 1 - ratio(stddev, mean)).otherwise(0.0)


def dominance(wins: Column, podiums: Column, points: Column, races: Column) -> Column:
    return ratio(wins * C.DOMINANCE_WIN + podiums * C.DOMINANCE_PODIUM + points, races)


def battle_status(points_behind: Column) -> Column:
    return F.when(points_behind <= 25, "Contender").when(points_behind <= 50, "Dark Horse").otherwise("Out of Contention")


def consistency_rating(variance: Column) -> Column:
    return (
        F.when(variance < 2, "Very Consistent")
        .when(variance < 5, "Consistent")
        .when(variance < 10, "Inconsistent")
        .otherwise("Very Inconsistent")
    )


def form_trend(rolling_position: Column) -> Column:
    return F.when(rolling_position < 10, "Good Form").when(rolling_position < 15, "Average Form").otherwise("Poor Form")


def qualifying_score(position: Column) -> Column:
    return F.when(position <= 3, 10).when(position <= 10, 5).otherwise(1)


def gain(better: Column, worse: Column) -> Column:
    """How far ``better`` is above ``worse``; 0 when it is not, or when either is null."""
    return F.when(better > worse, better - worse).otherwise(0)
