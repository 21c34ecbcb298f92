"""Report tables over the gold layer. Seasons, slices and sizes are parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.functions import metrics as M


def season(df: DataFrame, year: int) -> DataFrame:
    return df.filter(F.col("year") == year)


def latest(df: DataFrame) -> DataFrame:
    """Rows of the last year in ``df``; the maximum is a scalar subquery, so the filter still reaches the scan."""
    return df.filter(F.col("year") == df.agg(F.max("year")).scalar())


def sliced(df: DataFrame, **equal) -> DataFrame:
    """Equality slice, e.g. ``year=2000, name="5-LOW"``."""
    for name, value in equal.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def championship_contenders(standings: DataFrame, year: int) -> DataFrame:
    return (
        season(standings, year)
        .select(
            "forename", "surname", "year", "total_points", "championship_position", "championship_battle_status"
        )
        .orderBy(F.desc("total_points"), "championship_position")
    )


def team_dominance(rankings: DataFrame, top: int = 10) -> DataFrame:
    return (
        rankings.select("constructorName", "year", "total_wins", "team_win_rate", "dominance_score")
        .orderBy(F.desc("dominance_score"), "constructorName", "year")
        .limit(top)
    )


def consistency_and_aggression(consistency: DataFrame, statistics: DataFrame, min_races: int = 5) -> DataFrame:
    """Drivers with more than ``min_races`` races. Both tables carry the same measures, so each column is taken
    from one side only, and the join uses the full key of both."""
    keys = ["driverId", "constructorId", "year"]
    form = consistency.select(*keys, "form_trend")
    return (
        statistics.filter(F.col("total_races") > min_races)
        .select(*keys, "forename", "surname", "consistency_score", "win_rate")
        .join(form, keys)
        .select("forename", "surname", "consistency_score", "win_rate", "form_trend")
        .orderBy(F.desc("consistency_score"))
    )


def pit_efficiency_by_team(efficiency: DataFrame) -> DataFrame:
    return (
        efficiency.groupBy("constructorName")
        .agg(F.avg("average_pit_time").alias("avg_pit_time"), F.avg("pit_consistency").alias("avg_consistency"))
        .orderBy("avg_pit_time")
    )


def driver_performance_trends(statistics: DataFrame) -> DataFrame:
    return statistics.select("driverId", "year", "win_rate", "podium_rate").orderBy("year", F.desc("win_rate"))


def top_by_points(df: DataFrame, top: int = 10) -> DataFrame:
    return df.orderBy(F.desc("total_points"), "driverId").limit(top)


def points_share(rankings: DataFrame) -> DataFrame:
    """Share of each constructor in all points; the total is a scalar subquery, not a one-task window."""
    total = rankings.agg(F.sum("total_points")).scalar()
    return rankings.groupBy("constructorName").agg(F.sum("total_points").alias("total_points")).withColumn(
        "points_share", M.ratio(F.col("total_points"), total)
    )


def seasons_descending(performance: DataFrame) -> DataFrame:
    return performance.select("year").distinct().orderBy(F.desc("year"))


def race_names(performance: DataFrame, year: int) -> DataFrame:
    return season(performance, year).select("name").distinct().orderBy("name")
