"""Silver and gold tables over the given data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.functions import metrics as M
from lapwise.plans import gold, silver
from lapwise.queries.common import sql
from lapwise.sources.binding import Binding

ROUNDED = 6


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Round values whose last digits depend on the order of summation."""
    kinds = dict(df.dtypes)
    return df.withColumns({n: M.nearest(F.col(n), ROUNDED) if kinds[n] == "double" else F.round(n, ROUNDED) for n in names})


def as_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names})


def performance(b: Binding) -> DataFrame:
    return silver.performance(b.results(), b.races(), b.drivers(), b.constructors())


def partials(b: Binding) -> DataFrame:
    return gold.season_partials(silver.race_facts(b.results(), b.races()))


def statistics(b: Binding) -> DataFrame:
    return gold.driver_statistics(partials(b), b.drivers(), b.constructors())


def rankings(b: Binding) -> DataFrame:
    return gold.constructor_rankings(partials(b), b.drivers(), b.constructors())


def seasons(b: Binding) -> DataFrame:
    return gold.driver_seasons(partials(b), b.drivers())


def standings(b: Binding) -> DataFrame:
    return gold.championship_standings(seasons(b))


def trends(b: Binding) -> DataFrame:
    return gold.lap_time_trends(b.unnumbered_laps(), b.races(), silver.race_teams(b.results()))


def pits(b: Binding) -> DataFrame:
    return silver.pit_analysis(b.stops_alone(), b.races(), b.drivers(), b.results())


def pit_efficiency(b: Binding) -> DataFrame:
    return gold.pit_stop_efficiency(pits(b), b.constructors())


def qualifying_vs_race(b: Binding) -> DataFrame:
    return gold.qualifying_vs_race(b.qualifying(), performance(b))


STATISTIC_ROUNDS = ["position_stddev", "consistency_score"]


def bound(build: Callable[[Binding], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A registry entry: the query over the racing tables bound to a folder of given tables."""
    return lambda spark, folder: build(Binding(spark, folder))


QUERIES = {
    "join1_performance": bound(performance),
    "join2_pit_analysis": bound(lambda b: pits(b).withColumnRenamed("pit_time_category", "category")),
    "join3_race_pace": bound(lambda b: gold.race_pace_analysis(performance(b), b.lap_times())),
    "join4_qualifying_vs_race": bound(qualifying_vs_race),
    "agg1_driver_statistics": bound(lambda b: rounded(statistics(b), *STATISTIC_ROUNDS)),
    "agg2_constructor_rankings": bound(rankings),
    "agg3_lap_time_trends": bound(lambda b: rounded(trends(b), "lap_time_stddev", "pace_consistency")),
    "agg4_pit_stop_efficiency": bound(lambda b: rounded(pit_efficiency(b), "pit_consistency")),
    "agg5_race_pace_summary": bound(
        lambda b: gold.race_pace_analysis(performance(b), b.lap_times())
        .groupBy("year")
        .agg(
            F.count(F.lit(1)).alias("results"),
            F.count("fastest_race_lap").alias("with_laps"),
            F.min("fastest_race_lap").alias("fastest_race_lap"),
            F.max("total_race_laps").alias("most_laps"),
            F.round(F.avg("race_finish_time"), 4).alias("average_finish_time"),
        )
    ),
    "win1_championship_standings": bound(lambda b: rounded(standings(b), "consistency_score")),
    "win2_leader_points": bound(
        lambda b: seasons(b).groupBy("year").agg(F.max("total_points").alias("leader_points"))
    ),
    "win3_driver_consistency": bound(
        lambda b: rounded(
            gold.driver_consistency(statistics(b)), *STATISTIC_ROUNDS, "rolling_average_position", "position_variance"
        )
    ),
    "met7_position_changes": bound(
        lambda b: qualifying_vs_race(b)
        .groupBy("constructorName", "year")
        .agg(
            F.sum("overtakes_made").alias("overtakes_made"),
            F.sum("positions_lost").alias("positions_lost"),
            F.count("position_change").alias("compared"),
            F.sum("qualifying_performance_score").alias("qualifying_score"),
        )
    ),
    "met9_battle_status": bound(
        lambda b: standings(b).groupBy("year", "championship_battle_status").agg(
            F.count(F.lit(1)).alias("drivers"), F.min("points_gap_to_leader").alias("largest_gap")
        )
    ),
    "met10_form_labels": bound(
        lambda b: gold.driver_consistency(statistics(b))
        .groupBy("consistency_rating", "form_trend")
        .agg(F.count(F.lit(1)).alias("rows"))
    ),
}

_STAT = """SELECT driverId, forename, surname, nationality, constructorId, constructorName, year, total_races, total_wins,
    total_podiums, total_points, average_finish_position, dnf_count, fastest_laps, career_best_position,
    career_worst_position, round(position_stddev, 6) AS position_stddev, win_rate, podium_rate, dnf_rate,
    points_per_race, finish_rate, round(consistency_score, 6) AS consistency_score"""

SQL = {
    "join1_performance": sql("SELECT * FROM performance", "performance"),
    "join2_pit_analysis": sql(
        "SELECT * RENAME (pit_time_category AS category) FROM pit_analysis", "pit_analysis"
    ),
    "join3_race_pace": sql(
        "SELECT *, average_race_lap_time * total_race_laps AS race_finish_time FROM race_pace", "race_pace"
    ),
    "join4_qualifying_vs_race": sql("SELECT * FROM qvr", "qvr"),
    "agg1_driver_statistics": sql(f"{_STAT} FROM driver_statistics", "driver_statistics"),
    "agg2_constructor_rankings": sql("SELECT * FROM constructor_rankings", "constructor_rankings"),
    "agg3_lap_time_trends": sql(
        "SELECT * REPLACE (round(lap_time_stddev, 6) AS lap_time_stddev, round(pace_consistency, 6) AS "
        "pace_consistency) FROM lap_trends",
        "lap_trends",
    ),
    "agg4_pit_stop_efficiency": sql(
        "SELECT * REPLACE (round(pit_consistency, 6) AS pit_consistency) FROM pit_efficiency", "pit_efficiency"
    ),
    "agg5_race_pace_summary": sql(
        """SELECT year, count(*) AS results, count(fastest_race_lap) AS with_laps, min(fastest_race_lap) AS
        fastest_race_lap, max(total_race_laps) AS most_laps,
        round(avg(average_race_lap_time * total_race_laps), 4) AS average_finish_time FROM race_pace GROUP BY year""",
        "race_pace",
    ),
    "win1_championship_standings": sql(
        "SELECT * REPLACE (round(consistency_score, 6) AS consistency_score) FROM standings", "standings"
    ),
    "win2_leader_points": sql(
        """SELECT DISTINCT year, first_value(total_points) OVER (PARTITION BY year ORDER BY total_points DESC)
        AS leader_points FROM driver_seasons""",
        "driver_seasons",
    ),
    "win3_driver_consistency": sql(
        _STAT
        + """, round(rolling_average_position, 6) AS rolling_average_position, rolling_points,
        round(position_variance, 6) AS position_variance, consistency_rating, form_trend FROM consistency""",
        "consistency",
    ),
    "met7_position_changes": sql(
        """SELECT constructorName, year, CAST(sum(overtakes_made) AS BIGINT) AS overtakes_made,
        CAST(sum(positions_lost) AS BIGINT) AS positions_lost, count(position_change) AS compared,
        CAST(sum(qualifying_performance_score) AS BIGINT) AS qualifying_score FROM qvr GROUP BY ALL""",
        "qvr",
    ),
    "met9_battle_status": sql(
        """SELECT year, championship_battle_status, count(*) AS drivers, min(points_gap_to_leader) AS largest_gap
        FROM standings GROUP BY ALL""",
        "standings",
    ),
    "met10_form_labels": sql(
        'SELECT consistency_rating, form_trend, count(*) AS "rows" FROM consistency GROUP BY ALL', "consistency"
    ),
}
