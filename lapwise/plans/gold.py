"""Gold builders.

The season tables share one heavy step, ``season_partials``: a single shuffle of the facts by driver,
constructor and year into sums that add up. Driver, team and season tables are rolled up from it, and names
are joined to the aggregated rows instead of to the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.functions import metrics as M
from lapwise.operators.maintenance import Stored
from lapwise.operators.running import row_numbers


def season_partials(facts: DataFrame, *more: Column) -> DataFrame:
    """Mergeable sums per driver, constructor and year, with ``more`` of the kind.

    ``fastest_laps`` counts rows whose ``fastestLap`` equals 1, the definition given for it.
    """
    finished = F.when(F.col("finished_race"), F.col("position")).cast("long")
    return facts.groupBy("driverId", "constructorId", "year").agg(
        F.count("raceId").alias("total_races"),
        M.count_where(F.col("position") == 1).alias("total_wins"),
        M.count_where(F.col("podium_finish")).alias("total_podiums"),
        F.sum("points").alias("total_points"),
        M.count_where(F.col("dnf_status")).alias("dnf_count"),
        M.count_where(F.col("fastestLap") == 1).alias("fastest_laps"),
        F.min("position").alias("career_best_position"),
        F.max("position").alias("career_worst_position"),
        F.count(finished).alias("finishes"),
        F.sum(finished).alias("finish_sum"),
        F.sum(finished * finished).alias("finish_squares"),
        *more,
    )


def best_slots(qualifying: DataFrame) -> DataFrame:
    """A driver has one grid slot per race, the best one."""
    return qualifying.groupBy("raceId", "driverId").agg(F.min("position").alias("qualifying_position"))


GRID_SUMS = ["grid_rows", "grid_slots", "grid_sum", "grid_places", "grid_place_sum", "grid_score"]


def grid_partials(facts: DataFrame, qualifying: DataFrame) -> DataFrame:
    """``season_partials`` with the sums that ``grid_means`` divides, so results are read once for both."""
    grid = best_slots(qualifying).withColumn("_on_grid", F.lit(True))
    start, there = F.col("qualifying_position"), F.col("_on_grid")
    place = F.when(there, F.col("position"))
    sums = [
        F.count(there), F.count(start), F.sum(start), F.count(place), F.sum(place),
        F.sum(F.when(there, M.qualifying_score(start))),
    ]
    joined = facts.join(grid, ["raceId", "driverId"], "left")
    return season_partials(joined, *[value.alias(name) for name, value in zip(GRID_SUMS, sums)])


def grid_means(partials: DataFrame, drivers: DataFrame, constructors: DataFrame) -> DataFrame:
    """Means of ``qualifying_vs_race`` per driver and year, from ``grid_partials``."""
    known = partials.join(drivers.select("driverId"), "driverId").join(constructors.select("constructorId"), "constructorId")
    sums = known.groupBy("driverId", "year").agg(*[F.sum(name).alias(name) for name in GRID_SUMS])
    return sums.filter("grid_rows > 0").select(
        "driverId", "year",
        M.ratio(F.col("grid_sum"), F.col("grid_slots")).alias("qualifying_position"),
        M.ratio(F.col("grid_place_sum"), F.col("grid_places")).alias("race_position"),
        M.ratio(F.col("grid_score"), F.col("grid_rows")).alias("qualifying_performance_score"),
    )


def stored_seasons() -> Stored:
    """The same sums as a stored aggregation that is kept up to date from changed rows."""
    finished = F.when(F.col("finished_race"), F.col("position")).cast("long")
    return Stored(
        ["driverId", "constructorId", "year"],
        sums={"total_points": F.col("points"), "finish_sum": finished, "finish_squares": finished * finished},
        counts={
            "total_races": F.col("raceId").isNotNull(),
            "total_wins": F.col("position") == 1,
            "total_podiums": F.col("podium_finish"),
            "dnf_count": F.col("dnf_status"),
            "fastest_laps": F.col("fastestLap") == 1,
            "finishes": finished.isNotNull(),
        },
        lows={"career_best_position": F.col("position")},
        highs={"career_worst_position": F.col("position")},
    )


_SUMS = [
    "total_races", "total_wins", "total_podiums", "total_points", "dnf_count", "fastest_laps",
    "finishes", "finish_sum", "finish_squares",
]


def roll_up(partials: DataFrame, *keys: str) -> DataFrame:
    """Add partials up to coarser keys; ``members`` counts the rows merged."""
    return partials.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.min("career_best_position").alias("career_best_position"),
        F.max("career_worst_position").alias("career_worst_position"),
        F.count(F.lit(1)).alias("members"),
    )


def driver_measures(sums: DataFrame) -> DataFrame:
    """Averages and rates of driver sums, at whatever grain they are."""
    races = F.col("total_races")
    based = sums.withColumns(
        {
            "average_finish_position": M.ratio(F.col("finish_sum"), F.col("finishes")),
            "position_stddev": F.sqrt(
                M.sample_variance(F.col("finishes"), F.col("finish_sum"), F.col("finish_squares"))
            ),
        }
    )
    return based.withColumns(
        {
            "win_rate": M.ratio(F.col("total_wins"), races),
            "podium_rate": M.ratio(F.col("total_podiums"), races),
            "dnf_rate": M.ratio(F.col("dnf_count"), races),
            "points_per_race": M.ratio(F.col("total_points"), races),
            "finish_rate": M.ratio(races - F.col("dnf_count"), races),
            "consistency_score": M.consistency(F.col("position_stddev"), F.col("average_finish_position")),
        }
    ).drop("finishes", "finish_sum", "finish_squares")


def driver_statistics(partials: DataFrame, drivers: DataFrame, constructors: DataFrame) -> DataFrame:
    names = drivers.select("driverId", "forename", "surname", "nationality")
    teams = constructors.select("constructorId", "constructorName")
    return driver_measures(partials).join(names, "driverId").join(teams, "constructorId")


def constructor_rankings(partials: DataFrame, drivers: DataFrame, constructors: DataFrame) -> DataFrame:
    """Team seasons. ``total_races`` counts result rows. The partials have one row per driver, so counting them
    gives the number of distinct drivers without a distinct aggregate.

    Known drivers are kept by an inner join on their unique id: a semi join would be moved below the partials and
    shuffle the facts once more.
    """
    known = partials.join(drivers.select("driverId"), "driverId")
    teams = constructors.select("constructorId", "constructorName", "constructorNationality")
    races = F.col("total_races")
    return (
        roll_up(known, "constructorId", "year")
        .join(teams, "constructorId")
        .select(
            "constructorId", "constructorName", "constructorNationality", "year",
            "total_races", "total_wins", "total_podiums", "total_points",
            F.col("members").alias("driver_count"),
            M.ratio(F.col("finish_sum"), F.col("finishes")).alias("average_team_position"),
            M.ratio(F.col("total_wins"), races).alias("team_win_rate"),
            M.ratio(F.col("total_podiums"), races).alias("team_podium_rate"),
            M.ratio(F.col("total_points"), races).alias("points_per_race"),
            M.dominance(F.col("total_wins"), F.col("total_podiums"), F.col("total_points"), races).alias(
                "dominance_score"
            ),
        )
    )


def driver_seasons(partials: DataFrame, drivers: DataFrame) -> DataFrame:
    """One row per driver and year, all teams together."""
    names = drivers.select("driverId", "forename", "surname", "nationality")
    return driver_measures(roll_up(partials, "driverId", "year").drop("members")).join(names, "driverId")


def championship_standings(seasons: DataFrame) -> DataFrame:
    """Rank drivers within each year; ties end at the driver id.

    The gap is own minus leader (never positive); the status reads how far behind that is. A year is ranked in cells
    of points, so no task holds a year.
    """
    ranked = row_numbers(
        seasons,
        ["year"],
        [F.desc("total_points"), F.desc("total_wins"), F.desc("total_podiums"), F.asc("driverId")],
        "championship_position",
        splits=[F.floor(-F.col("total_points") / (1 << 20)), F.floor(-F.col("total_points") / 32)],
    )
    leaders = seasons.groupBy("year").agg(F.max("total_points").alias("leader_points"))
    behind = F.col("leader_points") - F.col("total_points")
    return ranked.join(leaders, "year").select(
        "driverId", "forename", "surname", "nationality", "year",
        F.col("championship_position").cast("int").alias("championship_position"),
        "total_points", "total_wins", "total_podiums", "total_races",
        (-behind).alias("points_gap_to_leader"),
        M.battle_status(behind).alias("championship_battle_status"),
        "win_rate", "podium_rate", "consistency_score",
    )


def driver_consistency(statistics: DataFrame) -> DataFrame:
    """Rolling five rows per driver by year, then team. A driver has at most teams x years rows here.

    Labels read values rounded to nine digits, so summation noise cannot move a value across a bound.
    """
    recent = Window.partitionBy("driverId").orderBy("year", "constructorId").rowsBetween(-4, 0)
    rolled = statistics.withColumns(
        {
            "rolling_average_position": F.avg("average_finish_position").over(recent),
            "rolling_points": F.sum("total_points").over(recent),
            "position_variance": F.var_samp("average_finish_position").over(recent),
        }
    )
    return rolled.withColumns(
        {
            "consistency_rating": M.consistency_rating(F.round("position_variance", 9)),
            "form_trend": M.form_trend(F.round("rolling_average_position", 9)),
        }
    )


def lap_time_trends(lap_times: DataFrame, races: DataFrame, teams: DataFrame) -> DataFrame:
    """Pace per race and driver. Laps are aggregated first; season and team join the aggregated rows."""
    per_race = lap_times.groupBy("raceId", "driverId").agg(
        F.min("milliseconds").alias("fastest_lap_time"),
        F.max("milliseconds").alias("slowest_lap_time"),
        F.avg("milliseconds").alias("average_lap_time"),
        F.count("lap").alias("total_laps"),
        F.stddev_samp("milliseconds").alias("lap_time_stddev"),
    )
    spread = F.col("slowest_lap_time") - F.col("fastest_lap_time")
    return (
        per_race.join(races.select("raceId", "year"), "raceId")
        .join(teams, ["raceId", "driverId"], "left")
        .withColumns(
            {
                "pace_consistency": 1 - M.quotient(F.col("lap_time_stddev"), F.col("average_lap_time")),
                "lap_degradation_rate": M.ratio(spread, F.col("total_laps")),
                "pace_improvement_potential": M.quotient(
                    F.col("average_lap_time") - F.col("fastest_lap_time"), F.col("average_lap_time")
                ),
            }
        )
    )


def stop_times(pit_analysis: DataFrame, *keys: str) -> DataFrame:
    return pit_analysis.groupBy(*keys).agg(
        F.count("stop").alias("total_pit_stops"),
        F.min("milliseconds").alias("fastest_pit_time"),
        F.max("milliseconds").alias("slowest_pit_time"),
        F.avg("milliseconds").alias("average_pit_time"),
        F.sum("milliseconds").alias("total_pit_time"),
    )


def stop_efficiency() -> Column:
    return M.ratio(F.lit(10000), F.col("average_pit_time"))


def pit_stop_efficiency(pit_analysis: DataFrame, constructors: DataFrame) -> DataFrame:
    per_race = stop_times(pit_analysis, "raceId", "year", "driverId", "constructorId")
    spread = F.col("slowest_pit_time") - F.col("fastest_pit_time")
    return per_race.join(
        constructors.select("constructorId", "constructorName"), "constructorId", "left"
    ).withColumns(
        {
            "pit_efficiency_score": stop_efficiency(),
            "pit_consistency": 1 - M.ratio(spread, F.col("average_pit_time")),
            "time_lost_in_pits": F.col("total_pit_time") / 1000.0,
        }
    )


def race_pit_scores(pit_analysis: DataFrame) -> DataFrame:
    """Pit efficiency per race and driver without its team: a driver has one team in a race, so the rows are the same."""
    per_race = stop_times(pit_analysis, "raceId", "year", "driverId")
    return per_race.withColumn("pit_efficiency_score", stop_efficiency())


def race_pace_analysis(performance: DataFrame, lap_times: DataFrame) -> DataFrame:
    """Pace of every result. Laps are aggregated before the join: repeats on the left leave means and extremes
    unchanged, and the join then carries one row per race and driver instead of one per lap."""
    laps = lap_times.groupBy("raceId", "driverId").agg(
        F.avg("milliseconds").alias("average_race_lap_time"),
        F.min("milliseconds").alias("fastest_race_lap"),
        F.max("lap").alias("total_race_laps"),
    )
    keys = ["raceId", "year", "driverId", "constructorId", "position"]
    return (
        performance.select(*keys)
        .distinct()
        .join(laps, ["raceId", "driverId"], "left")
        .withColumn("race_finish_time", F.col("average_race_lap_time") * F.col("total_race_laps"))
    )


def qualifying_vs_race(qualifying: DataFrame, performance: DataFrame) -> DataFrame:
    """Grid against finish. A driver has one grid slot per race, so qualifying is cut to the best slot first:
    the join can then never multiply repeated rows of both sides."""
    grid = best_slots(qualifying)
    race = performance.select(
        "raceId", "driverId", "year", "constructorId", F.col("position").alias("race_position"),
        "forename", "surname", "nationality", "constructorName", "constructorNationality",
    )
    start, finish = F.col("qualifying_position"), F.col("race_position")
    return grid.join(race, ["raceId", "driverId"]).select(
        "raceId", "year", "driverId", "constructorId", start, finish,
        (start - finish).alias("position_change"),
        M.gain(start, finish).alias("overtakes_made"),
        M.gain(finish, start).alias("positions_lost"),
        M.qualifying_score(start).alias("qualifying_performance_score"),
        "forename", "surname", "nationality", "constructorName", "constructorNationality",
    )
