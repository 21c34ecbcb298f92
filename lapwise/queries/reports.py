"""Report tables over the given data."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapwise.operators.staging import stage
from lapwise.plans import gold, reports
from lapwise.queries.common import sql
from lapwise.queries.gold import bound, performance, pit_efficiency, rankings, rounded, standings, statistics


def _consistency(b):
    stats = stage(statistics(b))
    report = reports.consistency_and_aggression(gold.driver_consistency(stats), stats)
    return rounded(report, "consistency_score")


QUERIES = {
    "rpt1_championship_contenders": bound(lambda b: reports.championship_contenders(standings(b), 2000)),
    "rpt2_team_dominance": bound(lambda b: reports.team_dominance(rankings(b))),
    "rpt3_consistency_and_aggression": bound(_consistency),
    "rpt4_pit_efficiency_by_team": bound(
        lambda b: rounded(reports.pit_efficiency_by_team(pit_efficiency(b)), "avg_pit_time", "avg_consistency")
    ),
    "rpt5_current_season_standings": bound(
        lambda b: rounded(reports.season(standings(b), 2001), "consistency_score")
    ),
    "rpt5_driver_performance_trends": bound(lambda b: reports.driver_performance_trends(statistics(b))),
    "rpt7_points_share": bound(lambda b: reports.points_share(rankings(b))),
    "rpt7_top_drivers": bound(
        lambda b: reports.top_by_points(standings(b).select("driverId", "surname", "year", "total_points", "win_rate"))
    ),
    "sort1_standings_ordered": bound(
        lambda b: standings(b)
        .select("year", "driverId", "total_points", "championship_position")
        .orderBy("year", "championship_position")
    ),
    "sort4_teams_by_average_position": bound(
        lambda b: rankings(b)
        .groupBy("constructorName")
        .agg(F.round(F.avg("average_team_position"), 6).alias("average_position"))
        .orderBy("average_position")
    ),
    "sort6_seasons_descending": bound(lambda b: reports.seasons_descending(performance(b))),
    "sort6_race_names": bound(lambda b: reports.race_names(performance(b), 2000)),
}

SQL = {
    "rpt1_championship_contenders": sql(
        """SELECT forename, surname, year, total_points, championship_position, championship_battle_status
        FROM standings WHERE year = 2000""",
        "standings",
    ),
    "rpt2_team_dominance": sql(
        """SELECT constructorName, year, total_wins, team_win_rate, dominance_score FROM constructor_rankings
        ORDER BY dominance_score DESC, constructorName, year LIMIT 10""",
        "constructor_rankings",
    ),
    "rpt3_consistency_and_aggression": sql(
        """SELECT s.forename, s.surname, round(s.consistency_score, 6) AS consistency_score, s.win_rate, c.form_trend
        FROM consistency c JOIN driver_statistics s USING (driverId, constructorId, year) WHERE s.total_races > 5""",
        "consistency",
    ),
    "rpt4_pit_efficiency_by_team": sql(
        """SELECT constructorName, round(avg(average_pit_time), 6) AS avg_pit_time,
        round(avg(pit_consistency), 6) AS avg_consistency FROM pit_efficiency GROUP BY constructorName""",
        "pit_efficiency",
    ),
    "rpt5_current_season_standings": sql(
        "SELECT * REPLACE (round(consistency_score, 6) AS consistency_score) FROM standings WHERE year = 2001",
        "standings",
    ),
    "rpt5_driver_performance_trends": sql(
        "SELECT driverId, year, win_rate, podium_rate FROM driver_statistics", "driver_statistics"
    ),
    "rpt7_points_share": sql(
        """SELECT constructorName, sum(total_points) AS total_points,
        sum(total_points) / (SELECT sum(total_points) FROM constructor_rankings) AS points_share
        FROM constructor_rankings GROUP BY constructorName""",
        "constructor_rankings",
    ),
    "rpt7_top_drivers": sql(
        """SELECT driverId, surname, year, total_points, win_rate FROM standings
        ORDER BY total_points DESC, driverId LIMIT 10""",
        "standings",
    ),
    "sort1_standings_ordered": sql(
        "SELECT year, driverId, total_points, championship_position FROM standings", "standings"
    ),
    "sort4_teams_by_average_position": sql(
        """SELECT constructorName, round(avg(average_team_position), 6) AS average_position
        FROM constructor_rankings GROUP BY constructorName""",
        "constructor_rankings",
    ),
    "sort6_seasons_descending": sql("SELECT DISTINCT year FROM performance", "performance"),
    "sort6_race_names": sql("SELECT DISTINCT name FROM performance WHERE year = 2000", "performance"),
}
