"""Key figures over the given data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.operators.running import row_numbers
from lapwise.operators.staging import stage
from lapwise.plans import distributions, kpis, silver
from lapwise.queries.common import sql
from lapwise.queries.gold import bound, partials, pits, qualifying_vs_race, rounded, seasons
from lapwise.sources.binding import Binding

MAX_PER_ROUND = 12.0


def facts(b: Binding) -> DataFrame:
    return silver.race_facts(b.results(), b.races())


def _places(b: Binding) -> DataFrame:
    """The finishing order of everyone who drove laps, by total time."""
    drove = b.lap_times().groupBy("raceId", "driverId").agg(F.sum("milliseconds").alias("total"))
    order = [F.asc("total"), F.asc("driverId")]
    return row_numbers(drove, ["raceId"], order, "position", [F.floor(F.col("total") / 100_000)]).drop("total")


def _weighted(b: Binding) -> DataFrame:
    aged = kpis.with_tyre_age(b.lap_times(), b.pit_stops())
    scores = kpis.weighted_consistency(aged)
    return scores.select(
        "driverId", "year", "laps", *[F.round(c, 4).alias(c) for c in ["weighted_mean", "weighted_stddev", "consistency"]]
    )


DIMENSIONS = ["circuitId", "constructorId", "year"]


def _stored_sketches(b: Binding) -> DataFrame:
    """Pit times per circuit, team and season, stored once."""
    return stage(distributions.sketches(pits(b), "milliseconds", DIMENSIONS))


def _pit_quantiles(b: Binding) -> DataFrame:
    """Quantiles of each dimension, rolled up from the stored sketches."""
    return distributions.quantiles(distributions.by_dimension(_stored_sketches(b), DIMENSIONS))


def _pit_extremes(b: Binding) -> DataFrame:
    found = distributions.by_dimension(_stored_sketches(b), DIMENSIONS)
    return found.select("dimension", "value", "n", "low", "high")


def _pit_ranks(b: Binding) -> DataFrame:
    """How many quantiles of each dimension there are, and how many miss the rank error of three standard bounds."""
    found = distributions.rank_bounds(pits(b), "milliseconds", _pit_quantiles(b), DIMENSIONS)
    wanted, slack = F.col("share") * F.col("n"), 3 * distributions.rank_error() * F.col("n") + 1
    missed = (F.col("below") > wanted + slack) | (F.col("upto") < wanted - slack)
    return found.groupBy("dimension").agg(F.count(F.lit(1)).alias("quantiles"), F.count_if(missed).alias("missed"))


POINTS = [25.0, 18.0, 15.0, 12.0, 10.0, 8.0, 6.0, 4.0, 2.0, 1.0]

QUERIES = {
    "kpi10_still_possible": bound(lambda b: kpis.still_possible(facts(b), b.races(), 11, POINTS, 8)),
    "kpi6_rank_correlation": bound(
        lambda b: rounded(
            kpis.rank_correlation(qualifying_vs_race(b), "constructorId", "qualifying_position", "race_position"),
            "rank_correlation",
        )
    ),
    "kpi9_pit_quantiles": bound(_pit_quantiles),
    "kpi9_pit_extremes": bound(_pit_extremes),
    "kpi9_quantile_ranks": bound(_pit_ranks),
    "kpi1_pace_index": bound(lambda b: rounded(kpis.pace_index(b.lap_times()), "pace_index")),
    "kpi2_undercut": bound(lambda b: kpis.undercut_efficiency(b.pit_stops(), _places(b))),
    "kpi3_weighted_consistency": bound(_weighted),
    "kpi4_reliability": bound(lambda b: rounded(kpis.reliability(facts(b)), "reliability")),
    "kpi5_fastest_laps": bound(lambda b: kpis.fastest_laps(b.lap_times(), b.races())),
    "kpi5_pit_benchmarks": bound(lambda b: rounded(kpis.pit_benchmarks(pits(b)), "average_stop")),
    "kpi5_season_benchmarks": bound(
        lambda b: rounded(kpis.season_benchmarks(seasons(b)), "average_points", "average_win_rate")
    ),
    "kpi6_grid_statistics": bound(
        lambda b: rounded(kpis.grid_statistics(qualifying_vs_race(b)), "correlation", "slope", "intercept")
    ),
    "kpi7_head_to_head": bound(lambda b: kpis.head_to_head(facts(b), kpis.against_leader(seasons(b)))),
    "kpi7_season_trend": bound(lambda b: kpis.season_trend(seasons(b))),
    "kpi7_standings_evolution": bound(lambda b: kpis.standings_evolution(facts(b), b.races())),
    "kpi8_contribution": bound(lambda b: kpis.contribution(partials(b))),
    "kpi9_pit_histogram": bound(lambda b: kpis.histogram(b.pit_stops(), "milliseconds", 5000)),
    "kpi10_elimination": bound(lambda b: kpis.eliminated(facts(b), b.races(), 6, MAX_PER_ROUND)),
    "kpi11_pace_histogram": bound(lambda b: kpis.histogram(b.lap_times(), "milliseconds", 10000, "year")),
    "kpi11_lap_progression": bound(lambda b: rounded(kpis.lap_progression(b.lap_times()), "average", "smoothed")),
    "kpi12_gains_by_stops": bound(
        lambda b: rounded(kpis.gains_by_stops(qualifying_vs_race(b), b.pit_stops()), "average_change")
    ),
}

SQL = {
    "kpi10_still_possible": sql(
        """SELECT year, driverId, points, rounds_left, final AS best_final,
        best <= final AND bool_and(places * coalesce(list_sum(s[1:least(m, rivals)]), 0) + room
          >= places * coalesce(list_sum(s[1:rivals]), 0)) AS possible
        FROM (SELECT p.year, p.driverId, p.points, l.n AS rounds_left, l.n * 8 AS places, p.points + l.n * 8 * 25.0 AS final,
            y.best, y.drivers - 1 AS rivals, m.m, [18, 15, 12, 10, 8, 6, 4, 2, 1]::DOUBLE[] AS s,
            (SELECT coalesce(sum(p.points + l.n * 8 * 25.0 - o.points), 0) FROM (
              SELECT points, row_number() OVER (ORDER BY points) AS n FROM pts q
              WHERE q.year = p.year AND q.driverId <> p.driverId) o WHERE o.n > m.m) AS room
          FROM pts p JOIN (SELECT year, max(points) AS best, count(*) AS drivers FROM pts GROUP BY year) y ON p.year = y.year
          JOIN (SELECT year, count(DISTINCT round) FILTER (WHERE round > 11) AS n FROM races GROUP BY year) l
            ON p.year = l.year, (SELECT unnest(range(0, 10)) AS m) m)
        GROUP BY year, driverId, points, rounds_left, final, best""",
        "facts",
        pts="""SELECT f.year, f.driverId, sum(f.points) AS points FROM facts f JOIN races y ON f.raceId = y.raceId
          WHERE y.round <= 11 GROUP BY ALL""",
    ),
    "kpi6_rank_correlation": sql(
        """SELECT constructorId, count(*) AS results, round(corr(a, b), 6) AS rank_correlation FROM (
          SELECT constructorId, rank() OVER (PARTITION BY constructorId ORDER BY qualifying_position)
            + (count(*) OVER (PARTITION BY constructorId, qualifying_position) - 1) / 2 AS a,
          rank() OVER (PARTITION BY constructorId ORDER BY race_position)
            + (count(*) OVER (PARTITION BY constructorId, race_position) - 1) / 2 AS b
          FROM qvr WHERE race_position IS NOT NULL AND qualifying_position IS NOT NULL AND constructorId IS NOT NULL)
        GROUP BY constructorId""",
        "qvr",
    ),
    "kpi9_pit_extremes": sql(
        """SELECT dimension, value, count(*) AS n, min(milliseconds) AS low, max(milliseconds) AS high FROM (
          SELECT 'circuitId' AS dimension, circuitId::VARCHAR AS value, milliseconds FROM pit_analysis UNION ALL
          SELECT 'constructorId', constructorId, milliseconds FROM pit_analysis UNION ALL
          SELECT 'year', year::VARCHAR, milliseconds FROM pit_analysis) GROUP BY ALL""",
        "pit_analysis",
    ),
    "kpi9_quantile_ranks": sql(
        """SELECT dimension, 5 * count(DISTINCT value) AS quantiles, 0::BIGINT AS missed FROM (
          SELECT 'circuitId' AS dimension, circuitId::VARCHAR AS value FROM pit_analysis UNION ALL
          SELECT 'constructorId', constructorId FROM pit_analysis UNION ALL
          SELECT 'year', year::VARCHAR FROM pit_analysis) WHERE value IS NOT NULL GROUP BY dimension""",
        "pit_analysis",
    ),
    "kpi1_pace_index": sql(
        """SELECT driverId, year, n AS laps, ms / n AS driver_average, season_average,
        round((ms / n - season_average) / season_average, 6) AS pace_index
        FROM (SELECT driverId, year, CAST(sum(milliseconds) AS DOUBLE) AS ms, count(*) AS n FROM laps GROUP BY ALL)
        JOIN (SELECT year, CAST(sum(milliseconds) AS DOUBLE) / count(*) AS season_average FROM laps GROUP BY year)
        USING (year)""",
        "laps",
    ),
    "kpi2_undercut": sql(
        """SELECT a.driverId, count(*) AS rivals, count(*) FILTER (WHERE a.position < b.position) AS beaten,
        count(*) FILTER (WHERE a.position < b.position) / count(*) AS undercut_efficiency
        FROM placed a JOIN placed b ON a.raceId = b.raceId AND a.stop = b.stop AND a.lap < b.lap GROUP BY a.driverId""",
        "pit_stops", "laps",
        placed="""SELECT * FROM pit_stops JOIN (SELECT raceId, driverId, row_number() OVER
        (PARTITION BY raceId ORDER BY sum(milliseconds), driverId) AS position
        FROM laps GROUP BY raceId, driverId)
        USING (raceId, driverId)""",
    ),
    "kpi3_weighted_consistency": sql(
        """SELECT driverId, year, laps, round(m, 4) AS weighted_mean, round(s, 4) AS weighted_stddev,
        round(1 - s / m, 4) AS consistency
        FROM (SELECT driverId, year, count(*) AS laps, sum(w * x) / sum(w) AS m,
          sqrt(greatest(0, sum(w * x * x) / sum(w) - (sum(w * x) / sum(w)) * (sum(w * x) / sum(w)))) AS s
          FROM (SELECT driverId, year, CAST(milliseconds AS DOUBLE) AS x,
            CAST(lap - min(lap) OVER (PARTITION BY raceId, driverId, stop) + 1 AS DOUBLE) AS w FROM laps)
          GROUP BY driverId, year)""",
        "laps",
    ),
    "kpi4_reliability": sql(
        """SELECT constructorId, CAST(sum(weekends) AS BIGINT) AS weekends,
        round(sum(w * clean) / sum(w * weekends), 6) AS reliability
        FROM (SELECT *, power(0.5, max(year) OVER (PARTITION BY constructorId) - year) AS w
          FROM (SELECT constructorId, year, count(*) AS weekends, count(*) FILTER (WHERE NOT retired) AS clean
            FROM (SELECT constructorId, year, raceId, bool_or(dnf_status) AS retired FROM facts GROUP BY ALL)
            GROUP BY ALL)) GROUP BY constructorId""",
        "facts",
    ),
    "kpi5_fastest_laps": sql(
        """SELECT y.circuitId, y.year, min(milliseconds) AS fastest_lap,
        CAST(sum(milliseconds) AS DOUBLE) / count(*) AS average_lap, count(*) AS laps
        FROM laps l JOIN races y ON l.raceId = y.raceId GROUP BY ALL""",
        "laps",
        "races",
    ),
    "kpi5_pit_benchmarks": sql(
        """SELECT constructorId, count(*) AS stops, min(milliseconds) AS fastest_stop,
        round(avg(milliseconds), 6) AS average_stop FROM pit_analysis GROUP BY constructorId""",
        "pit_analysis",
    ),
    "kpi5_season_benchmarks": sql(
        """SELECT s.year, min(driverId) FILTER (WHERE total_points = best) AS best_driver, max(total_points) AS best_points,
        round(avg(total_points), 6) AS average_points, round(avg(win_rate), 6) AS average_win_rate
        FROM driver_seasons s JOIN (SELECT year, max(total_points) AS best FROM driver_seasons GROUP BY year) m
        ON s.year = m.year GROUP BY s.year""",
        "driver_seasons",
    ),
    "kpi6_grid_statistics": sql(
        """SELECT constructorId, count(*) AS results, round(corr(race_position, qualifying_position), 6) AS correlation,
        round(regr_slope(race_position, qualifying_position), 6) AS slope,
        round(regr_intercept(race_position, qualifying_position), 6) AS intercept
        FROM qvr WHERE race_position IS NOT NULL GROUP BY constructorId""",
        "qvr",
    ),
    "kpi7_head_to_head": sql(
        """SELECT a.year, a.driverId, b.driverId AS rivalId, count(*) AS races,
        count(*) FILTER (WHERE a.place < b.place) AS ahead, count(*) FILTER (WHERE a.place > b.place) AS behind
        FROM best a JOIN best b ON a.raceId = b.raceId AND a.year = b.year AND a.driverId <> b.driverId
        JOIN standings s ON s.year = b.year AND s.driverId = b.driverId AND s.championship_position = 1
        GROUP BY ALL""",
        "facts",
        "standings",
        best="""SELECT year, raceId, driverId, min(position) AS place FROM facts WHERE position IS NOT NULL
          GROUP BY ALL""",
    ),
    "kpi7_season_trend": sql(
        """SELECT driverId, year, total_points,
        total_points - lag(total_points) OVER (PARTITION BY driverId ORDER BY year) AS points_change,
        win_rate - lag(win_rate) OVER (PARTITION BY driverId ORDER BY year) AS win_rate_change FROM driver_seasons""",
        "driver_seasons",
    ),
    "kpi7_standings_evolution": sql(
        """SELECT *, sum(points) OVER (PARTITION BY year, driverId ORDER BY round
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS points_so_far
        FROM (SELECT f.year, f.driverId, y.round, sum(f.points) AS points FROM facts f JOIN races y
          ON f.raceId = y.raceId GROUP BY ALL)""",
        "facts",
    ),
    "kpi8_contribution": sql(
        """SELECT constructorId, driverId, year, total_points, team_points, total_points / team_points AS contribution
        FROM (SELECT *, sum(total_points) OVER (PARTITION BY constructorId, year) AS team_points
          FROM (SELECT constructorId, driverId, year, sum(points) AS total_points FROM facts GROUP BY ALL))""",
        "facts",
    ),
    "kpi9_pit_histogram": sql(
        'SELECT milliseconds // 5000 * 5000 AS bin, count(*) AS "rows" FROM pit_stops GROUP BY 1', "pit_stops"
    ),
    "kpi10_elimination": sql(
        """SELECT p.year, driverId, points, best - points AS gap, l.n AS rounds_left, best - points > l.n * 12.0 AS eliminated
        FROM pts p JOIN (SELECT year, max(points) AS best FROM pts GROUP BY year) m ON p.year = m.year
        JOIN (SELECT year, count(DISTINCT round) FILTER (WHERE round > 6) AS n FROM races GROUP BY year) l
        ON p.year = l.year""",
        "facts",
        pts="""SELECT f.year, f.driverId, sum(f.points) AS points FROM facts f JOIN races y ON f.raceId = y.raceId
          WHERE y.round <= 6 GROUP BY ALL""",
    ),
    "kpi11_pace_histogram": sql(
        'SELECT year, milliseconds // 10000 * 10000 AS bin, count(*) AS "rows" FROM laps GROUP BY ALL', "laps"
    ),
    "kpi11_lap_progression": sql(
        """SELECT raceId, lap, round(a, 6) AS average, round(avg(a) OVER (PARTITION BY raceId ORDER BY lap
          ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS smoothed
        FROM (SELECT raceId, lap, avg(milliseconds) AS a FROM laps GROUP BY ALL)""",
        "laps",
    ),
    "kpi12_gains_by_stops": sql(
        """SELECT coalesce(n, 0) AS total_pit_stops, count(*) AS results, count(position_change) AS finished,
        round(avg(position_change), 6) AS average_change
        FROM qvr LEFT JOIN (SELECT raceId, driverId, count(*) AS n FROM pit_stops GROUP BY ALL) p
        ON qvr.raceId = p.raceId AND qvr.driverId = p.driverId GROUP BY 1""",
        "qvr",
        "pit_stops",
    ),
}
