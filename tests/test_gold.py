"""Gold builders on small fixtures and invariants on the given data."""

import pytest
from pyspark.sql import functions as F

from lapwise.plans import gold, kpis, reports, silver
from lapwise.queries import gold as registered
from lapwise.sources.binding import Binding

FOLDER = "/root/testdata/sf0.001"

FACTS = (
    "raceId INT, driverId INT, constructorId INT, year INT, position INT, points DOUBLE, finished_race BOOLEAN, "
    "podium_finish BOOLEAN, dnf_status BOOLEAN, fastestLap INT"
)


def fact(race, driver, team, year, position, points, dnf=False, fastest=None):
    done = position is not None and not dnf
    return (race, driver, team, year, position, points, done, position in (1, 2, 3), dnf, fastest)


@pytest.fixture
def league(rows):
    drivers = rows(
        "driverId INT, forename STRING, surname STRING, nationality STRING",
        *[(i, f"f{i}", f"s{i}", "n") for i in range(1, 6)],
    )
    teams = rows(
        "constructorId INT, constructorName STRING, constructorNationality STRING", (1, "red", "x"), (2, "blue", "y")
    )
    facts = rows(
        FACTS,
        fact(1, 1, 1, 2000, 1, 25.0, fastest=1), fact(2, 1, 2, 2000, 3, 15.0), fact(3, 1, 1, 2000, 2, 18.0),
        fact(1, 2, 2, 2000, 4, 12.0),
        fact(1, 3, 2, 2000, None, 0.0, dnf=True), fact(2, 3, 2, 2000, None, 0.0, dnf=True),
        fact(1, 4, 1, 2000, 2, 33.0),
        fact(1, 9, 1, 2000, 5, 99.0),
    )
    return facts, drivers, teams


def test_driver_statistics(league):
    facts, drivers, teams = league
    stats = gold.driver_statistics(gold.season_partials(facts), drivers, teams)
    got = {(r["driverId"], r["constructorId"]): r for r in stats.collect()}
    assert sorted(got) == [(1, 1), (1, 2), (2, 2), (3, 2), (4, 1)]
    two = got[(1, 1)]
    assert (two["total_races"], two["total_wins"], two["total_podiums"], two["total_points"]) == (2, 1, 2, 43.0)
    assert two["average_finish_position"] == 1.5
    assert two["position_stddev"] == pytest.approx(0.5**0.5)
    assert two["consistency_score"] == pytest.approx(1 - 0.5**0.5 / 1.5)
    assert (two["fastest_laps"], two["win_rate"], two["career_worst_position"]) == (1, 0.5, 2)
    one = got[(2, 2)]
    assert one["position_stddev"] is None and one["consistency_score"] == 0.0
    out = got[(3, 2)]
    assert out["average_finish_position"] is None and out["dnf_rate"] == 1.0 and out["finish_rate"] == 0.0


def test_rankings_count_known_drivers_only(league, values):
    facts, drivers, teams = league
    ranked = gold.constructor_rankings(gold.season_partials(facts), drivers, teams)
    got = values(ranked, "constructorName", "total_races", "driver_count", "total_points", "dominance_score")
    assert got == [("blue", 4, 3, 27.0, (18 + 27) / 4), ("red", 3, 2, 76.0, (25 + 18 * 3 + 76) / 3)]


def test_standings_ties_gaps_and_status(rows, values):
    seasons = rows(
        "driverId INT, forename STRING, surname STRING, nationality STRING, year INT, total_points DOUBLE, "
        "total_wins LONG, total_podiums LONG, total_races LONG, win_rate DOUBLE, podium_rate DOUBLE, "
        "consistency_score DOUBLE",
        *[
            (d, "f", "s", "n", y, p, w, 0, 1, 0.0, 0.0, 0.0)
            for d, y, p, w in [
                (1, 2000, 100.0, 1), (2, 2000, 100.0, 2), (3, 2000, 75.0, 0), (4, 2000, 74.0, 0), (5, 2000, 50.0, 0),
                (6, 2000, 49.0, 0), (8, 2001, 10.0, 0), (7, 2001, 10.0, 0),
            ]
        ],
    )
    expected = [
        (1, 2, 0.0, "Contender"), (2, 1, 0.0, "Contender"), (3, 3, -25.0, "Contender"), (4, 4, -26.0, "Dark Horse"),
        (5, 5, -50.0, "Dark Horse"), (6, 6, -51.0, "Out of Contention"), (7, 1, 0.0, "Contender"),
        (8, 2, 0.0, "Contender"),
    ]
    got = gold.championship_standings(seasons)
    assert values(
        got, "driverId", "championship_position", "points_gap_to_leader", "championship_battle_status"
    ) == expected


def test_rolling_consistency(rows):
    stats = rows(
        "driverId INT, constructorId INT, year INT, average_finish_position DOUBLE, total_points DOUBLE",
        (1, 1, 2000, 4.0, 1.0),
        *[(2, 1, 2000 + i, float(i), 10.0) for i in range(5)],
        *[(3, 1, 2000 + i, float(i * 10), 1.0) for i in range(7)],
    )
    got = {(r["driverId"], r["year"]): r for r in gold.driver_consistency(stats).collect()}
    single = got[(1, 2000)]
    assert (single["position_variance"], single["consistency_rating"]) == (None, "Very Inconsistent")
    five = got[(2, 2004)]
    assert (five["rolling_average_position"], five["rolling_points"], five["position_variance"]) == (2.0, 50.0, 2.5)
    assert (five["consistency_rating"], five["form_trend"]) == ("Consistent", "Good Form")
    seven = got[(3, 2006)]
    assert (seven["rolling_average_position"], seven["form_trend"]) == (40.0, "Poor Form")


def test_qualifying_vs_race_changes(rows, values):
    qualifying = rows(
        "raceId INT, driverId INT, position INT", (1, 1, 5), (1, 2, 2), (1, 3, 3), (1, 4, 11), (1, 4, 12)
    )
    performance = rows(
        "raceId INT, driverId INT, year INT, constructorId INT, position INT, forename STRING, surname STRING, "
        "nationality STRING, constructorName STRING, constructorNationality STRING",
        *[(1, d, 2000, 1, p, "f", "s", "n", "c", "cn") for d, p in [(1, 2), (2, 6), (3, 3), (4, None)]],
    )
    got = values(
        gold.qualifying_vs_race(qualifying, performance),
        "driverId", "position_change", "overtakes_made", "positions_lost", "qualifying_performance_score",
    )
    assert got == [(1, 3, 3, 0, 5), (2, -4, 0, 4, 10), (3, 0, 0, 0, 10), (4, None, 0, 0, 1)]


def test_laps_compare_as_numbers(rows):
    laps = rows("raceId INT, driverId INT, lap INT, milliseconds LONG", (1, 1, 1, 9), (1, 1, 2, 57), (1, 1, 10, 101))
    races = rows("raceId INT, year INT", (1, 2000))
    teams = rows("raceId INT, driverId INT, constructorId INT", (1, 1, 7))
    row = gold.lap_time_trends(laps, races, teams).first()
    assert (row["fastest_lap_time"], row["slowest_lap_time"], row["total_laps"], row["constructorId"]) == (9, 101, 3, 7)
    performance = rows(
        "raceId INT, year INT, driverId INT, constructorId INT, position INT", (1, 2000, 1, 7, 1), (2, 2000, 1, 7, 2)
    )
    pace = {r["raceId"]: r for r in gold.race_pace_analysis(performance, laps).collect()}
    assert pace[1]["total_race_laps"] == 10 and pace[2]["race_finish_time"] is None


def test_undercut_equals_pairs(spark):
    stops = spark.range(400).select(
        (F.col("id") % 3).alias("raceId"), F.col("id").alias("driverId"), (F.col("id") % 2).alias("stop"),
        (F.col("id") * 7 % 13).alias("lap"),
    )
    places = stops.select("raceId", "driverId", (F.col("driverId") * 11 % 50 + 1).cast("int").alias("position"))
    rows = [r.asDict() for r in stops.join(places, ["raceId", "driverId"]).collect()]
    expected = {}
    for a in rows:
        later = [b for b in rows if (b["raceId"], b["stop"]) == (a["raceId"], a["stop"]) and b["lap"] > a["lap"]]
        if later:
            expected[a["driverId"]] = (len(later), sum(b["position"] > a["position"] for b in later))
    got = {r["driverId"]: (r["rivals"], r["beaten"]) for r in kpis.undercut_efficiency(stops, places).collect()}
    assert got == expected


def test_tyre_age_restarts_at_stops(rows, values):
    laps = rows("raceId INT, driverId INT, lap INT, milliseconds LONG", *[(1, 1, i, 100) for i in range(1, 7)])
    stops = rows("raceId INT, driverId INT, stop INT, lap INT", (1, 1, 1, 3), (1, 1, 2, 6))
    expected = [(1, 0, 1), (2, 0, 2), (3, 1, 1), (4, 1, 2), (5, 1, 3), (6, 2, 1)]
    assert values(kpis.with_tyre_age(laps, stops), "lap", "stint", "tyre_age") == expected


def test_invariants_on_given_data(spark):
    b = Binding(spark, FOLDER)
    stats = registered.statistics(b)
    assert stats.filter("total_wins > total_races OR total_podiums < total_wins").isEmpty()
    assert stats.agg(F.sum("total_races")).first()[0] == b.results().count()
    leaders = registered.standings(b).filter("championship_position = 1").groupBy("year").count()
    assert leaders.filter("count <> 1").isEmpty()
    share = reports.points_share(registered.rankings(b)).agg(F.sum("points_share")).first()[0]
    assert share == pytest.approx(1.0)


def test_season_aggregation_shuffles_facts_once(spark):
    b = Binding(spark, FOLDER)
    partials = gold.season_partials(silver.race_facts(b.results(), b.races()))
    plan = partials._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "PushedFilters: [IsNotNull(l_orderkey)" in plan
    assert "l_shipdate" not in plan and "l_extendedprice" not in plan
