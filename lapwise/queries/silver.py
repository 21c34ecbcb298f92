"""Cleaning rules, declared transforms and small joins over the given data."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapwise import constants as C
from lapwise.functions import clean
from lapwise.operators import declarative
from lapwise.plans import reports, season, silver
from lapwise.queries.common import sql
from lapwise.queries.gold import bound, as_text, performance
from lapwise.sources.binding import Binding

RACE_STEPS = [
    {"type": "clean_string", "columns": ["name", "circuitId"]},
    {"type": "standardize_timestamp", "columns": ["date", "time"]},
    {"type": "validate_range", "column": "year", "min_value": C.YEAR_RANGE[0], "max_value": C.YEAR_RANGE[1]},
    {
        "type": "add_derived_columns",
        "columns": [
            {"name": "race_duration_minutes", "expression": "hour(time) * 60 + minute(time) + second(time) / 60.0D"},
            {
                "name": "race_season_phase",
                "expression": "CASE WHEN round <= 5 THEN 'Early' WHEN round <= 15 THEN 'Mid' ELSE 'Late' END",
            },
        ],
    },
]

TEAM_SPEC = {
    "group_by": ["constructorId", "constructorName", "constructorNationality", "year"],
    "metrics": [
        {"name": "total_races", "function": "count", "column": "raceId"},
        {
            "name": "total_wins", "function": "sum", "column": "podium_finish", "boolean": True,
            "condition": "position = 1",
        },
        {"name": "total_podiums", "function": "sum", "column": "podium_finish", "boolean": True},
        {"name": "total_points", "function": "sum", "column": "points"},
        {"name": "driver_count", "function": "count_distinct", "column": "driverId"},
        {"name": "average_team_position", "function": "avg", "column": "position", "filter": "finished_race = true"},
    ],
    "derived_metrics": [
        {"name": "team_win_rate", "expression": "total_wins / total_races"},
        {"name": "team_podium_rate", "expression": "total_podiums / total_races"},
        {"name": "points_per_race", "expression": "total_points / total_races"},
        {
            "name": "dominance_score",
            "expression": "(total_wins * 25 + total_podiums * 18 + total_points) / total_races",
        },
    ],
}


def _races_out(df):
    return as_text(df, "date", "time").withColumn("race_duration_minutes", F.round("race_duration_minutes", 6))


def _mixed_dates(b: Binding):
    """The order date written in one of four formats, or as no date at all, then read back."""
    written = b.given("orders").select(
        F.col("o_orderkey").alias("raceId"),
        F.when(F.col("o_orderkey") % 5 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderkey") % 5 == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(F.col("o_orderkey") % 5 == 2, F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(F.col("o_orderkey") % 5 == 3, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise("unknown")
        .alias("text"),
    )
    parsed = clean.any_format_timestamp(F.col("text"))
    return written.select("raceId", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


def _enriched(b: Binding):
    teams = b.constructors().select(
        "constructorId", F.col("constructorName").alias("name"), F.col("constructorNationality").alias("nationality")
    )
    return season.enriched_results(b.results(), b.races(), teams)


QUERIES = {
    "prj1_silver_races": bound(lambda b: _races_out(silver.races(b.raw_races()))),
    "prj3_silver_drivers": bound(lambda b: as_text(silver.drivers(b.raw_drivers()), "dob")),
    "prj4_title_case_names": bound(
        lambda b: silver.constructors(
            b.constructors().select(
                "constructorId",
                F.concat(F.lit(" "), F.lower("constructorNationality"), F.lit(" team ")).alias("name"),
                F.concat(F.lit(" "), "constructorNationality").alias("nationality"),
            ),
            title_case=True,
        )
    ),
    "prj7_mixed_date_formats": bound(_mixed_dates),
    "prj9_season_phases": bound(
        lambda b: silver.races(b.raw_races())
        .groupBy("year", "race_season_phase")
        .agg(F.count(F.lit(1)).alias("races"), F.count("time").alias("timed"))
    ),
    "prj13_silver_circuits": bound(lambda b: silver.circuits(b.circuits())),
    "prj15_cleaned_results": bound(lambda b: silver.cleaned_results(b.results()).drop("positionOrder")),
    "prj17_outcome_flags": bound(
        lambda b: silver.cleaned_results(b.results())
        .groupBy("finished_race", "podium_finish", "dnf_status")
        .agg(F.count(F.lit(1)).alias("results"), F.sum("points").alias("points"))
    ),
    "prj19_pit_ranges": bound(
        lambda b: silver.pit_analysis(b.pit_stops(), b.races(), b.drivers()).select(
            "raceId", "driverId", "stop", "milliseconds", "pit_duration_seconds"
        )
    ),
    "prj20_pit_categories": bound(
        lambda b: b.pit_stops()
        .groupBy(clean.pit_category(F.col("milliseconds")).alias("pit_time_category"))
        .agg(F.count(F.lit(1)).alias("stops"), F.sum("milliseconds").alias("milliseconds"))
    ),
    "prj21_year_range": bound(
        lambda b: silver.races(b.raw_races(), C.YEAR_RANGE).groupBy("year").agg(F.count(F.lit(1)).alias("races"))
    ),
    "prj22_declared_transforms": bound(lambda b: _races_out(declarative.transform(b.raw_races(), RACE_STEPS))),
    "prj23_declared_aggregation": bound(lambda b: declarative.aggregate(performance(b), TEAM_SPEC)),
    "prj24_numeric_or_zero": bound(
        lambda b: b.results()
        .withColumn("value", clean.number_or_zero(F.col("position")))
        .groupBy("constructorId")
        .agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("results"))
    ),
    "prj25_latest_season": bound(
        lambda b: reports.latest(b.races()).groupBy("year", "round").agg(F.count(F.lit(1)).alias("races"))
    ),
    "prj26_equality_slice": bound(
        lambda b: reports.sliced(performance(b), year=2000, name="5-LOW")
        .groupBy("driverId", "constructorId")
        .agg(F.sum("points").alias("points"))
    ),
    "prj28_street_circuits": bound(
        lambda b: silver.races(b.raw_races())
        .groupBy("name", F.col("name").rlike(C.STREET_PATTERN).cast("int").alias("is_street_circuit"))
        .agg(F.count(F.lit(1)).alias("races"))
    ),
    "join8_enriched_results": bound(
        lambda b: _enriched(b).select(
            "raceid", "driverid", "constructorid", "constructor_name", "nationality", "year", "name", "points",
            "positionorder", "podium_finish",
        )
    ),
    "join9_wins_filled": bound(lambda b: season.wins_filled(_enriched(b))),
    "agg6_last_season_drivers": bound(lambda b: season.last_season_drivers(_enriched(b), b.drivers())),
    "agg7_last_season_constructors": bound(lambda b: season.last_season_constructors(_enriched(b))),
    "set1_distinct_seasons": bound(lambda b: performance(b).select("year", "name", "constructorId").distinct()),
}

_RACES = """SELECT raceId, year, round, name, circuitId, date,
    CASE WHEN h IS NOT NULL THEN date || ' ' || lpad(CAST(h AS VARCHAR), 2, '0') || ':' ||
      lpad(CAST(m AS VARCHAR), 2, '0') || ':' || lpad(CAST(s AS VARCHAR), 2, '0') END AS time,
    round(h * 60 + m + s / 60.0, 6) AS race_duration_minutes,
    CASE WHEN round <= 5 THEN 'Early' WHEN round <= 15 THEN 'Mid' ELSE 'Late' END AS race_season_phase
    FROM raw_races"""

_CLEANED = """SELECT raceId, driverId, constructorId, position, positionText, points, laps, fastestLap,
    finished_race, podium_finish, dnf_status FROM facts"""

_ENRICHED = """SELECT r.raceId AS raceid, r.driverId AS driverid, r.constructorId AS constructorid,
    c.constructorName AS constructor_name, c.constructorNationality AS nationality, y.year, y.name, r.points,
    r.positionOrder AS positionorder, r.positionOrder <= 3 AS podium_finish
    FROM results r JOIN races y ON r.raceId = y.raceId JOIN constructors c ON r.constructorId = c.constructorId"""

_ENR = ["results", "races", "constructors"]

SQL = {
    "prj1_silver_races": sql(_RACES, "raw_races"),
    "prj3_silver_drivers": sql(
        """SELECT driverId, forename, surname, nationality, 'D' || CAST(driverId AS VARCHAR) || 'X' AS code,
        strftime(dob, '%Y-%m-%d') AS dob, forename || ' ' || surname AS full_name,
        CASE WHEN dob > DATE '2000-01-01' THEN 'Gen Z' WHEN dob > DATE '1980-01-01' THEN 'Millennial'
          ELSE 'Gen X/Boomer' END AS driver_age_group FROM drivers""",
        "drivers",
    ),
    "prj4_title_case_names": sql(
        """SELECT constructorId, upper(constructorNationality[1]) || lower(constructorNationality[2:]) || ' Team' AS name,
        constructorNationality AS nationality FROM constructors""",
        "constructors",
    ),
    "prj7_mixed_date_formats": """SELECT o_orderkey AS raceId,
        CASE WHEN o_orderkey % 5 = 4 THEN NULL
          WHEN o_orderkey % 5 = 2 AND day(o_orderdate) <= 12 THEN
            strftime(make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)), '%Y-%m-%d') || ' 00:00:00'
          WHEN o_orderkey % 5 = 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
          ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' END AS parsed FROM orders""",
    "prj9_season_phases": sql(
        f"SELECT year, race_season_phase, count(*) AS races, count(time) AS timed FROM ({_RACES}) GROUP BY ALL",
        "raw_races",
    ),
    "prj13_silver_circuits": sql(
        "SELECT * FROM circuits WHERE lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180", "circuits"
    ),
    "prj15_cleaned_results": sql(_CLEANED, "facts"),
    "prj17_outcome_flags": sql(
        """SELECT finished_race, podium_finish, dnf_status, count(*) AS results, sum(points) AS points
        FROM facts GROUP BY ALL""",
        "facts",
    ),
    "prj19_pit_ranges": sql(
        "SELECT raceId, driverId, stop, milliseconds, pit_duration_seconds FROM pit_analysis", "pit_analysis"
    ),
    "prj20_pit_categories": sql(
        """SELECT CASE WHEN milliseconds < 20000 THEN 'Fast' WHEN milliseconds < 25000 THEN 'Normal'
          WHEN milliseconds < 30000 THEN 'Slow' ELSE 'Very Slow' END AS pit_time_category, count(*) AS stops,
        CAST(sum(milliseconds) AS BIGINT) AS milliseconds FROM pit_stops GROUP BY 1""",
        "pit_stops",
    ),
    "prj21_year_range": sql(
        "SELECT year, count(*) AS races FROM races WHERE year BETWEEN 1950 AND 2030 GROUP BY year", "races"
    ),
    "prj22_declared_transforms": sql(_RACES, "raw_races"),
    "prj23_declared_aggregation": sql("SELECT * FROM constructor_rankings", "constructor_rankings"),
    "prj24_numeric_or_zero": sql(
        """SELECT constructorId, CAST(sum(coalesce(position, 0)) AS DOUBLE) AS total, count(*) AS results
        FROM results GROUP BY constructorId""",
        "results",
    ),
    "prj25_latest_season": sql(
        """SELECT year, round, count(*) AS races FROM races WHERE year = (SELECT max(year) FROM races)
        GROUP BY year, round""",
        "races",
    ),
    "prj26_equality_slice": sql(
        """SELECT driverId, constructorId, sum(points) AS points FROM performance
        WHERE year = 2000 AND name = '5-LOW' GROUP BY ALL""",
        "performance",
    ),
    "prj28_street_circuits": sql(
        """SELECT name, CAST(regexp_matches(name, '(Monaco|Singapore|Baku|Melbourne)') AS INTEGER) AS is_street_circuit,
        count(*) AS races FROM raw_races GROUP BY ALL""",
        "raw_races",
    ),
    "join8_enriched_results": sql(_ENRICHED, *_ENR),
    "join9_wins_filled": sql(
        "SELECT driverid, count(*) AS total_races, count(*) FILTER (WHERE positionorder = 1) AS total_wins "
        f"FROM ({_ENRICHED}) GROUP BY driverid",
        *_ENR,
    ),
    "agg6_last_season_drivers": sql(
        """SELECT e.driverid, e.year, sum(points) AS total_points, count(*) AS total_races,
        count(*) FILTER (WHERE podium_finish) AS total_podiums, count(*) FILTER (WHERE positionorder = 1) AS total_wins,
        count(*) FILTER (WHERE positionorder = 1) / count(*) AS win_rate, d.surname
        FROM enriched e JOIN drivers d ON e.driverid = d.driverId
        WHERE e.year = (SELECT max(year) FROM enriched) GROUP BY e.driverid, e.year, d.surname""",
        *_ENR,
        "drivers",
        enriched=_ENRICHED,
    ),
    "agg7_last_season_constructors": sql(
        """SELECT constructor_name AS constructorName, year, sum(points) AS total_points,
        count(DISTINCT raceid) AS total_races, count(*) FILTER (WHERE positionorder = 1) AS total_wins,
        count(*) FILTER (WHERE positionorder = 1) / count(DISTINCT raceid) AS team_win_rate
        FROM enriched WHERE year = (SELECT max(year) FROM enriched) GROUP BY constructor_name, year""",
        *_ENR,
        enriched=_ENRICHED,
    ),
    "set1_distinct_seasons": sql("SELECT DISTINCT year, name, constructorId FROM performance", "performance"),
}
