"""Cleaning rules on their edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lapwise import constants as C
from lapwise.functions import clean
from lapwise.operators import declarative
from lapwise.plans import silver


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_races_drop_null_keys_and_clean(rows):
    bronze = rows(
        "raceId INT, year INT, round INT, circuitId STRING, name STRING, date STRING, time STRING",
        (1, 2000, 5, " 7 ", " A ", "2000-05-01", "14:30:30"),
        (2, 2000, 6, "7", "B", "2000-05-01", None),
        (3, 2000, 15, "7", "C", "bad", "14:00:00"),
        (4, 2000, 16, "7", "D", "2000-05-01", "00:00:00"),
        (5, 2000, None, "7", None, None, "\\N"),
        (None, 2000, 1, "7", "E", "2000-05-01", None),
        (6, None, 1, "7", "F", "2000-05-01", None),
    )
    got = {r["raceId"]: r for r in silver.races(bronze).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    assert (got[1]["name"], got[1]["circuitId"], got[1]["date"]) == ("A", "7", dt.date(2000, 5, 1))
    assert got[1]["race_duration_minutes"] == pytest.approx(14 * 60 + 30.5)
    assert got[2]["time"] is None and got[2]["race_duration_minutes"] is None
    assert got[3]["date"] is None and got[3]["time"] is None
    assert got[4]["race_duration_minutes"] == 0
    assert [got[i]["race_season_phase"] for i in (1, 2, 3, 4, 5)] == ["Early", "Mid", "Mid", "Late", "Late"]


def test_year_range(rows):
    bronze = rows(
        "raceId INT, year INT, round INT, circuitId STRING, name STRING, date STRING, time STRING",
        *[(i, y, 1, "1", "x", None, None) for i, y in enumerate([1949, 1950, 2030, 2031])],
    )
    kept = silver.races(bronze, C.YEAR_RANGE)
    assert sorted(r["year"] for r in kept.collect()) == [1950, 2030]


def test_drivers(rows):
    bronze = rows(
        "driverId INT, code STRING, forename STRING, surname STRING, dob STRING, nationality STRING",
        (1, " abc ", " Ann ", "Lee ", "2000-01-01", " X "),
        (2, None, "Bo", None, "2000-01-02", None),
        (3, "z", "C", "D", "1980-01-01", "Y"),
        (4, "z", "C", "D", "1980-01-02", "Y"),
        (5, "z", "C", "D", None, "Y"),
        (None, "z", "C", "D", None, "Y"),
    )
    got = {r["driverId"]: r for r in silver.drivers(bronze).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    assert (got[1]["code"], got[1]["full_name"], got[1]["nationality"]) == ("ABC", "Ann Lee", "X")
    assert got[2]["full_name"] is None
    groups = [got[i]["driver_age_group"] for i in (1, 2, 3, 4, 5)]
    assert groups == ["Millennial", "Gen Z", "Gen X/Boomer", "Millennial", "Gen X/Boomer"]


def test_circuits(rows):
    cases = [
        (1, "Italy", 90.0, 180.0), (2, "USA", -90.0, -180.0), (3, "Japan", 90.1, 0.0), (4, "Japan", 0.0, -180.1),
        (5, "Japan", None, 0.0), (6, " Japan ", 0.0, 0.0), (7, "Nowhere", 0.0, 0.0), (None, "Italy", 0.0, 0.0),
    ]
    bronze = rows(
        "circuitId INT, name STRING, location STRING, country STRING, lat DOUBLE, lng DOUBLE",
        *[(i, " n ", " l ", c, a, b) for i, c, a, b in cases],
    )
    got = {r["circuitId"]: r["circuit_region"] for r in silver.circuits(bronze).collect()}
    assert got == {1: "Europe", 2: "Americas", 6: "Asia-Pacific", 7: "Other"}


def test_constructors_title_case(rows):
    bronze = rows("constructorId INT, name STRING, nationality STRING", (1, " red team ", " X "), (None, "a", "b"))
    assert [tuple(r) for r in silver.constructors(bronze, title_case=True).collect()] == [(1, "Red Team", "X")]


RESULT = (
    "raceId INT, driverId INT, constructorId INT, position STRING, positionText STRING, points STRING, laps STRING, "
    "fastestLap INT"
)


def result(race, position="1", text="1", points="0", laps="1"):
    return (race, 1, 1, position, text, points, laps, None)


def test_result_ranges(rows):
    good = [
        result(1, "1"), result(2, "50"), result(3, "\\N"), result(4, None), result(5, points="50"),
        result(6, points=None), result(7, laps="100"), result(8, laps=None), result(9, points="abc"), result(10, "+5"),
    ]
    bad = [
        result(21, "51"), result(22, "0"), result(23, points="-1"), result(24, points="51"), result(25, laps="0"),
        result(26, laps="101"), (None, 1, 1, "1", "1", "0", "1", None), (27, None, 1, "1", "1", "0", "1", None),
        (28, 1, None, "1", "1", "0", "1", None),
    ]
    got = {r["raceId"]: r for r in silver.cleaned_results(rows(RESULT, *good, *bad)).collect()}
    assert sorted(got) == list(range(1, 11))
    assert [got[i]["position"] for i in (1, 2, 3, 4, 10)] == [1, 50, None, None, None]
    assert got[9]["points"] is None


def test_result_flags(rows):
    cases = [("20", "1"), ("21", "3"), ("R", "4"), ("D", None), ("F", "\\N"), ("W", "2"), (None, None)]
    df = rows(RESULT, *[result(i, p, t) for i, (t, p) in enumerate(cases)])
    got = {r["raceId"]: r for r in silver.cleaned_results(df).collect()}
    assert [got[i]["finished_race"] for i in range(7)] == [True, False, False, False, False, False, False]
    assert [got[i]["podium_finish"] for i in range(7)] == [True, True, False, False, False, True, False]
    assert [got[i]["dnf_status"] for i in range(7)] == [False, False, True, True, True, False, False]


def test_pit_ranges_and_categories(rows, values):
    times = [999, 1000, 19999, 20000, 24999, 25000, 29999, 30000, 300000, 300001, None]
    stops = [(i, 1, 1, ms) for i, ms in enumerate(times)] + [(i, 1, s, 1000) for i, s in ((20, 0), (21, 10), (22, 11))]
    pits = rows("raceId INT, driverId INT, stop INT, milliseconds LONG", *stops)
    races = rows(
        "raceId INT, year INT, round INT, name STRING, circuitId STRING",
        *[(i, 2000, 1, "r", "c") for i in range(30)],
    )
    drivers = rows("driverId INT, forename STRING, surname STRING, nationality STRING", (1, "a", "b", "c"))
    results = rows("raceId INT, driverId INT, constructorId INT", (1, 1, 9), (1, 1, 8))
    got = values(
        silver.pit_analysis(pits, races, drivers, results), "raceId", "pit_time_category", "constructorId"
    )
    assert sorted(got, key=lambda r: r[0]) == [
        (1, "Fast", 8), (2, "Fast", None), (3, "Normal", None), (4, "Normal", None), (5, "Slow", None),
        (6, "Slow", None), (7, "Very Slow", None), (8, "Very Slow", None), (21, "Fast", None),
    ]


def test_any_format_and_number_or_zero(rows):
    df = rows("t STRING", ("2001-02-03",), ("03/02/2001",), ("02/13/2001",), ("2001-02-03 04:05:06",), ("x",), (None,))
    got = column(df, clean.any_format_timestamp(F.col("t")))
    day = dt.datetime(2001, 2, 3)
    assert got == [day, day, dt.datetime(2001, 2, 13), dt.datetime(2001, 2, 3, 4, 5, 6), None, None]
    df = rows("t STRING", ("1.5",), ("\\N",), (None,))
    assert column(df, clean.number_or_zero(F.col("t"))) == [1.5, 0.0, 0.0]


def test_declared_transforms_equal_builder(rows, values):
    bronze = rows(
        "driverId INT, code STRING, forename STRING, surname STRING, dob STRING, nationality STRING",
        (1, " abc ", " Ann ", "Lee ", "2000-01-01", " X "),
        (2, "q", "Bo", None, "1999-05-05", None),
    )
    steps = [
        {"type": "clean_string", "columns": ["forename", "surname", "nationality"]},
        {"type": "standardize_code", "column": "code"},
        {"type": "add_derived_columns", "columns": [{"name": "full_name", "expression": "concat(forename, ' ', surname)"}]},
    ]
    names = ["driverId", "code", "forename", "surname", "nationality", "full_name"]
    assert values(declarative.transform(bronze, steps), *names) == values(silver.drivers(bronze), *names)
    with pytest.raises(ValueError):
        declarative.transform(bronze, [{"type": "guess", "columns": []}])


def test_declared_ranges_and_numbers(rows, values):
    df = rows("a STRING, b STRING", ("1", "5"), ("x", "6"), ("9", "5"))
    steps = [
        {"type": "clean_numeric", "columns": ["a"]},
        {"type": "extract_coordinates", "columns": ["b"]},
        {"type": "validate_range", "columns": [{"name": "a", "min_value": 1, "max_value": 8}]},
        {"type": "standardize_name", "column": "c"},
    ]
    got = declarative.transform(df.withColumn("c", F.lit(" red car ")), steps)
    assert values(got) == [(1.0, 5.0, "Red Car"), (None, 6.0, "Red Car")]


def test_declared_aggregate_rejects_unknown_function(rows):
    spec = {"group_by": ["a"], "metrics": [{"name": "m", "function": "mode", "column": "a"}]}
    with pytest.raises(ValueError):
        declarative.aggregate(rows("a INT", (1,)), spec)
