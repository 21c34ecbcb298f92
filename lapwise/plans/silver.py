"""Silver builders: cleaned dimensions and joined facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise import constants as C
from lapwise.functions import clean


def races(bronze: DataFrame, years: tuple[int, int] | None = None) -> DataFrame:
    """Cleaned races. ``race_duration_minutes`` is the start time of day in minutes; the name is kept.

    ``years`` adds the declared year range.
    """
    kept = bronze.filter("raceId IS NOT NULL AND year IS NOT NULL")
    if years:
        kept = kept.filter(clean.within(F.col("year"), years))
    day = clean.iso_date(F.col("date"))
    typed = kept.withColumns(
        {
            "name": F.trim("name"),
            "circuitId": F.trim("circuitId"),
            "date": day,
            "time": clean.start_timestamp(day, F.col("time")),
        }
    )
    return typed.withColumns(
        {
            "race_duration_minutes": clean.minutes_of_day(F.col("time")),
            "race_season_phase": clean.season_phase(F.col("round")),
        }
    )


def drivers(bronze: DataFrame) -> DataFrame:
    typed = bronze.filter("driverId IS NOT NULL").withColumns(
        {
            "forename": F.trim("forename"),
            "surname": F.trim("surname"),
            "nationality": F.trim("nationality"),
            "code": clean.code(F.col("code")),
            "dob": clean.iso_date(F.col("dob")),
        }
    )
    return typed.withColumns(
        {
            "full_name": clean.full_name(F.col("forename"), F.col("surname")),
            "driver_age_group": clean.age_group(F.col("dob")),
        }
    )


def constructors(bronze: DataFrame, title_case: bool = False) -> DataFrame:
    name = clean.title(F.col("name")) if title_case else F.trim("name")
    return bronze.filter("constructorId IS NOT NULL").withColumns(
        {"name": name, "nationality": F.trim("nationality")}
    )


def circuits(bronze: DataFrame) -> DataFrame:
    located = bronze.filter(
        F.col("circuitId").isNotNull()
        & clean.within(F.col("lat"), C.LATITUDE_RANGE)
        & clean.within(F.col("lng"), C.LONGITUDE_RANGE)
    )
    texts = ["name", "location", "country"]
    return located.withColumns({c: F.trim(c) for c in texts}).withColumn(
        "circuit_region", clean.circuit_region(F.col("country"))
    )


def result_rules() -> dict[str, str]:
    """What a raw result must keep to become a cleaned one, by name."""
    return {
        "keys": " AND ".join(f"{k} IS NOT NULL" for k in C.RESULT_MERGE_KEYS),
        "position": "NOT coalesce(position RLIKE '^[0-9]+$', false) OR " + _fits("position", "INT", C.POSITION_RANGE),
        "points": _fits("points", "DOUBLE", C.POINTS_RANGE),
        "laps": _fits("laps", "INT", C.LAPS_RANGE),
    }


def pit_stop_rules() -> dict[str, str]:
    """The same for pit stops, where a missing value breaks its rule."""
    return {
        "keys": "raceId IS NOT NULL AND driverId IS NOT NULL",
        "stop": "try_cast(stop AS INT) BETWEEN {} AND {}".format(*C.STOP_RANGE),
        "milliseconds": "try_cast(milliseconds AS BIGINT) BETWEEN {} AND {}".format(*C.PIT_MS_RANGE),
    }


def _fits(column: str, kind: str, bounds: tuple) -> str:
    value = f"try_cast({column} AS {kind})"
    return f"({value} IS NULL OR {value} BETWEEN {bounds[0]} AND {bounds[1]})"


def cleaned_results(results: DataFrame) -> DataFrame:
    """Typed, range-checked results with the three outcome flags; no joins, so it can feed aggregations early."""
    typed = results.filter(" AND ".join(f"{k} IS NOT NULL" for k in C.RESULT_MERGE_KEYS)).withColumns(
        {
            "position": clean.whole_number(F.col("position")),
            "points": F.col("points").try_cast("double"),
            "laps": F.col("laps").try_cast("int"),
        }
    )
    return typed.filter(
        clean.whole_within_or_null(F.col("position"), C.POSITION_RANGE)
        & clean.within_or_null(F.col("points"), C.POINTS_RANGE)
        & clean.within_or_null(F.col("laps"), C.LAPS_RANGE)
    ).withColumns(
        {
            "finished_race": clean.flag(F.col("positionText").isin(C.FINISH_TEXTS)),
            "podium_finish": clean.flag(F.col("position").isin(C.PODIUM_PLACES)),
            "dnf_status": clean.flag(F.col("positionText").isin(C.DNF_TEXTS)),
        }
    )


def race_facts(results: DataFrame, races_: DataFrame) -> DataFrame:
    """Cleaned results with the season of their race: what the season tables need, before any dimension."""
    season = races_.select("raceId", "year")
    return cleaned_results(results).join(season, "raceId")


def performance(
    results: DataFrame, races_: DataFrame, drivers_: DataFrame, constructors_: DataFrame
) -> DataFrame:
    """Star join of results with its dimensions, each cut to the columns it adds, so no name is ambiguous.

    The load time of the results, when they have one, stays for freshness checks and incremental loads.
    """
    loaded = [c for c in ["ingestion_timestamp"] if c in results.columns]
    race = races_.select("raceId", "year", "round", "name", "circuitId")
    driver = drivers_.select("driverId", "forename", "surname", "nationality")
    team = constructors_.select("constructorId", "constructorName", "constructorNationality")
    return (
        cleaned_results(results)
        .join(race, "raceId")
        .join(driver, "driverId")
        .join(team, "constructorId")
        .select(
            "raceId", "driverId", "constructorId", "position", "positionText", "points", "laps", "finished_race",
            "podium_finish", "dnf_status", "fastestLap", "year", "round", "name", "circuitId", "forename", "surname",
            "nationality", "constructorName", "constructorNationality", *loaded,
        )
    )


def race_teams(results: DataFrame) -> DataFrame:
    """One constructor per race and driver; the smallest id where a driver has several rows in a race."""
    return results.groupBy("raceId", "driverId").agg(F.min("constructorId").alias("constructorId"))


def pit_analysis(
    pit_stops: DataFrame, races_: DataFrame, drivers_: DataFrame, results: DataFrame | None = None
) -> DataFrame:
    """Valid pit stops with race and driver; with ``results`` also the constructor (null when unknown)."""
    valid = pit_stops.filter("raceId IS NOT NULL AND driverId IS NOT NULL").withColumns(
        {"stop": F.col("stop").try_cast("int"), "milliseconds": F.col("milliseconds").try_cast("long")}
    )
    valid = valid.filter(
        clean.within(F.col("stop"), C.STOP_RANGE) & clean.within(F.col("milliseconds"), C.PIT_MS_RANGE)
    )
    race = races_.select("raceId", "year", "round", "name", "circuitId")
    driver = drivers_.select("driverId", "forename", "surname", "nationality")
    joined = valid.join(race, "raceId").join(driver, "driverId")
    team = []
    if results is not None:
        joined = joined.join(race_teams(results), ["raceId", "driverId"], "left")
        team = ["constructorId"]
    return joined.select(
        "raceId", "driverId", *team, "stop", "milliseconds",
        (F.col("milliseconds") / 1000.0).alias("pit_duration_seconds"),
        clean.pit_category(F.col("milliseconds")).alias("pit_time_category"),
        "year", "round", "name", "circuitId", "forename", "surname", "nationality",
    )
