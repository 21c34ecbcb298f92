"""Explicit schemas of every raw table and the layout of every stored table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


TYPES = {
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _schema(text: str) -> T.StructType:
    """``name TYPE, ...`` without a session, so the module can be imported before one exists."""
    pairs = [field.split() for field in text.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


RAW = {
    "races": _schema("raceId LONG, year INT, round INT, circuitId STRING, name STRING, date STRING, time STRING"),
    "drivers": _schema(
        "driverId LONG, code STRING, forename STRING, surname STRING, dob STRING, nationality STRING"
    ),
    "constructors": _schema("constructorId LONG, name STRING, nationality STRING"),
    "circuits": _schema(
        "circuitId LONG, name STRING, location STRING, country STRING, lat DOUBLE, lng DOUBLE"
    ),
    "results": _schema(
        "resultId LONG, raceId LONG, driverId LONG, constructorId LONG, position STRING, positionText STRING, "
        "positionOrder INT, points STRING, laps STRING, fastestLap INT"
    ),
    "lap_times": _schema("raceId LONG, driverId LONG, lap INT, milliseconds LONG"),
    "pit_stops": _schema("raceId LONG, driverId LONG, stop INT, lap INT, milliseconds LONG"),
    "qualifying": _schema("raceId LONG, driverId LONG, position INT"),
}


@dataclass(frozen=True)
class TableSpec:
    """Where a table comes from and how it is laid out.

    ``cluster_by`` never repeats a ``partition_by`` column: inside one partition such a column is constant.
    """

    name: str
    layer: str
    source_file: str | None = None
    source_format: str | None = None
    partition_by: list[str] = field(default_factory=list)
    cluster_by: list[str] = field(default_factory=list)

    @property
    def full_name(self) -> str:
        return f"{self.layer}.{self.name}"

    def path(self, base: str) -> str:
        return f"{base.rstrip('/')}/{self.layer}/{self.name}"


# Race-level partitions would give one tiny directory per race, so such tables are clustered instead.
BRONZE = [
    TableSpec("races", "bronze", "races.csv", "csv", ["year"], ["raceId"]),
    TableSpec("drivers", "bronze", "drivers.json", "json", [], ["driverId"]),
    TableSpec("constructors", "bronze", "constructors.json", "json", [], ["constructorId"]),
    TableSpec("circuits", "bronze", "circuits.csv", "csv", [], ["circuitId"]),
    TableSpec("results", "bronze", "results.json", "json", [], ["raceId", "resultId"]),
    TableSpec("lap_times", "bronze", "lap_times", "csv", [], ["raceId", "driverId", "lap"]),
    TableSpec("pit_stops", "bronze", "pit_stops.json", "json", [], ["raceId", "driverId", "stop"]),
    TableSpec("qualifying", "bronze", "qualifying", "json", [], ["raceId", "driverId"]),
]

SILVER = [
    TableSpec("races", "silver", partition_by=["year"], cluster_by=["round", "raceId"]),
    TableSpec("drivers", "silver", cluster_by=["nationality", "driverId"]),
    TableSpec("constructors", "silver", cluster_by=["nationality", "constructorId"]),
    TableSpec("circuits", "silver", cluster_by=["country", "circuitId"]),
    TableSpec("performance", "silver", partition_by=["year"], cluster_by=["raceId", "driverId", "constructorId"]),
    TableSpec("pit_analysis", "silver", partition_by=["year"], cluster_by=["raceId", "driverId", "stop"]),
]

GOLD = [
    TableSpec("driver_statistics", "gold", partition_by=["year"], cluster_by=["driverId"]),
    TableSpec("constructor_rankings", "gold", partition_by=["year"], cluster_by=["constructorId"]),
    TableSpec("lap_time_trends", "gold", partition_by=["year"], cluster_by=["raceId", "driverId"]),
    TableSpec("pit_stop_efficiency", "gold", partition_by=["year"], cluster_by=["constructorId", "driverId"]),
    TableSpec("race_pace_analysis", "gold", partition_by=["year"], cluster_by=["raceId", "driverId"]),
    TableSpec("championship_standings", "gold", partition_by=["year"], cluster_by=["championship_position"]),
    TableSpec("qualifying_vs_race", "gold", partition_by=["year"], cluster_by=["raceId", "driverId"]),
    TableSpec("driver_consistency", "gold", partition_by=["year"], cluster_by=["driverId"]),
]

SPECS = {spec.full_name: spec for spec in BRONZE + SILVER + GOLD}

# The given benchmark tables the domain tables are bound to.
GIVEN = {
    "region": _schema("r_regionkey INT, r_name STRING"),
    "nation": _schema("n_nationkey INT, n_name STRING, n_regionkey INT"),
    "customer": _schema(
        "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "supplier": _schema("s_suppkey LONG, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"),
    "part": _schema(
        "p_partkey LONG, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
    ),
    "orders": _schema(
        "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": _schema(
        "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": _schema(
        "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, props STRING"
    ),
}
