"""Binds the given benchmark tables to the racing tables.

=============  ==================================================================================
races          orders: key, year and month of the order date, text columns for the cleaning rules
drivers        supplier with its nation
constructors   brands of part
circuits       nation with its region
results        lineitem with the brand and size of its part
qualifying     lineitem ranked per order by price
lap_times      events numbered per user and day
pit_stops      purchase events of lap_times, numbered per user and day
=============  ==================================================================================

Every table grows with the given ones. No broadcast is forced: Spark decides by size at run time.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapwise.operators.running import row_numbers, running_totals
from lapwise.schemas import GIVEN


class Binding:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def given(self, name: str) -> DataFrame:
        return self.spark.read.schema(GIVEN[name]).parquet(f"{self.folder}/{name}.parquet")

    def raw_races(self) -> DataFrame:
        """Races as read from text: untrimmed names, dates and times as strings, some times missing."""
        known = enumerate(["Monaco", "Singapore", "Baku", "Melbourne", "Belgium"])
        place = F.coalesce(*[F.when(F.col("circuitId") == i, name) for i, name in known], F.col("o_orderpriority"))
        clock = F.format_string(
            "%02d:%02d:%02d", F.col("o_custkey") % 24, F.col("raceId") % 60, F.floor(F.col("raceId") / 60) % 60
        )
        return (
            self.given("orders")
            .withColumn("raceId", F.col("o_orderkey"))
            .withColumn("circuitId", (F.col("o_custkey") % 25).cast("int"))
            .select(
                "raceId",
                F.year("o_orderdate").alias("year"),
                F.month("o_orderdate").alias("round"),
                F.concat(F.lit("  "), place, F.lit(" Grand Prix ")).alias("name"),
                F.concat(F.lit(" "), F.col("circuitId").cast("string"), F.lit(" ")).alias("circuitId"),
                F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                F.when(F.col("o_orderstatus") != "P", clock).alias("time"),
            )
        )

    def races(self) -> DataFrame:
        return self.given("orders").select(
            F.col("o_orderkey").alias("raceId"),
            F.year("o_orderdate").alias("year"),
            F.month("o_orderdate").alias("round"),
            F.col("o_orderpriority").alias("name"),
            (F.col("o_custkey") % 25).cast("int").alias("circuitId"),
            F.to_date("o_orderdate").alias("date"),
        )

    def raw_drivers(self) -> DataFrame:
        nation = self.given("nation").select("n_nationkey", "n_name")
        born = F.date_add(F.lit("1960-01-01").cast("date"), (F.col("s_suppkey") * 37 % 16000).cast("int"))
        return (
            self.given("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("driverId"),
                F.concat(F.lit(" "), F.split_part("s_name", F.lit("#"), F.lit(1))).alias("forename"),
                F.concat(F.split_part("s_name", F.lit("#"), F.lit(2)), F.lit(" ")).alias("surname"),
                F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("nationality"),
                F.concat(F.lit(" d"), F.col("s_suppkey").cast("string"), F.lit("x ")).alias("code"),
                F.date_format(born, "yyyy-MM-dd").alias("dob"),
            )
        )

    def drivers(self) -> DataFrame:
        nation = self.given("nation").select("n_nationkey", "n_name")
        return (
            self.given("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("driverId"),
                F.split_part("s_name", F.lit("#"), F.lit(1)).alias("forename"),
                F.split_part("s_name", F.lit("#"), F.lit(2)).alias("surname"),
                F.col("n_name").alias("nationality"),
            )
        )

    def constructors(self) -> DataFrame:
        """Brands with their first type; the few pairs are made distinct by hash before the text minimum sorts."""
        return (
            self.given("part")
            .select("p_brand", "p_type")
            .distinct()
            .groupBy(F.col("p_brand").alias("constructorId"))
            .agg(F.min("p_type").alias("constructorNationality"))
            .select("constructorId", F.col("constructorId").alias("constructorName"), "constructorNationality")
        )

    def circuits(self) -> DataFrame:
        """Circuits with one country per region and coordinates that leave the valid range at both ends."""
        country = (
            F.when(F.col("r_name") == "EUROPE", "Italy")
            .when(F.col("r_name") == "AMERICA", "Brazil")
            .when(F.col("r_name") == "ASIA", "Japan")
            .when(F.col("r_name") == "MIDDLE EAST", "UAE")
            .otherwise(F.col("n_name"))
        )
        region = self.given("region")
        return (
            self.given("nation")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").alias("circuitId"),
                F.concat(F.lit(" "), F.col("n_name")).alias("name"),
                F.concat(F.col("r_name"), F.lit(" ")).alias("location"),
                F.concat(F.lit(" "), country).alias("country"),
                (F.col("n_nationkey") * 8.0 - 96.0).alias("lat"),
                (F.col("n_nationkey") * 16.0 - 190.0).alias("lng"),
            )
        )

    def results(self) -> DataFrame:
        """One row per lineitem; a returned line has no position and the text ``R``."""
        place = F.col("l_linenumber").cast("string")
        out = F.col("l_returnflag") == "R"
        part = self.given("part").select("p_partkey", "p_brand", "p_size")
        return (
            self.given("lineitem")
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("l_orderkey").alias("raceId"),
                F.col("l_suppkey").alias("driverId"),
                F.col("p_brand").alias("constructorId"),
                F.when(out, F.lit("\\N")).otherwise(place).alias("position"),
                F.when(out, F.lit("R")).otherwise(place).alias("positionText"),
                F.col("l_linenumber").alias("positionOrder"),
                F.col("l_quantity").alias("points"),
                F.col("p_size").alias("laps"),
                F.round(F.col("l_discount") * 100).cast("int").alias("fastestLap"),
            )
        )

    @cached_property
    def _ranked_lines(self) -> DataFrame:
        """Grid position by price; the lines of an order are few."""
        lines = self.given("lineitem").select(
            F.col("l_orderkey").alias("raceId"),
            F.col("l_suppkey").alias("driverId"),
            "l_extendedprice",
            "l_partkey",
            "l_linenumber",
        )
        order = [F.desc("l_extendedprice"), F.asc("l_partkey"), F.asc("driverId"), F.asc("l_linenumber")]
        return lines.withColumn("position", F.row_number().over(Window.partitionBy("raceId").orderBy(*order)))

    def qualifying(self) -> DataFrame:
        return self._ranked_lines.select("raceId", "driverId", F.col("position").cast("int").alias("position"))

    @cached_property
    def _events(self) -> DataFrame:
        return self.given("events").select(
            F.datediff(F.col("ts").cast("date"), F.lit("2023-12-31").cast("date")).cast("long").alias("raceId"),
            F.col("user_id").alias("driverId"),
            F.year("ts").alias("year"),
            F.round(F.col("value") * 1000).cast("long").alias("milliseconds"),
            (F.col("event_type") == "purchase").alias("in_pit"),
            "ts",
            "event_id",
        )

    @cached_property
    def _numbered_events(self) -> DataFrame:
        # Nothing bounds the events of a user on a day, so they are numbered minute by minute.
        totals = {"lap": F.lit(1).cast("long"), "stop": F.col("in_pit").cast("long")}
        splits = [F.hour("ts"), F.minute("ts")]
        return running_totals(self._events, ["raceId", "driverId"], [F.asc("ts"), F.asc("event_id")], totals, splits)

    def unnumbered_laps(self) -> DataFrame:
        """Laps for sums and counts over them, which read no number: ``lap`` is 1 in every row."""
        return self._events.select("raceId", "driverId", "year", F.lit(1).alias("lap"), "milliseconds")

    def stops_alone(self) -> DataFrame:
        """Pit stops without the lap they were made in, so only stops are numbered."""
        splits = [F.hour("ts"), F.minute("ts")]
        stops = row_numbers(
            self._events.filter("in_pit"), ["raceId", "driverId"], [F.asc("ts"), F.asc("event_id")], "stop", splits
        )
        return stops.select("raceId", "driverId", F.col("stop").cast("int").alias("stop"), "milliseconds")

    def lap_times(self) -> DataFrame:
        return self._numbered_events.select(
            "raceId", "driverId", "year", F.col("lap").cast("int").alias("lap"), "milliseconds"
        )

    def timed_laps(self) -> DataFrame:
        """Laps with the time they ended."""
        return self._numbered_events.select(
            "driverId", "raceId", F.col("lap").cast("int").alias("lap"), "milliseconds", F.col("ts").alias("at")
        )

    def pit_stops(self) -> DataFrame:
        return (
            self._numbered_events
            .filter("in_pit")
            .select(
                "raceId",
                "driverId",
                F.col("stop").cast("int").alias("stop"),
                F.col("lap").cast("int").alias("lap"),
                "milliseconds",
            )
        )

    def laps_with_stops(self) -> DataFrame:
        """Laps together with the number of stops made so far, from one pass over the events."""
        return self._numbered_events.select(
            "raceId", "driverId", "year", F.col("lap").cast("int").alias("lap"), "milliseconds", "in_pit", "stop"
        )
