"""The one-season variant: enrich results, then totals of the last season only. Column names are lower case."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise import constants as C
from lapwise.functions import clean
from lapwise.functions import metrics as M
from lapwise.plans.reports import latest
from lapwise.sinks.writers import write_table
from lapwise.sources.readers import read_csv_or_json, read_table


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def enriched_results(results: DataFrame, races: DataFrame, constructors: DataFrame) -> DataFrame:
    race = lower_names(races).select("raceid", "year", "name", "date")
    team = (
        lower_names(constructors)
        .withColumnRenamed("name", "constructor_name")
        .select("constructorid", "constructor_name", "nationality")
    )
    last_podium = C.PODIUM_PLACES[-1]
    return (
        lower_names(results)
        .join(race, "raceid")
        .join(team, "constructorid")
        .withColumns(
            {
                "podium_finish": F.col("positionorder").try_cast("int") <= last_podium,
                "points": clean.number_or_zero(F.col("points")),
            }
        )
    )


def last_season_drivers(enriched: DataFrame, drivers: DataFrame) -> DataFrame:
    totals = latest(enriched).groupBy("driverid", "year").agg(
        F.sum("points").alias("total_points"),
        F.count("raceid").alias("total_races"),
        M.count_where(F.col("podium_finish")).alias("total_podiums"),
        M.count_where(F.col("positionorder") == 1).alias("total_wins"),
    )
    return (
        totals.withColumn("win_rate", M.ratio(F.col("total_wins"), F.col("total_races")))
        .join(lower_names(drivers).select("driverid", "surname"), "driverid")
        .orderBy(F.desc("total_points"), "driverid")
    )


def wins_filled(enriched: DataFrame) -> DataFrame:
    """Race counts with wins joined from their own aggregate; drivers without a win get 0."""
    wins = enriched.filter("positionorder = 1").groupBy("driverid").agg(F.count(F.lit(1)).alias("total_wins"))
    races = enriched.groupBy("driverid").agg(F.count("raceid").alias("total_races"))
    return races.join(wins, "driverid", "left").na.fill(0, ["total_wins"])


def last_season_constructors(enriched: DataFrame) -> DataFrame:
    """``total_races`` counts distinct races here, unlike the ranking table, which counts result rows."""
    return (
        latest(enriched)
        .groupBy(F.col("constructor_name").alias("constructorName"), "year")
        .agg(
            F.sum("points").alias("total_points"),
            F.count_distinct("raceid").alias("total_races"),
            M.count_where(F.col("positionorder") == 1).alias("total_wins"),
        )
        .withColumn("team_win_rate", M.ratio(F.col("total_wins"), F.col("total_races")))
    )


def run(spark: SparkSession, raw_base: str, out_base: str) -> None:
    """Raw files (CSV, else JSON) to four Parquet tables: drivers, performance and the two last-season tables.

    The season tables read the stored performance table, so the joins run once.
    """
    raw = {n: read_csv_or_json(spark, f"{raw_base}/{n}") for n in ["drivers", "results", "races", "constructors"]}
    names = [F.col("forename"), F.col("surname")]
    typed = enriched_results(raw["results"], raw["races"], raw["constructors"]).withColumns(
        {"year": F.col("year").cast("int"), "positionorder": F.col("positionorder").try_cast("int")}
    )
    write_table(raw["drivers"].withColumn("full_name", clean.full_name(*names)), f"{out_base}/silver/drivers")
    write_table(typed, f"{out_base}/silver/performance", cluster_by=["raceid", "driverid"])
    stored = read_table(spark, f"{out_base}/silver/performance")
    drivers = read_table(spark, f"{out_base}/silver/drivers")
    last_season_drivers(stored, drivers).write.mode("overwrite").parquet(f"{out_base}/gold/driver_statistics")
    last_season_constructors(stored).write.mode("overwrite").parquet(f"{out_base}/gold/constructor_rankings")
