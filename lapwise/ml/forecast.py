"""Rule-based chances and per-series forecasts as column expressions and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.functions.clean import clamp

# Win chance from pole, loss per grid place, bonus in rain, and the step from win to podium and to the interval.
BASE_WIN = 0.45
GRID_STEP = 0.08
RAIN_BONUS = 0.1
PODIUM_STEP = 0.25
INTERVAL = 0.05


def rule_chances(scenarios: DataFrame, rain_drivers: list) -> DataFrame:
    """Chances of each scenario (grid, weather, driver); ``rain_drivers`` get the bonus when it is ``Rainy``."""
    in_form = (F.col("weather") == "Rainy") & F.col("driver").isin(rain_drivers)
    bonus = F.when(in_form, RAIN_BONUS).otherwise(0.0)
    win = clamp(BASE_WIN - (F.col("grid") - 1) * GRID_STEP + bonus, 0.01, 0.99)
    return (
        scenarios.withColumn("win_probability", win)
        .withColumn("podium_probability", F.least(F.lit(0.99), F.col("win_probability") + PODIUM_STEP))
        .withColumns(
            {
                "lower": F.col("win_probability") - INTERVAL,
                "upper": F.col("win_probability") + INTERVAL,
            }
        )
    )


def forecast(history: DataFrame, key: str, periods: int = 10) -> DataFrame:
    """Weekly forecast per series: a straight trend plus the mean residual of the calendar week.

    ``history`` has ``key``, ``ds`` (date) and ``y``. Trend and residuals are mergeable aggregates, so a series
    may hold any share of the rows. A series needs two different dates, or its trend is its mean.
    """
    week = F.date_trunc("week", "ds").cast("date")
    weekly = history.groupBy(key, week.alias("ds")).agg(F.sum("y").cast("double").alias("y"))
    t = F.datediff("ds", F.lit("1970-01-05").cast("date")) / 7
    weekly = weekly.withColumn("t", t)
    trend = weekly.groupBy(key).agg(
        F.coalesce(F.regr_slope("y", "t"), F.lit(0.0)).alias("slope"),
        F.coalesce(F.regr_intercept("y", "t"), F.avg("y")).alias("intercept"),
        F.max("ds").alias("last"),
    )
    fit = F.col("intercept") + F.col("slope") * F.col("t")
    season = (
        weekly.join(trend, key)
        .groupBy(key, F.weekofyear("ds").alias("week"))
        .agg(F.avg(F.col("y") - fit).alias("seasonal"))
    )
    ahead = F.sequence(F.date_add("last", 7), F.date_add("last", 7 * periods), F.expr("INTERVAL 7 DAYS"))
    future = trend.withColumn("ds", F.explode(ahead)).withColumn("t", t).withColumn("week", F.weekofyear("ds"))
    return future.join(season, [key, "week"], "left").select(
        key, "ds", fit.alias("trend"), (fit + F.coalesce("seasonal", F.lit(0.0))).alias("yhat")
    )
