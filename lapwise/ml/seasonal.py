"""Seasonal regression per series: trend, yearly Fourier terms and prediction intervals from sums alone.

The model is linear in 1, the time in years and sine and cosine of ``ORDER`` yearly waves. Its normal equations are sums over
the weeks of a series, so they merge and a series may hold any share of the rows. The equations, a few unknowns per
series, are solved by Cholesky factors written as column expressions. A term that the weeks of a series cannot tell apart from
those before it gets no weight. Solved and fitted rows are stored before anything is asked of them: a filter that is moved
below such a chain of columns would write the whole chain out many times. The interval of a week to come is yhat -+ quantile * s * sqrt(1 + leverage).

A week without rows is no observation. A series with fewer weeks than terms plus one has no interval (null).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.operators.staging import stage

ORDER = 2
WEEKS_PER_YEAR = 365.25 / 7
# Normal quantile of a two-sided interval of 90 %.
QUANTILE = 1.6448536269514722
# A pivot below this share of its own sum of squares means a dependent term.
DEPENDENT = 1e-9


def terms(time: Column, order: int = ORDER) -> list[Column]:
    """The inputs at a time in years."""
    waves = [wave(2 * math.pi * k * time) for k in range(1, order + 1) for wave in (F.sin, F.cos)]
    return [F.lit(1.0), time, *waves]


def weekly(history: DataFrame, key: str) -> DataFrame:
    """Sums of ``y`` per series and week with the time in years since the series' first week."""
    week = F.date_trunc("week", "ds").cast("date")
    sums = history.groupBy(key, week.alias("ds")).agg(F.sum("y").cast("double").alias("y")).filter("y IS NOT NULL")
    first = sums.groupBy(key).agg(F.min("ds").alias("_first"))
    return sums.join(first, key).withColumn("_time", _years(F.col("ds"), F.col("_first")))


def _years(day: Column, first: Column) -> Column:
    return F.datediff(day, first) / 7 / WEEKS_PER_YEAR


def equations(weeks: DataFrame, key: str, order: int = ORDER) -> DataFrame:
    """The normal equations of each series: one row of mergeable sums."""
    x, y = terms(F.col("_time"), order), F.col("y")
    n = len(x)
    return weeks.groupBy(key).agg(
        F.count(F.lit(1)).alias("weeks"), F.min("_first").alias("_first"), F.max("ds").alias("_last"), F.sum(y * y).alias("_yy"),
        *[F.sum(x[i] * x[j]).alias(f"_a{i}_{j}") for i in range(n) for j in range(i + 1)],
        *[F.sum(x[i] * y).alias(f"_b{i}") for i in range(n)],
    )


def solved(sums: DataFrame, order: int = ORDER) -> DataFrame:
    """Adds the factors ``_l{i}_{j}``, the coefficients ``c{i}`` and the residual deviation ``sigma``."""
    n = 2 + 2 * order
    df = sums
    for j in range(n):
        left = F.col(f"_a{j}_{j}")
        for k in range(j):
            left = left - F.col(f"_l{j}_{k}") * F.col(f"_l{j}_{k}")
        independent = left > DEPENDENT * F.col(f"_a{j}_{j}")
        df = df.withColumn(f"_l{j}_{j}", F.when(independent, F.sqrt(left)))
        below = {}
        for i in range(j + 1, n):
            value = F.col(f"_a{i}_{j}")
            for k in range(j):
                value = value - F.col(f"_l{i}_{k}") * F.col(f"_l{j}_{k}")
            below[f"_l{i}_{j}"] = F.coalesce(value / F.col(f"_l{j}_{j}"), F.lit(0.0))
        df = df.withColumns(below) if below else df
    for i in range(n):
        value = F.col(f"_b{i}")
        for k in range(i):
            value = value - F.col(f"_l{i}_{k}") * F.col(f"_z{k}")
        df = df.withColumn(f"_z{i}", F.coalesce(value / F.col(f"_l{i}_{i}"), F.lit(0.0)))
    for i in range(n - 1, -1, -1):
        value = F.col(f"_z{i}")
        for k in range(i + 1, n):
            value = value - F.col(f"_l{k}_{i}") * F.col(f"c{k}")
        df = df.withColumn(f"c{i}", F.coalesce(value / F.col(f"_l{i}_{i}"), F.lit(0.0)))
    explained, used = F.lit(0.0), F.lit(0)
    for i in range(n):
        explained = explained + F.col(f"_z{i}") * F.col(f"_z{i}")
        used = used + F.col(f"_l{i}_{i}").isNotNull().cast("int")
    rest = F.greatest(F.lit(0.0), F.col("_yy") - explained)
    return df.withColumn("sigma", F.when(F.col("weeks") > used, F.sqrt(rest / (F.col("weeks") - used))))


def fitted(times: DataFrame, order: int = ORDER, quantile: float = QUANTILE) -> DataFrame:
    """Adds yhat, lower and upper to rows that have a solved series and a ``_time``."""
    x = terms(F.col("_time"), order)
    df = times
    yhat, leverage = F.lit(0.0), F.lit(0.0)
    for i, value in enumerate(x):
        yhat = yhat + F.col(f"c{i}") * value
        for k in range(i):
            value = value - F.col(f"_l{i}_{k}") * F.col(f"_v{k}")
        df = df.withColumn(f"_v{i}", F.coalesce(value / F.col(f"_l{i}_{i}"), F.lit(0.0)))
        leverage = leverage + F.col(f"_v{i}") * F.col(f"_v{i}")
    reach = quantile * F.col("sigma") * F.sqrt(1 + leverage)
    return df.withColumn("yhat", yhat).withColumns({"lower": F.col("yhat") - reach, "upper": F.col("yhat") + reach})


def forecast(history: DataFrame, key: str, periods: int = 10, order: int = ORDER) -> DataFrame:
    """The ``periods`` weeks after the last one of every series: key, ds, yhat, lower, upper (90 %)."""
    models = stage(solved(equations(weekly(history, key), key, order), order))
    ahead = F.sequence(F.date_add("_last", 7), F.date_add("_last", 7 * periods), F.expr("INTERVAL 7 DAYS"))
    future = models.withColumn("ds", F.explode(ahead)).withColumn("_time", _years(F.col("ds"), F.col("_first")))
    return fitted(future, order).select(key, "ds", "yhat", "lower", "upper")


def coverage(history: DataFrame, key: str, held_out: int = 10, order: int = ORDER) -> DataFrame:
    """Back test: the last weeks of every series against a model of the weeks before; rows and how many the interval holds."""
    weeks = weekly(history, key)
    last = weeks.groupBy(key).agg(F.max("ds").alias("_end"))
    dated = weeks.join(last, key).withColumn("_late", F.col("ds") > F.date_sub("_end", 7 * held_out))
    models = stage(solved(equations(dated.filter("NOT _late"), key, order), order)).drop("_first")
    told = stage(fitted(dated.filter("_late").join(models, key), order))
    return told.filter("lower IS NOT NULL").groupBy(key).agg(
        F.count(F.lit(1)).alias("weeks"), F.count_if(F.col("y").between(F.col("lower"), F.col("upper"))).alias("held")
    )


def imbalance(history: DataFrame, key: str, order: int = ORDER) -> DataFrame:
    """Per series the weeks, and the largest sum of residuals times an input, relative to the sum of absolute values.

    Both are what least squares makes zero.
    """
    weeks = weekly(history, key)
    models = stage(solved(equations(weeks, key, order), order)).drop("_first", "weeks")
    told = stage(fitted(weeks.join(models, key), order))
    x = terms(F.col("_time"), order)
    sums = [F.abs(F.sum((F.col("y") - F.col("yhat")) * value)) for value in x]
    return told.groupBy(key).agg(
        F.count(F.lit(1)).alias("weeks"), (F.greatest(*sums) / F.greatest(F.sum(F.abs("y")), F.lit(1.0))).alias("imbalance")
    )
