"""Transforms and aggregations declared as data.

A transform list is a list of dicts with a ``type``; an aggregation spec names its grouping, its metrics and
expressions over them. Both become ordinary DataFrame calls; conditions and expressions are SQL text that
Spark parses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.functions import clean


def _columns(step: dict) -> list[str]:
    return step["columns"] if "columns" in step else [step["column"]]


def _each(change):
    return lambda df, step: df.withColumns({c: change(F.col(c)) for c in _columns(step)})


def _timestamps(df: DataFrame, step: dict) -> DataFrame:
    """``date`` becomes a date, ``time`` the start built from both; other columns go through the known formats."""
    names = _columns(step)
    changed = {c: clean.any_format_timestamp(F.col(c)) for c in names if c not in ("date", "time")}
    if "date" in names:
        changed["date"] = clean.iso_date(F.col("date"))
    if "time" in names:
        changed["time"] = clean.start_timestamp(clean.iso_date(F.col("date")), F.col("time"))
    return df.withColumns(changed)


def _ranges(df: DataFrame, step: dict) -> DataFrame:
    """Keep rows whose values lie in range; null passes."""
    bounds = step["columns"] if "columns" in step else [{**step, "name": step["column"]}]
    for b in bounds:
        df = df.filter(clean.within_or_null(F.col(b["name"]), (b["min_value"], b["max_value"])))
    return df


def _derived(df: DataFrame, step: dict) -> DataFrame:
    """Expressions run in order, so a later one may use an earlier one."""
    for c in step["columns"]:
        df = df.withColumn(c["name"], F.expr(c["expression"]))
    return df


TRANSFORMS = {
    "clean_string": _each(F.trim),
    "standardize_code": _each(clean.code),
    "standardize_name": _each(clean.title),
    "standardize_timestamp": _timestamps,
    "clean_numeric": _each(lambda c: c.try_cast("double")),
    "extract_coordinates": _each(lambda c: c.try_cast("double")),
    "validate_range": _ranges,
    "add_derived_columns": _derived,
}


def transform(df: DataFrame, steps: list[dict]) -> DataFrame:
    for step in steps:
        if step["type"] not in TRANSFORMS:
            raise ValueError(f"unknown transform {step['type']!r}")
        df = TRANSFORMS[step["type"]](df, step)
    return df


FUNCTIONS = {
    "count": F.count,
    "count_distinct": F.count_distinct,
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "stddev": F.stddev_samp,
    "variance": F.var_samp,
}


def _metric(metric: dict):
    if metric["function"] == "custom":
        return F.expr(metric["expression"]).alias(metric["name"])
    if metric["function"] not in FUNCTIONS:
        raise ValueError(f"unknown function {metric['function']!r}")
    value = F.col(metric["column"])
    if metric.get("boolean"):
        value = value.cast("int")
    test = metric.get("condition") or metric.get("filter")
    if test:
        value = F.when(F.expr(test), value)
    result = FUNCTIONS[metric["function"]](value)
    if metric["function"] == "sum":
        result = F.coalesce(result, F.lit(0))
    return result.alias(metric["name"])


def aggregate(df: DataFrame, spec: dict) -> DataFrame:
    """``spec``: ``group_by``, ``metrics`` (name, function, column, condition or filter) and ``derived_metrics``."""
    result = df.groupBy(*spec["group_by"]).agg(*[_metric(m) for m in spec["metrics"]])
    for d in spec.get("derived_metrics", []):
        result = result.withColumn(d["name"], F.expr(d["expression"]))
    return result
