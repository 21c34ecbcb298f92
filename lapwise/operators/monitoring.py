"""Run and table monitoring over ledger tables.

Two ledgers hold one row per run and one row per table write. Every report is an aggregation over them, with the
clock as a parameter.

* runs: run_id, run_name, started, ended, status, rows_processed, seconds, error
* tables: table_name, recorded, row_count, size_mb, partitions, quality_score
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = (
    "run_id STRING, run_name STRING, started TIMESTAMP, ended TIMESTAMP, status STRING, rows_processed BIGINT, tables STRING, "
    "seconds DOUBLE, error STRING"
)

TABLE_SCHEMA = (
    "table_name STRING, recorded TIMESTAMP_NTZ, row_count BIGINT, size_mb DOUBLE, partitions BIGINT, "
    "quality_score DOUBLE"
)

UNHEALTHY_PERCENT = 20
WARNING_PERCENT = 10
LONG_RUN_SECONDS = 3600
STALE_HOURS = 24

# Bytes per value by type; strings are measured, any other type counts 20.
WIDTHS = {
    T.IntegerType(): 4, T.LongType(): 8, T.FloatType(): 4, T.DoubleType(): 8, T.TimestampType(): 8,
    T.TimestampNTZType(): 8,
}
OTHER_WIDTH = 20


def run_record(
    spark: SparkSession,
    run_id: str,
    name: str,
    started: dt.datetime,
    ended: dt.datetime | None,
    status: str,
    rows: int = 0,
    tables: list[str] | None = None,
    error: str | None = None,
) -> DataFrame:
    """One row to append to the run ledger; ``RUNNING`` has no end and stands until a row with an end follows it."""
    seconds = (ended - started).total_seconds() if ended else None
    row = (run_id, name, started, ended, status, rows, ",".join(tables or []), seconds, error)
    return spark.createDataFrame([row], RUN_SCHEMA)


def current_runs(runs: DataFrame) -> DataFrame:
    """The last row of each run: its end if it has one, else the row of its start."""
    values = [c for c in runs.columns if c != "run_id"]
    last = F.max_by(F.struct(*values), F.struct(F.col("ended").isNotNull(), F.col("ended")))
    return runs.groupBy("run_id").agg(last.alias("r")).select("run_id", "r.*").select(*runs.columns)


def final_status(done: int, planned: int) -> str:
    if done == planned:
        return "SUCCESS"
    return "PARTIAL" if done else "FAILED"


def size_estimate(df: DataFrame) -> tuple[Column, Column]:
    """Aggregates for the row count and the bytes of all rows."""
    fixed = sum(WIDTHS.get(f.dataType, OTHER_WIDTH) for f in df.schema if f.dataType != T.StringType())
    texts = [F.coalesce(F.sum(F.octet_length(f.name)), F.lit(0)) for f in df.schema if f.dataType == T.StringType()]
    count = F.count(F.lit(1))
    return count, reduce(lambda a, b: a + b, texts, count * F.lit(fixed))


def table_record(
    df: DataFrame, name: str, at: dt.datetime, quality: DataFrame | None = None, partition_by: str | None = None
) -> DataFrame:
    """One table-ledger row from one pass. The score is the pass rate of ``quality`` (a check summary)."""
    rows, size = size_estimate(df)
    parts = F.count_distinct(F.col(partition_by)) if partition_by else F.lit(None).cast("long")
    record = df.agg(rows.alias("row_count"), (size / (1 << 20)).alias("size_mb"), parts.alias("partitions"))
    score = quality.select("pass_rate").scalar() if quality is not None else F.lit(None).cast("double")
    return record.select(
        F.lit(name).alias("table_name"), _clock(at).alias("recorded"), "row_count", "size_mb", "partitions",
        score.alias("quality_score"),
    )


def run_summary(runs: DataFrame, *by: str) -> DataFrame:
    return runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_executions"),
        F.count_if(F.col("status") == "SUCCESS").alias("successful_executions"),
        F.count_if(F.col("status") == "FAILED").alias("failed_executions"),
        (F.count_if(F.col("status") == "SUCCESS") * 100.0 / F.count(F.lit(1))).alias("success_rate"),
        F.avg("seconds").alias("average_seconds"),
        F.sum("rows_processed").alias("total_rows_processed"),
    )


def latest_runs(runs: DataFrame, top: int = 5) -> DataFrame:
    return runs.orderBy(F.desc("started"), "run_id").limit(top)


def latest_per_table(tables: DataFrame, *tie_break: str) -> DataFrame:
    """Newest record per table as a mergeable maximum: a table with very many records needs no sort."""
    values = [c for c in tables.columns if c != "table_name"]
    newest = F.max_by(F.struct(*values), F.struct("recorded", *tie_break))
    return tables.groupBy("table_name").agg(newest.alias("r")).select("table_name", "r.*")


def table_summary(latest: DataFrame) -> DataFrame:
    return latest.agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.sum("row_count").alias("total_rows"),
        F.sum(F.coalesce("size_mb", F.lit(0.0))).alias("total_size_mb"),
        F.avg("quality_score").alias("average_quality_score"),
    )


def _clock(as_of: dt.datetime, hours_before: int = 0) -> Column:
    """A wall-clock time, free of any time zone."""
    return F.lit((as_of - dt.timedelta(hours=hours_before)).isoformat(" ")).cast("timestamp_ntz")


def stale_tables(latest: DataFrame, as_of: dt.datetime, hours: int = STALE_HOURS) -> DataFrame:
    return latest.filter(F.col("recorded") < _clock(as_of, hours))


def health(runs: DataFrame, latest: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row for the 24 hours before ``as_of``."""
    recent = runs.filter(F.col("started").between(_clock(as_of, 24), _clock(as_of)))
    stale = stale_tables(latest, as_of).agg(F.count(F.lit(1))).scalar()
    rate = F.col("failure_rate")
    return (
        recent.agg(
            F.count(F.lit(1)).alias("recent_executions"),
            F.count_if(F.col("status") == "FAILED").alias("recent_failures"),
            F.count_if(F.col("seconds") > LONG_RUN_SECONDS).alias("long_runs"),
        )
        .withColumn(
            "failure_rate",
            F.try_divide(F.col("recent_failures") * 100.0, F.col("recent_executions").cast("double")),
        )
        .withColumn("stale_tables", stale)
        .withColumn(
            "status",
            F.when(F.col("recent_executions") == 0, "UNKNOWN")
            .when(rate > UNHEALTHY_PERCENT, "UNHEALTHY")
            .when(rate > WARNING_PERCENT, "WARNING")
            .otherwise("HEALTHY"),
        )
    )


def recommendations(runs: DataFrame, latest: DataFrame, as_of: dt.datetime) -> DataFrame:
    """What to do about the health of the last 24 hours: rows (finding, subject, advice), none if all is well.

    A finding about tables has one row per stale table.
    """
    state = health(runs, latest, as_of)
    rate = F.col("failure_rate")
    cases = [
        ("no_runs", F.col("recent_executions") == 0, "No run in the last 24 hours: check the schedule"),
        ("many_failures", rate > UNHEALTHY_PERCENT, "Many runs failed: look into their errors"),
        ("some_failures", (rate > WARNING_PERCENT) & (rate <= UNHEALTHY_PERCENT), "More runs failed than usual: watch them"),
        ("long_runs", F.col("long_runs") > 0, "Some runs took more than an hour: look for what slows them down"),
    ]
    rows = [
        F.struct(F.lit(name).alias("finding"), F.lit("pipeline").alias("subject"), F.lit(text).alias("advice"), test.alias("holds"))
        for name, test, text in cases
    ]
    found = state.select(F.inline(F.array(*rows))).filter("holds").drop("holds")
    # Like the status, findings about tables need recent runs to speak of.
    stale = stale_tables(latest, as_of).filter(state.select(F.col("recent_executions")).scalar() > 0)
    return found.unionByName(
        stale.select(
            F.lit("stale_table").alias("finding"), F.col("table_name").alias("subject"),
            F.lit("Not updated in a day: check what loads it").alias("advice"),
        )
    )


def ingestion_status(runs: DataFrame, latest: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Run summary, table summary and health as (section, metric, value) rows."""

    def rows(df: DataFrame, section: str) -> DataFrame:
        pairs = [
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
            for c, kind in df.dtypes
            if kind != "string"
        ]
        return df.select(F.lit(section).alias("section"), F.inline(F.array(*pairs)))

    parts = [rows(run_summary(runs), "runs"), rows(table_summary(latest), "tables"),
             rows(health(runs, latest, as_of), "health")]
    return reduce(DataFrame.unionByName, parts)


def export(runs: DataFrame, tables: DataFrame, path: str) -> None:
    """Both ledgers as JSON lines in two folders under ``path``."""
    runs.write.mode("overwrite").json(f"{path}/runs")
    tables.write.mode("overwrite").json(f"{path}/tables")
