"""Quality checks and monitoring reports over the given data."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise import constants as C
from lapwise.operators import monitoring as mon
from lapwise.operators import quality as dq
from lapwise.operators.quality import CheckSpec
from lapwise.queries.common import sql
from lapwise.queries.gold import bound, performance, rankings, rounded, statistics
from lapwise.plans import silver
from lapwise.schemas import GIVEN
from lapwise.sources.binding import Binding

LOADED = dt.datetime(2001, 8, 1, 12)
MONITORED = dt.datetime(2024, 1, 31)

RESULT_CHECKS = [
    CheckSpec("position_known", "null_check", ["position"], threshold=50.0),
    CheckSpec("position_required", "null_check", ["position"], threshold=0.0),
    CheckSpec("keys_known", "null_check", ["raceId", "driverId", "constructorId"], threshold=0.0),
    CheckSpec("few_laps", "range_check", ["laps"], "laps <= 45", threshold=5.0),
    CheckSpec("placed_in_front", "range_check", ["position"], "position <= 5", threshold=90.0),
    CheckSpec("enough_rows", "row_count_check", threshold=100),
    CheckSpec("too_few_rows", "row_count_check", threshold=10**15),
]

DUPLICATE_CHECKS = [
    CheckSpec("one_result_per_driver", "duplicate_check", ["raceId", "driverId"], threshold=1.0),
    CheckSpec("one_result_per_team", "duplicate_check", ["raceId", "constructorId"], threshold=50.0),
    CheckSpec("whole_rows", "duplicate_check", threshold=0.0),
]


def _schema_and_rows(b: Binding) -> DataFrame:
    """Orders against the schema of customer (all differ) and against its own; both beside a full row count."""
    orders = b.given("orders")
    specs = [
        CheckSpec("own_schema", "schema_check", expected=GIVEN["orders"]),
        CheckSpec("foreign_schema", "schema_check", expected=GIVEN["region"]),
        CheckSpec("orders_counted", "row_count_check", threshold=1),
    ]
    return dq.run_checks(orders, specs)


def _freshness(b: Binding) -> DataFrame:
    specs = [
        CheckSpec("fresh", "freshness_check", ["ts"], threshold=48),
        CheckSpec("late", "freshness_check", ["ts"], threshold=1),
        CheckSpec("event_times", "null_check", ["ts"], threshold=0.0),
    ]
    results = dq.run_checks(b.given("events"), specs, as_of=dt.datetime(2024, 2, 1, 12))
    return results.select("check_name", "status", "total_rows")


def _suites(b: Binding) -> DataFrame:
    """The predefined suites of the tables that can be built here."""
    loaded = performance(b).withColumn("ingestion_timestamp", F.lit("2001-07-31 12:00:00").cast("timestamp_ntz"))
    tables = {
        "bronze.races": b.races(),
        "bronze.drivers": b.drivers(),
        "bronze.constructors": b.constructors(),
        "bronze.circuits": b.circuits(),
        "bronze.lap_times": b.lap_times(),
        "bronze.results": b.results(),
        "silver.performance": loaded,
        "silver.pit_analysis": silver.pit_analysis(b.pit_stops(), b.races(), b.drivers()),
        "gold.driver_statistics": statistics(b),
        "gold.constructor_rankings": rankings(b),
    }
    checked = [
        dq.run_checks(df, dq.SUITES[name], LOADED, C.WARNING_PERCENT[name.partition(".")[0]]).withColumn(
            "table", F.lit(name)
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, checked)


def _references(b: Binding) -> DataFrame:
    """Lap drivers are users, of whom only some are known drivers; results refer to known rows only."""
    results = b.results()
    checks = [
        dq.referential_check(results, b.races(), "raceId", "results_races"),
        dq.referential_check(results, b.drivers(), "driverId", "results_drivers"),
        dq.referential_check(results, b.constructors(), "constructorId", "results_constructors"),
        dq.referential_check(b.lap_times(), b.drivers(), "driverId", "laps_drivers"),
    ]
    return reduce(DataFrame.unionByName, checks)


def runs(b: Binding) -> DataFrame:
    """A run ledger: one run per event, its outcome and length from the event's value."""
    value = F.col("value")
    return b.given("events").select(
        F.col("event_id").alias("run_id"),
        F.concat(F.lit("load_"), "event_type").alias("run_name"),
        F.col("ts").alias("started"),
        F.when(value < 3, "FAILED").when(value < 6, "PARTIAL").otherwise("SUCCESS").alias("status"),
        F.col("user_id").alias("rows_processed"),
        (value * 20).alias("seconds"),
    )


def _ledger(b: Binding) -> DataFrame:
    """Every run as written: a row of its start, and for most a row of its end."""
    ended = runs(b).withColumn("ended", F.col("started") + F.make_dt_interval(secs=F.col("seconds")))
    begun = ended.withColumns({
        "ended": F.lit(None).cast("timestamp_ntz"), "status": F.lit("RUNNING"), "rows_processed": F.lit(0).cast("long"),
        "seconds": F.lit(None).cast("double"),
    })
    return begun.withColumn("ended", F.col("ended").cast(ended.schema["ended"].dataType)).union(
        ended.filter("status <> 'FAILED'")
    )


def _bad_conditions(b: Binding) -> DataFrame:
    """Conditions that cannot run fail alone; the sound checks beside them still run."""
    specs = [
        CheckSpec("unknown_column", "range_check", [], "no_such_column > 1", threshold=0.0),
        CheckSpec("bad_syntax", "range_check", [], "laps >>>", threshold=0.0),
        CheckSpec("not_boolean", "range_check", [], "laps + 1", threshold=0.0),
        CheckSpec("missing", "null_check", ["no_such_column"], threshold=0.0),
        CheckSpec("laps_known", "range_check", ["laps"], "laps IS NOT NULL", threshold=0.0),
    ]
    return dq.run_checks(_placed(b), specs).select("check_name", "status", "total_rows", "bad_rows")


def _gates(b: Binding) -> DataFrame:
    """Per set of checks, whether its table is accepted: warnings pass, failures do not."""
    sets = {"results": RESULT_CHECKS, "tolerant": RESULT_CHECKS[:1], "counted": RESULT_CHECKS[5:6]}
    verdicts = [
        dq.run_checks(_placed(b), specs).groupBy().agg((F.count_if(F.col("status") == "FAIL") == 0).alias("accepted"))
        .select(F.lit(name).alias("suite"), "accepted") for name, specs in sets.items()
    ]
    return reduce(DataFrame.unionByName, verdicts)


def tables(b: Binding) -> DataFrame:
    """A table ledger: one record per event for a table named after its type and user."""
    return b.given("events").select(
        F.concat_ws("_", "event_type", "user_id").alias("table_name"),
        F.col("ts").alias("recorded"),
        "event_id",
        F.round(F.col("value") * 100).cast("long").alias("row_count"),
        F.col("value").alias("size_mb"),
        (100 - F.least("value", F.lit(100.0))).alias("quality_score"),
    )


def latest(b: Binding) -> DataFrame:
    return mon.latest_per_table(tables(b), "event_id")


def _sizes(b: Binding) -> DataFrame:
    named = {"races": b.races(), "results": b.results(), "drivers": b.drivers(), "lineitem": b.given("lineitem")}
    records = [mon.table_record(df, name, MONITORED) for name, df in named.items()]
    return reduce(DataFrame.unionByName, records).select("table_name", "row_count", F.round("size_mb", 6).alias("size_mb"))


def _scored(b: Binding) -> DataFrame:
    """A table record whose score is the pass rate of its own checks."""
    results = _placed(b)
    score = dq.summary(dq.run_checks(results, RESULT_CHECKS))
    return mon.table_record(results, "results", MONITORED, score, "constructorId").select(
        "table_name", "row_count", "partitions", F.round("quality_score", 6).alias("quality_score")
    )


QUERIES = {
    "dq1_result_checks": bound(lambda b: rounded(dq.run_checks(_placed(b), RESULT_CHECKS), "bad_pct")),
    "dq2_duplicates": bound(lambda b: rounded(dq.run_checks(_placed(b), DUPLICATE_CHECKS), "bad_pct")),
    "dq4_schema_and_rows": bound(lambda b: _schema_and_rows(b).select("check_name", "status", "total_rows", "bad_rows")),
    "dq5_freshness": bound(_freshness),
    "dq7_bad_conditions": bound(_bad_conditions),
    "dq10_gates": bound(_gates),
    "mon1_current_runs": bound(
        lambda b: mon.current_runs(_ledger(b)).select("run_id", "run_name", "status", "rows_processed")
    ),
    "dq8_summary": bound(
        lambda b: rounded(
            dq.summary(dq.run_checks(_placed(b), [*RESULT_CHECKS, *DUPLICATE_CHECKS])), "pass_rate"
        )
    ),
    "dq9_suites": bound(lambda b: _suites(b).select("table", "check_name", "status", "total_rows", "bad_rows")),
    "dq12_references": bound(
        lambda b: _references(b).select("check_name", "column", "status", "total_rows", "bad_rows")
    ),
    "dq15_layer_threshold": bound(
        lambda b: rounded(
            dq.run_checks(_placed(b), RESULT_CHECKS, warn_pct=C.WARNING_PERCENT["bronze"]), "bad_pct"
        ).select("check_name", "status", "bad_pct")
    ),
    "join11_orphans": bound(lambda b: dq.orphans(b.lap_times(), b.drivers(), "driverId")),
    "join11_filtered_orphans": bound(lambda b: dq.filtered_orphans(b.lap_times(), b.drivers(), "driverId")),
    "mon2_scored_table": bound(_scored),
    "mon3_table_sizes": bound(_sizes),
    "mon4_run_summary": bound(lambda b: rounded(mon.run_summary(runs(b), "run_name"), "average_seconds")),
    "mon5_table_summary": bound(
        lambda b: rounded(mon.table_summary(latest(b)), "total_size_mb", "average_quality_score")
    ),
    "mon6_health": bound(lambda b: mon.health(runs(b), latest(b), MONITORED)),
    "mon6_recommendations": bound(lambda b: mon.recommendations(runs(b), latest(b), MONITORED)),
    "mon7_stale_tables": bound(
        lambda b: mon.stale_tables(latest(b), MONITORED).select("table_name", "row_count", "size_mb")
    ),
    "mon8_ingestion_status": bound(lambda b: rounded(mon.ingestion_status(runs(b), latest(b), MONITORED), "value")),
    "sort7_latest_runs": bound(
        lambda b: mon.latest_runs(runs(b)).select("run_id", "run_name", "status", "rows_processed", "seconds")
    ),
    "win9_latest_per_table": bound(lambda b: latest(b).drop("recorded")),
}


def _placed(b: Binding) -> DataFrame:
    return silver.cleaned_results(b.results())


def _check_sql(name: str, kind: str, column: str, bad: str, what: str, threshold: float, warn: float = 0.0) -> str:
    pct = f"coalesce({bad} * 100.0 / nullif(count(*), 0), 0)"
    status = (
        f"CASE WHEN {pct} > {threshold} THEN 'FAIL' WHEN {pct} > {warn} THEN 'WARNING' ELSE 'PASS' END"
    )
    return f"""SELECT '{name}' AS check_name, '{kind}' AS check_type, '{column}' AS "column", {status} AS status,
        count(*) AS total_rows, CAST({bad} AS BIGINT) AS bad_rows, CAST(round({pct}, 6) AS DOUBLE) AS bad_pct,
        CASE WHEN {status} = 'PASS' THEN '' ELSE printf('%d {what} in %d rows', CAST({bad} AS BIGINT), count(*))
        END AS message FROM """


def _null(name, columns, threshold, table="facts", warn=0.0):
    test = " OR ".join(f"{c} IS NULL" for c in columns)
    bad = f"count(*) FILTER (WHERE {test})"
    return _check_sql(name, "null_check", ",".join(columns), bad, "null values", threshold, warn) + table


def _range(name, column, condition, threshold, table="facts", warn=0.0):
    bad = f"count(*) FILTER (WHERE NOT coalesce({condition}, false))"
    return _check_sql(name, "range_check", column, bad, "invalid values", threshold, warn) + table


def _rows(name, least, table="facts"):
    return f"""SELECT '{name}' AS check_name, 'row_count_check' AS check_type, '' AS "column",
        CASE WHEN count(*) < {least} THEN 'FAIL' ELSE 'PASS' END AS status, count(*) AS total_rows,
        CAST(0 AS BIGINT) AS bad_rows, CAST(0 AS DOUBLE) AS bad_pct,
        CASE WHEN count(*) < {least} THEN printf('%d rows', count(*)) ELSE '' END AS message FROM {table}"""


def _dup(name, columns, threshold, table="facts", keys=None):
    shown = ",".join(columns)
    grouped = ", ".join(columns) if columns else keys
    inner = f"(SELECT count(*) AS n FROM {table} GROUP BY {grouped})"
    base = _check_sql(name, "duplicate_check", shown, "sum(n - 1)", "duplicate records", threshold)
    return base.replace("count(*)", "CAST(sum(n) AS BIGINT)") + inner


_ALL = "raceId, driverId, constructorId, position, positionText, positionOrder, points, laps, fastestLap"


def _result_sql(warn: float = 0.0) -> str:
    return " UNION ALL ".join(
        [
            _null("position_known", ["position"], 50.0, warn=warn),
            _null("position_required", ["position"], 0.0, warn=warn),
            _null("keys_known", ["raceId", "driverId", "constructorId"], 0.0, warn=warn),
            _range("few_laps", "laps", "laps <= 45", 5.0, warn=warn),
            _range("placed_in_front", "position", "position <= 5", 90.0, warn=warn),
            _rows("enough_rows", 100),
            _rows("too_few_rows", 10**15),
        ]
    )


_RESULT_SQL = _result_sql()

_DUP_SQL = " UNION ALL ".join(
    [
        _dup("one_result_per_driver", ["raceId", "driverId"], 1.0),
        _dup("one_result_per_team", ["raceId", "constructorId"], 50.0),
        _dup("whole_rows", [], 0.0, keys=_ALL),
    ]
)

_SUITE_SQL = " UNION ALL ".join(
    f"SELECT '{table}' AS \"table\", check_name, status, total_rows, bad_rows FROM ({text})"
    for table, text in [
        ("bronze.races", _null("races_null_check", ["raceId"], 0.0, "races")),
        ("bronze.races", _rows("races_row_count", 100, "races")),
        ("bronze.drivers", _null("drivers_null_check", ["driverId"], 0.0, "drivers")),
        ("bronze.races", _dup("races_unique", ["raceId"], 0.0, "races")),
        ("bronze.drivers", _dup("drivers_unique", ["driverId"], 0.0, "drivers")),
        ("bronze.constructors", _dup("constructors_unique", ["constructorId"], 0.0, "constructors")),
        ("bronze.circuits", _dup("circuits_unique", ["circuitId"], 0.0, "circuits")),
        ("bronze.lap_times", _range("lap_times_range_check", "milliseconds", "milliseconds > 0", 1.0, "laps", 5.0)),
        ("bronze.results", _null("results_keys", ["raceId", "driverId", "constructorId"], 0.0, "results", 5.0)),
        ("bronze.results", _rows("results_row_count", 1, "results")),
        (
            "bronze.results",
            _dup("results_duplicates", ["raceId", "driverId"], 1.0, "results").replace("> 0.0 ", "> 5.0 "),
        ),
        ("silver.performance", _null("performance_null_check", ["driverId"], 0.0, "performance")),
        (
            "silver.performance",
            _null("performance_keys", ["raceId", "driverId", "constructorId"], 0.0, "performance"),
        ),
        (
            "silver.performance",
            _range("performance_position", "position", "position >= 1 OR position IS NULL", 0.0, "performance"),
        ),
        (
            "silver.performance",
            """SELECT 'performance_freshness' AS check_name, 'PASS' AS status, count(*) AS total_rows,
            CAST(0 AS BIGINT) AS bad_rows FROM performance""",
        ),
        ("silver.pit_analysis", _range("pit_duration_positive", "milliseconds", "milliseconds > 0", 0.0, "pit_analysis")),
        (
            "gold.driver_statistics",
            _null("driver_statistics_null_check", ["driverId"], 0.0, "driver_statistics"),
        ),
        (
            "gold.driver_statistics",
            _null("driver_statistics_complete", ["driverId", "year", "total_points"], 0.0, "driver_statistics"),
        ),
        (
            "gold.driver_statistics",
            _range("races_cover_wins", "total_races", "total_races >= total_wins", 0.0, "driver_statistics"),
        ),
        (
            "gold.constructor_rankings",
            _range("points_not_negative", "total_points", "total_points >= 0", 0.0, "constructor_rankings"),
        ),
    ]
)


def _reference(name: str, facts: str, dimension: str, key: str) -> str:
    bad = f"count(*) FILTER (WHERE {key} NOT IN (SELECT {key} FROM {dimension}))"
    return f"""SELECT '{name}' AS check_name, '{key}' AS "column",
        CASE WHEN {bad} > 0 THEN 'FAIL' ELSE 'PASS' END AS status, count(*) AS total_rows, {bad} AS bad_rows
        FROM {facts}"""


_RUNS = """SELECT event_id AS run_id, 'load_' || event_type AS run_name, ts AS started,
    CASE WHEN value < 3 THEN 'FAILED' WHEN value < 6 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status,
    user_id AS rows_processed, value * 20 AS seconds FROM events"""

_LATEST = """SELECT * EXCLUDE (n) FROM (SELECT event_type || '_' || user_id AS table_name, ts AS recorded, event_id,
    CAST(round(value * 100) AS BIGINT) AS row_count, value AS size_mb, 100 - least(value, 100.0) AS quality_score,
    row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1"""

_SUMMARY = """count(*) AS total_executions, count(*) FILTER (WHERE status = 'SUCCESS') AS successful_executions,
    count(*) FILTER (WHERE status = 'FAILED') AS failed_executions,
    count(*) FILTER (WHERE status = 'SUCCESS') * 100.0 / count(*) AS success_rate,
    round(avg(seconds), 6) AS average_seconds, CAST(sum(rows_processed) AS BIGINT) AS total_rows_processed"""

_HEALTH = """SELECT *, CASE WHEN recent_executions = 0 THEN 'UNKNOWN' WHEN failure_rate > 20 THEN 'UNHEALTHY'
    WHEN failure_rate > 10 THEN 'WARNING' ELSE 'HEALTHY' END AS status
    FROM (SELECT count(*) AS recent_executions, count(*) FILTER (WHERE status = 'FAILED') AS recent_failures,
      count(*) FILTER (WHERE seconds > 3600) AS long_runs,
      count(*) FILTER (WHERE status = 'FAILED') * 100.0 / nullif(count(*), 0) AS failure_rate,
      (SELECT count(*) FROM latest WHERE recorded < TIMESTAMP '2024-01-30 00:00:00') AS stale_tables
      FROM runs WHERE started BETWEEN TIMESTAMP '2024-01-30 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00')"""

_TABLES = """SELECT count(*) AS total_tables, CAST(sum(row_count) AS BIGINT) AS total_rows,
    round(sum(size_mb), 6) AS total_size_mb, round(avg(quality_score), 6) AS average_quality_score FROM latest"""


def _section(section: str, relation: str, *metrics: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{m}' AS metric, round(CAST({m} AS DOUBLE), 6) AS value FROM ({relation})"
        for m in metrics
    )


def _size(name: str, table: str, fixed: int, *texts: str) -> str:
    strings = "".join(f" + coalesce(sum(octet_length(encode({t}))), 0)" for t in texts)
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count,
        round((count(*) * {fixed}{strings}) / 1048576, 6) AS size_mb FROM {table}"""


SQL = {
    "dq1_result_checks": sql(_RESULT_SQL, "facts"),
    "dq2_duplicates": sql(_DUP_SQL, "facts"),
    "dq4_schema_and_rows": """SELECT 'own_schema' AS check_name, 'PASS' AS status, CAST(6 AS BIGINT) AS total_rows,
        CAST(0 AS BIGINT) AS bad_rows UNION ALL SELECT 'foreign_schema', 'FAIL', 2, 8
        UNION ALL SELECT 'orders_counted', 'PASS', count(*), 0 FROM orders""",
    "dq5_freshness": """SELECT check_name, CASE WHEN age > hours THEN 'FAIL' WHEN age > 24 THEN 'WARNING' ELSE 'PASS'
        END AS status, total_rows FROM (SELECT date_diff('second', max(ts), TIMESTAMP '2024-02-01 12:00:00') / 3600.0
        AS age, count(*) AS total_rows FROM events), (VALUES ('fresh', 48), ('late', 1)) v(check_name, hours)
        UNION ALL SELECT 'event_times', 'PASS', count(*) FROM events""",
    "dq7_bad_conditions": sql(
        """SELECT * FROM (VALUES ('unknown_column'), ('bad_syntax'), ('not_boolean'), ('missing')) v(check_name),
        (SELECT 'FAIL' AS status, CAST(NULL AS BIGINT) AS total_rows, CAST(NULL AS BIGINT) AS bad_rows)
        UNION ALL SELECT 'laps_known', CASE WHEN count(*) > count(laps) THEN 'FAIL' ELSE 'PASS' END, count(*),
        count(*) - count(laps) FROM facts""",
        "facts",
    ),
    "dq10_gates": sql(
        f"""SELECT 'results' AS suite, count(*) FILTER (WHERE status = 'FAIL') = 0 AS accepted FROM ({_RESULT_SQL})
        UNION ALL SELECT 'tolerant', (SELECT count(*) FILTER (WHERE position IS NULL) * 100.0 / count(*) <= 50 FROM facts)
        UNION ALL SELECT 'counted', (SELECT count(*) >= 100 FROM facts)""",
        "facts",
    ),
    "mon1_current_runs": sql(
        """SELECT run_id, run_name, CASE WHEN status = 'FAILED' THEN 'RUNNING' ELSE status END AS status,
        CASE WHEN status = 'FAILED' THEN 0 ELSE rows_processed END AS rows_processed FROM runs""",
        runs=_RUNS,
    ),
    "dq8_summary": sql(
        f"""SELECT count(*) AS total_checks, count(*) FILTER (WHERE status = 'PASS') AS passed_checks,
        count(*) FILTER (WHERE status = 'WARNING') AS warning_checks,
        count(*) FILTER (WHERE status = 'FAIL') AS failed_checks,
        round(count(*) FILTER (WHERE status = 'PASS') * 100.0 / count(*), 6) AS pass_rate
        FROM ({_RESULT_SQL} UNION ALL {_DUP_SQL})""",
        "facts",
    ),
    "dq9_suites": sql(
        _SUITE_SQL, "races", "drivers", "constructors", "circuits", "laps", "results", "performance", "pit_analysis", "driver_statistics",
        "constructor_rankings",
    ),
    "dq12_references": sql(
        " UNION ALL ".join(
            [
                _reference("results_races", "results", "races", "raceId"),
                _reference("results_drivers", "results", "drivers", "driverId"),
                _reference("results_constructors", "results", "constructors", "constructorId"),
                _reference("laps_drivers", "laps", "drivers", "driverId"),
            ]
        ),
        "results", "races", "drivers", "constructors", "laps",
    ),
    "dq15_layer_threshold": sql(
        f"SELECT check_name, status, bad_pct FROM ({_result_sql(5.0)})", "facts"
    ),
    "join11_orphans": sql(
        """SELECT l.driverId, count(*) AS "rows" FROM laps l WHERE NOT EXISTS
        (SELECT 1 FROM drivers d WHERE d.driverId = l.driverId) GROUP BY l.driverId""",
        "laps",
        "drivers",
    ),
    "join11_filtered_orphans": sql(
        """SELECT l.driverId, count(*) AS "rows" FROM laps l WHERE NOT EXISTS
        (SELECT 1 FROM drivers d WHERE d.driverId = l.driverId) GROUP BY l.driverId""",
        "laps",
        "drivers",
    ),
    "mon2_scored_table": sql(
        f"""SELECT 'results' AS table_name, count(*) AS row_count, count(DISTINCT constructorId) AS partitions,
        (SELECT round(count(*) FILTER (WHERE status = 'PASS') * 100.0 / count(*), 6) FROM ({_RESULT_SQL}))
        AS quality_score FROM results""",
        "facts",
    ),
    "mon3_table_sizes": sql(
        " UNION ALL ".join(
            [
                _size("races", "races", 40, "name"),
                _size(
                    "results", """(SELECT *, CASE WHEN positionText = 'R' THEN '\\N' ELSE positionText END AS place
                    FROM results)""", 36, "constructorId", "positionText", "place",
                ),
                _size("drivers", "drivers", 8, "forename", "surname", "nationality"),
                _size("lineitem", "lineitem", 68, "l_returnflag", "l_linestatus"),
            ]
        ),
        "races", "results", "drivers",
    ),
    "mon4_run_summary": sql(f"SELECT run_name, {_SUMMARY} FROM runs GROUP BY run_name", runs=_RUNS),
    "mon5_table_summary": sql(_TABLES, latest=_LATEST),
    "mon6_health": sql(_HEALTH, runs=_RUNS, latest=_LATEST),
    "mon6_recommendations": sql(
        """SELECT 'no_runs' AS finding, 'pipeline' AS subject, 'No run in the last 24 hours: check the schedule' AS advice
          FROM health WHERE recent_executions = 0
        UNION ALL SELECT 'many_failures', 'pipeline', 'Many runs failed: look into their errors' FROM health
          WHERE failure_rate > 20
        UNION ALL SELECT 'some_failures', 'pipeline', 'More runs failed than usual: watch them' FROM health
          WHERE failure_rate > 10 AND failure_rate <= 20
        UNION ALL SELECT 'long_runs', 'pipeline', 'Some runs took more than an hour: look for what slows them down'
          FROM health WHERE long_runs > 0
        UNION ALL SELECT 'stale_table', table_name, 'Not updated in a day: check what loads it' FROM latest, health
          WHERE recorded < TIMESTAMP '2024-01-30 00:00:00' AND recent_executions > 0""",
        runs=_RUNS, latest=_LATEST, health=_HEALTH,
    ),
    "mon7_stale_tables": sql(
        "SELECT table_name, row_count, size_mb FROM latest WHERE recorded < TIMESTAMP '2024-01-30 00:00:00'",
        latest=_LATEST,
    ),
    "mon8_ingestion_status": sql(
        " UNION ALL ".join(
            [
                _section(
                    "runs", f"SELECT {_SUMMARY} FROM runs", "total_executions", "successful_executions",
                    "failed_executions", "success_rate", "average_seconds", "total_rows_processed",
                ),
                _section("tables", _TABLES, "total_tables", "total_rows", "total_size_mb", "average_quality_score"),
                _section(
                    "health", _HEALTH, "recent_executions", "recent_failures", "long_runs", "failure_rate",
                    "stale_tables",
                ),
            ]
        ),
        runs=_RUNS,
        latest=_LATEST,
    ),
    "sort7_latest_runs": sql(
        "SELECT run_id, run_name, status, rows_processed, seconds FROM runs ORDER BY started DESC, run_id LIMIT 5",
        runs=_RUNS,
    ),
    "win9_latest_per_table": sql("SELECT * EXCLUDE (recorded) FROM latest", latest=_LATEST),
}
