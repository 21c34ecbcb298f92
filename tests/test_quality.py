"""Checks, gate, schema differences and monitoring."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from lapwise.operators import monitoring as mon
from lapwise.operators import quality as dq
from lapwise.operators.quality import CheckSpec

NOW = dt.datetime(2000, 1, 10)


def status(df, *specs, **options):
    return {r["check_name"]: r for r in dq.run_checks(df, list(specs), as_of=NOW, **options).collect()}


def test_null_thresholds(rows):
    df = rows("a INT", (1,), (2,), (3,), (None,))
    got = status(
        df,
        CheckSpec("none", "null_check", ["a"]),
        CheckSpec("zero", "null_check", ["a"], threshold=0.0),
        CheckSpec("exact", "null_check", ["a"], threshold=25.0),
        CheckSpec("over", "null_check", ["a"], threshold=24.9),
    )
    assert {n: r["status"] for n, r in got.items()} == {
        "none": "WARNING", "zero": "FAIL", "exact": "WARNING", "over": "FAIL",
    }
    assert (got["zero"]["bad_rows"], got["zero"]["bad_pct"], got["zero"]["total_rows"]) == (1, 25.0, 4)
    tolerant = status(df, CheckSpec("none", "null_check", ["a"]), warn_pct=30.0)
    assert tolerant["none"]["status"] == "PASS" and tolerant["none"]["message"] == ""


def test_range_counts_null_as_invalid(rows):
    df = rows("a INT", (1,), (5,), (None,))
    got = status(df, CheckSpec("r", "range_check", ["a"], "a < 4", 50.0))["r"]
    assert (got["status"], got["bad_rows"]) == ("FAIL", 2)


def test_duplicates(rows):
    df = rows("a INT, b INT", (1, 1), (1, 2), (1, 1), (None, 1))
    got = status(
        df,
        CheckSpec("one", "duplicate_check", ["a"], threshold=50.0),
        CheckSpec("two", "duplicate_check", ["a", "b"], threshold=0.0),
        CheckSpec("rows", "duplicate_check"),
    )
    assert [(got[n]["status"], got[n]["bad_rows"]) for n in ("one", "two", "rows")] == [
        ("WARNING", 2), ("FAIL", 1), ("WARNING", 1),
    ]


def test_empty_table(rows):
    df = rows("a INT, t TIMESTAMP", (1, NOW)).filter("a > 1")
    got = status(
        df,
        CheckSpec("null", "null_check", ["a"], threshold=0.0),
        CheckSpec("dup", "duplicate_check", ["a"], threshold=0.0),
        CheckSpec("fresh", "freshness_check", ["t"], threshold=1),
        CheckSpec("count", "row_count_check", threshold=1),
        CheckSpec("any", "row_count_check"),
    )
    assert {n: r["status"] for n, r in got.items()} == {
        "null": "PASS", "dup": "PASS", "fresh": "FAIL", "count": "FAIL", "any": "PASS",
    }


@pytest.mark.parametrize(
    "hours, limit, expected",
    [(1, 48, "PASS"), (24, 48, "PASS"), (25, 48, "WARNING"), (48, 48, "WARNING"), (49, 48, "FAIL"), (500, None, "WARNING")],
)
def test_freshness(rows, hours, limit, expected):
    df = rows("t TIMESTAMP", (NOW - dt.timedelta(hours=hours),), (NOW - dt.timedelta(hours=900),), (None,))
    got = status(df, CheckSpec("f", "freshness_check", ["t"], threshold=limit))
    assert got["f"]["status"] == expected


def test_schema_check(rows):
    df = rows("a INT, b STRING", (1, "x"))
    schema = lambda *fields: T.StructType([T.StructField(n, t) for n, t in fields])
    a, b = ("a", T.IntegerType()), ("b", T.StringType())
    got = status(
        df,
        CheckSpec("same", "schema_check", expected=schema(a, b)),
        CheckSpec("extra", "schema_check", expected=schema(a)),
        CheckSpec("missing", "schema_check", expected=schema(a, b, ("c", T.LongType()))),
        CheckSpec("type", "schema_check", expected=schema(("a", T.LongType()), b)),
    )
    assert {n: (r["status"], r["message"]) for n, r in got.items()} == {
        "same": ("PASS", ""), "extra": ("WARNING", "extra b"), "missing": ("FAIL", "missing c"),
        "type": ("WARNING", "type a"),
    }


def test_checks_that_cannot_run_fail(rows):
    df = rows("a INT", (1,))
    got = status(
        df,
        CheckSpec("gone", "null_check", ["z"], threshold=0.0),
        CheckSpec("odd", "guess"),
        CheckSpec("bare", "range_check", ["a"]),
        CheckSpec("fine", "null_check", ["a"], threshold=0.0),
    )
    assert {n: r["status"] for n, r in got.items()} == {"gone": "FAIL", "odd": "FAIL", "bare": "FAIL", "fine": "PASS"}


def test_summary_and_gate(rows):
    df = rows("a INT", (1,), (None,))
    warn = dq.run_checks(df, [CheckSpec("w", "null_check", ["a"]), CheckSpec("p", "row_count_check", threshold=1)])
    assert dq.accepted(warn)
    assert dq.summary(warn).first().asDict() == {
        "total_checks": 2, "passed_checks": 1, "warning_checks": 1, "failed_checks": 0, "pass_rate": 50.0,
    }
    assert not dq.accepted(dq.run_checks(df, [CheckSpec("f", "null_check", ["a"], threshold=0.0)]))


def test_checks_share_one_scan(rows):
    specs = [
        CheckSpec("n", "null_check", ["a"]), CheckSpec("r", "range_check", ["a"], "a > 0"),
        CheckSpec("c", "row_count_check", threshold=1),
    ]
    plan = dq.run_checks(rows("a INT", (1,)), specs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_orphans(rows, values):
    facts, dimension = rows("k INT, v INT", (1, 1), (2, 1), (2, 2), (None, 1)), rows("k INT", (1,))
    assert values(dq.orphans(facts, dimension, "k")) == [(2, 2), (None, 1)]
    got = dq.referential_check(facts, dimension, "k", "fk").first()
    assert (got["status"], got["total_rows"], got["bad_rows"]) == ("FAIL", 4, 3)


def test_table_record_measures_all_rows(rows):
    df = rows("a INT, b LONG, c STRING, d BOOLEAN", (1, 1, "xy", True), (2, 2, None, None))
    got = mon.table_record(df, "t", NOW, partition_by="a").first()
    assert (got["row_count"], got["partitions"]) == (2, 2)
    assert got["size_mb"] == pytest.approx((2 * (4 + 8 + 20) + 2) / 2**20)


RUNS = "run_name STRING, started TIMESTAMP_NTZ, status STRING, rows_processed LONG, seconds DOUBLE"
TABLES = "table_name STRING, recorded TIMESTAMP_NTZ, row_count LONG, size_mb DOUBLE, quality_score DOUBLE"


def runs(rows, *states, hours=1, seconds=10.0):
    return rows(RUNS, *[("r", NOW - dt.timedelta(hours=hours), s, 1, seconds) for s in states])


@pytest.mark.parametrize(
    "failed, total, expected", [(0, 10, "HEALTHY"), (1, 10, "HEALTHY"), (2, 10, "WARNING"), (3, 10, "UNHEALTHY")]
)
def test_health(rows, failed, total, expected):
    tables = rows(TABLES, ("t", NOW - dt.timedelta(hours=25), 1, 1.0, 1.0), ("u", NOW, 1, 1.0, 1.0))
    states = ["FAILED"] * failed + ["SUCCESS"] * (total - failed)
    got = mon.health(runs(rows, *states, seconds=4000.0), tables, NOW).first()
    assert (got["status"], got["stale_tables"], got["long_runs"]) == (expected, 1, total)


def test_health_unknown_without_recent_runs(rows):
    tables = rows(TABLES, ("t", NOW, 1, 1.0, 1.0))
    assert mon.health(runs(rows, "FAILED", hours=30), tables, NOW).first()["status"] == "UNKNOWN"


def test_latest_and_summaries(rows):
    day = lambda d: NOW - dt.timedelta(days=d)
    tables = rows(TABLES, ("t", day(2), 5, 1.0, 50.0), ("t", day(1), 7, None, 90.0), ("u", day(3), 1, 2.0, 100.0))
    got = mon.table_summary(mon.latest_per_table(tables)).first()
    assert (got["total_tables"], got["total_rows"], got["total_size_mb"], got["average_quality_score"]) == (2, 8, 2.0, 95.0)
    ledger = runs(rows, "SUCCESS", "FAILED", "RUNNING", "SUCCESS")
    got = mon.run_summary(ledger).first()
    assert (got["total_executions"], got["success_rate"], got["average_seconds"]) == (4, 50.0, 10.0)
    assert [mon.final_status(d, 2) for d in (2, 1, 0)] == ["SUCCESS", "PARTIAL", "FAILED"]


def test_orphans_by_key_filter(rows, spark, values):
    """Equal to the anti join for filters of any size; a filter never misses a key and merges by parts."""
    facts = spark.range(3000).selectExpr("IF(id % 50 = 0, NULL, id % 700) AS k", "id AS x")
    dimension = spark.range(400).selectExpr("id * 2 AS k").union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    want = sorted(values(dq.orphans(facts, dimension, "k")), key=str)
    for bits in (64, 32_768, 100_000):
        assert sorted(values(dq.filtered_orphans(facts, dimension, "k", bits)), key=str) == want
    low, high = dimension.filter("k < 300"), dimension.filter("k >= 300")
    both = dq.merged_filters(dq.key_filter(low, "k", 100_000), dq.key_filter(high, "k", 100_000))
    found = dq.possible(facts.select("k").distinct(), both, "k", 100_000).collect()
    inside = {r["k"] for r in dimension.collect()} - {None}
    assert all(r["possible"] for r in found if r["k"] in inside)
    assert sum(r["possible"] for r in found if r["k"] not in inside) < 40
    assert not next(r["possible"] for r in found if r["k"] is None)
    empty = dimension.limit(0)
    assert sorted(values(dq.filtered_orphans(facts, empty, "k")), key=str) == sorted(values(dq.orphans(facts, empty, "k")), key=str)
