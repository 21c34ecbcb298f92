"""Every registered query against its SQL on the smallest data, and the registry's own rules."""

import importlib.util
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

ROOT = Path(__file__).resolve().parents[1]
FOLDER = "/root/testdata/sf0.001"

spec = importlib.util.spec_from_file_location("check_oracle", ROOT / "tools" / "check_oracle.py")
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)

# Models fitted without SQL counterpart that take long; tests/test_learning.py covers them on fixtures.
SLOW = {"ml8_winner_models", "ml9_lap_models", "ml10_importances", "ml15_batch_scores", "ml19_finish_model",
        "ml22_podium_model", "ml11_k_sweep"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    assert check.compare(df, duck, oracle_sql()[name]).startswith("ok")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", sorted(queries().keys() - oracle_sql().keys() - SLOW))
def test_query_without_sql_has_rows(spark, name):
    assert not queries()[name](spark, FOLDER).isEmpty()


def test_registry():
    assert oracle_sql().keys() <= queries().keys()


def test_entry(spark):
    assert entry(spark).count() > 0
