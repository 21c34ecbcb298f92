"""Curve clustering, checks in one read and incremental maintenance."""

import datetime as dt
import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lapwise.operators import quality
from lapwise.operators.maintenance import Stored, refresh_stored
from lapwise.operators.quality import CheckSpec
from lapwise.sinks import curve, writers


def touched(path, column, low, high):
    """Share of files whose statistics admit a value in the range."""
    files = [f for f in Path(path).rglob("*.parquet")]
    hits = 0
    for file in files:
        meta = pq.read_metadata(file)
        place = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(place).statistics for g in range(meta.num_row_groups)]
        hits += any(s.min <= high and s.max >= low for s in stats if s is not None and s.has_min_max)
    return hits / len(files), len(files)


@pytest.fixture
def points(spark):
    skewed = (F.pow(F.rand(5), 4) * 10_000).cast("int")
    return spark.range(60_000).select(
        "id", (F.xxhash64("id") % 5000).cast("int").alias("a"), skewed.alias("b"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), (F.rand(9) * 3000).cast("int")).alias("c"),
    )


def test_every_column_of_the_curve_skips_files(spark, points, tmp_path):
    writers.write_table(points.repartition(32), f"{tmp_path}/plain")
    stored = spark.read.parquet(f"{tmp_path}/plain")
    curve.along_curve(stored, ["a", "b", "c"], partitions=64).write.parquet(f"{tmp_path}/curve")
    writers.clustered(stored, ["a", "b", "c"], 64).write.parquet(f"{tmp_path}/ranged")
    narrow = {"a": (100, 140), "b": (3000, 3300), "c": (dt.date(2004, 1, 1), dt.date(2004, 2, 1))}
    for column, (low, high) in narrow.items():
        share, files = touched(f"{tmp_path}/curve", column, low, high)
        assert files >= 48 and share <= 0.5, column
    assert touched(f"{tmp_path}/ranged", "b", *narrow["b"])[0] == 1.0  # ranges prune by the first column only
    assert spark.read.parquet(f"{tmp_path}/curve").exceptAll(stored).isEmpty()
    assert spark.read.parquet(f"{tmp_path}/curve").count() == 60_000


def test_curve_inside_partitions_and_on_compaction(spark, points, tmp_path):
    rows = points.withColumn("year", (F.col("id") % 2).cast("int"))
    writers.write_table(rows, f"{tmp_path}/t", ["year"], curve_by=["b", "c"])
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.count() == 60_000 and back.select("year").distinct().count() == 2
    writers.compact(spark, f"{tmp_path}/t", f"{tmp_path}/u", target_bytes=50_000, curve_by=["b", "c"])
    share, files = touched(f"{tmp_path}/u", "c", dt.date(2001, 1, 1), dt.date(2001, 1, 20))
    assert files > 4 and share < 0.7
    with pytest.raises(ValueError):
        writers.write_table(rows, f"{tmp_path}/v", cluster_by=["b"], curve_by=["c"])


def test_hot_place_spreads_and_odd_values_rank(spark, rows, tmp_path):
    hot = spark.range(20_000).select(F.lit("same").alias("name"), F.lit(None).cast("double").alias("x"), "id")
    other = spark.range(4_000).select(F.concat(F.lit("n"), "id").alias("name"), F.rand(1).alias("x"), F.col("id") + 50_000)
    hot.union(other).write.parquet(f"{tmp_path}/h")
    curve.along_curve(spark.read.parquet(f"{tmp_path}/h"), ["name", "x"], partitions=12).write.parquet(f"{tmp_path}/i")
    sizes = [pq.read_metadata(f).num_rows for f in Path(f"{tmp_path}/i").rglob("*.parquet")]
    assert sum(sizes) == 24_000 and max(sizes) < 5_000
    odd = rows("t timestamp, f boolean, s string, e int", (None, None, None, None), (dt.datetime(2020, 1, 1), True, "\u00e9", None))
    assert curve.along_curve(odd, ["t", "f", "s", "e"]).count() == 2
    assert curve.along_curve(odd.limit(0), ["t", "s"]).count() == 0


def test_ranks_follow_the_cut_points(spark):
    cuts = [float(v) for v in (1, 2, 2, 5, 7, 7, 9)]
    values = [None, 0.0, 1.0, 2.0, 4.9, 5.0, 7.0, 8.0, 9.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", curve.rank(F.col("v"), cuts, 3).alias("r"))
    assert [r["r"] for r in df.collect()] == [0 if v is None else sum(c <= v for c in cuts) for v in values]
    curved = spark.range(1).select(curve.interleaved([F.lit(5), F.lit(3)], 3).alias("z")).first()["z"]
    assert curved == 0b100111


SPECS = [
    CheckSpec("keys", "null_check", ["a", "b"], threshold=0.0), CheckSpec("range", "range_check", ["a"], "a > 1", 50.0),
    CheckSpec("rows", "row_count_check", threshold=3), CheckSpec("fresh", "freshness_check", ["t"], threshold=48),
    CheckSpec("one", "duplicate_check", ["a"], threshold=0.0), CheckSpec("two", "duplicate_check", ["b", "a"]),
    CheckSpec("all", "duplicate_check"), CheckSpec("again", "duplicate_check", ["a"], threshold=90.0),
]
NOW = dt.datetime(2020, 1, 2)


def test_all_checks_read_the_table_once(rows, spark, tmp_path):
    at = dt.datetime(2020, 1, 1)
    data = [(1, None, at), (1, None, at), (2, "x", None), (None, None, at), (None, "x", at), (2, "x", at), (3, "y", at)]
    rows("a int, b string, t timestamp_ntz", *data).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    results = quality.run_checks(df, SPECS, NOW)
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    found = {r["check_name"]: (r["status"], r["total_rows"], r["bad_rows"]) for r in results.collect()}
    assert found == {
        "keys": ("FAIL", 7, 4), "range": ("FAIL", 7, 4), "rows": ("PASS", 7, 0), "fresh": ("PASS", 7, 0),
        "one": ("FAIL", 7, 3), "two": ("WARNING", 7, 2), "all": ("WARNING", 7, 1), "again": ("WARNING", 7, 3),
    }


def test_checks_of_an_empty_table(rows):
    found = {r["check_name"]: (r["status"], r["total_rows"], r["bad_rows"]) for r in
             quality.run_checks(rows("a int, b string, t timestamp_ntz"), SPECS, NOW).collect()}
    assert found == {s.name: ("FAIL" if s.name in ("rows", "fresh") else "PASS", 0, 0) for s in SPECS}


def stored():
    value = F.col("v")
    return Stored(["k", "y"], sums={"total": value}, counts={"big": value > 5}, lows={"low": value}, highs={"high": value})


def test_maintained_sums_equal_recomputation(spark, rows, tmp_path):
    rng = random.Random(6)
    schema = "i int, k string, y int, v int"
    row = lambda i: (i, rng.choice(["a", "b", "c", None]), rng.choice([1, 2, None]), rng.choice([None, *range(10)]))
    base = [row(i) for i in range(60)] + [(900, "lone", 1, 3), (901, "nulls", 1, None), (902, "nulls", 1, 7)]
    target = stored()
    path = f"{tmp_path}/0"
    target.compute(rows(schema, *base)).write.parquet(path)
    for step in range(5):
        gone = rng.sample(range(len(base)), 9) if step < 3 else []
        if step == 0:
            gone = [n for n, r in enumerate(base) if r[0] in (900, 902)]
        changed = rng.sample([n for n in range(len(base)) if n not in gone], 6)
        fresh = [row(1000 * (step + 1) + j) for j in range(5)]
        removed = [base[n] for n in [*gone, *changed]]
        added = [(base[n][0], *row(0)[1:]) for n in changed] + fresh
        base = [r for n, r in enumerate(base) if n not in {*gone, *changed}] + added
        current, new = rows(schema, *base), f"{tmp_path}/{step + 1}"
        refresh_stored(spark, target, path, new, rows(schema, *removed), rows(schema, *added), current)
        path = new
        have = sorted(map(str, target.visible(spark.read.parquet(path)).collect()))
        assert have == sorted(map(str, target.visible(target.compute(current)).collect())), step


def test_rows_are_read_again_only_for_lost_extremes(spark, rows):
    schema = "k string, y int, v int"
    target = stored()
    state = target.compute(rows(schema, ("a", 1, 1), ("a", 1, 5), ("a", 1, 9), ("b", 1, 4)))
    unread = spark.range(1).select(F.raise_error(F.lit("read")).cast("string").alias("k"), F.lit(1).alias("y"), F.lit(1).alias("v"))
    middle = target.changes(state, rows(schema, ("a", 1, 5)), rows(schema, ("b", 1, 2)), unread)
    assert sorted((r["k"], r["low"], r["high"], r["total"]) for r in middle.collect()) == [("a", 1, 9, 10), ("b", 2, 4, 6)]
    with pytest.raises(Exception, match="read"):
        target.changes(state, rows(schema, ("a", 1, 9)), rows(schema), unread)


def test_season_sums_as_stored_aggregation(rows):
    from lapwise.plans import gold

    schema = (
        "raceId long, driverId long, constructorId string, year int, position int, points double, finished_race boolean, "
        "podium_finish boolean, dnf_status boolean, fastestLap int"
    )
    facts = rows(schema, (1, 1, "x", 2000, 1, 25.0, True, True, False, 1), (2, 1, "x", 2000, None, 0.0, False, False, True, 2),
                 (3, 2, "y", 2001, 9, None, True, False, False, None))
    kept = gold.stored_seasons()
    names = sorted(kept.columns)
    want = gold.season_partials(facts).select(*names).collect()
    assert sorted(map(str, kept.visible(kept.compute(facts)).select(*names).collect())) == sorted(map(str, want))
