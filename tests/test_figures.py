"""Sketched distributions, rank correlation, importances, inputs free of the race itself, recommendations."""

import datetime as dt
import random

import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lapwise.ml import features, models
from lapwise.operators import monitoring as mon
from lapwise.plans import distributions, kpis


def test_quantiles_of_rolled_up_sketches(spark):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("team"),
        (F.col("id") % 4).cast("int").alias("year"), (F.pow(F.rand(3), 3) * 100_000).cast("long").alias("v"),
    ).union(spark.range(50).select(F.lit("few"), F.lit(9), F.col("id") * 2)).union(spark.range(5).select(F.lit("few"), F.lit(9), F.lit(None).cast("long")))
    stored = distributions.sketches(rows, "v", ["team", "year"])
    dims = distributions.by_dimension(stored, ["team", "year"])
    sizes = {(r["dimension"], r["value"]): (r["n"], r["low"], r["high"]) for r in dims.collect()}
    assert sizes["team", "few"] == (50, 0, 98) == sizes["year", "9"]
    found = distributions.quantiles(dims)
    for r in distributions.rank_bounds(rows, "v", found, ["team", "year"]).collect():
        slack = 2 * distributions.rank_error() * r["n"] + 1
        assert r["below"] - slack <= r["share"] * r["n"] <= r["upto"] + slack, r
    exact = {r["share"]: r["quantile"] for r in found.filter("value = 'few'").collect()}
    assert exact[0.5] in (48, 50) and len(exact) == len(distributions.SHARES)
    assert distributions.sketches(rows.limit(0), "v", ["team"]).count() == 0


def mid_ranks(values):
    return [sum(v < x for v in values) + (sum(v == x for v in values) + 1) / 2 for x in values]


def test_rank_correlation(rows):
    rng = random.Random(4)
    data = [("hot", rng.randint(1, 30), rng.randint(1, 3000)) for _ in range(400)] + [("up", i, i * i) for i in range(9)]
    data += [("down", i, -i) for i in range(5)] + [("flat", 1, i) for i in range(4)] + [("none", None, 3), (None, 1, 2)]
    got = {r["team"]: (r["results"], r["rank_correlation"]) for r in
           kpis.rank_correlation(rows("team string, x int, y int", *data), "team", "x", "y").collect()}
    assert got["up"] == (9, pytest.approx(1.0)) and got["down"] == (5, pytest.approx(-1.0)) and got["flat"] == (4, None)
    assert got.keys() == {"hot", "up", "down", "flat"}
    a, b = (mid_ranks([d[i] for d in data if d[0] == "hot"]) for i in (1, 2))
    mean = sum(a) / len(a)
    cov = sum((p - mean) * (q - mean) for p, q in zip(a, b))
    var = (sum((p - mean) ** 2 for p in a) * sum((q - mean) ** 2 for q in b)) ** 0.5
    assert got["hot"][1] == pytest.approx(cov / var)


def test_undercut_has_no_largest_place(rows):
    far = 2**20
    stops = rows("raceId int, driverId int, stop int, lap int", (1, 1, 1, 5), (1, 2, 1, 9), (1, 3, 1, 9), (1, 4, 1, 3))
    places = rows("raceId int, driverId int, position int", (1, 1, 3), (1, 2, far), (1, 3, 2), (1, 4, far + 1))
    got = {r["driverId"]: (r["rivals"], r["beaten"]) for r in kpis.undercut_efficiency(stops, places).collect()}
    assert got == {1: (2, 1), 4: (3, 0)}
    assert kpis.undercut_efficiency(stops, places.limit(0)).count() == 0


def test_permutation_importance(spark):
    rows = spark.range(3000).select("id", (F.rand(1) * 10).alias("strong"), F.rand(2).alias("weak"), F.rand(3).alias("unused"))
    data = rows.withColumn("y", 5 * F.col("strong") + F.col("weak"))
    model = models.chain(["strong", "weak"], LinearRegression(labelCol="y", featuresCol="features")).fit(data)
    first = models.permutation_importances(model, data, ["id"], "y", rounds=3)
    got = [(r["feature"], r["importance"], r["spread"]) for r in first.orderBy(F.desc("importance")).collect()]
    assert [name for name, *_ in got] == ["strong", "weak"] and got[0][1] > 100 * got[1][1] > 0
    again = models.permutation_importances(model, data.repartition(7), ["id"], "y", rounds=3).orderBy(F.desc("importance"))
    assert [(r["feature"], pytest.approx(r["importance"])) for r in again.collect()] == [(n, v) for n, v, _ in got]
    zero = models.chain(["strong", "weak", "unused"], LinearRegression(labelCol="y", featuresCol="features", regParam=0.5, elasticNetParam=1.0)).fit(data)
    found = {r["feature"]: r["importance"] for r in models.permutation_importances(zero, data, ["id"], "y", rounds=2).collect()}
    assert found["unused"] == 0.0 and found["strong"] > 1


def test_model_is_saved_with_its_inputs(spark, tmp_path):
    data = spark.range(50).select(F.col("id").cast("double").alias("b"), F.rand(1).alias("a"), F.rand(2).alias("y"))
    model = models.chain(["b", "a"], LinearRegression(labelCol="y", featuresCol="features")).fit(data)
    scores = spark.createDataFrame([("linear", 0.5)], "model string, rmse double")
    models.save(model, f"{tmp_path}/m", "y", scores)
    assert [tuple(r) for r in models.saved_inputs(spark, f"{tmp_path}/m").collect()] == [(0, "b", "y"), (1, "a", "y")]
    assert models.saved_scores(spark, f"{tmp_path}/m").first()["rmse"] == 0.5
    assert models.load(f"{tmp_path}/m").transform(data).count() == 50


def lap_inputs(rows, laps, places):
    races = rows("raceId long, year int, circuitId int, name string", *[(r, 2020, 1 if r < 4 else 2, "x") for r in range(1, 6)])
    circuits = rows("circuitId int, circuit_region string", (1, "Europe"), (2, "Americas"))
    drivers = rows("driverId long, dob date", (1, dt.date(1990, 1, 1)), (2, dt.date(1980, 1, 1)))
    df = features.lap_features(
        rows("raceId long, driverId long, lap int, milliseconds long", *laps), races, circuits, drivers,
        rows("raceId long, driverId long, position int", *places), min_laps=2,
    )
    return {(r["raceId"], r["driverId"], r["lap"]): r for r in df.collect()}


def test_lap_inputs_do_not_depend_on_the_race_itself(rows):
    laps = [(race, driver, lap, 80_000 + 100 * lap + race) for race in (1, 2, 3, 4) for driver in (1, 2) for lap in range(1, 8 + race)]
    places = [(race, driver, driver + race) for race in (1, 2, 3, 4) for driver in (1, 2)]
    whole = lap_inputs(rows, laps, places)
    # Race 3 ends earlier, with other places and times of its last laps.
    cut = [x for x in laps if x[0] != 3 or x[2] <= 5]
    other = lap_inputs(rows, cut, [(r, d, 9 if r == 3 else p) for r, d, p in places])
    for key, row in other.items():
        if key[0] <= 3:
            assert [row[n] for n in features.LAP_FEATURES] == [whole[key][n] for n in features.LAP_FEATURES], key
    assert whole[1, 1, 1]["scheduled_laps"] == 0 == whole[4, 1, 1]["scheduled_laps"]
    assert whole[2, 1, 1]["scheduled_laps"] == 8 and whole[3, 2, 4]["scheduled_laps"] == 9
    assert whole[3, 1, 4]["is_final_phase"] == 1 and whole[1, 1, 4]["is_final_phase"] == 0
    assert whole[2, 2, 3]["driver_form"] == 1.0


def test_finish_inputs_read_the_season_before(rows):
    grid = rows(
        "raceId long, driverId long, constructorId long, year int, qualifying_position int, race_position int",
        (1, 1, 1, 2000, 4, 1), (2, 1, 1, 2001, 8, 2), (3, 1, 1, 2001, 2, 3),
    )
    none = rows("driverId long, constructorId long, year int, points_per_race double, finish_rate double")
    trends = rows("driverId long, constructorId long, year int, average_lap_time double, lap_degradation_rate double")
    pits = rows("constructorId long, year int, average_pit_time double")
    home = rows("raceId long, circuitId int", (1, 5), (2, 5), (3, 5))
    got = {r["raceId"]: r["circuit_specialization"] for r in features.finish_features(grid, none, trends, pits, home).collect()}
    assert got == {1: 0.0, 2: 4.0, 3: 4.0}


NOW = dt.datetime(2024, 5, 2)


def test_recommendations(rows):
    def found(runs, *tables):
        runs = rows("run_id int, status string, started timestamp_ntz, seconds double", *runs)
        tables = rows("table_name string, recorded timestamp_ntz", *tables)
        return sorted((r["finding"], r["subject"]) for r in mon.recommendations(runs, tables, NOW).collect())

    fine = [(i, "SUCCESS", dt.datetime(2024, 5, 1, 12), 10.0) for i in range(9)]
    old, new = ("old", dt.datetime(2024, 4, 1)), ("new", NOW)
    assert found(fine, new) == [] and found([], old) == [("no_runs", "pipeline")]
    assert found(fine + [(10, "FAILED", dt.datetime(2024, 5, 1, 12), 1.0)], new) == []
    assert found(fine[:6] + [(10, "FAILED", dt.datetime(2024, 5, 1, 12), 9000.0)], old, new) == [
        ("long_runs", "pipeline"), ("some_failures", "pipeline"), ("stale_table", "old")
    ]
    assert found(fine[:2] + [(10, "FAILED", dt.datetime(2024, 5, 1, 12), 1.0)], new) == [("many_failures", "pipeline")]
