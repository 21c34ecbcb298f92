"""Features, models, segments and forecasts."""

import datetime as dt
import hashlib

import duckdb
import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lapwise import constants as C
from lapwise.functions import metrics as M
from lapwise.ml import features, forecast, models, segments
from lapwise.plans import gold
from lapwise.queries import learning
from lapwise.sources.binding import Binding


@pytest.fixture(scope="module")
def points(spark):
    """Two inputs, a class that follows them and a value linear in them."""
    x, y = F.col("id") % 17, F.col("id") * 31 % 23
    return (
        spark.range(600)
        .select("id", x.cast("double").alias("x"), y.cast("double").alias("y"))
        .withColumns({"label": (F.col("x") + F.col("y") > 18).cast("int"), "value": 3 * F.col("x") - F.col("y") + 5})
        .cache()
    )


def test_split_is_stable_and_whole(points):
    train, test = models.split(points, ["id"])
    again, _ = models.split(points.repartition(7), ["id"])
    assert train.count() + test.count() == 600 and 400 < train.count() < 560
    assert train.select("id").exceptAll(again.select("id")).isEmpty()


def test_split_follows_the_digest_of_the_key(spark):
    keys = [(i % 7, i) for i in range(300)] + [(None, 3), (5, None), (None, None)]
    rows = spark.createDataFrame(keys, "a int, b long")
    train, test = models.split(rows, ["a", "b"])
    plain = lambda *key: int(hashlib.md5("|".join(str(k) for k in key if k is not None).encode()).hexdigest()[:7], 16) % 10
    assert {tuple(r) for r in train.collect()} == {key for key in keys if plain(*key) < 8}
    assert {tuple(r) for r in test.collect()} == {key for key in keys if plain(*key) >= 8}


def test_compare_picks_the_better_classifier(points):
    shared = {"labelCol": "label", "featuresCol": "features"}
    trials = {"good": LogisticRegression(**shared), "blind": LogisticRegression(maxIter=0, **shared)}
    best, table = models.compare(points, ["id"], ["x", "y", "absent"], trials, "label", True)
    scores = {r["model"]: r for r in table.collect()}
    assert scores["good"]["auc"] > 0.95 and scores["blind"]["auc"] == pytest.approx(0.5)
    assert best.stages[-1].coefficients.toArray().any() and best.stages[0].getInputCols() == ["x", "y"]


def test_trees_take_rows_in_even_tasks(spark, points, monkeypatch):
    """One large split, and rows that share one key and one vector: tasks stay even and bounded."""
    monkeypatch.setattr(models, "TASK_ROWS", 50)
    same = points.coalesce(1).withColumns({"x": F.lit(1.0), "label": F.lit(1)})
    sizes = models.dealt(same, 600).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 12 and max(r["count"] for r in sizes) <= 55
    seen, own = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or own(self, df))
    forest = models.classifiers("label")["random_forest"].setNumTrees(3)
    model, predictions = models.fitted(points.coalesce(1), ["id"], ["x", "y"], forest, "label")
    assert seen == [12] and predictions.count() == models.split(points, ["id"])[1].count()
    assert model.stages[-1].getNumTrees == 3 and models.classification_report(predictions, "label").first()["accuracy"] > 0.9


def test_permutation_scores_in_even_tasks(points, monkeypatch):
    """Narrow rows in one split are scored many times each: their copies are made in tasks dealt by rows, not by bytes."""
    monkeypatch.setattr(models, "TASK_ROWS", 50)
    monkeypatch.setattr(models, "CELL_ROWS", 100)
    rows = points.coalesce(1).withColumn("same", F.lit(0.1))
    inputs = ["x", "y", "same"]
    model = models.chain(inputs, LinearRegression(labelCol="value", featuresCol="features")).fit(rows)
    found = models.permutation_importances(model, rows, ["id"], "value")
    plan = found._jdf.queryExecution().toString()
    assert "RoundRobinPartitioning(12)" in plan and "hashpartitioning(_cell" in plan
    losses = {r["feature"]: (r["importance"], r["spread"]) for r in found.collect()}
    assert losses["same"] == (0.0, 0.0) and losses["x"][0] > losses["y"][0] > 1 and losses["x"][1] > 0


def test_copied_rows_take_smaller_tasks_than_trees(points):
    cores = points.sparkSession.sparkContext.defaultParallelism
    assert models.tasks(points, 5 * cores * 200_000) == cores < models.tasks(points, 5 * cores * 200_000, models.COPIED_ROWS) == 5 * cores


def test_the_sweep_lets_k_means_keep_its_rows(points, monkeypatch):
    """A table that is stored already makes k-means decode it in every iteration."""
    kept, own = [], segments.KMeans._fit
    monkeypatch.setattr(segments.KMeans, "_fit", lambda self, df: kept.append(df.storageLevel.useMemory) or own(self, df))
    best, scores = segments.sweep(points, ["x", "y", "absent"], range(2, 4))
    assert kept == [False, False] and best in (2, 3)
    assert all(r["silhouette"] > 0 and r["cost"] > 0 for r in scores.collect())


def test_forests_keep_the_node_of_each_row():
    trees = [models.classifiers("l")["random_forest"], models.regressors("l")["random_forest"]]
    assert all(t.getCacheNodeIds() and t.getNumTrees() == 100 and t.getMaxDepth() == 10 for t in trees)


def test_a_large_forest_is_fitted_in_parts_that_vote(points, monkeypatch):
    monkeypatch.setattr(models, "PART_TREES", 4)
    fits, plain = [], RandomForestClassifier.fit

    def fit(self, train, params=None):
        fits.append(plain(self, train, params))
        return fits[-1]

    monkeypatch.setattr(RandomForestClassifier, "fit", fit)
    forest = RandomForestClassifier(numTrees=10, maxDepth=4, seed=7, labelCol="label", featuresCol="features")
    found = models.fitted_forest(points, ["id"], ["x", "y"], forest, "label")
    assert [part.getNumTrees for part in fits] == [4, 3, 3]
    assert len({part.toDebugString.partition("\n")[2] for part in fits[1:]}) == 2  # same size, other draws
    rows = found.select("label", "prediction", "features").collect()
    assert len(rows) == models.split(points, ["id"])[1].count()
    for row in rows[:20]:
        votes = sum(part.predictRaw(row["features"]).toArray() for part in fits)
        assert row["prediction"] == float(votes.argmax())
    assert sum(row["prediction"] == row["label"] for row in rows) > 0.9 * len(rows)


@pytest.mark.parametrize("classify", [True, False])
def test_a_forest_over_many_rows_is_fitted_in_parts_and_united(spark, points, monkeypatch, tmp_path, classify):
    """Findings F2, F5 to F9: a row had counts and two nodes for all trees at once."""
    monkeypatch.setattr(models, "TASK_ROWS", 50)
    monkeypatch.setattr(models, "PART_TREES", 4)
    label = "label" if classify else "value"
    forest = (models.classifiers if classify else models.regressors)(label)["random_forest"].setNumTrees(10).setMaxDepth(4)
    parts, plain = [], type(forest).fit
    monkeypatch.setattr(type(forest), "fit", lambda self, df, params=None: parts.append(plain(self, df, params)) or parts[-1])
    model, found = models.fitted(points, ["id"], ["x", "y"], forest, label)
    whole = model.stages[-1]
    assert [p.getNumTrees for p in parts] == [4, 3, 3] and whole.getNumTrees == 10
    assert [t.toDebugString for p in parts for t in p.trees] == [t.toDebugString for t in whole.trees]
    assert model.stages[0].getInputCols() == ["x", "y"] and sum(whole.featureImportances.toArray()) == pytest.approx(1.0)
    columns = ["prediction", *(["rawPrediction", "probability"] if classify else [])]
    rows = found.select(label, "features", *columns).collect()
    assert len(rows) == models.split(points, ["id"])[1].count() > 50
    for row in rows[:20]:
        if classify:
            votes = sum(p.predictRaw(row["features"]).toArray() for p in parts)
            assert row["rawPrediction"].toArray() == pytest.approx(votes) and row["prediction"] == float(votes.argmax())
            assert row["probability"].toArray() == pytest.approx(votes / 10)
        else:
            sums = sum(p.predict(row["features"]) * p.getNumTrees for p in parts)
            assert row["prediction"] == pytest.approx(sums / 10)
    models.save(model, str(tmp_path / "m"))
    again = models.load(str(tmp_path / "m")).transform(points)
    assert again.select("id", "prediction").exceptAll(model.transform(points).select("id", "prediction")).isEmpty()


def test_small_rows_are_fitted_at_once(points, monkeypatch):
    monkeypatch.setattr(models, "PART_TREES", 2)
    monkeypatch.setattr(models, "forest_parts", None)
    forest = models.classifiers("label")["random_forest"].setNumTrees(3)
    assert models.fitted(points, ["id"], ["x", "y"], forest, "label")[0].stages[-1].getNumTrees == 3


def test_compare_picks_the_smaller_error(points):
    shared = {"labelCol": "value", "featuresCol": "features"}
    trials = {"flat": LinearRegression(regParam=1e6, **shared), "line": LinearRegression(**shared)}
    best, table = models.compare(points, ["id"], ["x", "y"], trials, "value", False)
    scores = {r["model"]: r for r in table.collect()}
    assert scores["line"]["rmse"] < 1e-6 < scores["flat"]["rmse"] and scores["line"]["r2"] == pytest.approx(1.0)
    assert best.stages[-1].getRegParam() == 0.0


def test_scores_importances_and_reload(spark, points, tmp_path):
    forest = RandomForestClassifier(numTrees=5, seed=1, labelCol="label", featuresCol="features")
    model, predictions = models.fitted(points, ["id"], ["x", "y"], forest, "label")
    weights = models.importances(spark, model).collect()
    assert sum(r["importance"] for r in weights) == pytest.approx(1.0) and {r["feature"] for r in weights} == {"x", "y"}
    scored = models.scored(model, points)
    assert scored.filter("win_probability < 0 OR win_probability > 1 OR confidence < 0.5").isEmpty()
    models.save(model, str(tmp_path / "m"))
    models.save(model, str(tmp_path / "m"))
    again = models.scored(models.load(str(tmp_path / "m")), points)
    pick = ["id", "prediction", "win_probability"]
    assert scored.select(*pick).exceptAll(again.select(*pick)).isEmpty()
    assert models.confusion(predictions, "label").agg(F.sum("rows")).first()[0] == predictions.count()


def test_reports(rows):
    got = models.error_report(rows("y DOUBLE, prediction DOUBLE", (1.0, 2.0), (3.0, 3.0), (5.0, 4.0)), "y").first()
    assert got["rmse"] == pytest.approx((2 / 3) ** 0.5) and got["mae"] == pytest.approx(2 / 3)
    assert got["r2"] == pytest.approx(1 - 2 / 8) and got["mape"] == pytest.approx((1 + 0 + 0.2) / 3 * 100)
    table = rows("y INT, prediction DOUBLE", (1, 1.0), (1, 0.0), (0, 1.0), (0, 0.0), (0, 0.0))
    got = models.classification_report(table, "y").first()
    assert (got["accuracy"], got["precision"], got["recall"], got["f1"]) == (0.6, 0.5, 0.5, 0.5)
    none = models.classification_report(rows("y INT, prediction DOUBLE", (0, 0.0)), "y").first()
    assert none["precision"] is None and none["accuracy"] == 1.0


def test_simulation_adds_up(spark, rows):
    train = spark.range(200).select(
        *[F.lit(0.0 + i).alias(n) for i, n in enumerate(["total_laps", "race_progress", "is_early_lap", "is_late_lap"])],
        (F.col("id") % 20).alias("lap"), (F.col("id") % 7).cast("double").alias("heat"),
    ).withColumn("ms", 1000 + 10 * F.col("lap") + F.col("heat"))
    line = LinearRegression(labelCol="ms", featuresCol="features")
    model = models.chain(["lap", "heat", "race_progress"], line).fit(train)
    got = models.simulated(model, rows("race INT, heat DOUBLE", (1, 2.0), (2, 0.0)), "race", F.lit(5)).collect()
    first = sorted((r["lap"], r["predicted_lap_time_ms"], r["cumulative_time_s"]) for r in got if r["race"] == 1)
    assert [lap for lap, _, _ in first] == [1, 2, 3, 4, 5]
    assert first[0][1] == pytest.approx(1012) and first[4][2] == pytest.approx(sum(1002 + 10 * i for i in range(1, 6)) / 1000)


def test_segments(spark):
    far = spark.range(80).select(
        F.col("id").alias("driverId"), *[F.lit("x").alias(n) for n in ("forename", "surname", "nationality")],
        F.lit(2000).alias("year"), *[F.lit(1).alias(n) for n in ("total_races", "total_wins")],
        *[F.lit(1.0).alias(n) for n in ("total_points", "finish_rate", "points_per_race")],
        (F.col("id") % 4 * 0.25).alias("win_rate"), (F.col("id") % 4 * 0.25).alias("podium_rate"),
        (10.0 - F.col("id") % 4).alias("average_finish_position"), (F.col("id") % 4 * 0.2).alias("consistency_score"),
    )
    best, table = segments.sweep(far, features.SEGMENT_FEATURES, range(2, 6))
    assert best == 4 and table.count() == 4
    model, clustered = segments.segmented(far, features.SEGMENT_FEATURES, 4)
    assert segments.centers(spark, model).count() == 16
    named = {r["win_rate"]: r["cluster_name"] for r in segments.four_segments(clustered).collect()}
    assert named == dict(zip([0.75, 0.5, 0.25, 0.0], C.FOUR_SEGMENTS))
    profiles = segments.profile(clustered)
    assert profiles.agg(F.sum("percentage")).first()[0] == pytest.approx(100.0)
    labels = {r["win_rate"]: r["cluster_label"] for r in segments.segment_table(clustered, profiles).collect()}
    assert labels == {0.75: "Elite Champions", 0.5: "Elite Champions", 0.25: "Elite Champions", 0.0: "Development Drivers"}


def test_segment_label_bounds(rows):
    df = rows("w DOUBLE, c DOUBLE", (0.21, 0.0), (0.2, 0.0), (0.1, 0.0), (0.05, 0.71), (0.05, 0.7), (None, None))
    got = [r[0] for r in df.select(segments.segment_label(F.col("w"), F.col("c"))).collect()]
    assert got == [
        "Elite Champions", "Race Winners", "Podium Contenders", "Consistent Finishers", "Development Drivers",
        "Development Drivers",
    ]


def test_rule_chances(rows):
    df = rows(
        "grid INT, weather STRING, driver STRING",
        (1, "Sunny", "a"), (7, "Sunny", "a"), (20, "Sunny", "a"), (1, "Rainy", "a"), (1, "Rainy", "b"),
    )
    got = [(round(r["win_probability"], 6), round(r["podium_probability"], 6)) for r in
           forecast.rule_chances(df, ["a"]).collect()]
    assert got == [(0.45, 0.7), (0.01, 0.26), (0.01, 0.26), (0.55, 0.8), (0.45, 0.7)]


def test_forecast_follows_a_line(spark):
    history = spark.range(20).select(
        F.lit("s").alias("k"), F.date_add(F.lit(dt.date(2000, 1, 3)), (F.col("id") * 7).cast("int")).alias("ds"),
        (F.col("id") * 2.0).alias("y"),
    ).unionByName(spark.createDataFrame([("one", dt.date(2000, 1, 5), 3.0)], "k STRING, ds DATE, y DOUBLE"))
    got = forecast.forecast(history, "k").orderBy("k", "ds").collect()
    line = [r for r in got if r["k"] == "s"]
    assert len(line) == 10 and line[0]["ds"] == dt.date(2000, 5, 22)
    assert [round(r["yhat"], 6) for r in line] == [40.0 + 2 * i for i in range(10)]
    assert {r["yhat"] for r in got if r["k"] == "one"} == {3.0}


def test_prior_season_uses_last_year_only(rows, values):
    df = rows(
        "driverId INT, constructorId INT, year INT, is_winner INT, points DOUBLE",
        (1, 1, 2000, 1, 10.0), (1, 1, 2001, 0, 20.0), (1, 2, 2001, 1, 30.0), (1, 1, 2003, 1, 40.0),
    )
    got = values(features.prior_season(df, ["is_winner"], ["points"]), "constructorId", "year", "is_winner", "points")
    assert got == [(1, 2000, 1, 0.0), (1, 2001, 0, 10.0), (1, 2003, 1, 0.0), (2, 2001, 1, 0.0)]


@pytest.mark.parametrize("label", ["is_winner", "is_podium"])
def test_labels_do_not_join_the_inputs_a_second_time(spark, monkeypatch, label):
    plans = []
    monkeypatch.setattr(learning, "stage", lambda df: plans.append(df) or df)
    b = Binding(spark, "/root/testdata/sf0.001")
    found = learning._labelled_seasons(b, label)
    # Laps are read for the numbering, its totals and the years of the trends; a second side would double that.
    reads = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("event_id#")
    assert 0 < reads(found) == reads(learning.winners(b))
    old = learning.winners(b).withColumn("is_podium", (F.col("total_podiums") > 0).cast("int"))
    keys = [*learning.SEASON_KEY, label]
    whole = features.prior_season(old, [label], features.WINNER_FEATURES).filter("year > 1995")
    assert sorted(map(tuple, found.select(keys).collect())) == sorted(map(tuple, whole.select(keys).collect()))
    sums = lambda df: df.agg(*[F.round(F.sum(n), 3) for n in features.WINNER_FEATURES]).first()
    assert tuple(sums(found)) == pytest.approx(tuple(sums(whole)))


def test_season_features_do_not_multiply_rows(rows):
    stats = rows("driverId INT, constructorId INT, year INT, total_wins INT", (1, 1, 2000, 1), (1, 2, 2000, 0))
    team = rows(
        "constructorId INT, year INT, team_win_rate DOUBLE, team_podium_rate DOUBLE, points_per_race DOUBLE, "
        "dominance_score DOUBLE", (1, 2000, 0.5, 0.5, 1.0, 2.0),
    )
    trends = rows(
        "driverId INT, year INT, fastest_lap_time LONG, average_lap_time DOUBLE, pace_consistency DOUBLE",
        (1, 2000, 5, 10.0, 0.5), (1, 2000, 4, 20.0, 0.7),
    )
    pits = rows("driverId INT, year INT, pit_efficiency_score DOUBLE", (1, 2000, 1.0), (1, 2000, 3.0))
    grid = rows(
        "driverId INT, year INT, qualifying_position INT, race_position INT, qualifying_performance_score INT",
        (1, 2000, 1, 3, 10), (1, 2000, 3, 5, 10),
    )
    got = {r["constructorId"]: r for r in features.season_features(stats, team, trends, pits, grid).collect()}
    assert len(got) == 2 and got[2]["team_win_rate"] is None
    assert (got[1]["average_lap_time"], got[1]["pit_efficiency_score"], got[1]["qualifying_position"]) == (15.0, 2.0, 2.0)


def test_division_by_zero_is_that_of_sql(rows, values):
    """Findings F3 to F7: a mean lap of no time made 0 where SQL has infinity."""
    df = rows("a DOUBLE, b DOUBLE", (2.0, 4.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 0.0), (1.0, None))
    got = [str(r[0]) for r in df.select(M.quotient(F.col("a"), F.col("b"))).collect()]
    assert got == ["0.5", "inf", "-inf", "nan", "None", "None"]


def test_rounding_is_that_of_sql(rows):
    """Finding F4: 323 / 640 is stored just below a tie at six places and was rounded up."""
    values = [323 / 640, 41 / 640, 6.25e-05, -2.5, float("inf"), None]
    df = rows("v DOUBLE", *[(v,) for v in values])
    wanted = [duckdb.execute("SELECT round(?::DOUBLE, 6)", [v]).fetchone()[0] for v in values]
    assert [r[0] for r in df.select(M.nearest(F.col("v"), 6)).collect()] == wanted


def test_trend_after_laps_of_no_time(rows):
    laps = rows("raceId LONG, driverId LONG, lap INT, milliseconds LONG", *[(1, 1, i + 1, t) for i, t in enumerate((0, 0, 70, 70))])
    got = features.lap_features(
        laps, rows("raceId LONG, year INT, circuitId INT, name STRING", (1, 2020, 1, "a")),
        rows("circuitId INT, circuit_region STRING", (1, "Europe")), rows("driverId LONG, dob DATE", (1, dt.date(1990, 1, 1))),
        rows("raceId LONG, driverId LONG, position INT", (1, 1, 1)), min_laps=2, average_bounds=(0, 180000),
    )
    found = got.orderBy("lap").select("driver_avg_lap_time_recent", F.round("lap_time_trend", 6).alias("t")).collect()
    assert [str(r["t"]) for r in found] == ["0.0", "nan", "inf", "2.0"] and found[0][0] == 0.0


def test_pace_of_seasons_of_no_time(rows):
    seasons = rows(
        "driverId LONG, constructorId STRING, year INT, total_races LONG, total_wins LONG, total_podiums LONG, total_points "
        "DOUBLE, position_stddev DOUBLE, average_finish_position DOUBLE, qualifying_position DOUBLE, position DOUBLE, "
        "team_win_rate DOUBLE, dominance_score DOUBLE, average_lap_time DOUBLE, pit_efficiency_score DOUBLE, "
        "qualifying_performance_score DOUBLE",
        *[(i, "a", 2020, 12, 1, 1, 9.0, 1.0, 2.0, 1.0, 1.0, 0.1, 2.0, t, 1.0, 5.0) for i, t in enumerate((0.0, 4.0, None))],
    )
    pick = lambda df, name: [r[0] for r in df.orderBy("driverId").select(name).collect()]
    assert pick(features.winner_features(seasons), "pace_efficiency_score") == [float("inf"), 0.25, 0.0]
    clusters = features.cluster_features(seasons)
    assert pick(clusters, "pace_quality") == [float("inf"), 0.25, 0.0]
    # Models read 0 there: centers stay numbers and no row is lost.
    model, found = segments.segmented(clusters, ["total_points", "pace_quality"], 2)
    assert found.count() == 3 and all(abs(v) < 10 for center in model.stages[-1].clusterCenters() for v in center)
    assert all(abs(r["cost"]) < 10 for r in segments.sweep(clusters, ["total_points", "pace_quality"], range(2, 3))[1].collect())


def test_seasons_read_the_results_once(spark, monkeypatch):
    """Findings F25, F26: results were joined with parts and races three times, and all columns stored to be clustered."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    staged, own = [], learning.stage
    monkeypatch.setattr(learning, "stage", lambda df: staged.append(df) or own(df))
    model, clustered = learning._clustered(Binding(spark, "/root/testdata/sf0.001"), 5, "year")
    # Once for the results and once for the grid; what is joined to their sums reads no result again.
    assert [plan(df).count("Relation [l_orderkey") for df in staged] == [2, 0]
    assert set(staged[1].columns) == {"year", *features.CLUSTER_FEATURES}
    assert model.stages[-1].getOrDefault("solver") == "row" and clustered.count() == staged[1].count()


def test_grid_means_are_those_of_the_rows(rows, values):
    facts = rows(
        "raceId INT, driverId INT, constructorId STRING, year INT, position INT, points DOUBLE, fastestLap INT, "
        "finished_race BOOLEAN, podium_finish BOOLEAN, dnf_status BOOLEAN",
        *[(race, driver, team, 2000, place, 1.0, 1, True, False, False) for race, driver, team, place in (
            (1, 1, "a", 2), (1, 1, "b", None), (2, 1, "a", 7), (3, 1, "a", 9), (1, 2, "a", 1), (1, 3, "c", 4), (4, None, "a", 5))],
    )
    # Driver 1 starts race 1 twice and race 3 not at all, race 2 has no place; driver 2 is unknown, as is team c.
    grid = rows(
        "raceId INT, driverId INT, position INT", (1, 1, 4), (1, 1, 12), (2, 1, None), (1, 2, 1), (1, 3, 2), (4, None, 3)
    )
    drivers = rows("driverId INT, forename STRING, surname STRING, nationality STRING", *[(i, "f", "s", "n") for i in (1, 3)])
    teams = rows(
        "constructorId STRING, constructorName STRING, constructorNationality STRING", ("a", "A", "x"), ("b", "B", "x")
    )
    whole = gold.qualifying_vs_race(grid, facts.join(drivers, "driverId").join(teams, "constructorId"))
    names = ["qualifying_position", "race_position", "qualifying_performance_score"]
    wanted = values(whole.groupBy("driverId", "year").agg(*[F.avg(n).alias(n) for n in names]))
    assert values(gold.grid_means(gold.grid_partials(facts, grid), drivers, teams)) == wanted == [(1, 2000, 4.0, 4.5, 11 / 3)]


def test_finish_rows_take_circuits_from_the_races(spark, monkeypatch):
    """Findings F1, F4: all results met their races, drivers and teams once more for the circuits, and nodes were kept."""
    b = Binding(spark, "/root/testdata/sf0.001")
    twice = b.races().union(b.races().filter("raceId % 3 = 0"))
    moved = twice.union(b.races().filter("raceId % 5 = 0").withColumn("circuitId", (F.col("circuitId") + 1).cast("int")))
    monkeypatch.setattr(b, "races", lambda: moved)
    parts = [learning.qualifying_vs_race(b), learning.statistics(b), learning.trends(b), learning.pit_efficiency(b)]
    whole = features.finish_features(*parts, learning.performance(b)).filter("race_position > 0")
    reads = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey")
    found = learning._finish_rows(b)
    assert reads(found) < reads(whole)
    rounded = lambda df: df.select(*[F.round(n, 6) if k == "double" else F.col(n) for n, k in df.dtypes])
    assert sorted(map(str, rounded(found).collect())) == sorted(map(str, rounded(whole).collect()))
    taken = []
    monkeypatch.setattr(learning.ml, "fitted_forest", lambda *a: taken.append(a[3]) or spark.createDataFrame([(1, 1.0)], "race_position INT, prediction DOUBLE"))
    assert learning._finish_model(b).count() == 1
    assert not taken[0].getCacheNodeIds() and (taken[0].getNumTrees(), taken[0].getMaxDepth()) == (200, 6)


def test_stops_are_numbered_alone(spark):
    b = Binding(spark, "/root/testdata/sf0.001")
    found, whole = b.stops_alone(), b.pit_stops().drop("lap")
    assert found.schema == whole.schema and found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()
    assert b.unnumbered_laps().count() == b.lap_times().count()
