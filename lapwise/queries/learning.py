"""Features, models and forecasts over the given data.

Feature tables and reports have SQL counterparts; fitted models do not.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapwise.functions import clean
from lapwise.functions import metrics as M
from lapwise.ml import features as ft
from lapwise.ml import forecast as fc
from lapwise.ml import models as ml
from lapwise.ml import seasonal
from lapwise.ml import segments as sg
from lapwise import constants as C
from lapwise.operators.staging import scratch, stage
from lapwise.plans import gold, silver
from lapwise.queries.common import sql
from lapwise.queries.gold import (
    STATISTIC_ROUNDS,
    bound,
    performance,
    pit_efficiency,
    qualifying_vs_race,
    rounded,
    statistics,
    trends,
)
from lapwise.sources.binding import Binding

# The given data starts in 1995, so every season counts; driver-team seasons are short there.
SINCE = 1995
MIN_RACES = 3
SEASON_KEY = ["driverId", "constructorId", "year"]
LAP_KEY = ["raceId", "driverId", "lap"]


def _season_sums(b: Binding) -> DataFrame:
    """Sums of the results with those of their grid slots, staged: results meet parts, races and slots once."""
    return stage(gold.grid_partials(silver.race_facts(b.results(), b.races()), b.qualifying()))


def season_features(b: Binding, sums: DataFrame | None = None) -> DataFrame:
    """Stops are scored without the results, which would only add the team that a driver's season leaves out again."""
    sums = _season_sums(b) if sums is None else sums
    seasons = sums.drop(*gold.GRID_SUMS)
    stats = gold.driver_statistics(seasons, b.drivers(), b.constructors())
    teams = gold.constructor_rankings(seasons, b.drivers(), b.constructors())
    stops = gold.race_pit_scores(silver.pit_analysis(b.stops_alone(), b.races(), b.drivers()))
    return ft.season_features(stats, teams, trends(b), stops, gold.grid_means(sums, b.drivers(), b.constructors()))


def winners(b: Binding) -> DataFrame:
    return ft.winner_features(season_features(b), SINCE)


def clusters(b: Binding) -> DataFrame:
    return ft.cluster_features(season_features(b), SINCE, MIN_RACES)


def _clustered(b: Binding, k: int, *others: str):
    """Model and clustered rows, staged with their inputs and ``others`` alone."""
    return sg.segmented(stage(clusters(b).select(*dict.fromkeys([*ft.CLUSTER_FEATURES, *others]))), ft.CLUSTER_FEATURES, k)


def laps(b: Binding) -> DataFrame:
    places = silver.cleaned_results(b.results()).groupBy("raceId", "driverId").agg(F.min("position").alias("position"))
    return ft.lap_features(
        b.lap_times(), b.races(), silver.circuits(b.circuits()), silver.drivers(b.raw_drivers()), places,
        since=SINCE, min_laps=2, average_bounds=(0, 180000),
    )


def _labelled_seasons(b: Binding, label: str) -> DataFrame:
    """Labels need the results alone; laps, stops and grids are read and joined once, for the inputs."""
    sums = _season_sums(b)
    counted = {"is_winner": "total_wins", "is_podium": "total_podiums"}[label]
    seasons = gold.driver_statistics(sums, b.drivers(), b.constructors()).filter(F.col("year") >= SINCE)
    labels = seasons.select(*SEASON_KEY, F.coalesce((F.col(counted) > 0).cast("int"), F.lit(0)).alias(label))
    inputs = ft.winner_features(season_features(b, sums), SINCE)
    return stage(ft.prior_season(labels, [label], ft.WINNER_FEATURES, inputs).filter(F.col("year") > SINCE))


def _winner_forest(b: Binding):
    data = _labelled_seasons(b, "is_winner")
    forest = ml.classifiers("is_winner")["random_forest"]
    return ml.fitted(data, SEASON_KEY, ft.WINNER_FEATURES, forest, "is_winner")


def _winner_models(b: Binding) -> DataFrame:
    data = _labelled_seasons(b, "is_winner")
    return ml.compare(data, SEASON_KEY, ft.WINNER_FEATURES, ml.classifiers("is_winner"), "is_winner", True)[1]


def _podium_model(b: Binding) -> DataFrame:
    data = _labelled_seasons(b, "is_podium")
    forest = {"random_forest": ml.classifiers("is_podium")["random_forest"]}
    return ml.compare(data, SEASON_KEY, ft.WINNER_FEATURES, forest, "is_podium", True)[1]


def _lap_models(b: Binding) -> DataFrame:
    data = stage(laps(b).select(*LAP_KEY[:2], "milliseconds", *ft.LAP_FEATURES))
    # Split by race, so that no race has laps on both sides.
    return ml.compare(data, ["raceId"], [n for n in ft.LAP_FEATURES if n != "lap"], ml.regressors("milliseconds"),
                      "milliseconds", False)[1]


def _lap_regression(b: Binding):
    data = stage(laps(b).select(*LAP_KEY[:2], "milliseconds", *ft.LAP_FEATURES))
    model = ml.chain(ft.LAP_FEATURES, ml.regressors("milliseconds")["linear_regression"]).fit(data)
    return model, data


def _scores(b: Binding) -> DataFrame:
    """All seasons, scored as a batch."""
    data = _labelled_seasons(b, "is_winner")
    model, _ = ml.fitted(
        data, SEASON_KEY, ft.WINNER_FEATURES, ml.classifiers("is_winner")["random_forest"], "is_winner"
    )
    batch = data.select(*SEASON_KEY, "is_winner", *ft.WINNER_FEATURES)
    return ml.scored(model, batch).select(
        *SEASON_KEY, "is_winner", "prediction", "win_probability", "confidence"
    )


def _importances(b: Binding) -> DataFrame:
    model, _ = _winner_forest(b)
    return ml.importances(b.spark, model)


def _simulation(b: Binding) -> DataFrame:
    """One scenario per race that has laps: the mean inputs of its laps, driven over the distance of the race."""
    model, data = _lap_regression(b)
    by_lap = ("lap", "scheduled_laps", "scheduled_progress", "is_early_lap", "is_final_phase")
    fixed = [n for n in ft.LAP_FEATURES if n not in by_lap]
    scenarios = data.groupBy("raceId").agg(F.max("lap").alias("_distance"), *[F.avg(n).alias(n) for n in fixed])
    seen = data.agg(F.min("milliseconds").cast("double"), F.max("milliseconds").cast("double")).first()
    bounds = None if seen[0] is None else (seen[0], seen[1])
    return ml.simulated(model, scenarios, "raceId", F.col("_distance"), bounds)


def _reloaded(b: Binding) -> DataFrame:
    model, data = _lap_regression(b)
    path = scratch(b.spark, "lap-model")
    ml.save(model, path)
    return ml.load(path).transform(data).select(*LAP_KEY, "prediction")


def _importance_facts(b: Binding) -> DataFrame:
    weights = _importances(b)
    return weights.agg(F.count(F.lit(1)).alias("features"), F.round(F.sum("importance"), 6).alias("total"))


def _segment_facts(b: Binding) -> DataFrame:
    """Rows per season and how many have the label that the means over all rows of their label ask for.

    Every label stands for a range of means, so clusters that share a label have joint means in it too.
    """
    _, clustered = _clustered(b, 5, "year")
    scored = stage(clustered.select("year", "prediction", *sg.PROFILED))  # narrow, so rows go through the model once
    labels = sg.labelled(sg.profile(scored)).select("prediction", "cluster_label")
    found = scored.join(labels, "prediction")
    means = found.groupBy("cluster_label").agg(F.avg("win_rate").alias("_wins"), F.avg("consistency_score").alias("_even"))
    asked = means.select("cluster_label", sg.segment_label(F.col("_wins"), F.col("_even")).alias("asked"))
    return _per_year(found.join(asked, "cluster_label"), F.col("asked") == F.col("cluster_label"))


def _four_facts(b: Binding) -> DataFrame:
    """Rows per season and how many have a name whose mean win rate no later name exceeds."""
    found = stage(_four(b))
    place = F.array_position(F.array(*map(F.lit, C.FOUR_SEGMENTS)), F.col("cluster_name"))
    means = found.groupBy("cluster_name", place.alias("place")).agg(F.avg("win_rate").alias("wins"))
    later = Window.orderBy("place").rowsBetween(1, Window.unboundedFollowing)  # over four rows
    worst = means.withColumn("above", F.max("wins").over(later))
    falling = (F.col("place") > 0) & (F.col("wins") >= F.coalesce("above", F.lit(0.0)))
    return _per_year(found.join(worst.select("cluster_name", falling.alias("falling")), "cluster_name"), F.col("falling"))


def _score_facts(b: Binding) -> DataFrame:
    """Rows per season and how many have a class, a probability and a confidence that fit each other."""
    p = F.col("win_probability")
    sure = F.abs(F.col("confidence") - F.greatest(p, 1 - p)) < 1e-9
    return _per_year(_scores(b), p.between(0, 1) & sure & (F.col("prediction") == (p > 0.5).cast("double")))


def _winner_balance(b: Binding) -> DataFrame:
    """Training rows and winners, and whether the regression expects as many winners as there are.

    That is the condition of the best intercept, which no penalty touches.
    """
    train, _ = ml.split(_labelled_seasons(b, "is_winner"), SEASON_KEY)
    model = ml.chain(ft.WINNER_FEATURES, ml.classifiers("is_winner")["logistic_regression"]).fit(train)
    chance = F.element_at(vector_to_array("probability"), 2)
    rows, won = F.count(F.lit(1)), F.sum("is_winner")
    return model.transform(train).agg(
        rows.alias("rows"), won.alias("winners"), (F.abs(F.sum(chance) - won) <= 1e-3 * rows).alias("balanced")
    )


def _lap_balance(b: Binding) -> DataFrame:
    """Training laps and their mean time, and whether the regression's mean is the same."""
    train, _ = ml.split(stage(laps(b).select(*LAP_KEY[:2], "milliseconds", *ft.LAP_FEATURES)), ["raceId"])
    model = ml.chain(ft.LAP_FEATURES, ml.regressors("milliseconds")["linear_regression"]).fit(train)
    mean = F.avg(F.col("milliseconds").cast("double"))
    return model.transform(train).agg(
        F.count(F.lit(1)).alias("laps"), F.round(mean, 4).alias("mean_time"),
        (F.abs(F.avg("prediction") - mean) <= 1e-6 * mean).alias("balanced"),
    )


def _center_facts(b: Binding) -> DataFrame:
    """Per input its mean over all rows, and whether the centers, weighted by size, have that mean."""
    data = stage(clusters(b).select(*ft.CLUSTER_FEATURES))
    model, clustered = sg.segmented(data, ft.CLUSTER_FEATURES, 5)
    sizes = clustered.groupBy("prediction").agg(F.count(F.lit(1)).alias("size"))
    joint = sg.centers(b.spark, model).join(sizes, "prediction").groupBy("feature").agg(
        (F.sum(F.col("center") * F.col("size")) / F.sum("size")).alias("joint")
    )
    means = data.agg(*[F.avg(n).alias(n) for n in ft.CLUSTER_FEATURES]).unpivot([], ft.CLUSTER_FEATURES, "feature", "mean")
    # Centers are standardised, and are those of the assignment one step before.
    return means.join(joint, "feature").select(
        "feature", M.nearest(F.col("mean"), 6).alias("mean"), (F.abs("joint") < 0.01).alias("balanced")
    )


def _podium_totals(b: Binding) -> DataFrame:
    """Held-out seasons with and without a podium, over both predictions."""
    forest = ml.classifiers("is_podium")["random_forest"]
    _, predictions = ml.fitted(
        _labelled_seasons(b, "is_podium"), SEASON_KEY, ft.WINNER_FEATURES, forest, "is_podium"
    )
    return ml.confusion(predictions, "is_podium").groupBy("label").agg(F.sum("rows").alias("rows"))


def _finish_totals(b: Binding) -> DataFrame:
    """Held-out rows per true place, over all predicted places."""
    return _finish_model(b).groupBy("label").agg(F.sum("rows").alias("rows"))


def _per_year(df: DataFrame, sound) -> DataFrame:
    return df.groupBy("year").agg(F.count(F.lit(1)).alias("rows"), F.count_if(sound).alias("sound"))


def _simulation_facts(b: Binding) -> DataFrame:
    """Laps per simulated race, whether the total after the last lap is the sum of the laps, and times below zero."""
    last, whole = F.max_by("cumulative_time_s", "lap"), F.sum("predicted_lap_time_s")
    total = F.abs(last - whole) <= 1e-6 * F.sum(F.abs("predicted_lap_time_s"))
    return _simulation(b).groupBy("raceId").agg(
        F.count(F.lit(1)).alias("laps"), total.alias("adds_up"), F.count_if(F.col("predicted_lap_time_ms") < 0).alias("negative")
    )


def _permuted(b: Binding) -> DataFrame:
    """Permutation importances of the lap regression on the races it was not fitted on."""
    data = stage(laps(b).select(*LAP_KEY[:2], "milliseconds", *ft.LAP_FEATURES))
    train, test = ml.split(data, ["raceId"])
    model = ml.chain(ft.LAP_FEATURES, ml.regressors("milliseconds")["linear_regression"]).fit(train)
    return ml.permutation_importances(model, stage(test), LAP_KEY, "milliseconds")


def _permuted_facts(b: Binding) -> DataFrame:
    found = _permuted(b)
    return found.agg(
        F.count(F.lit(1)).alias("features"), F.count_if(F.col("importance").isNull()).alias("unknown"),
        F.max(F.when(F.col("feature") == "is_wet_race", F.round(F.abs("importance"), 6))).alias("constant_input"),
    )


def _saved_metadata(b: Binding) -> DataFrame:
    """Inputs and label of a saved model as read again."""
    model, _ = _lap_regression(b)
    path = scratch(b.spark, "lap-model")
    ml.save(model, path, "milliseconds")
    return ml.saved_inputs(b.spark, path)


def _reload_facts(b: Binding) -> DataFrame:
    """Predictions of the saved model against those of the model read again, per race."""
    model, data = _lap_regression(b)
    path = scratch(b.spark, "lap-model")
    ml.save(model, path)
    own = model.transform(data).withColumnRenamed("prediction", "own").drop("features", "scaled")
    again = ml.load(path).transform(own.select(*data.columns, "own"))
    return again.groupBy("raceId").agg(
        F.count(F.lit(1)).alias("laps"), F.count_if(F.col("own") != F.col("prediction")).alias("mismatches")
    )


def _sweep(b: Binding) -> DataFrame:
    return sg.sweep(stage(clusters(b).select(*ft.CLUSTER_FEATURES)), ft.CLUSTER_FEATURES)[1]


def _centers(b: Binding) -> DataFrame:
    model, _ = _clustered(b, 5)
    return sg.centers(b.spark, model)


def _segments(b: Binding) -> DataFrame:
    _, clustered = _clustered(b, 5, *sg.DESCRIBED)
    return sg.segment_table(clustered, sg.profile(clustered))


def _four(b: Binding) -> DataFrame:
    _, clustered = sg.segmented(stage(ft.filled(statistics(b))), ft.SEGMENT_FEATURES, 4)
    return sg.four_segments(clustered).select(*SEASON_KEY, "cluster_name", "win_rate")


def _finish_rows(b: Binding) -> DataFrame:
    """Circuits come from the races themselves: every row with a grid slot is of a race with results."""
    rows = ft.finish_features(qualifying_vs_race(b), statistics(b), trends(b), pit_efficiency(b), b.races())
    return rows.filter("race_position > 0")


def _finish_model(b: Binding) -> DataFrame:
    data = _finish_rows(b)
    # Rows are found from the root again at each of the six levels: kept nodes would take more room than the rows.
    forest = RandomForestClassifier(
        numTrees=200, maxDepth=6, seed=ml.SEED, subsamplingRate=0.8, labelCol="race_position", featuresCol="features"
    )
    keys = ["raceId", "driverId", "constructorId"]
    predictions = ml.fitted_forest(stage(data), keys, ft.FINISH_FEATURES, forest, "race_position")
    return ml.confusion(predictions, "race_position")


def _chances(b: Binding) -> DataFrame:
    """One scenario per qualified driver; it rains where the order is final, and drivers 1 and 2 like rain."""
    wet = b.given("orders").select(
        F.col("o_orderkey").alias("raceId"),
        F.when(F.col("o_orderstatus") == "F", "Rainy").otherwise("Sunny").alias("weather"),
    )
    scenarios = b.qualifying().join(wet, "raceId").select(
        "raceId", "weather", F.col("driverId").alias("driver"), F.col("position").alias("grid")
    )
    return rounded(
        fc.rule_chances(scenarios, [1, 2]), "win_probability", "podium_probability", "lower", "upper"
    )


def _forecast(b: Binding) -> DataFrame:
    history = b.results().join(b.races().select("raceId", "date"), "raceId").select(
        "constructorId", F.col("date").alias("ds"), F.col("points").alias("y")
    )
    ahead = fc.forecast(history, "constructorId")
    return ahead.select(
        "constructorId", F.col("ds").cast("string").alias("ds"), F.round("trend", 4).alias("trend"),
        F.round("yhat", 4).alias("yhat"),
    )


def _points_by_day(b: Binding) -> DataFrame:
    return b.results().join(b.races().select("raceId", "date"), "raceId").select(
        "constructorId", F.col("date").alias("ds"), F.col("points").alias("y")
    )


def _seasonal(b: Binding) -> DataFrame:
    ahead = seasonal.forecast(_points_by_day(b), "constructorId")
    return ahead.withColumn("ds", F.col("ds").cast("string"))


def _seasonal_facts(b: Binding) -> DataFrame:
    """Weeks of each series, and whether the fit is that of least squares."""
    found = seasonal.imbalance(_points_by_day(b), "constructorId")
    return found.select("constructorId", "weeks", (F.col("imbalance") < 1e-6).alias("least_squares"))


def _profile(b: Binding) -> DataFrame:
    """Profiles and rule labels of a known grouping: the consistency rating."""
    rated = gold.driver_consistency(statistics(b))
    return rounded(
        sg.labelled(sg.profile(rated, "consistency_rating")), "avg_total_wins", "avg_total_points", "avg_win_rate",
        "avg_consistency", "avg_finish_rate", "avg_points_per_race", "percentage",
    )


def _naive_errors(b: Binding) -> DataFrame:
    """Errors of the simplest forecast: the driver's recent mean."""
    known = laps(b).filter("driver_avg_lap_time_recent > 0").withColumn(
        "prediction", F.col("driver_avg_lap_time_recent")
    )
    report = ml.error_report(known, "milliseconds")
    return report.select("rows", *[F.round(c, 4).alias(c) for c in report.columns if c != "rows"])


def _pole_wins(b: Binding) -> DataFrame:
    return qualifying_vs_race(b).select(
        (clean.flag(F.col("race_position") == 1)).cast("int").alias("won"),
        (F.col("qualifying_position") == 1).cast("int").alias("prediction"),
    )


def _split_sizes(b: Binding) -> DataFrame:
    train, test = ml.split(statistics(b), SEASON_KEY)
    parts = train.select(F.lit("train").alias("part")).unionByName(test.select(F.lit("test").alias("part")))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))


def _running_time(b: Binding) -> DataFrame:
    upto = Window.partitionBy("raceId", "driverId").orderBy("lap").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("milliseconds").over(upto)
    return b.lap_times().select("raceId", "driverId", "lap", total.alias("cumulative_time"))


_LAP_ROUNDS = [
    "average_lap_time", "driver_avg_lap_time_recent", "circuit_avg_lap_time_recent", "lap_time_trend",
    "race_progress", "scheduled_progress",
]
_RECENT = ["driver_avg_lap_time_recent", "circuit_avg_lap_time_recent", "lap_time_trend"]

QUERIES = {
    "join5_season_features": bound(
        lambda b: rounded(
            season_features(b), *STATISTIC_ROUNDS, "fastest_lap_time", "average_lap_time", "pace_consistency",
            "pit_efficiency_score",
        )
    ),
    "ml2_winner_features": bound(
        lambda b: rounded(
            winners(b).select(
                *SEASON_KEY, "is_winner", "win_to_podium_ratio", "points_per_win", "performance_consistency",
                "qualifying_to_race_correlation", "constructor_dominance", "pace_efficiency_score",
            ),
            "performance_consistency", "qualifying_to_race_correlation", "pace_efficiency_score",
        )
    ),
    "ml3_cluster_features": bound(
        lambda b: rounded(
            clusters(b).select(
                *SEASON_KEY, "win_efficiency", "podium_efficiency", "points_per_race", "finish_rate",
                "consistency_score", "pace_quality", "pit_efficiency_normalized", "constructor_impact",
                "qualifying_strength",
            ),
            "consistency_score", "pace_quality", "pit_efficiency_normalized", "qualifying_strength",
        )
    ),
    "ml4_lap_features": bound(
        lambda b: rounded(laps(b).drop("dob", "name"), *_LAP_ROUNDS)
    ),
    "win4_recent_laps": bound(lambda b: rounded(laps(b).select(*LAP_KEY, "circuitId", *_RECENT), *_RECENT)),
    "win8_running_time": bound(_running_time),
    "agg10_cluster_profile": bound(_profile),
    "agg12_error_report": bound(_naive_errors),
    "agg13_classification_report": bound(lambda b: ml.classification_report(_pole_wins(b), "won")),
    "agg13_confusion": bound(lambda b: ml.confusion(_pole_wins(b), "won")),
    "ml7_split_sizes": bound(_split_sizes),
    "ml8_winner_models": bound(_winner_models),
    "ml8_winner_balance": bound(_winner_balance),
    "ml9_lap_balance": bound(_lap_balance),
    "ml12_center_facts": bound(_center_facts),
    "ml19_finish_totals": bound(_finish_totals),
    "ml9_lap_models": bound(_lap_models),
    "ml10_importances": bound(_importances),
    "ml11_k_sweep": bound(_sweep),
    "ml12_cluster_centers": bound(_centers),
    "ml14_driver_segments": bound(_segments),
    "ml10_importance_facts": bound(_importance_facts),
    "ml14_segment_facts": bound(_segment_facts),
    "ml15_batch_scores": bound(_scores),
    "ml15_score_facts": bound(_score_facts),
    "ml16_simulation_facts": bound(_simulation_facts),
    "ml17_reload_facts": bound(_reload_facts),
    "ml18_four_facts": bound(_four_facts),
    "ml10_permutation_importances": bound(_permuted),
    "ml10_permutation_facts": bound(_permuted_facts),
    "ml17_saved_inputs": bound(_saved_metadata),
    "ml16_race_simulation": bound(_simulation),
    "ml17_reloaded_model": bound(_reloaded),
    "ml18_four_segments": bound(_four),
    "ml19_finish_model": bound(_finish_model),
    "ml20_rule_chances": bound(_chances),
    "ml21_forecast": bound(_forecast),
    "ml21_seasonal_forecast": bound(_seasonal),
    "ml21_seasonal_coverage": bound(lambda b: seasonal.coverage(_points_by_day(b), "constructorId")),
    "ml21_seasonal_facts": bound(_seasonal_facts),
    "ml22_podium_model": bound(_podium_model),
    "ml22_podium_totals": bound(_podium_totals),
}

_SEASON = """SELECT s.*, t.team_win_rate, t.team_podium_rate, t.points_per_race AS points_per_race_constructor,
    t.dominance_score, p.fastest_lap_time, p.average_lap_time, p.pace_consistency, e.pit_efficiency_score,
    g.qualifying_position, g.position, g.qualifying_performance_score
    FROM driver_statistics s
    LEFT JOIN constructor_rankings t ON s.constructorId = t.constructorId AND s.year = t.year
    LEFT JOIN (SELECT driverId, year, min(fastest_lap_time) AS fastest_lap_time, avg(average_lap_time) AS
      average_lap_time, avg(pace_consistency) AS pace_consistency FROM lap_trends GROUP BY ALL) p
      ON s.driverId = p.driverId AND s.year = p.year
    LEFT JOIN (SELECT driverId, year, avg(pit_efficiency_score) AS pit_efficiency_score FROM pit_efficiency
      GROUP BY ALL) e ON s.driverId = e.driverId AND s.year = e.year
    LEFT JOIN (SELECT driverId, year, avg(qualifying_position) AS qualifying_position, avg(race_position) AS position,
      avg(qualifying_performance_score) AS qualifying_performance_score FROM qvr GROUP BY ALL) g
      ON s.driverId = g.driverId AND s.year = g.year"""

_SEASON_NEEDS = ["driver_statistics", "constructor_rankings", "lap_trends", "pit_efficiency", "qvr"]

_LAPS = """SELECT l.raceId, l.driverId, l.lap, l.milliseconds, t.total_laps, t.average_lap_time, y.year, y.circuitId,
    c.circuit_region, p.position, p.before, d.dob, y.name, s.sched,
    avg(l.milliseconds) OVER (PARTITION BY l.driverId ORDER BY l.raceId, l.lap ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
      AS d_recent,
    avg(l.milliseconds) OVER (PARTITION BY y.circuitId ORDER BY l.raceId, l.lap, l.driverId
      ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS c_recent
    FROM laps l JOIN (SELECT raceId, driverId, count(*) AS total_laps, CAST(sum(milliseconds) AS DOUBLE) / count(*) AS
      average_lap_time FROM laps GROUP BY ALL HAVING count(*) >= 2 AND avg(milliseconds) BETWEEN 0 AND 180000) t
      ON l.raceId = t.raceId AND l.driverId = t.driverId
    JOIN races y ON l.raceId = y.raceId
    LEFT JOIN (SELECT * FROM circuits WHERE lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180) c
      ON y.circuitId = c.circuitId
    LEFT JOIN drivers d ON l.driverId = d.driverId
    LEFT JOIN (SELECT raceId, driverId, position, lag(position) OVER (PARTITION BY driverId ORDER BY raceId) AS before
      FROM (SELECT raceId, driverId, min(position) AS position FROM facts GROUP BY raceId, driverId)) p
      ON l.raceId = p.raceId AND l.driverId = p.driverId
    LEFT JOIN (SELECT raceId, lag(d) OVER (PARTITION BY circuitId ORDER BY raceId) AS sched
      FROM (SELECT l.raceId, circuitId, max(lap) AS d FROM laps l JOIN races y ON l.raceId = y.raceId GROUP BY ALL)) s
      ON l.raceId = s.raceId"""

_LAP_NEEDS = ["laps", "races", "circuits", "drivers", "facts"]

_RECENT_SQL = """round(coalesce(d_recent, 0), 6) AS driver_avg_lap_time_recent,
    round(coalesce(c_recent, 0), 6) AS circuit_avg_lap_time_recent,
    round(coalesce((milliseconds - d_recent) / d_recent, 0), 6) AS lap_time_trend"""

_POLE = """SELECT CAST(coalesce(race_position = 1, false) AS INTEGER) AS won,
    CAST(qualifying_position = 1 AS INTEGER) AS prediction FROM qvr"""



def _training_side(*keys: str) -> str:
    """Tenth of a row by the MD5 of its key."""
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(keys)})), 1, 7) AS BIGINT) % 10"


_CLUSTER = """SELECT total_races, total_wins, total_podiums, total_points, win_rate, podium_rate,
    coalesce(average_finish_position, 0) AS average_finish_position, CAST(total_wins AS DOUBLE) / total_races AS win_efficiency,
    CAST(total_podiums AS DOUBLE) / total_races AS podium_efficiency, points_per_race, finish_rate,
    coalesce(consistency_score, 0) AS consistency_score, coalesce(1 / average_lap_time, 0) AS pace_quality,
    coalesce(pit_efficiency_score / 100, 0) AS pit_efficiency_normalized,
    coalesce(team_win_rate * dominance_score, 0) AS constructor_impact,
    coalesce(qualifying_performance_score / 10, 0) AS qualifying_strength FROM season WHERE total_races >= 3"""

SQL = {
    "ml7_split_sizes": sql(
        f"""SELECT CASE WHEN {_training_side(*SEASON_KEY)} < 8 THEN 'train' ELSE 'test' END AS part, count(*) AS "rows"
        FROM driver_statistics GROUP BY ALL""",
        "driver_statistics",
    ),
    "ml8_winner_balance": sql(
        f"""SELECT count(*) AS "rows", count(*) FILTER (total_wins > 0) AS winners, true AS balanced
        FROM driver_statistics WHERE year > {SINCE} AND {_training_side(*SEASON_KEY)} < 8""",
        "driver_statistics",
    ),
    "ml9_lap_balance": sql(
        f"""SELECT count(*) AS laps, round(avg(milliseconds), 4) AS mean_time, true AS balanced FROM lapf
        WHERE {_training_side("raceId")} < 8""",
        *_LAP_NEEDS, lapf=_LAPS,
    ),
    "ml22_podium_totals": sql(
        f"""SELECT CAST(total_podiums > 0 AS INTEGER) AS label, count(*) AS "rows" FROM driver_statistics
        WHERE year > {SINCE} AND {_training_side(*SEASON_KEY)} >= 8 GROUP BY ALL""",
        "driver_statistics",
    ),
    "ml12_center_facts": sql(
        f"""SELECT feature, round(mean, 6) AS mean, true AS balanced FROM (SELECT {', '.join(
            f'avg({name}) AS {name}' for name in ft.CLUSTER_FEATURES)} FROM clustering)
        UNPIVOT (mean FOR feature IN ({', '.join(ft.CLUSTER_FEATURES)}))""",
        *_SEASON_NEEDS, season=_SEASON, clustering=_CLUSTER,
    ),
    "ml19_finish_totals": sql(
        f"""SELECT race_position AS label, count(*) AS "rows" FROM qvr WHERE race_position > 0
        AND {_training_side("raceId", "driverId", "constructorId")} >= 8 GROUP BY ALL""",
        "qvr",
    ),
    "join5_season_features": sql(
        """SELECT * REPLACE (round(position_stddev, 6) AS position_stddev, round(consistency_score, 6) AS
        consistency_score, CAST(fastest_lap_time AS BIGINT) AS fastest_lap_time, round(average_lap_time, 6) AS
        average_lap_time, round(pace_consistency, 6) AS pace_consistency, round(pit_efficiency_score, 6) AS
        pit_efficiency_score) FROM season""",
        *_SEASON_NEEDS,
        season=_SEASON,
    ),
    "ml2_winner_features": sql(
        """SELECT driverId, constructorId, year, CAST(total_wins > 0 AS INTEGER) AS is_winner,
        CASE WHEN total_podiums > 0 THEN total_wins / total_podiums ELSE 0.0 END AS win_to_podium_ratio,
        CASE WHEN total_wins > 0 THEN total_points / total_wins ELSE 0.0 END AS points_per_win,
        round(coalesce(1 - position_stddev / average_finish_position, 0), 6) AS performance_consistency,
        round(coalesce(1.0 / (abs(qualifying_position - position) + 1), 0), 6) AS qualifying_to_race_correlation,
        coalesce(team_win_rate * dominance_score, 0) AS constructor_dominance,
        round(coalesce(1 / average_lap_time, 0), 6) AS pace_efficiency_score FROM season""",
        *_SEASON_NEEDS,
        season=_SEASON,
    ),
    "ml3_cluster_features": sql(
        """SELECT driverId, constructorId, year, total_wins / total_races AS win_efficiency,
        total_podiums / total_races AS podium_efficiency, points_per_race, finish_rate,
        round(coalesce(consistency_score, 0), 6) AS consistency_score,
        round(coalesce(1 / average_lap_time, 0), 6) AS pace_quality,
        round(coalesce(pit_efficiency_score / 100, 0), 6) AS pit_efficiency_normalized,
        coalesce(team_win_rate * dominance_score, 0) AS constructor_impact,
        round(coalesce(qualifying_performance_score / 10, 0), 6) AS qualifying_strength
        FROM season WHERE total_races >= 3""",
        *_SEASON_NEEDS,
        season=_SEASON,
    ),
    "ml10_importance_facts": f"SELECT {len(ft.WINNER_FEATURES)}::BIGINT AS features, 1.0::DOUBLE AS total",
    "ml14_segment_facts": sql(
        """SELECT year, count(*) AS "rows", count(*) AS sound FROM driver_statistics WHERE total_races >= 3
        GROUP BY year""",
        "driver_statistics",
    ),
    "ml15_score_facts": sql(
        """SELECT year, count(*) AS "rows", count(*) AS sound FROM driver_statistics WHERE year > 1995 GROUP BY year""",
        "driver_statistics",
    ),
    "ml16_simulation_facts": sql(
        """SELECT raceId, max(lap)::BIGINT AS laps, true AS adds_up, 0::BIGINT AS negative FROM lapf GROUP BY raceId""",
        *_LAP_NEEDS, lapf=_LAPS,
    ),
    "ml10_permutation_facts": f"""SELECT {len(ft.LAP_FEATURES)}::BIGINT AS features, 0::BIGINT AS unknown,
        0.0::DOUBLE AS constant_input""",
    "ml17_saved_inputs": " UNION ALL ".join(
        f"SELECT {i} AS place, '{name}' AS feature, 'milliseconds' AS label" for i, name in enumerate(ft.LAP_FEATURES)
    ),
    "ml17_reload_facts": sql(
        """SELECT raceId, count(*) AS laps, 0::BIGINT AS mismatches FROM lapf GROUP BY raceId""",
        *_LAP_NEEDS, lapf=_LAPS,
    ),
    "ml18_four_facts": sql(
        """SELECT year, count(*) AS "rows", count(*) AS sound FROM driver_statistics GROUP BY year""",
        "driver_statistics",
    ),
    "ml4_lap_features": sql(
        f"""SELECT raceId, driverId, lap, milliseconds, total_laps, round(average_lap_time, 6) AS average_lap_time,
        year, circuitId, circuit_region, coalesce(position, 0) AS position, {_RECENT_SQL},
        round(lap / total_laps, 6) AS race_progress, CAST(lap <= 5 AS INTEGER) AS is_early_lap,
        CAST(lap >= total_laps - 5 AS INTEGER) AS is_late_lap,
        CAST(coalesce(year - year(dob), 0) AS INTEGER) AS driver_experience,
        CASE WHEN before <= 5 THEN 1.0 WHEN before <= 10 THEN 0.5 ELSE 0.0 END::DOUBLE AS driver_form,
        CASE circuit_region WHEN 'Europe' THEN 'European' WHEN 'Americas' THEN 'American' WHEN 'Asia-Pacific'
          THEN 'Asian' ELSE 'Other' END AS circuit_type, 0 AS is_street_circuit,
        CASE circuit_region WHEN 'Asia-Pacific' THEN 28 WHEN 'Americas' THEN 25 ELSE 22 END AS expected_temperature,
        0.1::DOUBLE AS is_wet_race,
        CASE WHEN circuit_region = 'Asia-Pacific' THEN 1.2 ELSE 1.0 END::DOUBLE AS expected_tire_degradation,
        CASE WHEN total_laps <= 50 THEN 1 WHEN total_laps <= 70 THEN 2 ELSE 3 END AS expected_pit_stops,
        coalesce(sched, 0) AS scheduled_laps, round(coalesce(lap / sched, 0), 6) AS scheduled_progress,
        CAST(coalesce(lap >= sched - 5, false) AS INTEGER) AS is_final_phase,
        CASE WHEN coalesce(sched, 0) <= 50 THEN 1 WHEN sched <= 70 THEN 2 ELSE 3 END AS planned_pit_stops FROM lapf""",
        *_LAP_NEEDS,
        lapf=_LAPS,
    ),
    "win4_recent_laps": sql(
        f"SELECT raceId, driverId, lap, circuitId, {_RECENT_SQL} FROM lapf", *_LAP_NEEDS, lapf=_LAPS
    ),
    "win8_running_time": sql(
        """SELECT raceId, driverId, lap, CAST(sum(milliseconds) OVER (PARTITION BY raceId, driverId ORDER BY lap
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_time FROM laps""",
        "laps",
    ),
    "agg10_cluster_profile": sql(
        """SELECT *, CASE WHEN avg_win_rate > 0.2 THEN 'Elite Champions' WHEN avg_win_rate > 0.1 THEN 'Race Winners'
          WHEN avg_win_rate > 0.05 THEN 'Podium Contenders' WHEN avg_consistency > 0.7 THEN 'Consistent Finishers'
          ELSE 'Development Drivers' END AS cluster_label
        FROM (SELECT consistency_rating, count(*) AS size, round(avg(total_wins), 6) AS avg_total_wins,
        round(avg(total_points), 6) AS avg_total_points, round(avg(win_rate), 6) AS avg_win_rate,
        round(avg(consistency_score), 6) AS avg_consistency, round(avg(finish_rate), 6) AS avg_finish_rate,
        round(avg(points_per_race), 6) AS avg_points_per_race,
        round(count(*) * 100 / (SELECT count(*) FROM consistency), 6) AS percentage
        FROM consistency GROUP BY consistency_rating)""",
        "consistency",
    ),
    "agg12_error_report": sql(
        """SELECT count(*) AS "rows", round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae,
        round(avg(abs(e) / nullif(y, 0)) * 100, 4) AS mape, round(avg(y), 4) AS mean_actual, round(avg(p), 4) AS mean_predicted,
        round(stddev_samp(y), 4) AS std_actual, round(stddev_samp(p), 4) AS std_predicted,
        round(1 - avg(e * e) / var_pop(y), 4) AS r2
        FROM (SELECT CAST(milliseconds AS DOUBLE) AS y, d_recent AS p, milliseconds - d_recent AS e FROM lapf
          WHERE d_recent > 0)""",
        *_LAP_NEEDS,
        lapf=_LAPS,
    ),
    "agg13_classification_report": sql(
        """SELECT *, (true_positive + true_negative) / "rows" AS accuracy,
        true_positive / (true_positive + false_positive) AS precision,
        true_positive / (true_positive + false_negative) AS recall,
        2 * true_positive / (2 * true_positive + false_positive + false_negative) AS f1
        FROM (SELECT count(*) AS "rows", count(*) FILTER (WHERE won = 1 AND prediction = 1) AS true_positive,
        count(*) FILTER (WHERE won = 0 AND prediction = 1) AS false_positive,
        count(*) FILTER (WHERE won = 1 AND prediction = 0) AS false_negative,
        count(*) FILTER (WHERE won = 0 AND prediction = 0) AS true_negative FROM pole)""",
        "qvr",
        pole=_POLE,
    ),
    "agg13_confusion": sql(
        'SELECT won AS label, prediction, count(*) AS "rows" FROM pole GROUP BY ALL', "qvr", pole=_POLE
    ),
    "ml20_rule_chances": sql(
        """SELECT raceId, weather, driver, grid, round(p, 6) AS win_probability,
        round(least(0.99, p + 0.25), 6) AS podium_probability, round(p - 0.05, 6) AS lower, round(p + 0.05, 6) AS upper
        FROM (SELECT q.raceId, CASE WHEN o_orderstatus = 'F' THEN 'Rainy' ELSE 'Sunny' END AS weather,
          q.driverId AS driver, q.position AS grid, greatest(0.01, least(0.99, CAST(0.45 AS DOUBLE) -
          (q.position - 1) * CAST(0.08 AS DOUBLE) +
          CASE WHEN o_orderstatus = 'F' AND q.driverId IN (1, 2) THEN 0.1 ELSE 0.0 END)) AS p
          FROM qualifying q JOIN orders ON q.raceId = o_orderkey)""",
        "qualifying",
    ),
    "ml21_seasonal_facts": sql(
        """SELECT constructorId, count(DISTINCT date_trunc('week', date)) AS weeks, true AS least_squares
        FROM results r JOIN races y ON r.raceId = y.raceId GROUP BY constructorId""",
        "results", "races",
    ),
    "ml21_forecast": sql(
        """SELECT f.constructorId, strftime(f.ds, '%Y-%m-%d') AS ds, round(intercept + slope * f.t, 4) AS trend,
        round(intercept + slope * f.t + coalesce(seasonal, 0), 4) AS yhat
        FROM (SELECT *, date_diff('day', DATE '1970-01-05', ds) / 7 AS t, CAST(week(ds) AS INTEGER) AS w
          FROM (SELECT constructorId, slope, intercept, CAST(last + CAST(7 * i AS INTEGER) AS DATE) AS ds
            FROM trend, range(1, 11) r(i))) f
        LEFT JOIN (SELECT k.constructorId, CAST(week(k.ds) AS INTEGER) AS w, avg(k.y - (intercept + slope * k.t))
          AS seasonal FROM weekly k JOIN trend USING (constructorId) GROUP BY ALL) s
          ON f.constructorId = s.constructorId AND f.w = s.w""",
        "results",
        "races",
        weekly="""SELECT *, date_diff('day', DATE '1970-01-05', ds) / 7 AS t FROM (SELECT constructorId,
          CAST(date_trunc('week', date) AS DATE) AS ds, sum(points) AS y
          FROM results r JOIN races y ON r.raceId = y.raceId GROUP BY ALL)""",
        trend="""SELECT constructorId, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept, max(ds) AS last
          FROM weekly GROUP BY constructorId""",
    ),
}
