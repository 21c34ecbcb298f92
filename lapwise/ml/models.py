"""Model training, comparison and scoring with Spark ML.

A model is always one fitted ``PipelineModel`` (assemble, standardise, estimate), so scoring uses the statistics
of the training data and saving keeps everything together.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark import SparkContext, StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapwise.functions import metrics as M
from lapwise.functions.clean import clamp
from lapwise.ml.features import present

SEED = 42
# Inputs are dealt among about so many rows at a time.
CELL_ROWS = 50_000
# Trees keep their rows in memory with the counts of one part, about 0.6 KB each; a task takes at most about so many. Every
# task sends the sums of all nodes at every level, so smaller tasks shuffle more of them.
TASK_ROWS = 1_000_000
# Rows that carry the inputs of other rows and are copied many times are sorted in smaller tasks.
COPIED_ROWS = 200_000
# Forests of many trees are fitted in parts of at most so many, so a row never has counts for more trees than that.
PART_TREES = 25
# Forests keep the node of every row and tree instead of walking from the root at every level; the lineage is as long as
# the trees are deep, so it needs no checkpoints.
FOREST = {"cacheNodeIds": True, "checkpointInterval": -1}

Forest = RandomForestClassifier | RandomForestRegressor
ForestModel = RandomForestClassificationModel | RandomForestRegressionModel


def chain(inputs: list[str], estimator: Estimator) -> Pipeline:
    assembler = VectorAssembler(inputCols=inputs, outputCol="raw_features", handleInvalid="skip")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return Pipeline(stages=[assembler, scaler, estimator])


def split(df: DataFrame, keys: list[str], train_tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """80/20 by the MD5 of the key: the same row falls on the same side in every run, layout and engine."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    side = F.conv(F.substring(digest, 1, 7), 16, 10).cast("int") % 10
    return df.filter(side < train_tenths), df.filter(side >= train_tenths)


def tasks(df: DataFrame, rows: int, most: int | None = None) -> int:
    """Whole rounds of all cores, at most about ``most`` rows a task, else ``TASK_ROWS``."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return cores * max(1, math.ceil(rows / (cores * (most or TASK_ROWS))))


def dealt(df: DataFrame, rows: int, most: int | None = None) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt in turn to its ``tasks``.

    Files of narrow rows are read in few large splits, which are far larger in a tree's memory. Keys play no part, so
    neither a key nor a vector that many rows share fills one task.
    """
    return df.repartition(tasks(df, rows, most))


def fit(train: DataFrame, inputs: list[str], estimator: Estimator, rows: int) -> PipelineModel:
    """The chain of ``inputs`` and ``estimator`` fitted on ``train``, about ``rows`` rows; trees get their rows dealt.

    A forest over more rows than one task takes is fitted in parts and united again.
    """
    if not estimator.hasParam("maxDepth"):
        return chain(inputs, estimator).fit(train)
    assembler, scaler, last = chain(inputs, estimator).getStages()
    raw = assembler.transform(train)
    scales = scaler.fit(raw)
    ready = dealt(scales.transform(raw).select(estimator.getLabelCol(), "features"), rows)
    if last.hasParam("numTrees") and rows > TASK_ROWS:
        return PipelineModel([assembler, scales, united(last, forest_parts(ready, last))])
    return PipelineModel([assembler, scales, last.fit(ready)])


def classifiers(label: str) -> dict[str, Estimator]:
    shared = {"labelCol": label, "featuresCol": "features"}
    return {
        "random_forest": RandomForestClassifier(numTrees=100, maxDepth=10, seed=SEED, **FOREST, **shared),
        "gradient_boosting": GBTClassifier(maxIter=100, maxDepth=5, seed=SEED, **shared),
        "logistic_regression": LogisticRegression(maxIter=100, regParam=0.01, **shared),
    }


def regressors(label: str) -> dict[str, Estimator]:
    shared = {"labelCol": label, "featuresCol": "features"}
    return {
        "linear_regression": LinearRegression(maxIter=100, regParam=0.01, **shared),
        "random_forest": RandomForestRegressor(numTrees=100, maxDepth=10, seed=SEED, **FOREST, **shared),
        "gradient_boosting": GBTRegressor(maxIter=100, maxDepth=5, seed=SEED, **shared),
    }


def confusion(predictions: DataFrame, label: str) -> DataFrame:
    truth, guess = F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    return predictions.groupBy(truth, guess).agg(F.count(F.lit(1)).alias("rows"))


def classification_report(predictions: DataFrame, label: str, positive: int = 1) -> DataFrame:
    """Accuracy, precision, recall and F1 in one aggregation."""
    truth, guess = F.col(label) == positive, F.col("prediction") == positive
    counts = predictions.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(truth & guess).alias("true_positive"),
        F.count_if(~truth & guess).alias("false_positive"),
        F.count_if(truth & ~guess).alias("false_negative"),
        F.count_if(~truth & ~guess).alias("true_negative"),
    )
    hit = F.col("true_positive")
    return counts.withColumns(
        {
            "accuracy": M.ratio(hit + F.col("true_negative"), F.col("rows")),
            "precision": M.ratio(hit, hit + F.col("false_positive")),
            "recall": M.ratio(hit, hit + F.col("false_negative")),
            "f1": M.ratio(2 * hit, 2 * hit + F.col("false_positive") + F.col("false_negative")),
        }
    )


def error_report(predictions: DataFrame, label: str) -> DataFrame:
    """Errors of a regression in one aggregation: rmse, mae, r2, mape and both distributions.

    A row whose actual value is 0 has no percentage error and is left out of mape only.
    """
    truth, error = F.col(label).cast("double"), F.col(label) - F.col("prediction")
    sums = predictions.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(truth).alias("variance"),
        (F.avg(F.try_divide(F.abs(error), truth)) * 100).alias("mape"),
        F.avg(truth).alias("mean_actual"),
        F.avg("prediction").alias("mean_predicted"),
        F.stddev_samp(truth).alias("std_actual"),
        F.stddev_samp("prediction").alias("std_predicted"),
    )
    return sums.withColumn("r2", 1 - F.try_divide(F.col("mse"), F.col("variance"))).drop("mse", "variance")


def compare(
    df: DataFrame, keys: list[str], inputs: list[str], estimators: dict[str, Estimator], label: str, classify: bool
) -> tuple[PipelineModel, DataFrame]:
    """Fit every estimator on the same split; the best by AUC (or RMSE) and one row of scores per model.

    ``df`` is read several times and should be staged; memory is left to the estimators.
    """
    inputs = present(df, inputs)
    rows = df.count()
    train, test = split(df.select(*keys, label, *inputs), keys)
    best, scores = None, []
    for name, estimator in estimators.items():
        model = fit(train, inputs, estimator, rows)
        if classify:
            predictions = model.transform(test).select(label, "prediction", "rawPrediction").persist(StorageLevel.MEMORY_AND_DISK)
            auc = BinaryClassificationEvaluator(labelCol=label).evaluate(predictions)
            row = classification_report(predictions, label).first()
            predictions.unpersist()
            score, values = auc, (name, auc, row["accuracy"], row["precision"], row["recall"], row["f1"])
        else:
            row = error_report(model.transform(test), label).first()
            score, values = -row["rmse"], (name, row["rmse"], row["mae"], row["r2"], row["mape"])
        scores.append(values)
        if best is None or score > best[0]:
            best = (score, model)
    columns = ["auc", "accuracy", "precision", "recall", "f1"] if classify else ["rmse", "mae", "r2", "mape"]
    ddl = ", ".join(["model STRING", *[f"{c} DOUBLE" for c in columns]])
    return best[1], df.sparkSession.createDataFrame(scores, ddl)


def fitted(
    df: DataFrame, keys: list[str], inputs: list[str], estimator: Estimator, label: str
) -> tuple[PipelineModel, DataFrame]:
    """One model on the training side and its predictions on the other; ``df`` should be staged."""
    inputs = present(df, inputs)
    train, test = split(df.select(*keys, label, *inputs), keys)
    model = fit(train, inputs, estimator, df.count())
    return model, model.transform(test)


def forest_parts(train: DataFrame, estimator: Forest) -> list[ForestModel]:
    """A forest as several smaller ones of about the same size over the same rows, ``_votes0``, ``_votes1``, ... of a row.

    Trees of a forest know nothing of each other, so the parts are one forest; seeds lie far apart, as Spark counts the
    partitions up from them. ``train`` is kept while they are fitted.
    """
    trees = estimator.getNumTrees()
    count = math.ceil(trees / PART_TREES)
    kept = train.persist(StorageLevel.MEMORY_AND_DISK)
    parts = []
    for number in range(count):
        own = {
            estimator.numTrees: trees // count + (number < trees % count),
            estimator.seed: estimator.getSeed() + number * 1_000_003,
        }
        if isinstance(estimator, RandomForestClassifier):
            own |= {estimator.rawPredictionCol: f"_votes{number}", estimator.probabilityCol: "", estimator.predictionCol: ""}
        parts.append(estimator.fit(kept, own))
    kept.unpersist()
    return parts


def united(estimator: Forest, parts: list[ForestModel]) -> ForestModel:
    """The forest of all trees of ``parts``: it votes, weighs its inputs and is saved as if fitted at once.

    Python cannot make a model from trees, so Spark's own constructor is called.
    """
    model = type(parts[0])
    package = "classification" if model is RandomForestClassificationModel else "regression"
    jvm = getattr(SparkContext._active_spark_context._jvm.org.apache.spark.ml, package)
    kind = jvm.DecisionTreeClassificationModel if package == "classification" else jvm.DecisionTreeRegressionModel
    trees = JavaWrapper._new_java_array([tree for part in parts for tree in part._java_obj.trees()], kind)
    sizes = [parts[0].numFeatures] + ([parts[0].numClasses] if package == "classification" else [])
    own = JavaWrapper._new_java_obj(f"org.apache.spark.ml.{package}.{model.__name__}", parts[0].uid, trees, *sizes)
    return estimator._copyValues(model(own))


def voted(df: DataFrame, parts: list[RandomForestClassificationModel]) -> DataFrame:
    """The class with most votes of all parts as ``prediction``; at a tie the smallest, as in one forest."""
    for part in parts:
        df = part.transform(df)
    names = [f"_votes{number}" for number in range(len(parts))]
    arrays = df.withColumns({name: vector_to_array(name) for name in names})
    sums = [reduce(add, [F.col(name)[place] for name in names]) for place in range(parts[0].numClasses)]
    total = arrays.withColumn("_votes", F.array(*sums))
    winner = (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double")
    return total.withColumn("prediction", winner).drop("_votes", *names)


def fitted_forest(df: DataFrame, keys: list[str], inputs: list[str], estimator: RandomForestClassifier, label: str) -> DataFrame:
    """Predictions on the held-out side by a large forest fitted in parts on the other; ``df`` should be staged."""
    inputs = present(df, inputs)
    train, test = split(df.select(*keys, label, *inputs), keys)
    assembler, scaler, last = chain(inputs, estimator).getStages()
    raw = assembler.transform(train)
    scales = scaler.fit(raw)
    parts = forest_parts(dealt(scales.transform(raw).select(label, "features"), df.count()), last)
    return voted(scales.transform(assembler.transform(test)), parts)


def importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Feature and weight rows of a tree model, or absolute coefficients of a linear one."""
    names = model.stages[0].getInputCols()
    last = model.stages[-1]
    weights = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    rows = [(n, float(abs(w))) for n, w in zip(names, weights.toArray())]
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE").orderBy(F.desc("importance"), "feature")


def scored(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Batch scores: class, probability of class 1 and the probability of the class chosen."""
    chances = vector_to_array("probability")
    return model.transform(df).withColumns(
        {"win_probability": F.element_at(chances, 2), "confidence": F.array_max(chances)}
    )


def simulated(
    model: PipelineModel, scenarios: DataFrame, key: str, laps: Column, bounds: tuple[float, float] | None = None
) -> DataFrame:
    """Lap-by-lap times of each scenario with the running total.

    A regression knows nothing beyond the laps it was fitted on; with ``bounds``, the shortest and longest of these,
    predictions are kept inside them.

    ``scenarios`` has one row per race to simulate with all inputs that do not depend on the lap. Laps are
    expanded in Spark and scored in one pass; a scenario has at most ``laps`` rows in its window.
    """
    grid = scenarios.withColumn("total_laps", laps).withColumn("lap", F.explode(F.sequence(F.lit(1), "total_laps")))
    grid = grid.withColumns(
        {
            "race_progress": M.ratio(F.col("lap"), F.col("total_laps")),
            "is_early_lap": (F.col("lap") <= 5).cast("int"),
            "is_late_lap": (F.col("lap") >= F.col("total_laps") - 5).cast("int"),
            "scheduled_laps": F.col("total_laps"),
        }
    )
    grid = grid.withColumns({"scheduled_progress": F.col("race_progress"), "is_final_phase": F.col("is_late_lap")})
    predicted = F.col("prediction") if bounds is None else clamp(F.col("prediction"), *bounds)
    so_far = Window.partitionBy(key).orderBy("lap").rowsBetween(Window.unboundedPreceding, 0)
    return (
        model.transform(grid)
        .select(key, "lap", predicted.alias("predicted_lap_time_ms"))
        .withColumn("predicted_lap_time_s", F.col("predicted_lap_time_ms") / 1000)
        .withColumn("cumulative_time_s", F.sum("predicted_lap_time_s").over(so_far))
    )


def permutation_importances(
    model: PipelineModel, test: DataFrame, keys: list[str], label: str, classify: bool = False, rounds: int = 5, seed: int = SEED
) -> DataFrame:
    """How much worse a model scores when one input's values are dealt to other rows: feature, importance, spread.

    Every round and input scores a copy of the rows in which that input comes from another row, against the rows as they
    are; all copies go through the model in one pass. The other row is the next one in an order by a seeded hash of the
    keys, within a hash cell of about ``CELL_ROWS`` rows, so no task sorts all rows and a run can be repeated. The score is the
    accuracy of a classifier or minus the mean squared error of a regression; ``importance`` is the mean loss over the
    rounds, ``spread`` its standard deviation. An input the model does not use loses exactly 0.
    """
    inputs = model.stages[0].getInputCols()
    count = test.count()
    cells = F.pmod(F.xxhash64(*keys), F.lit(max(1, count // CELL_ROWS))).alias("_cell")
    kept = [F.col(f"`{n}`") for n in dict.fromkeys([*keys, label, *inputs])]
    rows = model.transform(test).select(*kept, F.col("prediction").alias("_own"), cells)
    # By size alone these narrow rows would meet in one task, however much is done with each of them.
    most = min(TASK_ROWS, COPIED_ROWS)
    shuffled = rows.repartition(tasks(rows, count, most), "_cell")
    for number in range(rounds):
        order = Window.partitionBy("_cell").orderBy(F.xxhash64(F.lit(seed + number), *keys), *keys)
        so_far = order.rowsBetween(Window.unboundedPreceding, 0)
        dealt_out = F.struct(*[F.col(f"`{n}`").alias(n) for n in inputs])
        # The last row of a cell takes the first one's values.
        value = F.coalesce(F.lead(dealt_out).over(order), F.first(dealt_out).over(so_far))
        shuffled = shuffled.withColumn(f"_r{number}", value)
    copies = []
    for number in range(rounds):
        for name in inputs:
            taken = [F.col(f"_r{number}")[n].alias(n) if n == name else F.col(f"`{n}`").alias(n) for n in inputs]
            copies.append(F.struct(F.lit(name).alias("_feature"), F.lit(number).alias("_round"), *taken))
    spread = dealt(shuffled, count, most).select(F.col(label).alias("_label"), "_own", F.inline(F.array(*copies)))

    def score(prediction: str) -> Column:
        error = F.col("_label") - F.col(prediction)
        return (error == 0).cast("double") if classify else -error * error

    # Losses are taken row by row, so rows with the same prediction lose exactly 0 in whatever order they are summed.
    losses = model.transform(spread).groupBy("_feature", "_round").agg(F.avg(score("_own") - score("prediction")).alias("_loss"))
    return losses.groupBy(F.col("_feature").alias("feature")).agg(
        F.avg("_loss").alias("importance"), F.coalesce(F.stddev_samp("_loss"), F.lit(0.0)).alias("spread")
    )


def save(model: PipelineModel, path: str, label: str | None = None, scores: DataFrame | None = None) -> None:
    """Save a model with what is needed to use it again: its inputs in order, its label and its scores if given."""
    model.write().overwrite().save(path)
    spark = SparkSession.active()
    inputs = [(i, name, label) for i, name in enumerate(model.stages[0].getInputCols())]
    spark.createDataFrame(inputs, "place INT, feature STRING, label STRING").coalesce(1).write.mode("overwrite").json(
        f"{path}/inputs"
    )
    if scores is not None:
        scores.write.mode("overwrite").json(f"{path}/scores")


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def saved_inputs(spark: SparkSession, path: str) -> DataFrame:
    """Inputs of a saved model in their order, with its label."""
    return spark.read.schema("place INT, feature STRING, label STRING").json(f"{path}/inputs").orderBy("place")


def saved_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(f"{path}/scores")
