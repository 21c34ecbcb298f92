"""Driver segmentation with k-means, and labels from cluster means."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapwise import constants as C
from lapwise.functions import metrics as M
from lapwise.ml.features import finite, present
from lapwise.ml.models import SEED, chain


def kmeans(k: int) -> KMeans:
    # The solver is named: to choose one, Spark would read all rows once more.
    return KMeans(k=k, maxIter=100, seed=SEED, initMode="k-means||", featuresCol="features", solver="row")


def _silhouette(clustered: DataFrame) -> float:
    return ClusteringEvaluator(featuresCol="features").evaluate(clustered)


def sweep(df: DataFrame, inputs: list[str], ks: range = range(2, 11)) -> tuple[int, DataFrame]:
    """Silhouette per k; the best k is the largest. Inputs are scaled once for all k; ``df`` should be staged.

    The vectors are not stored: k-means keeps the rows it iterates over itself, but would decode a stored table each time.
    """
    inputs = present(df, inputs)
    prepared = chain(inputs, kmeans(2)).getStages()
    assembled = prepared[0].transform(finite(df.select(*inputs), inputs))
    vectors = prepared[1].fit(assembled).transform(assembled).select("features")
    scores = []
    for k in ks:
        model = kmeans(k).fit(vectors)
        scores.append((k, _silhouette(model.transform(vectors)), float(model.summary.trainingCost)))
    table = df.sparkSession.createDataFrame(scores, "k INT, silhouette DOUBLE, cost DOUBLE")
    return max(scores, key=lambda s: s[1])[0], table


def segmented(df: DataFrame, inputs: list[str], k: int) -> tuple[PipelineModel, DataFrame]:
    """Model and clustered rows; infinite and NaN inputs count as 0 in both."""
    inputs = present(df, inputs)
    usable = finite(df, inputs)
    model = chain(inputs, kmeans(k)).fit(usable)
    return model, model.transform(usable)


def centers(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Cluster centers in standardised units, one row per cluster and input."""
    names = model.stages[0].getInputCols()
    rows = [
        (i, n, float(v)) for i, center in enumerate(model.stages[-1].clusterCenters()) for n, v in zip(names, center)
    ]
    return spark.createDataFrame(rows, "prediction INT, feature STRING, center DOUBLE")


# What a profile reads of the rows.
PROFILED = ["total_wins", "total_points", "win_rate", "consistency_score", "finish_rate", "points_per_race"]


def profile(clustered: DataFrame, by: str = "prediction") -> DataFrame:
    """Size, share and mean measures per cluster. The share divides by a scalar subquery over the few clusters."""
    means = clustered.groupBy(by).agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("total_wins").alias("avg_total_wins"),
        F.avg("total_points").alias("avg_total_points"),
        F.avg("win_rate").alias("avg_win_rate"),
        F.avg("consistency_score").alias("avg_consistency"),
        F.avg("finish_rate").alias("avg_finish_rate"),
        F.avg("points_per_race").alias("avg_points_per_race"),
    )
    total = clustered.agg(F.count(F.lit(1))).scalar()
    return means.withColumn("percentage", M.ratio(F.col("size") * 100, total))


def segment_label(win_rate: Column, consistency: Column) -> Column:
    tests = [(win_rate > bound, label) for bound, label in C.SEGMENT_BY_WIN_RATE]
    tests.append((consistency > C.SEGMENT_CONSISTENCY[0], C.SEGMENT_CONSISTENCY[1]))
    return F.coalesce(*[F.when(test, label) for test, label in tests], F.lit(C.SEGMENT_LAST))


def labelled(profiles: DataFrame) -> DataFrame:
    return profiles.withColumn("cluster_label", segment_label(F.col("avg_win_rate"), F.col("avg_consistency")))


# What a segment table tells of the rows besides their cluster.
DESCRIBED = [
    "driverId", "forename", "surname", "nationality", "year", "total_races", "total_wins", "total_points", "win_rate",
    "consistency_score", "finish_rate",
]


def segment_table(clustered: DataFrame, profiles: DataFrame, by: str = "prediction") -> DataFrame:
    """Drivers with the label of their cluster; the label side has one row per cluster."""
    labels = labelled(profiles).select(by, "cluster_label")
    return clustered.join(labels, by).select(
        *DESCRIBED[:5], by, "cluster_label", *DESCRIBED[5:],
    )


def four_segments(clustered: DataFrame) -> DataFrame:
    """Names for four clusters by falling mean win rate, since cluster numbers carry no meaning."""
    order = Window.orderBy(F.desc("avg_win_rate"), "prediction")
    ranked = clustered.groupBy("prediction").agg(F.avg("win_rate").alias("avg_win_rate")).withColumn(
        "rank", F.row_number().over(order)
    )
    names = F.array(*[F.lit(n) for n in C.FOUR_SEGMENTS])
    named = ranked.select("prediction", F.get(names, F.col("rank") - 1).alias("cluster_name"))
    return clustered.join(named, "prediction")
