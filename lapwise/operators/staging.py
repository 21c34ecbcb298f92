"""Reliable intermediate results in shared storage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; where it is unset, one below the warehouse.

    Both are shared by all executors. A machine-local temporary folder is never used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path in that storage."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table and read it from there.

    Later readers repeat none of the work, read only the columns they need, and lose nothing with an executor.
    """
    path = scratch(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(staged: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = staged.sparkSession
    folders = {name.rpartition("/")[0] for name in staged.inputFiles()}
    for folder in folders:
        if "/stage-" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
