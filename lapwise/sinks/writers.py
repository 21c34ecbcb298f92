"""Writers: partitioned and clustered tables, compaction, quarantine, retention and refresh."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.operators.staging import remove, stage
from lapwise.sinks.curve import along_curve
from lapwise.sources.readers import file_list, read_table

TARGET_FILE_BYTES = 128 << 20
MAX_RECORDS_PER_FILE = 1_000_000


def clustered(df: DataFrame, columns: list[str], partitions: int | None = None) -> DataFrame:
    """Range-cluster rows so files cover narrow key ranges and scans skip by min/max statistics.

    Ranges are cut by sampled row counts over all ``columns``, so one hot leading value spreads over several
    tasks as long as later columns differ. Sampling reads ``df`` twice, so use it on stored tables.
    """
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*columns)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    cluster_by: list[str] | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    curve_by: list[str] | None = None,
) -> None:
    """Write a table.

    With ``cluster_by`` rows are ranged by partition and key, so the files of a partition cover disjoint key ranges and
    scans skip them by their statistics; a hot partition spreads over many files. ``curve_by`` instead clusters along a
    Z-order curve: a filter on any of its columns skips files, not only one on the first. Ranging samples its input, so
    ``df`` is staged and computed once. Without either rows are only rebalanced by partition.
    """
    if cluster_by and curve_by:
        raise ValueError("a table is clustered by ranges or along a curve, not both")
    if cluster_by or curve_by:
        staged = stage(df)
        if curve_by:
            out = along_curve(staged, curve_by, partition_by)
        else:
            out = clustered(staged, [*(partition_by or []), *cluster_by])
    else:
        staged, out = None, df.hint("rebalance", *(partition_by or []))
    writer = out.write.mode(mode).format(fmt).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    if staged is not None:
        remove(staged)


def append(df: DataFrame, path: str, **layout) -> None:
    write_table(df, path, mode="append", **layout)


def register(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Make the table at ``path`` known to the catalog, creating its schema and finding its partitions."""
    database = name.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    if spark.catalog.tableExists(name) and _is_partitioned(spark, name):
        spark.sql(f"MSCK REPAIR TABLE {name}")


def _is_partitioned(spark: SparkSession, name: str) -> bool:
    return any(column.isPartition for column in spark.catalog.listColumns(name))


def compact(
    spark: SparkSession,
    path: str,
    new_path: str,
    target_bytes: int = TARGET_FILE_BYTES,
    fmt: str = "parquet",
    cluster_by: list[str] | None = None,
    curve_by: list[str] | None = None,
) -> int:
    """Rewrite small files to about ``target_bytes`` each at a new path; returns the number of files asked for.

    A table clustered by ``cluster_by`` or along a curve through ``curve_by`` stays or becomes so; otherwise
    neighbouring files are joined without a shuffle.
    """
    size = file_list(spark, path).agg(F.sum("length").alias("size")).first()["size"] or 0
    files = max(1, -(-size // target_bytes))
    rows = read_table(spark, path, fmt)
    if curve_by:
        out = along_curve(rows, curve_by, partitions=files)
    else:
        out = clustered(rows, cluster_by, files) if cluster_by else rows.coalesce(files)
    out.write.mode("overwrite").format(fmt).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).save(new_path)
    return files


def checked(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Add ``reject_reason``: the names of the rules a row breaks, empty when it keeps all. Null breaks a rule."""
    broken = [F.when(~F.coalesce(F.expr(rule), F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("reject_reason", F.concat_ws(",", *broken))


def quarantine(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Split into rows that keep all rules and rows that break one, the latter with their reasons."""
    marked = checked(df, rules)
    return marked.filter("reject_reason = ''").drop("reject_reason"), marked.filter("reject_reason <> ''")


def write_with_quarantine(df: DataFrame, rules: dict[str, str], path: str) -> tuple[DataFrame, DataFrame]:
    """Write both sides in one pass, to ``path/rejected=false`` and the side path ``path/rejected=true``, and
    return them as read from there: the rows to go on with and the rejected ones with their reasons."""
    marked = checked(df, rules).withColumn("rejected", F.col("reject_reason") != "")
    marked.write.mode("overwrite").partitionBy("rejected").parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    good = stored.filter(~F.col("rejected")).drop("rejected", "reject_reason")
    return good, stored.filter("rejected").drop("rejected")


def retained(df: DataFrame, date_column: str, days: int, as_of: dt.date) -> DataFrame:
    """Rows not older than ``days`` before ``as_of``; a row without a date is kept."""
    return df.filter(F.col(date_column).isNull() | (F.col(date_column) >= F.date_sub(F.lit(as_of), days)))


def refresh(df: DataFrame, path: str) -> DataFrame:
    """Store the current result of a query and read it from there."""
    df.write.mode("overwrite").parquet(path)
    return read_table(df.sparkSession, path)
