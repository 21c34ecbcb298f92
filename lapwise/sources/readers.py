"""Readers for raw files and stored tables, and the audit columns added on the way in."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.schemas import RAW, TableSpec

FORMATS = ("csv", "json", "parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header, one file or a directory. Without a schema every column is a string."""
    reader = spark.read.option("header", True).option("nullValue", "\\N")
    return (reader.schema(schema) if schema else reader).csv(path)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """JSON lines, one file or a directory. Without a schema Spark infers one with an extra pass."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """Files under ``path`` with size and time; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def detect_format(spark: SparkSession, path: str, declared: str | None = None) -> str:
    """Declared format, else the extension, else a directory holding any CSV file is CSV and any other JSON."""
    if declared:
        if declared not in FORMATS:
            raise ValueError(f"unsupported format {declared!r}")
        return declared
    extension = re.search(r"\.([A-Za-z0-9]+)/?$", path)
    if extension:
        if extension.group(1).lower() not in FORMATS:
            raise ValueError(f"unsupported file {path!r}")
        return extension.group(1).lower()
    return "json" if file_list(spark, path).filter("path LIKE '%.csv'").isEmpty() else "csv"


def read_source(
    spark: SparkSession, path: str, declared: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    fmt = detect_format(spark, path, declared)
    if fmt == "csv":
        return read_csv(spark, path, schema)
    if fmt == "json":
        return read_json(spark, path, schema)
    return read_table(spark, path)


def read_raw(spark: SparkSession, spec: TableSpec, base: str) -> DataFrame:
    """A raw table with its fixed schema."""
    return read_source(spark, f"{base.rstrip('/')}/{spec.source_file}", spec.source_format, RAW[spec.name])


def read_csv_or_json(spark: SparkSession, stem: str) -> DataFrame:
    """``stem.csv`` if it exists, else ``stem.json``; column names in lower case."""
    try:
        df = read_csv(spark, f"{stem}.csv")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = read_json(spark, f"{stem}.json")
    return df.toDF(*[c.lower() for c in df.columns])


def from_rows(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    """A few rows given in code, such as scoring inputs."""
    return spark.createDataFrame(rows, schema)


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append with schema evolution: a column missing on one side is null there."""
    return old.unionByName(new, allowMissingColumns=True)


def probe(spark: SparkSession, specs: list[TableSpec], base: str) -> DataFrame:
    """One row per raw table: whether it exists and is readable, files, bytes, newest time, columns and rows."""

    def facts(spec: TableSpec) -> DataFrame:
        path = f"{base.rstrip('/')}/{spec.source_file}"
        try:
            files = file_list(spark, path)
            rows = read_raw(spark, spec, base).groupBy().agg(F.count(F.lit(1)).alias("rows"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            empty = "table STRING, file_exists BOOLEAN, files BIGINT, bytes BIGINT, modified TIMESTAMP, columns STRING"
            return spark.createDataFrame([(spec.name, False, 0, 0, None, None)], empty).withColumn(
                "rows", F.lit(None).cast("long")
            )
        return files.agg(
            F.lit(spec.name).alias("table"),
            F.lit(True).alias("file_exists"),
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("bytes"),
            F.max("modificationTime").alias("modified"),
            F.lit(",".join(RAW[spec.name].names)).alias("columns"),
        ).withColumn("rows", rows.scalar())

    return reduce(DataFrame.unionByName, [facts(spec) for spec in specs])


def _clock(at: dt.datetime | None) -> Column:
    """A given wall-clock time of the session time zone, or now."""
    return F.lit(at.isoformat(" ")).cast("timestamp") if at else F.current_timestamp()


def audited(df: DataFrame, batch_id: int, at: dt.datetime | None = None) -> DataFrame:
    """Load time, load date and one batch id for all rows of the load."""
    now = _clock(at)
    return df.withColumns(
        {
            "ingestion_timestamp": now,
            "ingestion_date": now.cast("date"),
            "processing_batch_id": F.lit(batch_id).cast("long"),
        }
    )


def updated(df: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    now = _clock(at)
    return df.withColumns({"last_updated_timestamp": now, "last_updated_date": now.cast("date")})


def with_source_file(df: DataFrame) -> DataFrame:
    """File name, size and time of every row; right for directories as well. ``df`` must come from a file scan."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("source_file_name"),
        F.col("_metadata.file_size").alias("source_file_size"),
        F.col("_metadata.file_modification_time").alias("source_file_modified"),
    )
