"""Incremental loads: batch by high-water mark, and the same as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.sinks.merge import high_water_mark, merged, newer_than, upsert, upsert_partitions
from lapwise.sources.readers import read_table


def newest_per_key(df: DataFrame, keys: list[str], ordering: list[str]) -> DataFrame:
    """Last row per key as a mergeable maximum, so many copies of one key need no sort in one task."""
    values = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*values), F.struct(*ordering))
    return df.groupBy(*keys).agg(newest.alias("r")).select(*keys, "r.*").select(*df.columns)


def incremental_merge(
    target: DataFrame,
    source: DataFrame,
    mark_column: str,
    keys: list[str],
    update_columns: list[str] | None = None,
    ordering: list[str] | None = None,
) -> DataFrame:
    """Target after merging the source rows loaded since the target's own high-water mark.

    The mark is a scalar subquery over the target, so the filter is part of the plan and reaches the source scan.
    """
    mark = target.agg(F.max(mark_column)).scalar()
    fresh = source.filter(mark.isNull() | (F.col(mark_column) > mark))
    return merged(target, newest_per_key(fresh, keys, ordering or [mark_column]), keys, update_columns)


def load_increment(
    spark: SparkSession,
    source: DataFrame,
    target_path: str | None,
    new_path: str,
    mark_column: str,
    keys: list[str],
    update_columns: list[str] | None = None,
) -> DataFrame:
    """Read the mark of the current snapshot, take newer source rows and write the next snapshot."""
    mark = high_water_mark(read_table(spark, target_path), mark_column) if target_path else None
    fresh = newest_per_key(newer_than(source, mark_column, mark), keys, [mark_column])
    return upsert(spark, target_path, new_path, fresh, keys, update_columns)


def stream_upsert(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    target_path: str,
    checkpoint: str,
    keys: list[str],
    event_time: str,
    partition_by: str,
    ordering: list[str] | None = None,
    delay: str | None = None,
    update_columns: list[str] | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Upsert all files now under ``source_path`` and stop; a later call goes on where this one ended.

    The newest row of a key by ``ordering`` (default: the event time) wins, within a batch and against the table,
    so late and repeated rows need no state. ``delay`` adds a watermark of that length and drops exact repeats
    inside it before the merge; rows later than that are then dropped too. A batch rewrites only the partitions
    of its rows, and replaying one gives the same table, so a restart after a failure is safe. The target must
    exist and be partitioned by ``partition_by``.
    """
    newer_by = ordering or [event_time]
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(source_path)
    if delay:
        stamped = rows.withColumn("_at", F.col(event_time).cast("timestamp"))
        rows = stamped.withWatermark("_at", delay).dropDuplicatesWithinWatermark(schema.names).drop("_at")

    def apply(batch: DataFrame, _: int) -> None:
        newest = newest_per_key(batch, keys, newer_by)
        upsert_partitions(spark, target_path, newest, keys, partition_by, update_columns, newer_by)

    query = (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
