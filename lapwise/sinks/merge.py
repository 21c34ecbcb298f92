"""Keyed upserts on plain Parquet. The path being read is never the path being written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.operators.staging import remove, stage
from lapwise.sinks.writers import clustered
from lapwise.sources.readers import read_table


# Partition values that an upsert rewrites at a time.
MAX_TOUCHED = 10_000


class DuplicateKeys(ValueError):
    """The source of an upsert has two rows for one key."""


class NullKeys(ValueError):
    """The source of an upsert has a row without key; it would be inserted again with every replay."""


def require_unique(df: DataFrame, keys: list[str]) -> None:
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    faults = df.groupBy(*keys).count().agg(
        F.coalesce(F.bool_or(no_key), F.lit(False)).alias("null"), F.max("count").alias("most")
    ).first()
    if faults["null"]:
        raise NullKeys(f"a source row has a null in {keys}")
    if (faults["most"] or 0) > 1:
        raise DuplicateKeys(f"several source rows share a key of {keys}")


def merged(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_columns: list[str] | None = None,
    newer_by: list[str] | None = None,
) -> DataFrame:
    """Target after the upsert: matched rows take ``update_columns`` (default: all) from the source, the rest of
    the source is inserted, the rest of the target stays. Null source values overwrite as well. Keys are unique on
    both sides, so the join has no hot key. With ``newer_by`` a matched row changes only if the source row is not
    older than the target row in these columns, so batches may arrive in any order."""
    columns = target.columns
    updated = [c for c in columns if c not in keys] if update_columns is None else update_columns
    old = target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in columns if c not in keys], F.lit(1).alias("_old"))
    new = source.select(
        *keys,
        *[F.col(c).alias(f"_new_{c}") if c in source.columns else F.lit(None).alias(f"_new_{c}")
          for c in columns if c not in keys],
        F.lit(1).alias("_new"),
    )

    matched = F.col("_new").isNotNull()
    if newer_by:
        sides = [F.struct(*[F.col(f"{side}_{c}").alias(c) for c in newer_by]) for side in ("_new", "_old")]
        matched = matched & (F.col("_old").isNull() | (sides[0] >= sides[1]))

    def value(name: str):
        take_new = matched if name in updated else F.col("_old").isNull()
        return F.when(take_new, F.col(f"_new_{name}")).otherwise(F.col(f"_old_{name}")).alias(name)

    return old.join(new, keys, "full_outer").select(*[F.col(c) if c in keys else value(c) for c in columns])


def upsert(
    spark: SparkSession,
    target_path: str | None,
    new_path: str,
    source: DataFrame,
    keys: list[str],
    update_columns: list[str] | None = None,
) -> DataFrame:
    """Write target plus source as a new snapshot at ``new_path``; without a target the source becomes it.

    The source is staged first: it is computed once, and the rows checked are the rows merged.
    """
    if target_path == new_path:
        raise ValueError("a snapshot must not replace the one it is built from")
    source = stage(source)
    require_unique(source, keys)
    rows = source if target_path is None else merged(read_table(spark, target_path), source, keys, update_columns)
    rows.write.mode("overwrite").parquet(new_path)
    return read_table(spark, new_path)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    partition_by: str,
    update_columns: list[str] | None = None,
    newer_by: list[str] | None = None,
) -> None:
    """Upsert in place that rewrites only the partitions that hold a key of the source or take one of its rows.

    A key whose partition value changes leaves its old partition; a null partition value is a partition like any other. A
    partition that loses its last row is removed. The merged rows of all source keys are staged before anything is
    overwritten, so a rerun after a failure starts from whole data: a key that such a run left in its old and its new
    partition is mended. A key of the source that stands several times in one partition is refused by name; other
    repeated keys of the target are none of the source's business and stay as they are. Partitions are rewritten
    ``MAX_TOUCHED`` at a time.

    Unlike ``upsert`` this replaces files of the table it reads: a reader needs the snapshot form.
    """
    source = stage(source)
    require_unique(source, keys)
    target = read_table(spark, path)
    matched = stage(target.join(source.select(*keys), keys, "left_semi"))
    _require_single(matched, keys, partition_by)
    final = stage(merged(matched.dropDuplicates(keys), source, keys, update_columns, newer_by).select(*target.columns))
    touched = stage(final.select(partition_by).union(matched.select(partition_by)).distinct())
    batch: list = []

    def rewrite() -> None:
        stays = _holds(target, partition_by, batch).join(source.select(*keys), keys, "left_anti")
        rows = stage(stays.select(*target.columns).unionByName(_holds(final, partition_by, batch)))
        filled = {row[0] for row in rows.select(partition_by).distinct().collect()}  # at most MAX_TOUCHED
        clustered(rows, [partition_by, *keys]).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(partition_by).parquet(path)
        emptied = [value for value in batch if value not in filled]
        if emptied:
            drop_partitions(_holds(target, partition_by, emptied))
        remove(rows)

    for row in touched.toLocalIterator():
        batch.append(row[0])
        if len(batch) >= MAX_TOUCHED:
            rewrite()
            batch.clear()
    if batch:
        rewrite()
    for done in (matched, final, touched, source):
        remove(done)


def _require_single(matched: DataFrame, keys: list[str], partition_by: str) -> None:
    """Refuse target rows that share a key inside one partition, naming some of the keys."""
    repeated = matched.groupBy(*keys, partition_by).count().filter("count > 1").select(*keys).limit(5).collect()
    if repeated:
        named = "; ".join(str(tuple(row)) for row in repeated)
        raise DuplicateKeys(f"several target rows share a key of {keys}: {named}")


def _holds(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is one of ``values``, null included."""
    known = [value for value in values if value is not None]
    found = F.col(column).isin(known)
    return df.filter(found | F.col(column).isNull() if None in values else found)


def drop_partitions(df: DataFrame) -> None:
    """Delete the files of a selection of whole partitions."""
    spark = df.sparkSession
    files = df.select(F.input_file_name()).distinct().collect()
    for folder in {row[0].rpartition("/")[0] for row in files}:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def repoint(spark: SparkSession, name: str, path: str) -> None:
    """Let the view ``name`` read the snapshot at ``path``."""
    read_table(spark, path).createOrReplaceTempView(name)


def newer_than(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows after the high-water mark; all rows when there is none yet."""
    return df if mark is None else df.filter(F.col(column) > F.lit(mark))


def high_water_mark(df: DataFrame, column: str):
    return df.agg(F.max(column).alias("mark")).first()["mark"]
