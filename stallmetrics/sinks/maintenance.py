"""Backup, delete, replace, rebuild, swap and restore for partitioned Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stallmetrics.functions.filters import not_on_day, on_day
from stallmetrics.schemas import PARTITION_COLUMN
from stallmetrics.sinks.tables import (
    WHOLE, balanced, cluster_columns, gathered, note_clustering, write_clustered, write_copied)
from stallmetrics.sources import paths


def backup_partition(spark: SparkSession, path: str, day, backup: str, column: str = PARTITION_COLUMN) -> None:
    """Copy one day aside, into the day's own folder below ``backup``.

    A complete copy is kept as it is; what an interrupted run left is written anew.
    """
    target = f"{backup}/{column}={day}"
    if not paths.exists(spark, f"{target}/_SUCCESS"):
        rows = spark.read.parquet(path).filter(on_day(day, column))
        rows.drop(column).write.mode("overwrite").parquet(target)


def backup_table(spark: SparkSession, path: str, backup: str, column: str = PARTITION_COLUMN) -> None:
    """Copy the whole table; fails if the backup exists. Its files are copied as they lie, unless they
    are many small ones."""
    rows = spark.read.parquet(path)
    if gathered(spark, path):
        write_copied(rows, backup, column, cluster_columns(spark, path))
    else:
        balanced(rows, column).write.mode("errorifexists").options(**WHOLE).partitionBy(column).parquet(backup)


def delete_partition(spark: SparkSession, path: str, day, column: str = PARTITION_COLUMN) -> bool:
    """Drop one day: the partition's directory, or the partition of a catalog table."""
    if "/" in path:
        return paths.delete(spark, f"{path}/{column}={day}")
    spark.sql(f"ALTER TABLE {path} DROP IF EXISTS PARTITION ({column} = DATE'{day}')")
    return True


def replace_partition(clean: DataFrame, path: str, column: str = PARTITION_COLUMN, dealt: bool = False) -> None:
    """Replace exactly the days that occur in ``clean``, partition by partition when the write commits.

    ``clean`` must not read the days it replaces: take it from a backup. Rows that are in parts of days already
    (``dealt``) are written as they are.
    """
    writer = (clean if dealt else balanced(clean, column)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.options(**WHOLE).partitionBy(column).parquet(path)


# The published MERGE with ON FALSE deletes the day and inserts the clean rows,
# which is a partition replace.
merge_replace = replace_partition


def restore_partition(spark: SparkSession, backup: str, path: str, day, column: str = PARTITION_COLUMN) -> None:
    """Put a backed-up day back; fails if the backup does not hold the day."""
    rows = spark.read.parquet(backup).filter(on_day(day, column))
    if rows.isEmpty():
        raise ValueError(f"{backup} has no rows of {day}")
    replace_partition(rows, path, column)


def rebuild_table(spark: SparkSession, path: str, day, clean: DataFrame, out: str,
                  column: str = PARTITION_COLUMN, cluster: str = "order_id") -> None:
    """New table: all other days (rows without a date included) plus the clean day. It keeps
    the table's own clustering; ``cluster`` is for a table without any. Files of the other days are
    copied as they lie, unless they are many small ones; only the clean day is shuffled."""
    cluster = next(iter(cluster_columns(spark, path)), cluster)
    others = spark.read.parquet(path).filter(not_on_day(day, column))
    if gathered(spark, path):
        write_copied(others.unionByName(balanced(clean, column)), out, column, [cluster])
        note_clustering(spark, out, cluster)
    else:
        write_clustered(others.unionByName(clean), out, column, cluster)


def swap_table(spark: SparkSession, new: str, current: str, backup: str) -> None:
    """Put ``new`` in the place of ``current``, which is kept as ``backup``.

    ``backup`` must not exist: a rename would move the table inside it. If the second rename
    fails, the first is undone; after a crash between them ``backup`` is the table.
    """
    if not paths.exists(spark, f"{new}/_SUCCESS"):
        raise ValueError(f"{new} is not a complete table")
    if paths.exists(spark, backup):
        raise ValueError(f"{backup} exists already")
    paths.rename(spark, current, backup)
    try:
        paths.rename(spark, new, current)
    except Exception:
        paths.rename(spark, backup, current)
        raise


def drop_temp(spark: SparkSession, path_or_table: str) -> None:
    """Remove a temporary result."""
    if "/" in path_or_table:
        paths.delete(spark, path_or_table)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {path_or_table}")
