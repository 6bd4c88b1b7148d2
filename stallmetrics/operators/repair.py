"""Repair of days that hold exact copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallmetrics.functions.keys import ROW_DIGEST, row_digest
from stallmetrics.operators import cells
from stallmetrics.operators.dedupe import dealt, dedupe_exact, dedupe_latest
from stallmetrics.operators.quality import row_grain
from stallmetrics.schemas import PARTITION_COLUMN
from stallmetrics.session import remove, settings, written
from stallmetrics.sinks.maintenance import replace_partition
from stallmetrics.sinks.tables import COPIED, cluster_columns, write_copied
from stallmetrics.sources import paths

DAY = PARTITION_COLUMN


def repair_dates(spark: SparkSession, path: str, backup: str, dates: list | None = None) -> DataFrame:
    """Find, back up, clean and verify duplicated days -- all days in one job each.

    Returns one row per repaired day: rows before, rows after, copies left. The clean rows
    are read from the backup, so no job overwrites what it is reading. An interrupted run is
    repeated with the same ``backup``, one folder per repair: an unfinished backup is written
    anew, a finished one decides which days are replaced. It is refused if the table has
    since received rows of these days that it lacks.

    Only rows that may have copies are shuffled whole (see ``cells``); the others are written
    as they lie in the backup.
    """
    table = spark.read.parquet(path)
    resumed, copied = paths.exists(spark, f"{backup}/_SUCCESS"), None
    if resumed:
        dates = [r[0] for r in spark.read.schema(table.schema).parquet(backup).select(DAY).distinct().collect()]
    elif dates is None:
        copied = copied_rows(table)
        # At most one entry per day of the table.
        dates = [r[0] for r in copied.select(DAY).distinct().orderBy(DAY).collect()]
    known = [d for d in dates if d is not None]
    chosen = F.col(DAY).isin(known) if known else F.lit(False)
    if None in dates:
        chosen = chosen | F.col(DAY).isNull()
    if not resumed:
        # The table's files hold a day each, so the backup gets no more files than they are, or their splits.
        write_copied(table.filter(chosen), backup, DAY, cluster_columns(spark, path), mode="overwrite")
    saved = spark.read.schema(table.schema).parquet(backup)
    if resumed:
        stored = table.filter(chosen)
        known_rows = saved.select(*row_digest(saved)).distinct()
        if not stored.select(*row_digest(stored)).join(known_rows, ROW_DIGEST, "left_anti").isEmpty():
            raise ValueError(f"{path} has rows that {backup} lacks")
    copied = copied_rows(saved) if copied is None else copied
    cluster = cluster_columns(spark, path)[:1]
    told = cells.marked(saved, row_digest(saved)[0], cells.field(copied, ROW_DIGEST[0]), "__copied")
    alone, twins = (told.filter(c).drop("__copied") for c in ("NOT __copied", "__copied"))
    # Shuffled once, in parts of days that hold all copies of a row.
    near = F.xxhash64(*cluster) if cluster else row_digest(twins)[0]
    clean = dedupe_exact(dealt(twins, DAY, near, row_digest(twins))).select(*saved.columns).unionByName(alone)
    with settings(spark, COPIED):
        replace_partition(clean.sortWithinPartitions(DAY, *cluster), path, dealt=True)
    remove(spark, copied.work_path)
    return repair_report(saved, spark.read.schema(table.schema).parquet(path).filter(chosen))


def copied_rows(rows: DataFrame) -> DataFrame:
    """Day and digest of the rows that occur more than once on a day, as a table in the work folder."""
    found = row_grain(rows, DAY).filter("copies > 1").select(DAY, *ROW_DIGEST)
    return written(found, "copied")


def repair_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before and after per day, and the copies that remain."""
    old = before.groupBy(DAY).agg(F.count("*").alias("rows_before"))
    new = row_grain(after, DAY).groupBy(DAY).agg(
        F.sum("copies").alias("rows_after"), F.sum(F.col("copies") - 1).alias("duplicates_left"))
    joined = old.join(new.withColumnRenamed(DAY, "__d"), F.col(DAY).eqNullSafe(F.col("__d")), "left")
    return joined.select(
        F.col(DAY).alias("date"), "rows_before", F.coalesce("rows_after", F.lit(0)).alias("rows_after"),
        F.coalesce("duplicates_left", F.lit(0)).alias("duplicates_left"))


def delete_older_versions(df: DataFrame, keys: list[str], order_col: str, tiebreak: list[str] = ()) -> DataFrame:
    """What remains after deleting all but the newest row per key (the published
    correlated delete, which is ill-typed as written, by its meaning)."""
    return dedupe_latest(df, keys, order_col, tiebreak)
