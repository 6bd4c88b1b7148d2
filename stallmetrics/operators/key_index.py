"""A kept index of business keys, so that a pull reads two longs for each stored row.

The index is a catalog table of (day, key) with one row per stored row, filed by month (or
another unit of time) and bucketed by key. A batch is shuffled to the same buckets; the stored side is not shuffled, as
long as there are at least as many buckets as ``spark.sql.shuffle.partitions``.
Data are appended before their keys, so a lost run can only leave the index short. Each pull
counts the days it touches on both sides, from one column each, and files the months of days
that differ anew before it looks for known keys.
"""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stallmetrics.functions.filters import day_text, prune_days
from stallmetrics.functions.keys import ROW_KEY, business_key
from stallmetrics.operators.ingest import NEAR, among, append_observed, key_rows, new_rows, outcome, staged, unseen
from stallmetrics.schemas import PARTITION_COLUMN
from stallmetrics.sources import paths
from stallmetrics.sources.readers import read_order_items

DAY, PERIOD, KNOWN = "day", "period", "known"
COLUMNS = [*ROW_KEY, DAY, PERIOD]


def period_of(spark: SparkSession, name: str) -> Column:
    """The period that a day is filed under in an index."""
    unit = spark.sql(f"SHOW TBLPROPERTIES {name} ('unit')").first()["value"]
    return F.date_trunc(unit, PARTITION_COLUMN).cast("date").alias(PERIOD)


def keys_of(rows: DataFrame, period: Column) -> DataFrame:
    """Index rows of order items: key, day and period."""
    return rows.select(*business_key(rows), F.col(PARTITION_COLUMN).alias(DAY), period)


def _file(spark: SparkSession, keys: DataFrame, name: str, mode: str, dealt: bool = False) -> None:
    """Write keys into the index, each bucket of a period as one file. Keys that a join with the index has left
    in files of whole buckets (``dealt``) are not shuffled again."""
    rows = keys.select(*COLUMNS)
    if not dealt:
        buckets = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Num Buckets'").first()["data_type"]
        rows = rows.repartition(int(buckets), *ROW_KEY).sortWithinPartitions(PERIOD, *ROW_KEY)
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=mode == "overwrite")


def create_index(spark: SparkSession, path: str, name: str, buckets: int | None = None, unit: str = "month") -> None:
    """Declare the index of a table in a folder and fill it from what is stored."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ", ".join(f"{c} BIGINT" for c in ROW_KEY)
    spark.sql(f"CREATE TABLE {name} ({keys}, {DAY} DATE, {PERIOD} DATE) USING parquet PARTITIONED BY ({PERIOD}) "
              f"CLUSTERED BY ({', '.join(ROW_KEY)}) SORTED BY ({', '.join(ROW_KEY)}) INTO {buckets} BUCKETS "
              f"LOCATION '{path}/_keys' TBLPROPERTIES ('unit' = '{unit}')")
    if paths.exists(spark, path) and any("=" in d for d in paths.child_dirs(spark, path)):
        _file(spark, keys_of(read_order_items(spark, path), period_of(spark, name)), name, "append")


def differing_days(table: DataFrame, index: DataFrame) -> DataFrame:
    """Days on which the index has another number of rows than the table."""
    count = lambda df, day, n: df.groupBy(day_text(day).alias("__day")).agg(F.count("*").alias(n), F.any_value(day).alias(f"{n}_day"))
    both = count(table, PARTITION_COLUMN, "stored").join(count(index, DAY, "indexed"), "__day", "full_outer")
    return both.filter(~F.col("stored").eqNullSafe(F.col("indexed"))).select(
        F.coalesce("stored_day", "indexed_day").alias(PARTITION_COLUMN), F.coalesce("stored", F.lit(0)).alias("stored"),
        F.coalesce("indexed", F.lit(0)).alias("indexed"))


def refile(spark: SparkSession, path: str, name: str, days: DataFrame | None = None) -> int:
    """File the periods of all differing days anew (of those in ``days`` if given); returns how
    many days differed."""
    table, index = read_order_items(spark, path), spark.table(name)
    if days is not None:
        table = prune_days(table, days)
        index = index.join(F.broadcast(days.select(day_text().alias("__d")).distinct()), day_text(DAY) == F.col("__d"), "left_semi")
    wrong = [r[0] for r in differing_days(table, index).select(PARTITION_COLUMN).collect()]  # at most a calendar
    if wrong:
        period = period_of(spark, name)
        periods = spark.createDataFrame([(d,) for d in wrong], f"{PARTITION_COLUMN} date").select(period.alias("__p")).distinct()
        again = keys_of(read_order_items(spark, path), period)
        kept = again.join(F.broadcast(periods), F.col(PERIOD).eqNullSafe(F.col("__p")), "left_semi")
        with staged(kept) as keys:  # a job must not read the folder whose index it overwrites
            _file(spark, keys, name, "overwrite")
    return len(wrong)


def looked_up(batch: DataFrame, name: str, placed: bool = True) -> DataFrame:
    """Keys of the batch, once each, with period and whether the index has them, and with their order if ``placed``.
    Of the index the batch's periods are read."""
    spark = batch.sparkSession
    period = period_of(spark, name)
    keys = key_rows(batch).groupBy(*ROW_KEY).agg(*[F.any_value(c).alias(c) for c in (PARTITION_COLUMN, *[NEAR] * placed)])
    known = prune_days(spark.table(name), batch.select(period), PERIOD).select(*ROW_KEY, F.lit(True).alias(KNOWN)).distinct()
    found = keys.join(known, ROW_KEY, "left").withColumn(KNOWN, F.col(KNOWN).isNotNull())
    return found.withColumns({PERIOD: period, DAY: F.col(PARTITION_COLUMN)})


def unseen_rows(batch: DataFrame, name: str, keys: DataFrame | None = None) -> DataFrame:
    """Rows of the batch whose key is not in the index, once each; ``keys`` are the batch's, looked up
    already."""
    return unseen(batch, (looked_up(batch, name) if keys is None else keys).filter(KNOWN))


def ingest_indexed(batch: DataFrame, path: str, name: str, stored: bool = False) -> dict:
    """``ingest_batch`` with a kept index: appends the unseen rows and then their keys. Only keys are
    joined with the index, and the unseen ones kept for both steps; a batch read from files (``stored``) is not staged."""
    spark = batch.sparkSession
    with nullcontext(batch) if stored else staged(batch) as rows:
        received = rows.count()
        if not received:
            return outcome(0, 0)
        refile(spark, path, name, rows)
        table, period = read_order_items(spark, path), period_of(spark, name)
        known = not prune_days(spark.table(name), rows.select(period), PERIOD).isEmpty()
        with staged(looked_up(rows, name, placed=False).filter(~F.col(KNOWN)).select(PARTITION_COLUMN, *COLUMNS)) as fresh:
            # Rows that the index knows are not shuffled whole, and of the table only keys that may be taken for unseen ones.
            some, stored_rows = (among(r, fresh) for r in (rows, table)) if known else (rows, table)
            written = Observation()
            append_observed(new_rows(some, stored_rows), path, written)
            _file(spark, fresh, name, "append", dealt=True)
        return outcome(received, int(written.get.get("inserted", 0)))
