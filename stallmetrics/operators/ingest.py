"""Idempotent ingest of order items."""

from __future__ import annotations

from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stallmetrics import schemas
from stallmetrics.functions.filters import morning_filter, prune_days
from stallmetrics.functions.keys import BUSINESS_KEY, ROW_DIGEST, ROW_KEY, business_key, row_digest
from stallmetrics.functions.text import date_part, fold_column_names, joined_list
from stallmetrics.operators import cells
from stallmetrics.operators.dedupe import PART, dealt, first_n
from stallmetrics.schemas import PARTITION_COLUMN
from stallmetrics.session import new_workdir, remove
from stallmetrics.sinks.tables import WHOLE, load_snapshot, save_snapshot
from stallmetrics.sources.readers import read_order_items

DATE_COLUMNS = [PARTITION_COLUMN, "order_delivery_date", "requested_delivery_date"]
NEAR = "__order"
# Outcome texts.
EMPTY, ALL_EXISTING, SUCCESS = "empty", "all_existing", "success"
# End of fixed values.


def normalize_orders(df: DataFrame) -> DataFrame:
    """Payload rows as table rows: folded names, renamed date, date parts, joined list."""
    rows = fold_column_names(df).withColumnRenamed("order_created_date", PARTITION_COLUMN)
    kinds = dict(rows.dtypes)
    fixes: dict[str, Column] = {c: date_part(F.col(c)) for c in DATE_COLUMNS if kinds.get(c) == "string"}
    if kinds.get("additional_products", "").startswith("array"):
        fixes["additional_products"] = joined_list(F.col("additional_products"))
    return rows.withColumns(fixes) if fixes else rows


def conform(rows: DataFrame) -> DataFrame:
    """Columns and types of the order-items table; fields the payload lacks are null."""
    return rows.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schemas.ORDER_ITEMS.fields
    ])


def first_per_key(batch: DataFrame) -> DataFrame:
    """One row per business key of the batch, with the key's two columns.

    Files have no row order, so the first is the earliest by creation time and then by
    digest: a fixed choice, which a retried task repeats.
    """
    marked = batch.select("*", *business_key(batch), *row_digest(batch))
    order = [F.col("order_creation_timestamp").asc_nulls_last()] if "order_creation_timestamp" in batch.columns else []
    return first_n(marked, ROW_KEY, 1, [*order, *ROW_DIGEST]).drop(*ROW_DIGEST)


def near(rows: DataFrame) -> Column:
    """What rows are kept together by: their order."""
    return F.expr("xxhash64(CAST(order_id AS STRING))") if "order_id" in rows.columns else F.lit(None).cast("long")


def key_rows(rows: DataFrame) -> DataFrame:
    """Day, order and key of rows."""
    return rows.select(PARTITION_COLUMN, near(rows).alias(NEAR), *business_key(rows))


def unseen(batch: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of the batch whose key is not among the ``known`` (``key_rows``), the first of each, in
    parts of days as they are written.

    Both are dealt by day and order, which the key contains. That is the only shuffle of whole
    rows; keys and digests of the batch are computed behind it.
    """
    day = F.col(PARTITION_COLUMN).cast(batch.schema[PARTITION_COLUMN].dataType)
    marks = known.select(day.alias(PARTITION_COLUMN), NEAR, *ROW_KEY, F.lit(True).alias("__stored"))
    both = batch.select("*", near(batch).alias(NEAR), *[F.lit(None).cast("long").alias(c) for c in ROW_KEY],
                        F.lit(False).alias("__stored")).unionByName(marks, allowMissingColumns=True)
    key = [F.when(F.col("__stored"), F.col(c)).otherwise(k) for c, k in zip(ROW_KEY, business_key(batch))]
    # Known keys are narrow: eight of them count as a row.
    placed = dealt(both, PARTITION_COLUMN, F.col(NEAR), key, F.when(F.col("__stored"), 1).otherwise(8) / 8)
    rows = placed.select(*batch.columns, PART, "__stored", *[k.alias(c) for c, k in zip(ROW_KEY, key)], *row_digest(batch))
    order = [F.col("order_creation_timestamp").asc_nulls_last()] if "order_creation_timestamp" in batch.columns else []
    first = first_n(rows, [PARTITION_COLUMN, PART, *ROW_KEY], 1, [F.desc("__stored"), *order, *ROW_DIGEST])
    return first.filter(~F.col("__stored")).select(*batch.columns)


def new_rows(batch: DataFrame, table: DataFrame) -> DataFrame:
    """Rows of the batch whose business key is not stored yet, once each.

    The key contains the creation date, so only the batch's own days of the table are
    read, and of those only the key columns.
    """
    stored = prune_days(table, batch).select(*[c for c in BUSINESS_KEY if c in table.columns])
    return unseen(batch, key_rows(stored))


@contextmanager
def staged(batch: DataFrame):
    """The batch computed once, into the work folder, and read from there; removed afterwards."""
    spark, path = batch.sparkSession, new_workdir(batch.sparkSession, "batch")
    try:
        batch.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(batch.schema).parquet(path)
    finally:
        remove(spark, path)


def among(rows: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows whose day is one of unseen keys and whose key may be one of them."""
    return cells.possible(prune_days(rows, fresh), business_key(rows)[0], cells.field(fresh, ROW_KEY[0]))


@contextmanager
def narrowed(batch: DataFrame, table: DataFrame):
    """Batch and table without rows that cannot matter to ``new_rows``: those whose key is no unseen one.

    Keys alone are compared first, so that rows which are stored already are not shuffled whole.
    """
    stored = prune_days(table, batch).select(*[c for c in BUSINESS_KEY if c in table.columns])
    if stored.isEmpty():
        yield batch, table
        return
    keys = batch.select(PARTITION_COLUMN, *business_key(batch))
    with staged(keys.join(stored.select(*business_key(stored)), ROW_KEY, "left_anti").select(PARTITION_COLUMN, ROW_KEY[0])) as fresh:
        yield tuple(among(rows, fresh) for rows in (batch, table))


def outcome(received: int, inserted: int) -> dict:
    status = SUCCESS if inserted else ALL_EXISTING if received else EMPTY
    return {"status": status, "received": received, "inserted": inserted, "skipped": received - inserted}


def ingest_batch(batch: DataFrame, path: str, stored: bool = False) -> dict:
    """Append the unseen rows of one pull and report the outcome.

    Running it again with the same rows appends nothing, whatever happened to the first run.
    Any failing step fails the batch: nothing is inserted unchecked. A batch that is read from files
    as it is (``stored``) is not staged.
    """
    with nullcontext(batch) if stored else staged(batch) as rows:
        received = rows.count()
        if not received:
            return outcome(0, 0)
        written = Observation()
        with narrowed(rows, read_order_items(batch.sparkSession, path)) as (some, table):
            append_observed(new_rows(some, table), path, written)
        return outcome(received, int(written.get.get("inserted", 0)))


def append_observed(rows: DataFrame, path: str, seen: Observation) -> None:
    """Append and count in one job, rows in parts of days as ``unseen`` leaves them. The count sits behind the last shuffle, in the writing
    stage, where a task retried after a lost executor is counted once."""
    counted = rows.observe(seen, F.count(F.lit(1)).alias("inserted"))
    counted.write.mode("append").options(**WHOLE).partitionBy(PARTITION_COLUMN).parquet(path)


def outcome_rows(spark: SparkSession, path: str, told: dict) -> DataFrame:
    """Outcome of a run as one row, with the rows now visible in the table."""
    visible = read_order_items(spark, path).agg(F.count("*").alias("visible_rows"))
    return visible.select(
        F.lit(told["status"]).alias("status"), F.lit(told["received"]).cast("long").alias("received"),
        F.lit(told["inserted"]).cast("long").alias("inserted"),
        F.lit(told["skipped"]).cast("long").alias("skipped"), "visible_rows")


def upsert_watermark(marks: DataFrame, fetch_date, fetched_at, updated_at: Column | None = None) -> DataFrame:
    """Progress marks with the given day's mark set. One row per day."""
    now = F.current_timestamp() if updated_at is None else updated_at
    one = marks.sparkSession.range(1).select(
        F.lit(fetch_date).cast("date").alias("fetch_date"),
        F.lit(fetched_at).cast("timestamp").alias("last_fetch_timestamp"), now.cast("timestamp").alias("updated_at"))
    both = marks.alias("t").join(one.alias("s"), "fetch_date", "full_outer")
    pick = lambda c: F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c)
    return both.select("fetch_date", pick("last_fetch_timestamp"), pick("updated_at"))


def record_fetch(spark: SparkSession, store: str, fetch_date, fetched_at) -> int:
    """Write the new progress marks as the next version of their store."""
    marks = load_snapshot(spark, store, schemas.FETCH_WATERMARK)
    return save_snapshot(upsert_watermark(marks, fetch_date, fetched_at), store)


def last_fetch(marks: DataFrame, fetch_date) -> DataFrame:
    """Newest mark of a day (no row if there is none)."""
    day = marks.filter(F.col("fetch_date") == F.lit(fetch_date).cast("date"))
    return day.orderBy(F.desc("last_fetch_timestamp")).limit(1).select("last_fetch_timestamp")


def run_fetch(spark: SparkSession, payload: DataFrame, path: str, mark_store: str | None = None,
              date_key: str = "", mode: str = "incremental", fetched_at=None,
              start_hour: int = 0, end_hour: int = 8) -> dict:
    """One pull end to end. A morning pull keeps only the day's early hours. The progress
    mark is informational and only set by a successful incremental pull of one day."""
    if mode == "morning":
        payload = morning_filter(payload, date_key, start_hour, end_hour)
    told = ingest_batch(conform(normalize_orders(payload)), path)
    if mark_store and mode == "incremental" and len(date_key) == 10 and told["status"] == SUCCESS:
        record_fetch(spark, mark_store, date_key, fetched_at)
    return told
