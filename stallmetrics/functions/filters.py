"""Predicates. Each returns a plain Column, so it reaches the Parquet scan."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.schemas import PARTITION_COLUMN

# Where a pulled row keeps its time, best field first.
TIME_FIELDS = ["order_created_date", "order_creation_timestamp", "created_at", "timestamp", "date"]
# End of fixed values.


def on_day(day, column: str = PARTITION_COLUMN) -> Column:
    return F.col(column) == F.lit(day).cast("date")


def not_on_day(day, column: str = PARTITION_COLUMN) -> Column:
    """All other days, rows without a date included."""
    return ~F.col(column).eqNullSafe(F.lit(day).cast("date"))


def between_days(start, end, column: str = PARTITION_COLUMN) -> Column:
    return F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def half_open(start, end, column: str) -> Column:
    return (F.col(column) >= F.lit(start).cast("date")) & (F.col(column) < F.lit(end).cast("date"))


def trailing_days(as_of, days: int, column: str = PARTITION_COLUMN) -> Column:
    return F.col(column) >= F.date_sub(F.lit(as_of).cast("date"), days)


def trailing_hours(as_of, hours: int, column: str) -> Column:
    return F.col(column) >= F.lit(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")


def in_months(year: int, months: list[int], column: str = PARTITION_COLUMN) -> Column:
    """Days in the given months of one year, as date ranges that prune partitions."""
    spans = [
        (F.col(column) >= F.make_date(F.lit(year), F.lit(m), F.lit(1)))
        & (F.col(column) < F.add_months(F.make_date(F.lit(year), F.lit(m), F.lit(1)), 1))
        for m in sorted(months)
    ]
    return reduce(lambda a, b: a | b, spans)


def one_of(column: str, values) -> Column:
    """Multi-select: no selection means no filter."""
    return F.col(column).isin(list(values)) if values else F.lit(True)


def is_blank(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def build_filter(start=None, end=None, cities=None, payments=None, statuses=None) -> Column:
    """Dashboard filter; every absent part is no restriction."""
    parts = []
    if start is not None and end is not None:
        parts.append(between_days(start, end))
    for column, values in (("city", cities), ("payment_method", payments), ("delivery_status", statuses)):
        if values:
            parts.append(F.col(column).isin(list(values)))
    return reduce(and_, parts, F.lit(True))


def valid_product(price: str = "price", name: str = "name") -> Column:
    return (F.col(price) > 0) & (F.col(name) != "")


def changed(column: str = "price_diff") -> Column:
    return F.col(column).isNotNull() & (F.col(column) != 0)


def day_text(column: str = PARTITION_COLUMN) -> Column:
    """A day as text, and the empty text for a missing day, so that missing days compare as equal."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def prune_days(table: DataFrame, batch: DataFrame, column: str = PARTITION_COLUMN) -> DataFrame:
    """``table`` cut down to the days that occur in ``batch``, by a join that Spark turns into a
    partition filter when it runs: nothing is collected.

    The days of a batch are at most a calendar's, so they are broadcast. The comparison holds
    for every text; Spark prunes only by a side with a condition that might select.
    """
    days = batch.select(day_text(column).alias("__day")).filter(F.col("__day") >= "").distinct()
    return table.join(F.broadcast(days), day_text(column) == F.col("__day"), "left_semi")


def morning_filter(df: DataFrame, as_of, start_hour: int = 0, end_hour: int = 8) -> DataFrame:
    """Rows of day ``as_of`` with a wall-clock hour in [start_hour, end_hour).

    The hour is read in the text's own offset, without conversion. A bare date counts
    as midnight; a text that does not parse (or no text) keeps the row only when its
    plain date text equals the day; a time field that is no text drops the row.
    """
    today = F.lit(str(as_of))
    types = dict(df.dtypes)
    candidates = []
    for name in TIME_FIELDS:
        if name in types:
            text = F.col(name).cast("string")
            candidates.append(
                F.when(text != "", F.struct(text.alias("text"), F.lit(types[name] == "string").alias("is_text")))
            )
    found = F.coalesce(*candidates) if candidates else F.lit(None).cast("struct<text:string,is_text:boolean>")
    iso = F.regexp_replace(found["text"], "Z", "+00:00")
    stamped = iso.contains("T")
    shape = F.when(
        stamped,
        iso.rlike(r"^\d{4}-\d{2}-\d{2}T([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d([.,]\d+)?)?)?"
                  r"([+-]\d{2}(:?\d{2}(:?\d{2}([.,]\d+)?)?)?)?$"),
    ).otherwise(iso.rlike(r"^\d{4}-\d{2}-\d{2}$"))
    parsed = shape & F.substring(iso, 1, 10).try_cast("date").isNotNull()
    hour = F.when(stamped, F.substring(iso, 12, 2).try_cast("int")).otherwise(F.lit(0))
    in_window = (F.substring(iso, 1, 10) == today) & (hour >= start_hour) & (hour < end_hour)
    plain = [F.when(F.col(c).cast("string") != "", F.col(c).cast("string"))
             for c in ("order_created_date_tr", "order_created_date") if c in types]
    fallback = F.coalesce(*plain, F.lit("")) == today
    keep = (
        F.when(found.isNull(), fallback)
        .when(~found["is_text"], F.lit(False))
        .when(parsed, in_window)
        .otherwise(fallback)
    )
    return df.filter(F.coalesce(keep, F.lit(False)))
