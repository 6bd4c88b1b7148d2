"""Audits of the order-items table.

Everything that counts distinct whole rows starts from ``row_grain``: one record per
row digest with its number of copies. Copies collapse before the shuffle, and the
shuffle carries a digest instead of twenty columns, so neither a hot order nor a
third of the table being copies of one row lands in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stallmetrics.functions.filters import in_months, is_blank, on_day, trailing_days, trailing_hours
from stallmetrics.functions.keys import ROW_DIGEST, row_digest, row_json
from stallmetrics.functions.money import ratio
from stallmetrics.schemas import PARTITION_COLUMN

DAY = PARTITION_COLUMN
# Status texts.
CLEAN, HAS_DUPLICATES = "✅ Temiz", "⚠️ Duplicate var!"
LINE_CLEAN, LINE_PREFIX, LINE_SUFFIX = "✅ TEMİZ", "⚠️ ", " DUPLICATE VAR!"
TODAY_LABEL = "📊 Bugünkü Veri Durumu"
QUALITY_LABEL = "Veri Kalitesi Kontrolü"
# End of fixed values.


def row_grain(df: DataFrame, *group: Column | str) -> DataFrame:
    """Distinct rows per group with ``copies``."""
    return df.groupBy(*group, *row_digest(df)).agg(F.count("*").alias("copies"))


def _order_counts(df: DataFrame, **group: Column) -> DataFrame:
    named = [c.alias(n) for n, c in group.items()]
    grain = row_grain(df, *named, "order_id")
    return grain.groupBy(*group, "order_id").agg(F.sum("copies").alias("rows"), F.count("*").alias("distinct_rows"))


def _row_measures() -> list[Column]:
    return [
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count("order_id").alias("unique_orders"),
        F.coalesce(F.sum("distinct_rows"), F.lit(0)).alias("unique_rows"),
        F.coalesce(F.sum(F.col("rows") - F.col("distinct_rows")), F.lit(0)).alias("exact_duplicates"),
    ]


def _per_order(rows: str = "total_rows", orders: str = "unique_orders") -> Column:
    return F.round(ratio(F.col(rows), F.col(orders)), 2).alias("avg_items_per_order")


def duplicate_summary(df: DataFrame, day=None) -> DataFrame:
    """Total, distinct and surplus rows, orders, and rows per order (of one day, if given)."""
    rows = df if day is None else df.filter(on_day(day))
    return _order_counts(rows).agg(*_row_measures()).select("*", _per_order())


def dates_with_surplus(df: DataFrame, year: int | None = None, months: list[int] | None = None) -> DataFrame:
    """Days with more rows than orders. Orders with several items count as surplus too:
    the figure says where to look, not what to delete."""
    rows = df.filter(F.col(DAY).isNotNull())
    if year is not None:
        rows = rows.filter(in_months(year, months or list(range(1, 13))))
    days = rows.groupBy(F.col(DAY).alias("date")).agg(
        F.count("*").alias("total_rows"), F.count_distinct("order_id").alias("unique_orders"))
    surplus = days.withColumn("potential_duplicates", F.col("total_rows") - F.col("unique_orders"))
    return surplus.filter(F.col("potential_duplicates") > 0).orderBy("date")


def dates_with_duplicates(df: DataFrame) -> DataFrame:
    """Days that hold exact copies."""
    grain = row_grain(df, DAY)
    days = grain.groupBy(DAY).agg(F.sum("copies").alias("total_rows"), F.count("*").alias("unique_rows"))
    return days.filter(F.col("total_rows") > F.col("unique_rows")).orderBy(DAY)


def with_order_size(df: DataFrame) -> DataFrame:
    """Each (day, order) with its rows on that day and in the whole input.

    The published form counts over a window on the raw rows. Here the window runs over
    one record per order and day, so its groups are as small as the number of days.
    """
    grain = df.groupBy(F.col(DAY).alias("date"), "order_id").agg(F.count("*").alias("rows"))
    return grain.withColumn("item_count", F.sum("rows").over(W.partitionBy("order_id")))


def health_by_day(df: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Nine measures per day with a status. An order's size counts its rows over the whole
    span, not just the day."""
    counts = _order_counts(df.filter(trailing_days(as_of, days)), date=F.col(DAY))
    sized = counts.withColumn("item_count", F.sum("rows").over(W.partitionBy("order_id")))
    known = F.col("order_id").isNotNull()
    table = sized.groupBy("date").agg(
        *_row_measures(),
        F.count_if(known & (F.col("item_count") == 1)).alias("single_item_orders"),
        F.count_if(known & (F.col("item_count") >= 2)).alias("multi_item_orders"),
    )
    status = F.when(F.col("exact_duplicates") == 0, F.lit(CLEAN)).otherwise(F.lit(HAS_DUPLICATES)).alias("status")
    return table.select("*", _per_order(), status).orderBy(F.desc("date"))


def health_today(df: DataFrame, as_of) -> DataFrame:
    """One labelled row about the day, with first and last time and the hours between."""
    rows = df.filter(on_day(as_of))
    grain = rows.groupBy("order_id", *row_digest(rows)).agg(
        F.count("*").alias("copies"), F.min("order_creation_timestamp").alias("first_ts"),
        F.max("order_creation_timestamp").alias("last_ts"))
    orders = grain.groupBy("order_id").agg(
        F.sum("copies").alias("rows"), F.count("*").alias("distinct_rows"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    line = orders.agg(*_row_measures(), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    span = F.timestamp_diff("HOUR", F.col("first_ts"), F.col("last_ts")).alias("span_hours")
    return line.select(F.lit(TODAY_LABEL).alias("check"), "*", span)


def duplicate_groups(df: DataFrame, day=None, n: int = 10,
                     keys: tuple[str, ...] = ("order_id", "product_code_1", "user_id", "city")) -> DataFrame:
    """Rows that occur more than once, most copies first."""
    rows = df if day is None else df.filter(on_day(day))
    groups = rows.groupBy(*keys, *row_digest(rows)).agg(
        F.count("*").alias("duplicate_count"), F.min("order_creation_timestamp").alias("first_seen"),
        F.max("order_creation_timestamp").alias("last_seen"))
    repeated = groups.filter(F.col("duplicate_count") > 1)
    return repeated.orderBy(F.desc("duplicate_count"), *keys, *ROW_DIGEST).limit(n).drop(*ROW_DIGEST)


def duplicate_samples(df: DataFrame, day=None, n: int = 20) -> DataFrame:
    """All records of the n orders with the most rows, as JSON text, one record per row.

    Records stay rows instead of one array per order: an order can hold any number.
    The join side is at most n rows, hence the broadcast.
    """
    rows = df if day is None else df.filter(on_day(day))
    counts = rows.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.count("*").alias("duplicate_count"))
    top = counts.filter(F.col("duplicate_count") > 1).orderBy(F.desc("duplicate_count"), "order_id").limit(n)
    records = rows.select(*df.columns, row_json(df).alias("record"))
    return records.join(F.broadcast(top), "order_id")


def duplicate_order_details(df: DataFrame, day=None, n: int = 5) -> DataFrame:
    """All rows of the first n orders that hold an exact copy. They come unsorted: copies are
    equal in every column, and a sort would put them all in one task."""
    rows = df if day is None else df.filter(on_day(day))
    repeated = row_grain(rows, "order_id").filter(F.col("copies") > 1).select("order_id").distinct()
    chosen = repeated.orderBy("order_id").limit(n)
    details = rows.join(F.broadcast(chosen), "order_id", "left_semi")
    return details.select(
        "order_id", "user_id", "city", "product_code_1", "additional_products", "order_creation_timestamp",
        row_json(df).alias("record"),
    )


def hourly_load(df: DataFrame, day=None) -> DataFrame:
    """Rows, orders and copies per hour."""
    rows = df if day is None else df.filter(on_day(day))
    counts = _order_counts(rows, hour=F.hour("order_creation_timestamp"))
    return counts.groupBy("hour").agg(*_row_measures()).drop("unique_rows").orderBy("hour")


def null_audit(df: DataFrame, day=None) -> DataFrame:
    """Missing and blank key fields."""
    rows = df if day is None else df.filter(on_day(day))
    return rows.agg(
        F.lit(QUALITY_LABEL).alias("check"),
        F.count("*").alias("total_rows"),
        F.count_if(F.col("order_id").isNull()).alias("order_id_null"),
        F.count_if(is_blank("user_id")).alias("user_id_blank"),
        F.count_if(is_blank("product_code_1")).alias("product_code_blank"),
        F.count_if(is_blank("city")).alias("city_blank"),
        F.count_if(F.col("order_creation_timestamp").isNull()).alias("timestamp_null"),
    )


def hourly_trend(df: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """New rows and orders in each of the last hours, newest first."""
    recent = df.filter(trailing_hours(as_of, hours, "order_creation_timestamp"))
    slots = recent.groupBy(F.date_trunc("hour", "order_creation_timestamp").alias("hour")).agg(
        F.count("*").alias("new_rows"), F.count_distinct("order_id").alias("new_orders"))
    return slots.orderBy(F.desc("hour")).limit(hours)


def health_line(df: DataFrame, as_of) -> DataFrame:
    """One row with the day's counts and a status text that names the number of copies."""
    line = duplicate_summary(df, as_of)
    copies = F.col("exact_duplicates")
    status = F.when(copies == 0, F.lit(LINE_CLEAN)).otherwise(
        F.concat(F.lit(LINE_PREFIX), copies.cast("string"), F.lit(LINE_SUFFIX)))
    return line.select(
        F.lit(as_of).cast("date").alias("date"), F.col("total_rows").alias("row_count"),
        F.col("unique_orders").alias("order_count"), copies.alias("duplicate_count"), status.alias("status"),
    )


def items_per_order(df: DataFrame, day=None) -> DataFrame:
    """Histogram of order sizes."""
    rows = df if day is None else df.filter(on_day(day))
    sizes = rows.groupBy("order_id").agg(F.count("*").alias("item_count"))
    return sizes.groupBy("item_count").agg(
        F.count("order_id").alias("order_count"), F.count("*").alias("total_items")).orderBy("item_count")


def order_size_by_day(df: DataFrame, year: int | None = None, months: list[int] | None = None) -> DataFrame:
    """Rows and orders per day, split into one-item and larger orders."""
    rows = df.filter(F.col(DAY).isNotNull())
    if year is not None:
        rows = rows.filter(in_months(year, months or list(range(1, 13))))
    known = F.col("order_id").isNotNull()
    days = with_order_size(rows).groupBy("date").agg(
        F.sum("rows").alias("row_count"), F.count("order_id").alias("unique_orders"),
        F.count_if(known & (F.col("item_count") == 1)).alias("orders_1_item"),
        F.count_if(known & (F.col("item_count") >= 2)).alias("orders_2plus_items"),
    )
    return days.select("*", _per_order("row_count")).orderBy(F.desc("date"))


def monthly_coverage(df: DataFrame, start="2023-01-01", end="2026-01-01") -> DataFrame:
    """Order-code coverage by delivery month.

    Folded to one record per month and order first, so four conditional distinct counts
    cost one shuffle. An order may count both with and without a code.
    """
    day = F.col("order_delivery_date")
    span = df.filter((day >= F.lit(start).cast("date")) & (day < F.lit(end).cast("date")))
    orders = span.groupBy(F.trunc(day, "MM").alias("m"), "order_id").agg(
        F.count("*").alias("rows"), F.count("order_code").alias("coded"))
    known = F.col("order_id").isNotNull()
    months = orders.groupBy("m").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("rows").alias("total_rows"),
        F.count_if(known & (F.col("coded") > 0)).alias("orders_with_code"),
        F.count_if(known & (F.col("coded") < F.col("rows"))).alias("orders_without_code"),
        F.sum("coded").alias("rows_with_code"),
        F.sum(F.col("rows") - F.col("coded")).alias("rows_without_code"),
    )
    return months.select(
        F.year("m").alias("year"), F.month("m").alias("month"),
        F.date_format("m", "yyyy-MM").alias("year_month"), F.date_format("m", "MMMM yyyy").alias("month_name"),
        "total_orders", "total_rows", "orders_with_code", "orders_without_code", "rows_with_code",
        "rows_without_code",
        F.round(ratio(F.col("orders_with_code") * 100, F.col("total_orders")), 2).alias("code_coverage_pct"),
        F.round(ratio(F.col("total_rows"), F.col("total_orders")), 2).alias("items_per_order"),
    ).orderBy("year", "month")


def date_column(df: DataFrame) -> str:
    """Name of the creation-date column: the newer tables renamed it."""
    for name in ("order_created_date_tr", "order_created_date"):
        if name in df.columns:
            return name
    raise ValueError("the table has no creation-date column")


def _dated(df: DataFrame, start, end) -> tuple[DataFrame, Column]:
    """Rows with a date, in the range if one is given, and their day."""
    name = date_column(df)
    rows = df.filter(F.col(name).isNotNull())
    if start is not None:
        # A range on the raw column; it prunes partitions and also holds for timestamps.
        rows = rows.filter((F.col(name) >= F.lit(start).cast("date"))
                           & (F.col(name) < F.date_add(F.lit(end).cast("date"), 1)))
    return rows, F.col(name).cast("date")


def day_counts(df: DataFrame, start=None, end=None) -> DataFrame:
    """Rows and orders per day, on either table layout."""
    rows, day = _dated(df, start, end)
    return rows.groupBy(day.alias("date")).agg(
        F.count("*").alias("row_count"), F.count_distinct("order_id").alias("unique_orders")).orderBy("date")


def range_check(df: DataFrame, start=None, end=None) -> DataFrame:
    """One row about a span: rows, orders, first and last day, and days with rows."""
    rows, day = _dated(df, start, end)
    grain = rows.groupBy("order_id", day.alias("date")).agg(F.count("*").alias("rows"))
    return grain.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"), F.count_distinct("order_id").alias("unique_orders"),
        F.min("date").alias("min_date"), F.max("date").alias("max_date"),
        F.count_distinct("date").alias("day_count"))


def reconcile_days(a: DataFrame, b: DataFrame, start=None, end=None) -> DataFrame:
    """Day counts of two tables side by side; days missing on one side count 0."""
    left = day_counts(a, start, end).withColumnsRenamed({"row_count": "rows_a", "unique_orders": "orders_a"})
    right = day_counts(b, start, end).withColumnsRenamed({"row_count": "rows_b", "unique_orders": "orders_b"})
    both = left.join(right, "date", "full_outer").fillna(0, ["rows_a", "orders_a", "rows_b", "orders_b"])
    return both.select(
        "*", (F.col("rows_a") - F.col("rows_b")).alias("rows_diff"),
        (F.col("orders_a") - F.col("orders_b")).alias("orders_diff"),
    ).orderBy("date")
