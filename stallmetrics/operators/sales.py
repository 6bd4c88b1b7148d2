"""Order metrics: the aggregates behind the reports and the dashboard.

Money is summed as decimal, so results do not depend on the order of rows, and shown
as double. Exact distinct order counts run as a two-step aggregate keyed by (group,
order), which spreads a hot group over all tasks; ``approx=True`` asks for sketches
(one small state per group) instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stallmetrics.functions.clock import comparison_range
from stallmetrics.functions.filters import between_days, trailing_days
from stallmetrics.functions.money import ratio
from stallmetrics.functions.text import normalize_turkish
from stallmetrics.schemas import PARTITION_COLUMN

DAY = PARTITION_COLUMN
# Labels of weekdays 1 (Sunday) to 7.
WEEKDAYS = ["Paz", "Pzt", "Sal", "Çar", "Per", "Cum", "Cmt"]
# Thresholds of the momentum label.
MOMENTUM_DAYS, MOMENTUM_UP, MOMENTUM_DOWN = 7, 1.1, 0.9
# End of fixed values.


def _orders(approx: bool = False) -> Column:
    return F.approx_count_distinct("order_id") if approx else F.count_distinct("order_id")


def _revenue() -> Column:
    return F.sum("order_amount").cast("double")


def _average() -> Column:
    return ratio(F.sum("order_amount"), F.count("order_amount"))


def _measures(*names: str, approx: bool = False) -> list[Column]:
    known = {
        "unique_orders": _orders(approx),
        "total_items": F.count("*"),
        "total_revenue": _revenue(),
        "avg_order_value": _average(),
    }
    return [known[n].alias(n) for n in names]


BASIC = ("unique_orders", "total_items", "total_revenue", "avg_order_value")


def daily_summary(df: DataFrame, approx: bool = False) -> DataFrame:
    dated = df.filter(F.col(DAY).isNotNull())
    return dated.groupBy(F.col(DAY).alias("date")).agg(*_measures(*BASIC, approx=approx)).orderBy(F.desc("date"))


def monthly_summary(df: DataFrame, approx: bool = False) -> DataFrame:
    dated = df.filter(F.col(DAY).isNotNull())
    month = F.trunc(DAY, "MM").alias("month")
    return dated.groupBy(month).agg(*_measures(*BASIC, approx=approx)).orderBy(F.desc("month"))


def _top(df: DataFrame, keys: list[str], n: int, measures, approx: bool) -> DataFrame:
    """Groups with the most orders; the keys break ties."""
    grouped = df.groupBy(*keys).agg(*(_measures(*measures, approx=approx)))
    return grouped.orderBy(F.desc("unique_orders"), *keys).limit(n)


def top_cities(df: DataFrame, n: int = 20, approx: bool = False) -> DataFrame:
    known = df.filter(F.col("city").isNotNull())
    return _top(known, ["city"], n, ("unique_orders", "total_items", "total_revenue"), approx)


def by_category(df: DataFrame, approx: bool = False) -> DataFrame:
    known = df.filter(F.col("product_category").isNotNull())
    return (
        known.groupBy(F.col("product_category").cast("string").alias("category_id"))
        .agg(*_measures("unique_orders", "total_items", "total_revenue", approx=approx))
        .orderBy(F.desc("unique_orders"), "category_id")
    )


def share_of_total(grouped: DataFrame, measure: str, name: str) -> DataFrame:
    """Percentage of the total. The total is a scalar subquery: a window over everything
    would gather all groups in one task."""
    total = grouped.agg(F.sum(measure)).scalar()
    return grouped.withColumn(name, F.round(ratio(F.col(measure) * F.lit(100.0), total), 2))


def payment_mix(df: DataFrame, approx: bool = False) -> DataFrame:
    known = df.filter(F.col("payment_method").isNotNull())
    mix = known.groupBy("payment_method").agg(*_measures("unique_orders", "total_revenue", approx=approx))
    return share_of_total(mix, "total_revenue", "revenue_percentage").orderBy(
        F.desc("unique_orders"), "payment_method")


def by_delivery_status(df: DataFrame, approx: bool = False) -> DataFrame:
    known = df.filter(F.col("delivery_status").isNotNull())
    return (
        known.groupBy("delivery_status").agg(*_measures("unique_orders", "total_items", approx=approx))
        .orderBy(F.desc("unique_orders"), "delivery_status")
    )


def totals(df: DataFrame) -> DataFrame:
    """Scorecard row."""
    return df.filter(F.col(DAY).isNotNull()).agg(
        F.count_distinct("order_id").alias("total_unique_orders"),
        F.count("*").alias("total_items"),
        _revenue().alias("total_revenue"),
        _average().alias("avg_order_value"),
        F.count_distinct(DAY).alias("days_with_orders"),
    )


def trend(df: DataFrame, as_of, days: int = 30, approx: bool = False) -> DataFrame:
    recent = df.filter(F.col(DAY).isNotNull() & trailing_days(as_of, days))
    return (
        recent.groupBy(F.col(DAY).alias("date"))
        .agg(*_measures("unique_orders", "total_revenue", approx=approx)).orderBy(F.desc("date"))
    )


def by_hour(df: DataFrame, approx: bool = False) -> DataFrame:
    stamped = df.filter(F.col("order_creation_timestamp").isNotNull())
    return (
        stamped.groupBy(F.hour("order_creation_timestamp").alias("hour"))
        .agg(*_measures("unique_orders", "total_revenue", approx=approx)).orderBy("hour")
    )


def top_vendors(df: DataFrame, n: int = 50, approx: bool = False) -> DataFrame:
    return _top(df.filter(F.col("vendor_id").isNotNull()), ["vendor_id"], n, BASIC, approx)


def top_products(df: DataFrame, n: int = 50, approx: bool = False) -> DataFrame:
    known = df.filter(F.col("product_name").isNotNull())
    top = _top(known, ["product_name", "product_code_1"], n, BASIC, approx)
    return top.withColumnsRenamed({"total_items": "total_items_sold", "avg_order_value": "avg_price"})


def top_regions(df: DataFrame, n: int = 100, approx: bool = False) -> DataFrame:
    known = df.filter(F.col("city").isNotNull() & F.col("district").isNotNull())
    return _top(known, ["city", "district"], n, ("unique_orders", "total_revenue"), approx)


def kpis(df: DataFrame, flt: Column) -> DataFrame:
    """One row with the seven dashboard measures.

    Several distinct counts make Spark expand each row once per count, inside one stage;
    days, cities and vendors collapse map side, so the one shuffle holds little more than
    the orders.
    """
    rows = df.filter(flt & F.col(DAY).isNotNull())
    return rows.agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count("*").alias("total_items"),
        _revenue().alias("total_revenue"),
        _average().alias("avg_order_value"),
        F.count_distinct(DAY).alias("active_days"),
        F.count_distinct("city").alias("unique_cities"),
        F.count_distinct("vendor_id").alias("unique_vendors"),
    )


def growth(df: DataFrame, start, end, mode: str = "previous_period", flt: Column | None = None) -> DataFrame:
    """Orders and revenue of a period against its base period, in one scan.

    Both periods are folded to one row per order first, so the two distinct counts
    need neither a second pass nor row expansion. Growth is null when the base has no order.
    """
    base_start, base_end = comparison_range(start, end, mode)
    in_period, in_base = between_days(start, end), between_days(base_start, base_end)
    rows = df.filter(in_period | in_base)
    if flt is not None:
        rows = rows.filter(flt)
    orders = rows.groupBy("order_id").agg(
        F.max(in_period).alias("in_period"), F.max(in_base).alias("in_base"),
        F.sum(F.when(in_period, F.col("order_amount"))).alias("amount"),
        F.sum(F.when(in_base, F.col("order_amount"))).alias("base_amount"),
    )
    known = F.col("order_id").isNotNull()
    both = orders.agg(
        F.count_if(known & F.col("in_period")).alias("total_orders"),
        F.count_if(known & F.col("in_base")).alias("base_orders"),
        F.sum("amount").cast("double").alias("total_revenue"),
        F.sum("base_amount").cast("double").alias("base_revenue"),
    )
    has_base = F.col("base_orders") > 0
    change = lambda now, base: F.when(has_base, ratio(F.col(now) - F.col(base), F.col(base)) * 100)
    return both.select(
        "*", change("total_orders", "base_orders").alias("growth_orders"),
        change("total_revenue", "base_revenue").alias("growth_revenue"),
    )


def daily_trend(df: DataFrame, flt: Column, n: int = 90) -> DataFrame:
    """Newest n days, oldest first."""
    rows = df.filter(flt & F.col(DAY).isNotNull())
    days = rows.groupBy(F.col(DAY).alias("date")).agg(
        *_measures("unique_orders", "total_revenue", "avg_order_value"))
    return days.orderBy(F.desc("date")).limit(n).orderBy("date")


def avg_daily_revenue(df: DataFrame, flt: Column) -> DataFrame:
    """Revenue per active day, 0 without any."""
    rows = df.filter(flt & F.col(DAY).isNotNull())
    days = rows.groupBy(DAY).agg(F.sum("order_amount").alias("amount"))
    return days.agg(F.coalesce(ratio(F.sum("amount"), F.count("*")), F.lit(0.0)).alias("avg_daily_revenue"))


def weekday_hour(df: DataFrame, flt: Column) -> DataFrame:
    """Orders by weekday (1 = Sunday, correctly labelled) and hour."""
    rows = df.filter(flt & F.col(DAY).isNotNull() & F.col("order_creation_timestamp").isNotNull())
    cells = rows.groupBy(F.dayofweek(DAY).alias("day_of_week"),
                         F.hour("order_creation_timestamp").alias("hour")).agg(_orders().alias("unique_orders"))
    label = F.element_at(F.array(*[F.lit(w) for w in WEEKDAYS]), F.col("day_of_week"))
    return cells.withColumn("day_label", label).orderBy("day_of_week", "hour")


def weekday_hour_pivot(df: DataFrame, flt: Column) -> DataFrame:
    """The same as a matrix with one column per hour; empty cells are 0."""
    hours = list(range(24))
    matrix = weekday_hour(df, flt).groupBy("day_of_week", "day_label").pivot("hour", hours).sum("unique_orders")
    named = matrix.withColumnsRenamed({str(h): f"h{h:02d}" for h in hours})
    return named.fillna(0).orderBy("day_of_week")


def top_cities_normalized(df: DataFrame, flt: Column, n: int = 10, merge_first: bool = False) -> DataFrame:
    """Top cities under their normalised names.

    The published form ranks the raw spellings, keeps ten and merges afterwards, so
    orders of merged spellings add up. ``merge_first`` merges before counting.
    """
    rows = df.filter(flt & F.col("city").isNotNull())
    shown = normalize_turkish(F.col("city")).alias("city_display")
    if merge_first:
        # One read: the names of orders are normalised, not those of rows.
        orders = rows.groupBy("city", "order_id").agg(F.sum("order_amount").alias("order_amount"))
        merged = orders.groupBy(shown).agg(*_measures("unique_orders", "total_revenue"))
    else:
        top = rows.groupBy("city").agg(_orders().alias("unique_orders"), F.sum("order_amount").alias("amount"))
        top = top.orderBy(F.desc("unique_orders"), "city").limit(n)
        merged = top.groupBy(shown).agg(
            F.sum("unique_orders").alias("unique_orders"), F.sum("amount").cast("double").alias("total_revenue"))
    return merged.orderBy(F.desc("unique_orders"), "city_display").limit(n)


def distribution(df: DataFrame, flt: Column, column: str) -> DataFrame:
    """Orders and revenue by payment method or delivery status, labels normalised."""
    rows = df.filter(flt & F.col(column).isNotNull())
    counts = rows.groupBy(column).agg(*_measures("unique_orders", "total_revenue"))
    return counts.withColumn(column, normalize_turkish(F.col(column))).orderBy(F.desc("unique_orders"), column)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Choices of a filter."""
    return df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def expand_cities(df: DataFrame, selected: list[str]) -> DataFrame:
    """Original spellings behind the selected normalised city names."""
    cities = df.filter(F.col("city").isNotNull()).select("city").distinct()
    return cities.filter(normalize_turkish(F.col("city")).isin(list(selected)))


def filter_by_city_names(df: DataFrame, selected: list[str]) -> DataFrame:
    """Orders of the selected normalised city names; no selection keeps everything. A filter
    without a second read of the table or a shuffle."""
    return df.filter(normalize_turkish(F.col("city")).isin(list(selected))) if selected else df


def momentum(daily: DataFrame) -> DataFrame:
    """Newest 7 daily rows against the 7 before, with a direction label.

    Only the newest 14 rows matter, so the numbering runs over 14 rows. With fewer the
    comparison is against itself (stable); a single row gives no result.
    """
    newest = daily.orderBy(F.desc("date")).limit(2 * MOMENTUM_DAYS)
    placed = newest.withColumn("__rn", F.row_number().over(W.partitionBy().orderBy(F.desc("date"))))
    recent_rows, older_rows = F.col("__rn") <= MOMENTUM_DAYS, F.col("__rn") > MOMENTUM_DAYS
    means = placed.agg(
        F.count("*").alias("rows"),
        F.avg(F.when(recent_rows, F.col("unique_orders"))).alias("recent_avg"),
        F.avg(F.when(older_rows, F.col("unique_orders"))).alias("older_avg"),
    ).filter(F.col("rows") > 1)
    previous = F.when(F.col("rows") >= 2 * MOMENTUM_DAYS, F.col("older_avg")).otherwise(F.col("recent_avg"))
    compared = means.select("recent_avg", previous.alias("previous_avg"))
    label = (
        F.when(F.col("recent_avg") > F.col("previous_avg") * MOMENTUM_UP, F.lit("up"))
        .when(F.col("recent_avg") < F.col("previous_avg") * MOMENTUM_DOWN, F.lit("down"))
        .otherwise(F.lit("stable"))
    )
    return compared.withColumn("direction", label)


# Column names of the order list and its display headings.
ORDER_LIST = {
    "order_id": "order_id",
    "order_created_date_tr": "tarih",
    "city": "sehir",
    "payment_method": "odeme_yontemi",
    "delivery_status": "teslimat_durumu",
    "vendor_id": "vendor_id",
    "product_name": "urun_adi",
    "product_code_1": "urun_kodu",
    "order_amount": "siparis_tutari",
    "order_creation_timestamp": "siparis_zamani",
}
ORDER_LIST_HEADINGS = {
    "order_id": "Sipariş ID",
    "tarih": "Tarih",
    "sehir": "Şehir",
    "odeme_yontemi": "Ödeme Yöntemi",
    "teslimat_durumu": "Teslimat Durumu",
    "vendor_id": "Vendor ID",
    "urun_adi": "Ürün Adı",
    "urun_kodu": "Ürün Kodu",
    "siparis_tutari": "Sipariş Tutarı",
    "siparis_zamani": "Sipariş Zamanı",
}
ORDER_LIST_LIMITS = [100, 500, 1000, 5000, 10000]
# End of fixed values.


def order_list(df: DataFrame, flt: Column, limit: int | None = 1000, tiebreak: list[str] = ()) -> DataFrame:
    """Newest order items under their list names; without a limit all of them, as an export needs."""
    if limit is not None and limit not in ORDER_LIST_LIMITS:
        raise ValueError(f"limit must be one of {ORDER_LIST_LIMITS}")
    rows = df.filter(flt & F.col(DAY).isNotNull())
    top = rows.orderBy(F.desc(DAY), "order_id", *tiebreak)
    top = top if limit is None else top.limit(limit)
    return top.select(*[F.col(src).alias(name) for src, name in ORDER_LIST.items()])


def order_list_display(listed: DataFrame) -> DataFrame:
    """Order list with normalised texts, formatted money and times, and headings."""
    from stallmetrics.functions.money import format_money

    texts = ["sehir", "odeme_yontemi", "teslimat_durumu", "urun_adi"]
    shown = listed.withColumns({c: normalize_turkish(F.col(c)) for c in texts})
    shown = shown.withColumn("siparis_tutari", format_money(F.col("siparis_tutari")))
    shown = shown.withColumn("siparis_zamani", F.date_format("siparis_zamani", "yyyy-MM-dd HH:mm:ss"))
    return shown.withColumnsRenamed(ORDER_LIST_HEADINGS)
