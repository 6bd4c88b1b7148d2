"""Registered queries: order metrics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from stallmetrics.functions import filters
from stallmetrics.functions.clock import ALL_TIME_START, PRESET_DAYS, preset_range
from stallmetrics.operators import frequent, rollup, sales
from stallmetrics.plans.registry import query
from stallmetrics.plans.views import ALL_COLUMNS, AS_OF, order_items, with_orders
from stallmetrics.session import new_workdir

DAY = "order_created_date_tr"
START, END = "1998-01-01", "1999-12-31"
PAYMENTS = ["1-URGENT", "5-LOW"]
FLT = lambda: filters.build_filter(START, END, payments=PAYMENTS)
FLT_SQL = f"order_created_date_tr BETWEEN DATE '{START}' AND DATE '{END}' AND payment_method IN ('1-URGENT', '5-LOW')"

ORDERS = "count(DISTINCT order_id) AS unique_orders"
ITEMS = "count(*) AS total_items"
REVENUE = "CAST(sum(order_amount) AS DOUBLE) AS total_revenue"
AVERAGE = "CAST(sum(order_amount) AS DOUBLE) / count(order_amount) AS avg_order_value"


def grouped(key: str, name: str, measures: str, where: str, tail: str = "") -> str:
    return with_orders(f"SELECT {key} AS {name}, {measures} FROM order_items WHERE {where} GROUP BY {key} {tail}")


def round2(expr: str) -> str:
    """Round half up on the decimal text of a double, as Spark does."""
    return f"CAST(round(CAST({expr} AS DECIMAL(30,10)), 2) AS DOUBLE)"


BASIC = f"{ORDERS}, {ITEMS}, {REVENUE}, {AVERAGE}"
BASE = ("order_id", "order_amount", DAY)


@query("a01_daily_summary", grouped(DAY, "date", BASIC, f"{DAY} IS NOT NULL"))
def _(spark, sf):
    return sales.daily_summary(order_items(spark, sf, *BASE))


@query("a02_monthly_summary", grouped(f"CAST(date_trunc('month', {DAY}) AS DATE)", "month", BASIC, f"{DAY} IS NOT NULL"))
def _(spark, sf):
    return sales.monthly_summary(order_items(spark, sf, *BASE))


@query("a03_top_cities", grouped("city", "city", f"{ORDERS}, {ITEMS}, {REVENUE}", "city IS NOT NULL",
                                 "ORDER BY unique_orders DESC, city LIMIT 20"))
def _(spark, sf):
    return sales.top_cities(order_items(spark, sf, *BASE, "city"))


@query("a04_by_category", grouped("CAST(product_category AS VARCHAR)", "category_id",
                                  f"{ORDERS}, {ITEMS}, {REVENUE}", "product_category IS NOT NULL"))
def _(spark, sf):
    return sales.by_category(order_items(spark, sf, *BASE, "product_category"))


@query("a05_payment_mix", with_orders(f"""
SELECT payment_method, unique_orders, total_revenue,
       {round2('total_revenue * 100.0 / sum(total_revenue) OVER ()')} AS revenue_percentage
FROM (SELECT payment_method, {ORDERS}, {REVENUE} FROM order_items WHERE payment_method IS NOT NULL GROUP BY 1)"""))
def _(spark, sf):
    return sales.payment_mix(order_items(spark, sf, *BASE, "payment_method"))


@query("a06_by_delivery_status", grouped("delivery_status", "delivery_status", f"{ORDERS}, {ITEMS}",
                                         "delivery_status IS NOT NULL"))
def _(spark, sf):
    return sales.by_delivery_status(order_items(spark, sf, *BASE, "delivery_status"))


@query("a07_totals", with_orders(f"""
SELECT count(DISTINCT order_id) AS total_unique_orders, {ITEMS}, {REVENUE}, {AVERAGE},
       count(DISTINCT {DAY}) AS days_with_orders FROM order_items WHERE {DAY} IS NOT NULL"""))
def _(spark, sf):
    return sales.totals(order_items(spark, sf, *BASE))


@query("a08_trend", grouped(DAY, "date", f"{ORDERS}, {REVENUE}", f"{DAY} >= DATE '{AS_OF}' - 30"))
def _(spark, sf):
    return sales.trend(order_items(spark, sf, *BASE), AS_OF)


@query("a09_by_hour", grouped("CAST(hour(order_creation_timestamp) AS INTEGER)", "hour", f"{ORDERS}, {REVENUE}",
                              "order_creation_timestamp IS NOT NULL"))
def _(spark, sf):
    return sales.by_hour(order_items(spark, sf, *BASE, "order_creation_timestamp"))


@query("a10_top_vendors", grouped("vendor_id", "vendor_id", BASIC, "vendor_id IS NOT NULL",
                                  "ORDER BY unique_orders DESC, vendor_id LIMIT 50"))
def _(spark, sf):
    return sales.top_vendors(order_items(spark, sf, "order_id", "order_amount", "vendor_id"))


@query("a11_top_products", with_orders(f"""
SELECT product_name, product_code_1, {ORDERS}, count(*) AS total_items_sold, {REVENUE},
       CAST(sum(order_amount) AS DOUBLE) / count(order_amount) AS avg_price
FROM order_items WHERE product_name IS NOT NULL GROUP BY product_name, product_code_1
ORDER BY unique_orders DESC, product_name, product_code_1 LIMIT 50"""))
def _(spark, sf):
    return sales.top_products(order_items(spark, sf, "order_id", "order_amount", "product_name", "product_code_1"))


@query("a12_top_regions", with_orders(f"""
SELECT city, district, {ORDERS}, {REVENUE} FROM order_items WHERE city IS NOT NULL AND district IS NOT NULL
GROUP BY city, district ORDER BY unique_orders DESC, city, district LIMIT 100"""))
def _(spark, sf):
    return sales.top_regions(order_items(spark, sf, *BASE, "city", "district"))


KPI_SQL = with_orders(f"""
SELECT count(DISTINCT order_id) AS total_orders, {ITEMS}, {REVENUE}, {AVERAGE},
       count(DISTINCT {DAY}) AS active_days, count(DISTINCT city) AS unique_cities,
       count(DISTINCT vendor_id) AS unique_vendors FROM order_items WHERE {FLT_SQL}""")


@query("a13_kpis", KPI_SQL)
def _(spark, sf):
    return sales.kpis(order_items(spark, sf, *BASE, "city", "vendor_id", "payment_method"), FLT())


def growth_sql(start: str, end: str, base_start: str, base_end: str) -> str:
    cur = f"{DAY} BETWEEN DATE '{start}' AND DATE '{end}'"
    base = f"{DAY} BETWEEN DATE '{base_start}' AND DATE '{base_end}'"
    return with_orders(f"""
SELECT *, CASE WHEN base_orders > 0 THEN CAST(total_orders - base_orders AS DOUBLE) / base_orders * 100 END AS growth_orders,
       CASE WHEN base_orders > 0 THEN (total_revenue - base_revenue) / base_revenue * 100 END AS growth_revenue
FROM (SELECT count(DISTINCT order_id) FILTER (WHERE {cur}) AS total_orders,
             count(DISTINCT order_id) FILTER (WHERE {base}) AS base_orders,
             CAST(sum(order_amount) FILTER (WHERE {cur}) AS DOUBLE) AS total_revenue,
             CAST(sum(order_amount) FILTER (WHERE {base}) AS DOUBLE) AS base_revenue
      FROM order_items WHERE payment_method IN ('1-URGENT', '5-LOW'))""")


GROWTH_SPAN = ("2000-02-01", "2000-04-15")  # 74 days apart
GROWTH_BASES = {
    "previous_period": ("1999-11-18", "2000-01-31"),
    "previous_year": ("1999-02-01", "1999-04-16"),
    "previous_month": ("2000-01-02", "2000-03-16"),
}


def _register_growth(mode: str, base: tuple[str, str]) -> None:
    @query(f"a14_growth_{mode}", growth_sql(*GROWTH_SPAN, *base))
    def _(spark, sf):
        start, end = (date.fromisoformat(d) for d in GROWTH_SPAN)
        rows = order_items(spark, sf, *BASE, "payment_method")
        return sales.growth(rows, start, end, mode, filters.build_filter(payments=PAYMENTS))


for _mode, _base in GROWTH_BASES.items():
    _register_growth(_mode, _base)


ROLLED = [DAY, "order_id", "order_amount", "city", "vendor_id", "payment_method"]


def rolled_up(spark, sf) -> dict:
    """The roll-up built while a year of the fact had half its rows, and then refreshed for the days of that year."""
    path = f"{new_workdir(spark, 'rollup')}/daily"
    fact = order_items(spark, sf, *ROLLED)
    early = fact.filter((F.year(DAY) != 1998) | (F.col("order_id") % 2 == 0))
    rollup.build(early, path, ["payment_method"], "year")  # a year a file, as the table is small
    rollup.refresh(fact, path, ["payment_method"], [date(1998, 3, 1), date(1998, 12, 31)], "year")
    return rollup.load(spark, path)


@query("a13_kpis_from_rollup", KPI_SQL)
def _(spark, sf):
    return rollup.kpis(rolled_up(spark, sf), FLT())


@query("a14_growth_from_rollup", growth_sql(*GROWTH_SPAN, *GROWTH_BASES["previous_year"]))
def _(spark, sf):
    start, end = (date.fromisoformat(d) for d in GROWTH_SPAN)
    return rollup.growth(rolled_up(spark, sf), start, end, "previous_year", filters.build_filter(payments=PAYMENTS))


@query("o01_frequent_vendors", with_orders(f"""
SELECT vendor_id, count(*) AS estimate, CAST(ceil((SELECT count(*) FROM order_items WHERE {FLT_SQL}) * {frequent.error_share()}) AS BIGINT)
         AS error_bound
FROM order_items WHERE {FLT_SQL} GROUP BY 1 ORDER BY estimate DESC, vendor_id LIMIT 20"""))
def _(spark, sf):
    """Vendors with the most items of a span, from daily sketches; there are fewer vendors than counters, so counts are exact."""
    path = f"{new_workdir(spark, 'sketches')}/vendors"
    fact = order_items(spark, sf, DAY, "vendor_id", "payment_method")
    frequent.sketches(fact, "vendor_id", ["payment_method"]).write.parquet(path)
    return frequent.top_items(spark.read.parquet(path), FLT(), 20, "vendor_id")


@query("a15_daily_trend", grouped(DAY, "date", f"{ORDERS}, {REVENUE}, {AVERAGE}", FLT_SQL,
                                  "ORDER BY date DESC LIMIT 90"))
def _(spark, sf):
    return sales.daily_trend(order_items(spark, sf, *BASE, "payment_method"), FLT())


@query("a16_avg_daily_revenue", with_orders(f"""
SELECT coalesce(CAST(sum(order_amount) AS DOUBLE) / nullif(count(DISTINCT {DAY}), 0), 0.0) AS avg_daily_revenue
FROM order_items WHERE {FLT_SQL}"""))
def _(spark, sf):
    return sales.avg_daily_revenue(order_items(spark, sf, *BASE, "payment_method"), FLT())


WEEKDAY_SQL = f"""
SELECT CAST(dayofweek({DAY}) + 1 AS INTEGER) AS day_of_week,
       CAST(hour(order_creation_timestamp) AS INTEGER) AS hour, {ORDERS},
       ['Paz', 'Pzt', 'Sal', 'Çar', 'Per', 'Cum', 'Cmt'][dayofweek({DAY}) + 1] AS day_label
FROM order_items WHERE {FLT_SQL} GROUP BY ALL"""


@query("a17_weekday_hour", with_orders(WEEKDAY_SQL))
def _(spark, sf):
    return sales.weekday_hour(order_items(spark, sf, *BASE, "order_creation_timestamp", "payment_method"), FLT())


@query("a17_weekday_hour_pivot", with_orders(
    "SELECT day_of_week, day_label, " + ", ".join(
        f"CAST(coalesce(sum(unique_orders) FILTER (WHERE hour = {h}), 0) AS BIGINT) AS h{h:02d}" for h in range(24))
    + f" FROM ({WEEKDAY_SQL}) GROUP BY 1, 2"))
def _(spark, sf):
    return sales.weekday_hour_pivot(
        order_items(spark, sf, *BASE, "order_creation_timestamp", "payment_method"), FLT())


@query("a18_top_cities_normalized", with_orders(f"""
SELECT city AS city_display, CAST(sum(unique_orders) AS BIGINT) AS unique_orders, CAST(sum(amount) AS DOUBLE) AS total_revenue
FROM (SELECT city, {ORDERS}, sum(order_amount) AS amount FROM order_items WHERE {FLT_SQL} GROUP BY city
      ORDER BY unique_orders DESC, city LIMIT 10) GROUP BY 1"""))
def _(spark, sf):
    return sales.top_cities_normalized(order_items(spark, sf, *BASE, "city", "payment_method"), FLT())


@query("a18_top_cities_merged_first", with_orders(f"""
SELECT city_display, {ORDERS}, {REVENUE} FROM (
  SELECT *, CASE WHEN district IN ('BUILDING', 'MACHINERY') THEN 'ISTANBUL-AVRUPA' ELSE 'ISTANBUL-ANADOLU' END AS city_display
  FROM order_items WHERE {FLT_SQL}) GROUP BY 1 ORDER BY unique_orders DESC, city_display LIMIT 10"""))
def _(spark, sf):
    rows = order_items(spark, sf, *BASE, "district", "payment_method")
    side = F.when(F.col("district").isin("BUILDING", "MACHINERY"), F.lit("avrupa")).otherwise(F.lit("anadolu"))
    spelled = rows.withColumn("city", F.concat(F.lit("  İstanbul "), side, F.col("district")))
    return sales.top_cities_normalized(spelled, FLT(), merge_first=True)


@query("a19_payment_distribution", grouped("payment_method", "payment_method", f"{ORDERS}, {REVENUE}", FLT_SQL))
def _(spark, sf):
    return sales.distribution(order_items(spark, sf, *BASE, "payment_method"), FLT(), "payment_method")


@query("a19_status_distribution", grouped("delivery_status", "delivery_status", f"{ORDERS}, {REVENUE}", FLT_SQL))
def _(spark, sf):
    rows = order_items(spark, sf, *BASE, "payment_method", "delivery_status")
    return sales.distribution(rows, FLT(), "delivery_status")


@query("a20_distinct_cities", with_orders("SELECT DISTINCT city FROM order_items WHERE city IS NOT NULL"))
def _(spark, sf):
    return sales.distinct_values(order_items(spark, sf, "city"), "city")


@query("a20_distinct_payments", with_orders(
    "SELECT DISTINCT payment_method FROM order_items WHERE payment_method IS NOT NULL"))
def _(spark, sf):
    return sales.distinct_values(order_items(spark, sf, "payment_method"), "payment_method")


@query("j11_expand_cities", with_orders(f"""
SELECT city, {ORDERS}, {ITEMS} FROM order_items WHERE city IN ('NATION_3', 'NATION_7') GROUP BY city"""))
def _(spark, sf):
    rows = sales.filter_by_city_names(order_items(spark, sf, "order_id", "city"), ["NATION_3", "NATION_7"])
    return rows.groupBy("city").agg(F.count_distinct("order_id").alias("unique_orders"),
                                    F.count("*").alias("total_items"))


@query("w05_revenue_share", with_orders(f"""
SELECT city, total_revenue, {round2('total_revenue * 100.0 / sum(total_revenue) OVER ()')} AS revenue_percentage
FROM (SELECT city, {REVENUE} FROM order_items GROUP BY city)"""))
def _(spark, sf):
    cities = order_items(spark, sf, "city", "order_amount").groupBy("city").agg(
        F.sum("order_amount").cast("double").alias("total_revenue"))
    return sales.share_of_total(cities, "total_revenue", "revenue_percentage")


@query("w11_momentum", with_orders(f"""
, d AS (SELECT {DAY} AS date, {ORDERS} FROM order_items WHERE {FLT_SQL} GROUP BY 1),
p AS (SELECT unique_orders, row_number() OVER (ORDER BY date DESC) AS rn FROM d),
m AS (SELECT avg(unique_orders) FILTER (WHERE rn <= 7) AS recent_avg,
             avg(unique_orders) FILTER (WHERE rn BETWEEN 8 AND 14) AS previous_avg FROM p)
SELECT recent_avg, previous_avg, CASE WHEN recent_avg > previous_avg * 1.1 THEN 'up'
       WHEN recent_avg < previous_avg * 0.9 THEN 'down' ELSE 'stable' END AS direction FROM m"""))
def _(spark, sf):
    return sales.momentum(sales.daily_trend(order_items(spark, sf, *BASE, "payment_method"), FLT()))


LIST_COLUMNS = tuple(sales.ORDER_LIST)
LIST_TIES = ["product_code_1", "vendor_id", "order_amount"]
LIST_SELECT = ", ".join(f"{src} AS {name}" for src, name in sales.ORDER_LIST.items()).replace(
    "order_amount AS", "CAST(order_amount AS DOUBLE) AS")
LIST_SQL = f"""SELECT {LIST_SELECT} FROM order_items WHERE {FLT_SQL}
ORDER BY order_created_date_tr DESC, order_id, product_code_1, vendor_id, order_amount LIMIT 1000"""


def _listed(spark, sf):
    return sales.order_list(order_items(spark, sf, *LIST_COLUMNS), FLT(), 1000, LIST_TIES)


@query("p14_order_list", with_orders(LIST_SQL))
def _(spark, sf):
    return _listed(spark, sf).withColumn("siparis_tutari", F.col("siparis_tutari").cast("double"))


@query("p15_order_list_display", with_orders(f"""
SELECT order_id AS "Sipariş ID", tarih AS "Tarih", sehir AS "Şehir", odeme_yontemi AS "Ödeme Yöntemi",
       teslimat_durumu AS "Teslimat Durumu", vendor_id AS "Vendor ID", urun_adi AS "Ürün Adı", urun_kodu AS "Ürün Kodu",
       '₺' || format('{{:,.2f}}', siparis_tutari) AS "Sipariş Tutarı",
       strftime(siparis_zamani, '%Y-%m-%d %H:%M:%S') AS "Sipariş Zamanı" FROM ({LIST_SQL})"""))
def _(spark, sf):
    return sales.order_list_display(_listed(spark, sf))


@query("f01_on_day", with_orders(
    f"SELECT count(*) AS row_count FROM order_items WHERE {DAY} = DATE '2000-01-15'"))
def _(spark, sf):
    return order_items(spark, sf, DAY).filter(filters.on_day("2000-01-15")).agg(F.count("*").alias("row_count"))


def _filter_query(name: str, sql: str, flt, *columns: str) -> None:
    """Rows and revenue that pass a predicate."""
    @query(name, with_orders(f"SELECT count(*) AS row_count, {REVENUE} FROM order_items WHERE {sql}"))
    def _(spark, sf):
        rows = order_items(spark, sf, *dict.fromkeys(("order_amount", *columns))).filter(flt())
        return rows.agg(F.count("*").alias("row_count"), F.sum("order_amount").cast("double").alias("total_revenue"))


_filter_query("f02_between", f"{DAY} BETWEEN DATE '{START}' AND DATE '{END}'",
              lambda: filters.between_days(START, END), DAY)
_filter_query("f03_half_open", "order_delivery_date >= DATE '1998-01-01' AND order_delivery_date < DATE '1999-01-01'",
              lambda: filters.half_open("1998-01-01", "1999-01-01", "order_delivery_date"), "order_delivery_date")
_filter_query("f04_two_sided", "order_delivery_date >= DATE '1998-03-01' AND order_delivery_date <= DATE '1998-03-05'",
              lambda: filters.between_days("1998-03-01", "1998-03-05", "order_delivery_date"), "order_delivery_date")
_filter_query("f05_trailing_days", f"{DAY} >= DATE '{AS_OF}' - 90", lambda: filters.trailing_days(AS_OF, 90), DAY)
_filter_query("f06_trailing_hours", "order_creation_timestamp >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 24 HOUR",
              lambda: filters.trailing_hours(F.lit("2001-08-01 12:00:00").cast("timestamp_ntz"), 24,
                                             "order_creation_timestamp"), "order_creation_timestamp")
_filter_query("f07_year_months", f"year({DAY}) = 2000 AND month({DAY}) IN (10, 11)",
              lambda: filters.in_months(2000, [10, 11]), DAY)
_filter_query("f08_in_list", "city IN ('NATION_1', 'NATION_5') AND payment_method IN ('5-LOW')",
              lambda: filters.one_of("city", ["NATION_1", "NATION_5"]) & filters.one_of("payment_method", ["5-LOW"]),
              "city", "payment_method")
_filter_query("f09_not_null", "order_code IS NOT NULL", lambda: F.col("order_code").isNotNull(), "order_code")
_filter_query("f10_blank", "order_code IS NULL OR order_code = ''", lambda: filters.is_blank("order_code"), "order_code")
_filter_query("f11_other_days", f"{DAY} IS DISTINCT FROM DATE '2000-01-15'",
              lambda: filters.not_on_day("2000-01-15"), DAY)
_filter_query("f13_build_filter", f"{FLT_SQL} AND city IN ('NATION_1', 'NATION_2') AND delivery_status IN ('O', 'F')",
              lambda: filters.build_filter(START, END, ["NATION_1", "NATION_2"], PAYMENTS, ["O", "F"]),
              DAY, "city", "payment_method", "delivery_status")
_filter_query("f13_empty_filter", "TRUE", lambda: filters.build_filter())
for _name, _days in {**PRESET_DAYS, "all_time": None}.items():
    _from = f"DATE '{AS_OF}' - {_days}" if _days is not None else f"DATE '{ALL_TIME_START}'"
    _filter_query(f"f14_preset_{_name}", f"{DAY} BETWEEN {_from} AND DATE '{AS_OF}'",
                  lambda name=_name: filters.between_days(*preset_range(name, date.fromisoformat(AS_OF))), DAY)


@query("o05_latest_row", with_orders("""
SELECT max(order_creation_timestamp) AS last_timestamp FROM order_items WHERE order_created_date_tr = DATE '2000-01-15'"""))
def _(spark, sf):
    rows = order_items(spark, sf, DAY, "order_creation_timestamp").filter(filters.on_day("2000-01-15"))
    return rows.agg(F.max("order_creation_timestamp").alias("last_timestamp"))


@query("u02_distinct_rows", with_orders("SELECT DISTINCT city, district, payment_method FROM order_items"))
def _(spark, sf):
    return order_items(spark, sf, "city", "district", "payment_method").distinct()


assert set(LIST_COLUMNS) <= set(ALL_COLUMNS)
