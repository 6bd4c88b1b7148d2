"""Registered queries: audits and row selection of the order-items table."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallmetrics.operators import dedupe, quality, reconcile, repair
from stallmetrics.plans.order_reports import round2
from stallmetrics.plans.registry import query
from stallmetrics.plans.views import (AS_OF, RECORD_SQL, order_items, order_items_dup, with_dup_orders, with_orders)

DAY = "order_created_date_tr"
ORDERS = "count(DISTINCT order_id)"
# dup_items with whole-row grain: one record per distinct row and its copies
GRAIN = ", grain AS (SELECT *, count(*) AS copies FROM dup_items GROUP BY ALL)"


def summary_sql(where: str = "TRUE", select: str = "", group: str = "") -> str:
    return f"""SELECT {select} CAST(coalesce(sum(copies), 0) AS BIGINT) AS total_rows, {ORDERS} AS unique_orders,
       count(*) AS unique_rows, CAST(coalesce(sum(copies - 1), 0) AS BIGINT) AS exact_duplicates,
       {round2(f'CAST(sum(copies) AS DOUBLE) / {ORDERS}')} AS avg_items_per_order
FROM grain WHERE {where} {group}"""


@query("a21_duplicate_summary", with_dup_orders(GRAIN + summary_sql()))
def _(spark, sf):
    return quality.duplicate_summary(order_items_dup(spark, sf))


@query("m10_duplicate_summary_day", with_dup_orders(GRAIN + summary_sql(f"{DAY} = DATE '1997-03-18'")))
def _(spark, sf):
    return quality.duplicate_summary(order_items_dup(spark, sf), "1997-03-18")


@query("a22_dates_with_surplus", with_dup_orders(f"""
SELECT {DAY} AS date, count(*) AS total_rows, {ORDERS} AS unique_orders, count(*) - {ORDERS} AS potential_duplicates
FROM dup_items WHERE year({DAY}) = 2000 AND month({DAY}) IN (10, 11) GROUP BY 1 HAVING count(*) > {ORDERS}"""))
def _(spark, sf):
    rows = order_items_dup(spark, sf, "order_id", DAY)
    return quality.dates_with_surplus(rows, 2000, [10, 11])


@query("f21_dates_with_duplicates", with_dup_orders(GRAIN + f"""
SELECT {DAY}, CAST(sum(copies) AS BIGINT) AS total_rows, count(*) AS unique_rows FROM grain GROUP BY 1
HAVING sum(copies) > count(*)"""))
def _(spark, sf):
    return quality.dates_with_duplicates(order_items_dup(spark, sf))


@query("a23_health_by_day", with_dup_orders(GRAIN + f"""
, span AS (SELECT *, CAST(sum(copies) OVER (PARTITION BY order_id) AS BIGINT) AS item_count FROM grain
           WHERE {DAY} >= DATE '{AS_OF}' - 7)
SELECT {DAY} AS date, CAST(sum(copies) AS BIGINT) AS total_rows, {ORDERS} AS unique_orders, count(*) AS unique_rows,
       CAST(sum(copies - 1) AS BIGINT) AS exact_duplicates,
       {round2(f'CAST(sum(copies) AS DOUBLE) / {ORDERS}')} AS avg_items_per_order,
       count(DISTINCT order_id) FILTER (WHERE item_count = 1) AS single_item_orders,
       count(DISTINCT order_id) FILTER (WHERE item_count >= 2) AS multi_item_orders,
       CASE WHEN sum(copies - 1) = 0 THEN '{quality.CLEAN}' ELSE '{quality.HAS_DUPLICATES}' END AS status
FROM span GROUP BY 1"""))
def _(spark, sf):
    return quality.health_by_day(order_items_dup(spark, sf), AS_OF)


@query("a24_health_today", with_dup_orders(GRAIN + f"""
SELECT '{quality.TODAY_LABEL}' AS "check", CAST(sum(copies) AS BIGINT) AS total_rows, {ORDERS} AS unique_orders,
       count(*) AS unique_rows, CAST(sum(copies - 1) AS BIGINT) AS exact_duplicates,
       min(order_creation_timestamp) AS first_ts, max(order_creation_timestamp) AS last_ts,
       datesub('hour', min(order_creation_timestamp), max(order_creation_timestamp)) AS span_hours
FROM grain WHERE {DAY} = DATE '1997-03-18'"""))
def _(spark, sf):
    return quality.health_today(order_items_dup(spark, sf), "1997-03-18")


@query("a25_duplicate_groups", with_dup_orders(f"""
SELECT order_id, product_code_1, user_id, city, count(*) AS duplicate_count,
       min(order_creation_timestamp) AS first_seen, max(order_creation_timestamp) AS last_seen
FROM dup_items GROUP BY order_id, product_code_1, user_id, city, hash(dup_items) HAVING count(*) > 1
ORDER BY duplicate_count DESC, order_id, product_code_1, user_id, city LIMIT 10"""))
def _(spark, sf):
    return quality.duplicate_groups(order_items_dup(spark, sf))


@query("a26_duplicate_samples", with_dup_orders("""
, top AS (SELECT order_id, count(*) AS duplicate_count FROM dup_items GROUP BY 1 HAVING count(*) > 1
          ORDER BY 2 DESC, 1 LIMIT 20)
SELECT order_id, duplicate_count, product_code_1, vendor_id, order_delivery_date, """ + RECORD_SQL + """ AS record
FROM dup_items JOIN top USING (order_id)"""))
def _(spark, sf):
    records = quality.duplicate_samples(order_items_dup(spark, sf))
    return records.select(
        "order_id", "duplicate_count", "product_code_1", "vendor_id", "order_delivery_date", "record")


@query("a27_hourly_load", with_dup_orders(GRAIN + f"""
SELECT CAST(hour(order_creation_timestamp) AS INTEGER) AS hour, CAST(sum(copies) AS BIGINT) AS total_rows,
       {ORDERS} AS unique_orders, CAST(sum(copies - 1) AS BIGINT) AS exact_duplicates
FROM grain WHERE {DAY} = DATE '1997-03-18' GROUP BY 1"""))
def _(spark, sf):
    return quality.hourly_load(order_items_dup(spark, sf), "1997-03-18")


@query("a28_null_audit", with_orders(f"""
SELECT '{quality.QUALITY_LABEL}' AS "check", count(*) AS total_rows, count(*) FILTER (WHERE order_id IS NULL) AS order_id_null,
       count(*) FILTER (WHERE user_id IS NULL OR user_id = '') AS user_id_blank,
       count(*) FILTER (WHERE order_code IS NULL OR order_code = '') AS product_code_blank,
       count(*) FILTER (WHERE delivery_status = 'O') AS city_blank,
       count(*) FILTER (WHERE delivery_status = 'F') AS timestamp_null FROM order_items"""))
def _(spark, sf):
    rows = order_items(spark, sf, "order_id", "user_id", "order_code", "delivery_status", "order_creation_timestamp")
    # The given tables have no gaps, so some are cut here: codes, cities and times go missing.
    gaps = rows.select(
        "order_id", "user_id", F.col("order_code").alias("product_code_1"),
        F.when(F.col("delivery_status") == "O", F.lit("")).otherwise(F.col("delivery_status")).alias("city"),
        F.when(F.col("delivery_status") != "F", F.col("order_creation_timestamp")).alias("order_creation_timestamp"))
    return quality.null_audit(gaps)


@query("a29_hourly_trend", with_orders(f"""
SELECT date_trunc('hour', order_creation_timestamp) AS hour, count(*) AS new_rows, {ORDERS} AS new_orders
FROM order_items WHERE order_creation_timestamp >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 24 HOUR
GROUP BY 1 ORDER BY 1 DESC LIMIT 24"""))
def _(spark, sf):
    as_of = F.lit("2001-08-01 12:00:00").cast("timestamp_ntz")
    return quality.hourly_trend(order_items(spark, sf, "order_id", "order_creation_timestamp"), as_of)


@query("a30_health_line", with_dup_orders(GRAIN + f"""
SELECT DATE '1997-03-18' AS date, CAST(sum(copies) AS BIGINT) AS row_count, {ORDERS} AS order_count,
       CAST(sum(copies - 1) AS BIGINT) AS duplicate_count,
       CASE WHEN sum(copies - 1) = 0 THEN '{quality.LINE_CLEAN}' ELSE '{quality.LINE_PREFIX}' ||
            CAST(CAST(sum(copies - 1) AS BIGINT) AS VARCHAR) || '{quality.LINE_SUFFIX}' END AS status
FROM grain WHERE {DAY} = DATE '1997-03-18'"""))
def _(spark, sf):
    return quality.health_line(order_items_dup(spark, sf), "1997-03-18")


@query("a31_items_per_order", with_orders("""
SELECT item_count, count(DISTINCT order_id) AS order_count, count(*) AS total_items
FROM (SELECT order_id, count(*) AS item_count FROM order_items GROUP BY 1) GROUP BY 1"""))
def _(spark, sf):
    return quality.items_per_order(order_items(spark, sf, "order_id"))


ORDER_SIZE_SQL = f"""
SELECT {DAY} AS date, count(*) AS row_count, {ORDERS} AS unique_orders,
       count(DISTINCT order_id) FILTER (WHERE item_count = 1) AS orders_1_item,
       count(DISTINCT order_id) FILTER (WHERE item_count >= 2) AS orders_2plus_items,
       {round2(f'CAST(count(*) AS DOUBLE) / {ORDERS}')} AS avg_items_per_order
FROM (SELECT order_id, {DAY}, count(*) OVER (PARTITION BY order_id) AS item_count FROM order_items WHERE WHERE_) GROUP BY 1"""


@query("a32_order_size_by_day", with_orders(
    ORDER_SIZE_SQL.replace("WHERE_", f"year({DAY}) = 2000 AND month({DAY}) = 11")))
def _(spark, sf):
    return quality.order_size_by_day(order_items(spark, sf, "order_id", DAY), 2000, [11])


@query("w04_order_size", with_orders(ORDER_SIZE_SQL.replace("WHERE_", "TRUE")))
def _(spark, sf):
    return quality.order_size_by_day(order_items(spark, sf, "order_id", DAY))


@query("a33_monthly_coverage", with_orders(f"""
SELECT CAST(year(order_delivery_date) AS INTEGER) AS year, CAST(month(order_delivery_date) AS INTEGER) AS month,
       strftime(order_delivery_date, '%Y-%m') AS year_month, strftime(order_delivery_date, '%B %Y') AS month_name,
       {ORDERS} AS total_orders, count(*) AS total_rows,
       count(DISTINCT order_id) FILTER (WHERE order_code IS NOT NULL) AS orders_with_code,
       count(DISTINCT order_id) FILTER (WHERE order_code IS NULL) AS orders_without_code,
       count(order_code) AS rows_with_code, count(*) - count(order_code) AS rows_without_code,
       {round2(f'CAST(count(DISTINCT order_id) FILTER (WHERE order_code IS NOT NULL) AS DOUBLE) * 100 / {ORDERS}')} AS code_coverage_pct,
       {round2(f'CAST(count(*) AS DOUBLE) / {ORDERS}')} AS items_per_order
FROM order_items WHERE order_delivery_date >= DATE '1995-01-01' AND order_delivery_date < DATE '2002-01-01'
GROUP BY ALL"""))
def _(spark, sf):
    rows = order_items(spark, sf, "order_id", "order_code", "order_delivery_date")
    return quality.monthly_coverage(rows, "1995-01-01", "2002-01-01")


@query("a33b_day_counts", with_orders(f"""
SELECT {DAY} AS date, count(*) AS row_count, {ORDERS} AS unique_orders FROM order_items
WHERE {DAY} BETWEEN DATE '2000-11-01' AND DATE '2000-11-05' GROUP BY 1"""))
def _(spark, sf):
    return quality.day_counts(order_items(spark, sf, "order_id", DAY), "2000-11-01", "2000-11-05")


@query("a33b_range_check", with_orders(f"""
SELECT count(*) AS row_count, {ORDERS} AS unique_orders, min({DAY}) AS min_date, max({DAY}) AS max_date,
       count(DISTINCT {DAY}) AS day_count FROM order_items WHERE {DAY} BETWEEN DATE '2000-11-01' AND DATE '2000-11-30'"""))
def _(spark, sf):
    return quality.range_check(order_items(spark, sf, "order_id", DAY), "2000-11-01", "2000-11-30")


@query("j06_duplicate_order_details", with_dup_orders(GRAIN + """
, chosen AS (SELECT DISTINCT order_id FROM grain WHERE copies > 1 ORDER BY order_id LIMIT 5)
SELECT order_id, user_id, city, product_code_1, additional_products, order_creation_timestamp,
       """ + RECORD_SQL + """ AS record FROM dup_items WHERE order_id IN (SELECT order_id FROM chosen)"""))
def _(spark, sf):
    return quality.duplicate_order_details(order_items_dup(spark, sf))


CHANGED_CTE = """
, changed AS (SELECT * REPLACE (CASE WHEN order_id % 97 = 0 THEN order_amount + 1 ELSE order_amount END AS order_amount)
              FROM order_items WHERE order_id % 113 <> 5),
surplus AS (SELECT 'a' AS side, * FROM (SELECT * FROM dup_items EXCEPT ALL SELECT * FROM changed)
            UNION ALL SELECT 'b', * FROM (SELECT * FROM changed EXCEPT ALL SELECT * FROM dup_items))"""


def changed_items(spark, sf):
    """Order items of which some have another amount and some are missing."""
    amount = F.when(F.col("order_id") % 97 == 0, F.col("order_amount") + 1).otherwise(F.col("order_amount"))
    rows = order_items(spark, sf).filter(F.col("order_id") % 113 != 5)
    return rows.withColumn("order_amount", amount.cast("decimal(18,2)"))


@query("j10_reconcile_rows", with_dup_orders(CHANGED_CTE + f"""
SELECT {DAY} AS date, order_id AS key, side, count(*) AS rows FROM surplus GROUP BY ALL"""))
def _(spark, sf):
    return reconcile.reconcile_rows(order_items_dup(spark, sf), changed_items(spark, sf))


@query("m10_differing_days", with_dup_orders(CHANGED_CTE + f"SELECT DISTINCT {DAY} AS date FROM surplus"))
def _(spark, sf):
    return reconcile.differing_days(order_items_dup(spark, sf), changed_items(spark, sf))


@query("j10_reconcile_days", with_dup_orders(f"""
, a AS (SELECT {DAY} AS date, count(*) AS n, {ORDERS} AS o FROM dup_items GROUP BY 1),
b AS (SELECT {DAY} AS date, count(*) AS n, {ORDERS} AS o FROM order_items WHERE delivery_status <> 'P' GROUP BY 1)
SELECT date, coalesce(a.n, 0) AS rows_a, coalesce(a.o, 0) AS orders_a, coalesce(b.n, 0) AS rows_b,
       coalesce(b.o, 0) AS orders_b, coalesce(a.n, 0) - coalesce(b.n, 0) AS rows_diff,
       coalesce(a.o, 0) - coalesce(b.o, 0) AS orders_diff FROM a FULL JOIN b USING (date)"""))
def _(spark, sf):
    newer = order_items_dup(spark, sf, "order_id", DAY)
    # The older table: another date column, a timestamp, and pending orders not loaded.
    older = order_items(spark, sf, "order_id", "order_creation_timestamp", "delivery_status")
    older = older.filter(F.col("delivery_status") != "P").withColumnRenamed(
        "order_creation_timestamp", "order_created_date")
    return quality.reconcile_days(newer, older)


KEPT = ["order_id", "product_code_1", "vendor_id", "rider_id", "order_creation_timestamp"]
KEPT_SQL = ", ".join(KEPT)


@query("w01_dedupe_exact", with_dup_orders(f"SELECT {KEPT_SQL} FROM (SELECT DISTINCT * FROM dup_items)"))
def _(spark, sf):
    return dedupe.dedupe_exact(order_items_dup(spark, sf)).select(*KEPT)


@query("w02_dedupe_fingerprint", with_dup_orders(f"SELECT {KEPT_SQL} FROM (SELECT DISTINCT * FROM dup_items)"))
def _(spark, sf):
    return dedupe.dedupe_fingerprint(order_items_dup(spark, sf)).select(*KEPT)


LATEST_TIES = ["order_delivery_date", "product_code_1", "vendor_id"]
LATEST_SQL = with_dup_orders(f"""
SELECT {KEPT_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_creation_timestamp DESC,
  order_delivery_date DESC, product_code_1 DESC, vendor_id DESC, rider_id DESC) AS rn FROM dup_items) WHERE rn = 1""")


@query("w03_dedupe_latest", LATEST_SQL)
def _(spark, sf):
    rows = order_items_dup(spark, sf, *KEPT, "order_delivery_date")
    return dedupe.dedupe_latest(rows, ["order_id"], "order_creation_timestamp",
                                [*LATEST_TIES, "rider_id"]).select(*KEPT)


@query("j09_delete_older_versions", LATEST_SQL)
def _(spark, sf):
    rows = order_items_dup(spark, sf, *KEPT, "order_delivery_date")
    return repair.delete_older_versions(rows, ["order_id"], "order_creation_timestamp",
                                        [*LATEST_TIES, "rider_id"]).select(*KEPT)


@query("w06_keep_first", with_orders("""
SELECT user_id, order_id, vendor_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY order_creation_timestamp, order_id, vendor_id, product_code_1) AS rn
  FROM order_items) WHERE rn = 1"""))
def _(spark, sf):
    position = ["order_creation_timestamp", "order_id", "vendor_id", "product_code_1"]
    rows = order_items(spark, sf, "user_id", *position)
    return dedupe.keep_first(rows, ["user_id"], position).select("user_id", "order_id", "vendor_id")


@query("w08_first_n_per_key", with_orders("""
SELECT user_id, order_id, vendor_id, product_code_1 FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY order_creation_timestamp, order_id, vendor_id, product_code_1) AS rn
  FROM order_items) WHERE rn <= 20"""))
def _(spark, sf):
    position = ["order_creation_timestamp", "order_id", "vendor_id", "product_code_1"]
    rows = order_items(spark, sf, "user_id", *position)
    return dedupe.first_n(rows, ["user_id"], 20, position).select("user_id", "order_id", "vendor_id", "product_code_1")
