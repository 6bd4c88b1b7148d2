"""Registered queries: sources, sinks, table maintenance, ingest and repair.

Each query writes the given tables (whole) to a fresh directory below the shared folder,
runs the operator there and returns the state it leaves behind, which SQL can state too.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stallmetrics import schemas
from stallmetrics.functions.clock import target_date
from stallmetrics.functions import filters
from stallmetrics.operators import benchmark, dedupe, ingest, key_index, pricing, repair, sales
from stallmetrics.plans.price_reports import (
    CHANGES_CTE, bench_rows, changes, cur, prev, scrape_rows, with_bench)
from stallmetrics.plans.registry import query
from stallmetrics.plans.views import order_items, order_items_dup, with_dup_orders, with_orders, with_snapshots
from stallmetrics.session import new_workdir
from stallmetrics.sinks import clustering, maintenance, tables
from stallmetrics.sources import paths, readers, variants

DAY = "order_created_date_tr"
# The maintenance operators take any date partition. Most queries here use the month, so
# that a small test table does not become thousands of tiny files.
MONTH = "order_month"
TARGET = "2000-04-01"
STATE_SQL = ("SELECT {key} AS part, count(*) AS row_count, count(DISTINCT order_id) AS unique_orders, "
             "CAST(sum(order_amount) AS DOUBLE) AS total_revenue FROM {src} {where} GROUP BY 1")
MONTH_SQL = "CAST(date_trunc('month', order_created_date_tr) AS DATE)"


def state_sql(src: str, where: str = "", key: str = MONTH_SQL) -> str:
    return STATE_SQL.format(src=src, where=where, key=key)


def monthly(rows: DataFrame) -> DataFrame:
    return rows.withColumn(MONTH, F.trunc(DAY, "MM"))


def state(rows: DataFrame, key: str = MONTH) -> DataFrame:
    """Rows, orders and revenue per partition."""
    return rows.groupBy(F.col(key).cast("date").alias("part")).agg(
        F.count("*").alias("row_count"), F.count_distinct("order_id").alias("unique_orders"),
        F.sum("order_amount").cast("double").alias("total_revenue"))


def stored(spark, sf, duplicated: bool = True) -> str:
    """The order items as a table partitioned by month; returns its path."""
    path = f"{new_workdir(spark, 'orders')}/table"
    rows = order_items_dup(spark, sf) if duplicated else order_items(spark, sf)
    tables.write_clustered(monthly(rows), path, MONTH)
    return path


def load(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


@query("s01_read_order_items", with_orders(state_sql("order_items", key=MONTH_SQL)))
def _(spark, sf):
    path = f"{new_workdir(spark, 'fact')}/order_items"
    ingest.conform(order_items(spark, sf)).write.parquet(path)
    return state(monthly(readers.read_order_items(spark, path)))


# Payload files hold every name in every row, so they are compressed; such a file is read by one task and holds a bounded number.
LANDED = {"compression": "gzip", "maxRecordsPerFile": 500_000}


def written_payload(spark, sf) -> str:
    """Order items as landed payload files, one folder per month of pulls."""
    rows = order_items(spark, sf)
    stamp = F.date_format("order_creation_timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    payload = rows.withColumns({
        "day": F.date_format(DAY, "yyyy-MM"),
        "order_created_date": F.date_format(DAY, "yyyy-MM-dd'T'00:00:00"),
        "order_creation_timestamp": stamp,
        "additional_products": F.array("additional_products"),
        "order_delivery_date": F.col("order_delivery_date").cast("string"),
        "requested_delivery_date": F.col("requested_delivery_date").cast("string"),
    }).drop(DAY)
    landing = f"{new_workdir(spark, 'landing')}/payload"
    payload.hint("rebalance", "day").write.partitionBy("day").options(**LANDED).json(landing)
    return landing


@query("s02_read_order_payload", with_orders(state_sql("order_items")))
def _(spark, sf):
    landing = written_payload(spark, sf)
    rows = ingest.conform(ingest.normalize_orders(readers.read_order_payload(spark, landing, multiline=False)))
    return state(monthly(rows))


@query("s02_read_month_payload", with_orders(state_sql("order_items", f"WHERE {MONTH_SQL} = DATE '{TARGET}'")))
def _(spark, sf):
    landing = written_payload(spark, sf)
    month = readers.read_order_payload(spark, landing, date_key=TARGET[:7], multiline=False)
    return state(monthly(ingest.conform(ingest.normalize_orders(month))))


@query("s02_changing_payload", with_orders(f"""
SELECT {MONTH_SQL} AS part, count(*) AS row_count, count(CASE WHEN order_id % 5 <> 0 THEN vendor_id END) AS vendors,
       CAST(sum(order_amount) AS DOUBLE) AS total_revenue, count(CASE WHEN order_id % 7 <> 0 THEN city END) AS cities,
       count(CASE WHEN order_id % 3 = 0 THEN 1 END) AS campaigns, CAST(sum(CASE WHEN order_id % 5 = 0 THEN vendor_id END) AS BIGINT) AS kept_vendors
FROM order_items GROUP BY 1"""))
def _(spark, sf):
    """Files in which some rows have a new field, lack one or hold a text for a number: every value is found again."""
    landing = f"{new_workdir(spark, 'changing')}/payload"
    every = lambda n: F.col("order_id") % n == 0
    rows = order_items(spark, sf, "order_id", DAY, "vendor_id", "order_amount", "city")
    known = F.to_json(F.struct("order_id", F.date_format(DAY, "yyyy-MM-dd'T'00:00:00").alias("order_created_date"), "order_amount",
                               F.when(~every(7), F.col("city")).alias("city"), F.when(~every(5), F.col("vendor_id")).alias("vendor_id"),
                               F.when(every(3), F.struct(F.col("order_id").alias("id"))).alias("campaign")))
    vendor = F.concat(F.lit('{"vendor_id":"v-'), F.col("vendor_id").cast("string"), F.lit('",'))
    line = F.when(every(5), F.concat(vendor, F.substring(known, 2, 1 << 30))).otherwise(known)
    rows.select(F.when(every(2), F.concat(F.lit("["), line, F.lit("]"))).otherwise(line)).write.text(landing)
    found = variants.read_changing_payload(spark, landing, schemas.ORDER_PAYLOAD)
    return changing_state(found)


def changing_state(found: DataFrame) -> DataFrame:
    """Typed and kept values per month."""
    kept = F.regexp_extract(F.try_element_at("rest", F.lit("vendor_id")), r"(\d+)", 1).try_cast("long")
    day = F.to_date(F.substring("order_created_date", 1, 10))
    return found.groupBy(F.trunc(day, "MM").alias("part")).agg(
        F.count("*").alias("row_count"), F.count("vendor_id").alias("vendors"),
        F.sum("order_amount").cast("double").alias("total_revenue"), F.count("city").alias("cities"),
        F.count(F.try_element_at("rest", F.lit("campaign"))).alias("campaigns"), F.sum(kept).alias("kept_vendors"))


CHUNK = 50
#: Parts in which a site's products are numbered, so that no task gets all of a large site.
SITE_PARTS = 4


def snapshot_documents(rows: DataFrame) -> DataFrame:
    """Nested snapshot documents of the current snapshot, at most 50 products each.

    Products are cut by their number in a part of their site, not by their id: ranges of ids, of which a
    site has few, made documents of one or two products, and each of these costs a reader far more than its
    text (the JSON parser copies its table of names for a document with a new one). Numbers and documents
    need one shuffle.
    """
    part = F.pmod(F.xxhash64("product_id"), F.lit(SITE_PARTS))
    place = F.row_number().over(W.partitionBy("site_id", "part").orderBy("product_id"))
    numbered = rows.withColumn("part", part).withColumn("chunk", F.floor((place - 1) / CHUNK))
    product = F.struct(F.col("product_name").alias("name"), "price", "url", "category",
                       F.col("timestamp").cast("timestamp").alias("timestamp"))
    docs = numbered.groupBy("site_id", "site_name", "part", "chunk").agg(
        F.map_from_entries(F.collect_list(F.struct("product_id", product))).alias("products"))
    site = F.struct(F.col("site_name").alias("name"), "products")
    return docs.select(F.create_map("site_id", site).alias("sites"))


FLAT_COLUMNS = ["site_id", "site_name", "product_id", "product_name", "price", "url", "category"]


STAMP = 'CAST("timestamp" AS TIMESTAMP) AS seen_at'


def stamped(rows: DataFrame, column: str = "timestamp") -> DataFrame:
    return rows.withColumn("seen_at", F.col(column).cast("timestamp_ntz"))


@query("s03_flatten_snapshot", with_snapshots(f"SELECT {', '.join(FLAT_COLUMNS)}, {STAMP} FROM cur_snap"))
def _(spark, sf):
    path = f"{new_workdir(spark, 'snapshot')}/docs"
    snapshot_documents(cur(spark, sf)).write.json(path)
    found = readers.flatten_snapshot(readers.read_snapshot(spark, path, multiline=False))
    return stamped(found).select(*FLAT_COLUMNS, "seen_at")


@query("s04_flatten_flat_snapshot", with_snapshots(f"SELECT product_id, product_name, price, url, {STAMP} FROM cur_snap"))
def _(spark, sf):
    path = f"{new_workdir(spark, 'flat')}/docs"
    docs = snapshot_documents(cur(spark, sf)).select(F.explode("sites").alias("site_id", "site"))
    docs.select(F.to_json("site.products").alias("value")).write.text(path)
    texts = readers.read_flat_snapshot(spark, path, wholetext=False)
    return stamped(readers.flatten_flat_snapshot(texts)).select("product_id", "product_name", "price", "url", "seen_at")


@query("s05_flatten_scrape", with_snapshots("""
SELECT CAST(s_suppkey AS VARCHAR) AS site_id, s_name AS site_name, s_acctbal >= 0 AS success,
       CASE WHEN s_acctbal < 0 THEN 'timeout' END AS error, c.product_id, c.price, CAST(c."timestamp" AS TIMESTAMP) AS seen_at,
       TIMESTAMP '2000-01-01 10:00:00' AS scraped_at,
       CASE WHEN c.product_id IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY c.site_id, CAST(c.product_id AS BIGINT) // 50
            ORDER BY CAST(c.product_id AS BIGINT)) - 1 AS INTEGER) END AS position
FROM supplier LEFT JOIN cur_snap c ON c.site_id = CAST(s_suppkey AS VARCHAR) AND s_acctbal >= 0"""))
def _(spark, sf):
    path = f"{new_workdir(spark, 'scrape')}/docs"
    chunk = F.floor(F.col("product_id").cast("long") / CHUNK).alias("chunk")
    product = F.when(F.col("product_id").isNotNull(), F.struct(
        F.col("product_id").cast("long").alias("n"), F.col("product_id").alias("id"), F.col("product_name").alias("name"), "price",
        "url", "category", F.col("timestamp").cast("timestamp").alias("timestamp")))
    sites = scrape_rows(spark, sf).groupBy("site_id", "site_name", "success", "error", chunk).agg(
        F.sort_array(F.collect_list(product)).alias("products"), F.lit("2000-01-01 10:00:00").cast("timestamp").alias("scraped_at"))
    sites.select(F.array(F.struct("site_id", "site_name", "success", "error", "products", "scraped_at")).alias("sites")).write.json(path)
    rows = stamped(readers.flatten_scrape(readers.read_scrape(spark, path, multiline=False)))
    return rows.select("site_id", "site_name", "success", "error", "product_id", "price", "seen_at",
                       F.col("scraped_at").cast("timestamp_ntz").alias("scraped_at"), "position")


@query("s06_flatten_benchmark", with_bench(
    "SELECT site_name, product_count, avg_price, min_price, max_price, TIMESTAMP '2000-01-01 10:00:00' AS seen_at FROM sites"))
def _(spark, sf):
    path = f"{new_workdir(spark, 'report')}/docs"
    text = lambda c: F.format_string("%.2f", F.col(c)).alias(c)
    entry = F.struct("product_count", text("avg_price"), text("min_price"), text("max_price"))
    by_site = F.create_map("site_name", entry).alias("by_site")
    reports = benchmark.bench_by_site(bench_rows(spark, sf)).select(
        F.lit("2000-01-01 10:00:00").cast("timestamp").alias("date"), F.struct(by_site).alias("price_analysis"))
    reports.write.json(path)
    return stamped(readers.flatten_benchmark(readers.read_benchmark(spark, path, multiline=False))).drop("timestamp")


@query("s07_enabled_sites", "SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, 'h2, h3' AS product_name FROM supplier WHERE s_acctbal >= 0")
def _(spark, sf):
    path = f"{new_workdir(spark, 'sites')}/config"
    site = spark.read.parquet(f"{sf}/supplier.parquet").select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"),
        (F.col("s_acctbal") >= 0).alias("enabled"),
        F.struct(F.lit(".card").alias("product_box"), F.lit("h2, h3").alias("product_name")).alias("selectors"))
    # Documents of one site each: the reader takes any number of sites per document.
    site.select(F.array(F.struct("id", "name", "enabled", "selectors")).alias("sites")).write.json(path)
    docs = spark.read.schema(schemas.SITES_CONFIG).json(path)
    return readers.enabled_sites(docs).select("id", "name", "selectors.product_name")


@query("s09_first_run_has_no_changes", with_snapshots("SELECT count(*) AS change_count FROM cur_snap WHERE FALSE"))
def _(spark, sf):
    missing = f"{new_workdir(spark, 'never')}/written"
    before = readers.flatten_snapshot(readers.read_snapshot(spark, missing))
    return pricing.price_changes(before, cur(spark, sf)).agg(F.count("*").alias("change_count"))


def mart(spark) -> str:
    """A fresh database with the declared tables."""
    base = new_workdir(spark, "mart")
    db = "mart_" + base.rsplit("-", 1)[1]
    tables.create_tables(spark, db, base)
    return db


@query("k01_create_tables", with_orders(state_sql("order_items")))
def _(spark, sf):
    db = mart(spark)
    # Monthly days keep the number of partitions of the test table small.
    rows = ingest.conform(order_items(spark, sf).withColumn(DAY, F.trunc(DAY, "MM")))
    tables.load_table(rows, f"{db}.order_items", schemas.ORDER_ITEMS, DAY)
    return state(spark.table(f"{db}.order_items"), DAY)


@query("k01_load_marts", with_bench("""
SELECT 'products' AS mart, count(*) AS row_count, count(DISTINCT site_id) AS sites, CAST(max("timestamp") AS TIMESTAMP) AS newest FROM cur_snap
UNION ALL SELECT 'price_history', count(*), count(DISTINCT site_id), CAST(max("timestamp") AS TIMESTAMP) FROM cur_snap
UNION ALL SELECT 'benchmarks', count(*), count(DISTINCT site_id), TIMESTAMP '2000-01-01 10:00:00' FROM sites
UNION ALL SELECT 'fetch_watermark', 1, 0, TIMESTAMP '2000-01-01 10:00:00'"""))
def _(spark, sf):
    """The four price marts, each loaded through its declaration."""
    db, run = mart(spark), F.lit("2000-01-01 10:00:00").cast("timestamp")
    snapshot = cur(spark, sf)
    load = lambda rows, name, schema, day=None: tables.load_table(rows, f"{db}.{name}", schema, day)
    load(pricing.product_rows(snapshot), "products", schemas.PRODUCTS)
    load(snapshot.withColumn("date", F.lit("2000-01-01").cast("date")), "price_history", schemas.PRICE_HISTORY, "date")
    stats = benchmark.bench_by_site(bench_rows(spark, sf)).withColumns({"timestamp": run, "date": F.to_date(run)})
    load(stats, "benchmarks", schemas.BENCHMARKS, "date")
    marks = spark.createDataFrame([], schemas.FETCH_WATERMARK)
    load(ingest.upsert_watermark(marks, "2000-01-01", "2000-01-01 10:00:00"), "fetch_watermark", schemas.FETCH_WATERMARK)
    stamps = {"products": "last_seen", "price_history": "timestamp", "benchmarks": "timestamp", "fetch_watermark": "last_fetch_timestamp"}
    found = [spark.table(f"{db}.{name}").agg(
        F.lit(name).alias("mart"), F.count("*").alias("row_count"),
        (F.count_distinct("site_id") if name != "fetch_watermark" else F.lit(0).cast("long")).alias("sites"),
        F.max(stamp).cast("timestamp_ntz").alias("newest")) for name, stamp in stamps.items()]
    return reduce(DataFrame.unionByName, found)


@query("k02_append_rows", with_dup_orders(state_sql("dup_items")))
def _(spark, sf):
    path = f"{new_workdir(spark, 'append')}/table"
    rows = monthly(order_items_dup(spark, sf))
    late = F.col("delivery_status") == "P"
    tables.append_rows(rows.filter(~late), path, MONTH)
    tables.append_rows(rows.filter(late), path, MONTH)
    return state(load(spark, path))


@query("k03_write_clustered", with_dup_orders(state_sql("dup_items")))
def _(spark, sf):
    return state(load(spark, stored(spark, sf)))


@query("k04_save_snapshot", with_snapshots("SELECT site_id, product_id, price FROM cur_snap"))
def _(spark, sf):
    store = f"{new_workdir(spark, 'state')}/snapshots"
    tables.save_snapshot(prev(spark, sf), store)
    tables.save_snapshot(cur(spark, sf), store)
    return tables.load_snapshot(spark, store, schemas.PRODUCT_ROWS).select("site_id", "product_id", "price")


@query("k04_expire_snapshots", with_snapshots("""
SELECT 1 AS first_deleted, 1 AS deleted, (SELECT count(*) FROM cur_snap) AS row_count"""))
def _(spark, sf):
    """Of three versions, one named by its writer, the oldest goes and the newest is read."""
    store = f"{new_workdir(spark, 'state')}/snapshots"
    tables.save_snapshot(prev(spark, sf), store, 1)
    for rows in (prev(spark, sf), cur(spark, sf)):
        tables.save_snapshot(rows, store)
    gone = tables.expire_snapshots(spark, store, 2)
    left = tables.load_snapshot(spark, store, schemas.PRODUCT_ROWS).agg(F.count("*").alias("row_count"))
    return left.select(F.lit(gone[0]).alias("first_deleted"), F.lit(len(gone)).alias("deleted"), "row_count")


@query("k05_append_price_history", with_snapshots("""
SELECT DATE '1999-01-01' AS date, site_id, product_id, price FROM prev_snap
UNION ALL SELECT DATE '2000-01-01', site_id, product_id, price FROM cur_snap"""))
def _(spark, sf):
    path = f"{new_workdir(spark, 'history')}/table"
    tables.append_price_history(prev(spark, sf), path, "1999-01-01")
    tables.append_price_history(cur(spark, sf), path, "2000-01-01")
    return load(spark, path).select(F.col("date").cast("date").alias("date"), "site_id", "product_id", "price")


@query("k06_append_benchmarks", with_bench("""
SELECT DATE '2000-01-01' AS date, site_id, site_name, product_count, avg_price, min_price, max_price,
       TIMESTAMP '2000-01-01 10:00:00' AS seen_at FROM sites"""))
def _(spark, sf):
    path = f"{new_workdir(spark, 'benchmarks')}/table"
    run = F.lit("2000-01-01 10:00:00").cast("timestamp")
    tables.append_benchmarks(benchmark.bench_by_site(bench_rows(spark, sf)), path, run)
    return stamped(load(spark, path)).drop("timestamp").withColumn("date", F.col("date").cast("date"))


@query("k07_export_catalog", with_snapshots("""
SELECT '2000-01-01T00:00:00' AS "Timestamp", category AS "Category", product_id AS "Product ID",
       product_name AS "Product name", price AS "Price", url AS "Product Link" FROM cur_snap"""))
def _(spark, sf):
    path = f"{new_workdir(spark, 'catalog')}/csv"
    for rows in (prev(spark, sf), cur(spark, sf)):  # the second export replaces the first
        tables.export_catalog(rows, path, F.lit("2000-01-01T00:00:00"))
    back = spark.read.option("header", True).csv(path)
    return back.withColumn("Price", F.col("Price").cast("double"))


@query("k08_append_change_log", with_snapshots(
    CHANGES_CTE + "SELECT product_id, product_name, old_price, new_price, price_diff, url, TIMESTAMP '2000-01-01 10:00:00' AS seen_at FROM changes"))
def _(spark, sf):
    path = f"{new_workdir(spark, 'log')}/changes"
    tables.append_change_log(changes(spark, sf), path, F.lit("2000-01-01 10:00:00").cast("timestamp"))
    return stamped(load(spark, path), "logged_at").drop("logged_at")


@query("k09_export_orders", with_orders("""
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(order_created_date_tr AS VARCHAR) AS tarih, city AS sehir
FROM order_items WHERE order_created_date_tr IS NOT NULL"""))
def _(spark, sf):
    path = f"{new_workdir(spark, 'export')}/csv"
    ties = ["product_code_1", "vendor_id", "order_amount"]
    tables.export_orders(sales.order_list(order_items(spark, sf), F.lit(True), None, ties), path)
    return spark.read.option("header", True).csv(path).select("order_id", "tarih", "sehir")


@query("k10_table_profile", with_dup_orders(
    "SELECT count(*) AS row_count, 'order_month' AS partition_columns, 'order_id' AS cluster_columns FROM dup_items"))
def _(spark, sf):
    return tables.table_profile(spark, stored(spark, sf)).drop("table", "columns")


@query("k03_write_interleaved", with_orders("""
SELECT unnest(['order_id', 'vendor_id']) AS looked_up, count(*) AS row_count, TRUE AS opens_fewer FROM order_items"""))
def _(spark, sf):
    """Look-ups by either column open fewer files than there are, and by the second one fewer than where rows are sorted by the first."""
    base = new_workdir(spark, "interleaved")
    rows = order_items(spark, sf, "order_id", "vendor_id", DAY).withColumn("year", F.year(DAY))
    clustering.write_interleaved(rows, f"{base}/both", ["order_id", "vendor_id"], "year", bloom=["order_id"], files=64)
    rows.repartitionByRange(64, "year", "order_id").sortWithinPartitions("year", "order_id").write.partitionBy("year").parquet(f"{base}/one")
    both, one = load(spark, f"{base}/both"), load(spark, f"{base}/one")
    out = []
    for column, other in (("order_id", both), ("vendor_id", one)):
        keys = [r[0] for r in rows.select(column).distinct().orderBy(F.xxhash64(column)).limit(20).collect()]
        opened = clustering.files_opened(both, column, keys).agg(F.sum("files")).scalar()
        if column == "vendor_id":
            against = clustering.files_opened(other, column, keys).agg(F.sum("files")).scalar()
        else:
            against = clustering.file_bounds(other, [column]).agg(F.count("*") * len(keys)).scalar()
        out.append(both.agg(F.count("*").alias("row_count")).select(
            F.lit(column).alias("looked_up"), "row_count", (opened < against).alias("opens_fewer")))
    return out[0].unionByName(out[1])


def bucketed_snapshots(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Both snapshots as bucketed tables."""
    base = new_workdir(spark, "bucketed")
    out = []
    for name, rows in (("prev", prev(spark, sf)), ("cur", cur(spark, sf))):
        table = f"{name}_{base.rsplit('-', 1)[1]}"
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        tables.write_bucketed(rows, table, f"{base}/{name}", pricing.KEY, buckets)
        out.append(spark.table(table))
    return tuple(out)


@query("k03_bucketed_price_changes", with_snapshots(
    CHANGES_CTE + "SELECT site_id, product_id, old_price, new_price, price_diff FROM changes"))
def _(spark, sf):
    """Price changes between bucketed snapshots: a join without a shuffle."""
    return pricing.price_changes(*bucketed_snapshots(spark, sf)).select(
        "site_id", "product_id", "old_price", "new_price", "price_diff")


ONE_MONTH = f"WHERE {MONTH_SQL} = DATE '{TARGET}'"
OTHER_MONTHS = f"WHERE {MONTH_SQL} <> DATE '{TARGET}'"
CLEAN_CTE = f"""
, clean AS (SELECT * FROM dup_items {OTHER_MONTHS}
            UNION ALL SELECT DISTINCT * FROM dup_items {ONE_MONTH})"""


@query("m01_backup_partition", with_dup_orders(state_sql("dup_items", ONE_MONTH)))
def _(spark, sf):
    path = stored(spark, sf)
    for _ in range(2):  # the second call finds the backup and leaves it alone
        maintenance.backup_partition(spark, path, TARGET, f"{path}-backup", MONTH)
    return state(load(spark, f"{path}-backup"))


@query("m02_backup_table", with_dup_orders(state_sql("dup_items")))
def _(spark, sf):
    path = stored(spark, sf)
    maintenance.backup_table(spark, path, f"{path}-backup", MONTH)
    return state(load(spark, f"{path}-backup"))


@query("m03_delete_partition", with_dup_orders(state_sql("dup_items", OTHER_MONTHS)))
def _(spark, sf):
    path = stored(spark, sf)
    maintenance.delete_partition(spark, path, TARGET, MONTH)
    return state(load(spark, path))


def cleaned_month(spark, path: str) -> DataFrame:
    """The target month without copies, read from its backup."""
    maintenance.backup_partition(spark, path, TARGET, f"{path}-backup", MONTH)
    return dedupe.dedupe_exact(load(spark, f"{path}-backup").withColumn(MONTH, F.col(MONTH).cast("date")))


@query("m04_replace_partition", with_dup_orders(CLEAN_CTE + state_sql("clean")))
def _(spark, sf):
    path = stored(spark, sf)
    maintenance.replace_partition(cleaned_month(spark, path), path, MONTH)
    return state(load(spark, path))


@query("m05_merge_replace", with_dup_orders(CLEAN_CTE + state_sql("clean")))
def _(spark, sf):
    path = stored(spark, sf)
    maintenance.merge_replace(cleaned_month(spark, path), path, MONTH)
    return state(load(spark, path))


@query("m06_rebuild_table", with_dup_orders(CLEAN_CTE + state_sql("clean")))
def _(spark, sf):
    path = stored(spark, sf)
    maintenance.rebuild_table(spark, path, TARGET, cleaned_month(spark, path), f"{path}-new", MONTH)
    return state(load(spark, f"{path}-new"))


@query("m07_swap_table", with_dup_orders(CLEAN_CTE + state_sql("clean")))
def _(spark, sf):
    path = stored(spark, sf)
    maintenance.rebuild_table(spark, path, TARGET, cleaned_month(spark, path), f"{path}-new", MONTH)
    maintenance.swap_table(spark, f"{path}-new", path, f"{path}-old")
    return state(load(spark, path))


@query("m08_restore_partition", with_dup_orders(state_sql("dup_items")))
def _(spark, sf):
    path = stored(spark, sf)
    maintenance.replace_partition(cleaned_month(spark, path), path, MONTH)
    maintenance.restore_partition(spark, f"{path}-backup", path, TARGET, MONTH)
    return state(load(spark, path))


@query("m09_repair_dates", with_dup_orders(f"""
, d AS (SELECT {MONTH_SQL} AS date, count(*) AS n FROM dup_items GROUP BY 1),
o AS (SELECT {MONTH_SQL} AS date, count(*) AS n FROM (SELECT DISTINCT * FROM dup_items) GROUP BY 1)
SELECT date, d.n AS rows_before, o.n AS rows_after, CAST(0 AS BIGINT) AS duplicates_left FROM d JOIN o USING (date) WHERE d.n > o.n"""))
def _(spark, sf):
    path = f"{new_workdir(spark, 'repair')}/table"
    # Real days moved to the first of their month, to keep the test table's files few.
    rows = order_items_dup(spark, sf).withColumn("requested_delivery_date", F.col(DAY))
    tables.write_clustered(rows.withColumn(DAY, F.trunc(DAY, "MM")), path)
    return repair.repair_dates(spark, path, f"{path}-backup")


@query("m11_insert_from", with_dup_orders(state_sql("dup_items")))
def _(spark, sf):
    path = stored(spark, sf, duplicated=False)
    again = monthly(order_items(spark, sf)).filter(F.col("order_id") % 50 == 0)
    tables.insert_from(again, path, MONTH)
    return state(load(spark, path))


@query("m12_drop_temp", with_orders("SELECT FALSE AS exists_after, count(*) AS row_count FROM order_items"))
def _(spark, sf):
    path = f"{new_workdir(spark, 'temp')}/result"
    rows = order_items(spark, sf, "order_id")
    rows.write.parquet(path)
    count = load(spark, path).count()
    maintenance.drop_temp(spark, path)
    return spark.range(1).select(F.lit(paths.exists(spark, path)).alias("exists_after"),
                                 F.lit(count).cast("long").alias("row_count"))


@query("u01_union_of_disjoint_days", with_orders(state_sql("order_items")))
def _(spark, sf):
    rows = monthly(order_items(spark, sf, "order_id", "order_amount", DAY))
    parts = rows.filter(filters.not_on_day(TARGET, MONTH)).unionByName(rows.filter(filters.on_day(TARGET, MONTH)))
    return state(parts)


# --- ingest --------------------------------------------------------------------------

KEY_SQL = ", ".join(ingest.BUSINESS_KEY)
FRESH_SQL = f"SELECT {MONTH_SQL} AS part, count(*) AS new_rows FROM (SELECT DISTINCT {KEY_SQL} FROM dup_items WHERE_) GROUP BY 1"


def fresh_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.trunc(DAY, "MM").alias("part")).agg(F.count("*").alias("new_rows"))


@query("j01_new_rows", with_dup_orders(FRESH_SQL.replace("WHERE_", "WHERE delivery_status = 'O'")))
def _(spark, sf):
    batch = order_items_dup(spark, sf)
    known = order_items(spark, sf).filter("delivery_status <> 'O'")
    return fresh_counts(ingest.new_rows(batch, known))


@query("st02_first_per_key", with_dup_orders(FRESH_SQL.replace("WHERE_", "")))
def _(spark, sf):
    return fresh_counts(ingest.first_per_key(order_items_dup(spark, sf)))


@query("f12_prune_days", with_dup_orders(f"""
SELECT {DAY} AS date, count(*) AS row_count FROM dup_items
WHERE {DAY} IN (SELECT {DAY} FROM order_items WHERE payment_method = '1-URGENT' AND city = 'NATION_3') GROUP BY 1"""))
def _(spark, sf):
    batch = order_items(spark, sf, DAY, "payment_method", "city").filter("payment_method = '1-URGENT' AND city = 'NATION_3'")
    kept = filters.prune_days(order_items_dup(spark, sf, "order_id", DAY), batch)
    return kept.groupBy(F.col(DAY).alias("date")).agg(F.count("*").alias("row_count"))


def monthly_items(rows: DataFrame) -> DataFrame:
    """Items with their days moved to the first of the month (few partitions to write)."""
    return ingest.conform(rows.withColumn(DAY, F.trunc(DAY, "MM")))


INGEST_SQL = f"""
, m AS (SELECT * REPLACE ({MONTH_SQL} AS order_created_date_tr) FROM dup_items),
n AS (SELECT (SELECT count(*) FROM m) AS received, (SELECT count(*) FROM (SELECT DISTINCT {KEY_SQL} FROM m)) AS fresh)"""


@query("st01_ingest_batch", with_dup_orders(INGEST_SQL + """
SELECT 'success' AS status, received, fresh AS inserted, received - fresh AS skipped, fresh AS visible_rows FROM n"""))
def _(spark, sf):
    path = f"{new_workdir(spark, 'ingest')}/order_items"
    outcome = ingest.ingest_batch(monthly_items(order_items_dup(spark, sf)), path)
    return ingest.outcome_rows(spark, path, outcome)


@query("j01_indexed_pulls", with_dup_orders(f"""
, m AS (SELECT * REPLACE ({MONTH_SQL} AS order_created_date_tr) FROM dup_items),
n AS (SELECT count(*) AS received, (SELECT count(*) FROM (SELECT DISTINCT {KEY_SQL} FROM m)) AS fresh,
             (SELECT count(*) FROM (SELECT DISTINCT {KEY_SQL} FROM m WHERE delivery_status <> 'O')) AS early FROM m)
SELECT 'success' AS status, received, fresh - early AS inserted, received - fresh + early AS skipped, fresh AS visible_rows,
       fresh AS indexed_rows, CAST(0 AS BIGINT) AS differing_days FROM n"""))
def _(spark, sf):
    """Two pulls against the kept index: the second finds the rows of the first by their keys."""
    path = f"{new_workdir(spark, 'indexed')}/order_items"
    name = "keys_" + path.split("/")[-2].rsplit("-", 1)[1]
    key_index.create_index(spark, path, name, unit="year")  # few files in a small table
    with ingest.staged(monthly_items(order_items_dup(spark, sf))) as rows:
        key_index.ingest_indexed(rows.filter("delivery_status <> 'O'"), path, name, stored=True)
        told = key_index.ingest_indexed(rows, path, name, stored=True)
    wrong = key_index.differing_days(readers.read_order_items(spark, path), spark.table(name)).agg(F.count("*"))
    indexed = spark.table(name).agg(F.count("*"))
    return ingest.outcome_rows(spark, path, told).select(
        "*", indexed.scalar().alias("indexed_rows"), wrong.scalar().alias("differing_days"))


@query("st08_redelivery", with_dup_orders(INGEST_SQL + """
SELECT 'all_existing' AS status, received, CAST(0 AS BIGINT) AS inserted, received AS skipped, fresh AS visible_rows FROM n"""))
def _(spark, sf):
    path = f"{new_workdir(spark, 'ingest')}/order_items"
    with ingest.staged(monthly_items(order_items_dup(spark, sf))) as batch:
        ingest.ingest_batch(batch, path, stored=True)
        return ingest.outcome_rows(spark, path, ingest.ingest_batch(batch, path, stored=True))


@query("st05_backfill", with_dup_orders(FRESH_SQL.replace("WHERE_", "").replace("new_rows", "row_count")))
def _(spark, sf):
    path = f"{new_workdir(spark, 'ingest')}/order_items"
    late = F.col(DAY) < "1997-01-01"
    with ingest.staged(monthly_items(order_items_dup(spark, sf))) as rows:
        ingest.ingest_batch(rows.filter(~late), path, stored=True)
        ingest.ingest_batch(rows, path, stored=True)  # the old months arrive late, the rest again
    return readers.read_order_items(spark, path).groupBy(F.col(DAY).alias("part")).agg(F.count("*").alias("row_count"))


@query("st05_days_back", with_dup_orders(f"""
SELECT {DAY} AS part, count(*) AS row_count FROM (SELECT DISTINCT {KEY_SQL} FROM dup_items
  WHERE {DAY} BETWEEN DATE '1997-03-15' AND DATE '1997-03-18') GROUP BY 1"""))
def _(spark, sf):
    """Pulls of the four days before a moment that is still the day before at home, each day's payload by its key."""
    path = f"{new_workdir(spark, 'back')}/order_items"
    now = datetime(1997, 3, 18, 21, 30, tzinfo=timezone(timedelta(0)))  # half past midnight of the 19th, local time
    rows = order_items_dup(spark, sf)
    for n in (1, 2, 3, 4, 1):
        key = target_date(now, days_back=n)
        ingest.run_fetch(spark, rows.filter(filters.on_day(key)), path, date_key=key)
    return readers.read_order_items(spark, path).groupBy(F.col(DAY).alias("part")).agg(F.count("*").alias("row_count"))


@query("st03_progress_mark", with_orders(
    # A pull without new rows sets no mark: the second one needs rows the first did not bring.
    "SELECT DATE '1997-03-18' AS fetch_date, CASE WHEN bool_or(delivery_status <> 'O') THEN TIMESTAMP '1997-03-18 09:00:00' "
    "ELSE TIMESTAMP '1997-03-18 08:00:00' END AS last_fetch_timestamp, count(*) AS rows_of_day "
    f"FROM order_items WHERE {DAY} = DATE '1997-03-18'"))
def _(spark, sf):
    base = new_workdir(spark, "marks")
    day = order_items(spark, sf).filter(filters.on_day("1997-03-18"))
    for stamp, rows in (("1997-03-18 08:00:00", day.filter("delivery_status = 'O'")), ("1997-03-18 09:00:00", day)):
        ingest.run_fetch(spark, rows, f"{base}/order_items", f"{base}/marks", "1997-03-18", "incremental", stamp)
    marks = tables.load_snapshot(spark, f"{base}/marks", schemas.FETCH_WATERMARK).drop("updated_at")
    seen = readers.read_order_items(spark, f"{base}/order_items").groupBy(F.col(DAY).alias("fetch_date")).agg(
        F.count("*").alias("rows_of_day"))
    return zoneless(marks.join(seen, "fetch_date"))


def zoneless(marks: DataFrame) -> DataFrame:
    return marks.withColumn("last_fetch_timestamp", F.col("last_fetch_timestamp").cast("timestamp_ntz"))


@query("st04_morning_catch_up", with_dup_orders(f"""
, day AS (SELECT DISTINCT {KEY_SQL} FROM dup_items WHERE {DAY} = DATE '1997-03-18' AND hour(order_creation_timestamp) < 8)
SELECT CASE WHEN count(*) = 0 THEN 'empty' ELSE 'success' END AS status,
       (SELECT count(*) FROM dup_items WHERE {DAY} = DATE '1997-03-18'
        AND hour(order_creation_timestamp) < 8) AS received, count(*) AS inserted, count(*) AS visible_rows FROM day"""))
def _(spark, sf):
    """The day's whole payload, of which the early hours are kept."""
    path = f"{new_workdir(spark, 'morning')}/order_items"
    stamp = F.concat(F.date_format("order_creation_timestamp", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00"))
    pulled = order_items_dup(spark, sf).withColumn("order_created_date", stamp).drop(DAY)
    outcome = ingest.run_fetch(spark, pulled, path, date_key="1997-03-18", mode="morning")
    return ingest.outcome_rows(spark, path, outcome).drop("skipped")


@query("o05_last_fetch", with_orders(f"""
SELECT max(order_creation_timestamp) AS last_fetch_timestamp FROM order_items WHERE {DAY} = DATE '1997-03-18'
HAVING count(*) > 0"""))
def _(spark, sf):
    marks = order_items(spark, sf, DAY, "order_creation_timestamp").withColumnsRenamed(
        {DAY: "fetch_date", "order_creation_timestamp": "last_fetch_timestamp"})
    return ingest.last_fetch(marks, "1997-03-18")


@query("j07_upsert_watermark", with_orders(f"""
SELECT {DAY} AS fetch_date, CASE WHEN {DAY} = DATE '1997-03-18' THEN TIMESTAMP '2002-01-01 00:00:00'
       ELSE max(order_creation_timestamp) END AS last_fetch_timestamp FROM order_items GROUP BY 1
UNION ALL SELECT DATE '2002-01-01', TIMESTAMP '2002-01-02 00:00:00'"""))
def _(spark, sf):
    marks = order_items(spark, sf, DAY, "order_creation_timestamp").groupBy(F.col(DAY).alias("fetch_date")).agg(
        F.max("order_creation_timestamp").cast("timestamp").alias("last_fetch_timestamp"))
    marks = marks.withColumn("updated_at", F.col("last_fetch_timestamp"))
    known = ingest.upsert_watermark(marks, "1997-03-18", "2002-01-01 00:00:00")
    return zoneless(ingest.upsert_watermark(known, "2002-01-01", "2002-01-02 00:00:00").drop("updated_at"))
