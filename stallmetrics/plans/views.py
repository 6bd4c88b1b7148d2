"""Order items and price observations over the TPC-H-like tables.

The order-items table is a star join. A query names the columns it needs and only the
dimension tables behind those columns are joined; every foreign key has its match, so
leaving a join out changes no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-01"

# column -> (expression, tables it needs besides lineitem)
_COLUMNS: dict[str, tuple[str, tuple[str, ...]]] = {
    "order_id": ("l_orderkey", ()),
    "order_code": ("CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat('OC-', CAST(l_orderkey AS STRING)) END",
                   ("orders",)),
    "product_code_1": ("CAST(l_partkey AS STRING)", ()),
    "product_name": ("p_name", ("part",)),
    "product_category": ("p_size", ("part",)),
    "user_id": ("CAST(o_custkey AS STRING)", ("orders",)),
    "city": ("n_name", ("orders", "customer", "nation")),
    "district": ("c_mktsegment", ("orders", "customer")),
    "neighborhood": ("r_name", ("orders", "customer", "nation", "region")),
    "delivery_location_type": ("l_returnflag", ()),
    "vendor_id": ("l_suppkey", ()),
    "rider_id": ("CAST(l_linenumber AS BIGINT)", ()),
    "additional_products": ("l_linestatus", ()),
    "payment_method": ("o_orderpriority", ("orders",)),
    "delivery_status": ("o_orderstatus", ("orders",)),
    "order_amount": ("CAST(l_extendedprice AS DECIMAL(18,2))", ()),
    "order_created_date_tr": ("CAST(o_orderdate AS DATE)", ("orders",)),
    "order_delivery_date": ("CAST(l_shipdate AS DATE)", ()),
    "requested_delivery_date": ("CAST(l_shipdate AS DATE)", ()),
    "order_creation_timestamp": (
        "timestampadd(SECOND, CAST((o_orderkey * 7919) % 86400 AS INT), o_orderdate)", ("orders",)),
}
ALL_COLUMNS = list(_COLUMNS)
# What an order leads to, joined to the orders, of which there are far fewer than items.
_ORDER_JOINS = [
    ("customer", "o_custkey", "c_custkey"),
    ("nation", "c_nationkey", "n_nationkey"),
    ("region", "n_regionkey", "r_regionkey"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_items(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Order items with the named columns (all of them by default)."""
    columns = columns or tuple(ALL_COLUMNS)
    needed = {t for c in columns for t in _COLUMNS[c][1]}
    rows = table(spark, sf_dir, "lineitem")
    # Where joins shuffle, items move twice: by part while they are narrow, and with their orders, complete.
    if "part" in needed:
        rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "orders" in needed:
        orders = table(spark, sf_dir, "orders")
        for name, left, right in _ORDER_JOINS:
            if name in needed:
                orders = orders.join(table(spark, sf_dir, name), F.col(left) == F.col(right))
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(*[F.expr(_COLUMNS[c][0]).alias(c) for c in columns])


def order_items_dup(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The same with every row of each fiftieth order twice."""
    rows = order_items(spark, sf_dir, *columns)
    copies = F.when(F.col("order_id") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("__copy", F.explode(copies)).drop("__copy")


def _price() -> Column:
    raw = (F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(18,6)")
    return F.round(raw, 2).cast("double")


def price_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price observations without names: a supplier is a site, a part a product, a line an
    observation. Needs no dimension table."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("site_id"), F.col("l_partkey").cast("string").alias("product_id"),
        _price().alias("price"), F.col("l_shipdate").alias("timestamp"), F.col("l_orderkey").alias("seq_a"),
        F.col("l_linenumber").alias("seq_b"),
    )


def with_names(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Site and product names, link and category added to price rows."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"),
        F.concat(F.lit("/p/"), F.col("p_partkey").cast("string")).alias("url"), F.col("p_brand").alias("category"))
    site = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("site_id"), F.col("s_name").alias("site_name"))
    return rows.join(part, "product_id").join(site, "site_id")


def price_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price observations with their names."""
    return with_names(spark, sf_dir, price_keys(spark, sf_dir))


POSITION = ["timestamp", "seq_a", "seq_b"]

# --- the same views as DuckDB SQL -------------------------------------------------

ORDER_ITEMS_SQL = """
order_items AS (
  SELECT l.l_orderkey AS order_id,
         CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE 'OC-' || CAST(l.l_orderkey AS VARCHAR) END AS order_code,
         CAST(l.l_partkey AS VARCHAR) AS product_code_1, p.p_name AS product_name, p.p_size AS product_category,
         CAST(o.o_custkey AS VARCHAR) AS user_id, n.n_name AS city, c.c_mktsegment AS district,
         r.r_name AS neighborhood, l.l_returnflag AS delivery_location_type, l.l_suppkey AS vendor_id,
         CAST(l.l_linenumber AS BIGINT) AS rider_id, l.l_linestatus AS additional_products,
         o.o_orderpriority AS payment_method, o.o_orderstatus AS delivery_status,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS order_amount,
         CAST(o.o_orderdate AS DATE) AS order_created_date_tr, CAST(l.l_shipdate AS DATE) AS order_delivery_date,
         CAST(l.l_shipdate AS DATE) AS requested_delivery_date,
         o.o_orderdate + to_seconds(CAST((o.o_orderkey * 7919) % 86400 AS BIGINT)) AS order_creation_timestamp
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

ORDER_ITEMS_DUP_SQL = ORDER_ITEMS_SQL + """,
dup_items AS (SELECT * FROM order_items UNION ALL SELECT * FROM order_items WHERE order_id % 50 = 0)"""

PRICE_OBS_SQL = """
price_obs AS (
  SELECT CAST(l.l_suppkey AS VARCHAR) AS site_id, s.s_name AS site_name, CAST(l.l_partkey AS VARCHAR) AS product_id,
         p.p_name AS product_name,
         CAST(round(CAST(l.l_extendedprice / l.l_quantity AS DECIMAL(18,6)), 2) AS DOUBLE) AS price,
         '/p/' || CAST(l.l_partkey AS VARCHAR) AS url, p.p_brand AS category, l.l_shipdate AS "timestamp",
         l.l_orderkey AS seq_a, l.l_linenumber AS seq_b
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""


def _json_value(column: str) -> str:
    """SQL of a column's JSON text."""
    if column in ("order_id", "product_category", "vendor_id", "rider_id", "order_amount"):
        text = f"CAST({column} AS VARCHAR)"
    elif column == "order_creation_timestamp":
        text = f"strftime({column}, '\"%Y-%m-%dT%H:%M:%S.000\"')"
    else:
        text = f"'\"' || {column} || '\"'"
    return f"'\"{column}\":' || coalesce({text}, 'null')"


#: An order item as JSON text.
RECORD_SQL = "'{' || " + " || ',' || ".join(_json_value(c) for c in ALL_COLUMNS) + " || '}'"


def with_orders(sql: str) -> str:
    return f"WITH {ORDER_ITEMS_SQL}\n{sql}"


def with_dup_orders(sql: str) -> str:
    return f"WITH {ORDER_ITEMS_DUP_SQL}\n{sql}"


def with_prices(sql: str) -> str:
    return f"WITH {PRICE_OBS_SQL}\n{sql}"


def snapshot_sql(name: str, before: str) -> str:
    """CTE: last observation per site and product before a day."""
    return f"""
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY site_id, product_id
                                 ORDER BY "timestamp" DESC, seq_a DESC, seq_b DESC) AS rn
    FROM price_obs WHERE "timestamp" < TIMESTAMP '{before}') WHERE rn = 1)"""


PREV_DAY, CUR_DAY = "1999-01-01", "2000-01-01"
SNAPSHOTS_SQL = PRICE_OBS_SQL + "," + snapshot_sql("prev_snap", PREV_DAY) + "," + snapshot_sql("cur_snap", CUR_DAY)


def with_snapshots(sql: str) -> str:
    return f"WITH {SNAPSHOTS_SQL}\n{sql}"
