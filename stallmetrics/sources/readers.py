"""Sources. Every reader declares its schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stallmetrics import schemas
from stallmetrics.sources import paths


def read_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options) -> DataFrame:
    """Read ``path``; a source that does not exist yet is an empty table (first run)."""
    if not paths.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


def read_order_items(spark: SparkSession, path: str) -> DataFrame:
    """Order-items fact, partitioned by creation date."""
    return read_or_empty(spark, path, schemas.ORDER_ITEMS)


def payload_request(date_key: str) -> dict[str, str]:
    """Request body of a pull: a seven-character key is a month, else a day."""
    return {"yearMonth": date_key} if len(date_key) == 7 else {"day": date_key}


def read_order_payload(spark: SparkSession, path: str, date_key: str | None = None, multiline: bool = True) -> DataFrame:
    """Order rows as delivered. ``date_key`` selects one day's or one month's pulls of a
    landing folder laid out as ``day=YYYY-MM-DD``.

    One pull is one JSON array (``multiline``); a landing folder written by Spark holds
    one object per line, which splits (``multiline=False``).
    """
    reader = spark.read.schema(schemas.ORDER_PAYLOAD).option("multiLine", multiline)
    if date_key is None:
        return reader.json(path)
    pattern = f"{path}/day={date_key}*" if "yearMonth" in payload_request(date_key) else f"{path}/day={date_key}"
    return reader.json(pattern)


def read_snapshot(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Nested snapshot documents, still nested."""
    return read_or_empty(spark, path, schemas.SNAPSHOT_DOCUMENT, "json", multiLine=str(multiline).lower())


def flatten_snapshot(docs: DataFrame) -> DataFrame:
    """Map of sites of maps of products, one row per product."""
    sites = docs.select(F.explode("sites").alias("site_id", "site"))
    products = sites.select("site_id", F.col("site.name").alias("site_name"),
                            F.explode("site.products").alias("product_id", "p"))
    return products.select(
        "site_id", "site_name", "product_id",
        F.col("p.name").alias("product_name"), F.col("p.price").alias("price"), F.col("p.url").alias("url"),
        F.col("p.category").alias("category"), F.col("p.timestamp").alias("timestamp"),
    )


def read_flat_snapshot(spark: SparkSession, path: str, wholetext: bool = True) -> DataFrame:
    """One-level snapshots as text: their top-level keys are data, not columns."""
    if not paths.exists(spark, path):
        return spark.createDataFrame([], "value string")
    return spark.read.text(path, wholetext=wholetext)


def flatten_flat_snapshot(texts: DataFrame, site_id: str = "", site_name: str = "") -> DataFrame:
    """One-level map of products, one row per product of the single site."""
    # The outer form parses each text once; a plain explode parses it again in a filter.
    entries = texts.select(F.explode_outer(F.from_json("value", schemas.FLAT_SNAPSHOT_MAP)).alias("product_id", "p"))
    return entries.filter(F.col("product_id").isNotNull()).select(
        F.lit(site_id).alias("site_id"), F.lit(site_name).alias("site_name"), "product_id",
        F.col("p.name").alias("product_name"), F.col("p.price").alias("price"), F.col("p.url").alias("url"),
        F.lit(None).cast("string").alias("category"), F.col("p.timestamp").alias("timestamp"),
    )


def read_scrape(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    return read_or_empty(spark, path, schemas.SCRAPE_RESULT, "json", multiLine=str(multiline).lower())


def flatten_scrape(docs: DataFrame) -> DataFrame:
    """One row per scraped product; a failed or empty site keeps one row without product.

    ``position`` is the place of the product in its site's list.
    """
    sites = docs.select(F.explode("sites").alias("s"))
    rows = sites.select(
        F.col("s.site_id").alias("site_id"), F.col("s.site_name").alias("site_name"),
        F.col("s.success").alias("success"), F.col("s.error").alias("error"),
        F.col("s.scraped_at").alias("scraped_at"), F.posexplode_outer("s.products").alias("position", "p"),
    )
    return rows.select(
        "site_id", "site_name", "success", "error", "scraped_at", "position",
        F.col("p.id").alias("product_id"), F.col("p.name").alias("product_name"), F.col("p.price").alias("price"),
        F.col("p.url").alias("url"), F.col("p.category").alias("category"), F.col("p.timestamp").alias("timestamp"),
    )


def read_benchmark(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    return read_or_empty(spark, path, schemas.BENCHMARK_REPORT, "json", multiLine=str(multiline).lower())


def flatten_benchmark(reports: DataFrame) -> DataFrame:
    """Per-site rows of benchmark reports, their text averages as numbers."""
    rows = reports.select(F.col("date").alias("timestamp"),
                          F.explode("price_analysis.by_site").alias("site_name", "b"))
    number = lambda name: F.col(f"b.{name}").try_cast("double").alias(name)
    return rows.select("timestamp", "site_name", F.col("b.product_count").alias("product_count"),
                       number("avg_price"), number("min_price"), number("max_price"))


def enabled_sites(config: DataFrame, only_enabled: bool = True) -> DataFrame:
    """One row per configured site."""
    sites = config.select(F.inline("sites"))
    return sites.filter("enabled") if only_enabled else sites


def read_sites(spark: SparkSession, path: str, only_enabled: bool = True) -> DataFrame:
    """Site dimension with its selectors and paging."""
    config = spark.read.schema(schemas.SITES_CONFIG).option("multiLine", True).json(path)
    return enabled_sites(config, only_enabled)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages: id, address, HTML."""
    return spark.read.schema(schemas.PAGES).parquet(path)
