"""Price benchmarks.

All per-site and per-category statistics derive from one small table, ``price_cube``:
one row per (site, category) with counts, sums and extremes. The product rows are
aggregated once, map side first, and every report below works on the cube.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stallmetrics.functions.filters import one_of, trailing_days
from stallmetrics.functions.money import exact_mean, ratio
from stallmetrics.operators.sales import share_of_total

MONEY = "decimal(28,4)"


def price_cube(products: DataFrame) -> DataFrame:
    """Counts, sums and extremes per site and category. Extremes use positive prices."""
    price = F.col("price").cast("decimal(18,4)")
    positive = F.when(F.col("price") > 0, price)
    return products.groupBy("site_id", "site_name", "category").agg(
        F.count("*").alias("n"), F.sum(price).alias("total"),
        F.count(positive).alias("pos_n"), F.sum(positive).alias("pos_total"),
        F.min(positive).alias("lo"), F.max(positive).alias("hi"),
    )


def bench_by_site(products: DataFrame, cube: DataFrame | None = None) -> DataFrame:
    """Count of all products; mean, minimum and maximum of the positive prices. Sites
    without a positive price are left out."""
    cube = price_cube(products) if cube is None else cube
    sites = cube.groupBy("site_id", "site_name").agg(
        F.sum("n").alias("product_count"), exact_mean(F.sum("pos_total"), F.sum("pos_n")).alias("avg_price"),
        F.min("lo").cast("double").alias("min_price"), F.max("hi").cast("double").alias("max_price"),
    )
    return sites.filter(F.col("min_price").isNotNull())


def kept_cube(products: DataFrame) -> DataFrame:
    """Cube without the sites that have no positive price."""
    per_site = F.sum("pos_n").over(W.partitionBy("site_id"))
    return price_cube(products).withColumn("__pos", per_site).filter(F.col("__pos") > 0).drop("__pos")


def bench_by_category(products: DataFrame) -> DataFrame:
    """Count and mean per category over every product of a kept site."""
    return kept_cube(products).groupBy("category").agg(
        F.sum("n").alias("product_count"), exact_mean(F.sum("total"), F.sum("n")).alias("avg_price"))


def bench_by_category_site(products: DataFrame) -> DataFrame:
    """Count and mean per category and site."""
    return kept_cube(products).groupBy("category", "site_id", "site_name").agg(
        F.sum("n").alias("product_count"), exact_mean(F.sum("total"), F.sum("n")).alias("avg_price"))


def bench_category_levels(products: DataFrame) -> DataFrame:
    """Category totals and category-by-site rows in one aggregate; ``site_id`` is null and
    ``is_total`` 1 on the totals."""
    cube = kept_cube(products)
    return cube.groupingSets([["category"], ["category", "site_id"]], "category", "site_id").agg(
        F.grouping("site_id").cast("int").alias("is_total"),
        F.sum("n").alias("product_count"), exact_mean(F.sum("total"), F.sum("n")).alias("avg_price"))


def categories_by_price(products: DataFrame) -> DataFrame:
    """Categories by mean price, dearest first."""
    return bench_by_category(products).orderBy(F.desc("avg_price"), "category")


def category_site_pivot(products: DataFrame, sites: list[str], name: str = "site_id") -> DataFrame:
    """Mean price per category with one column per given site; empty cells are 0."""
    cells = bench_by_category_site(products)
    matrix = cells.groupBy("category").pivot(name, sites).agg(F.first("avg_price"))
    return matrix.fillna(0.0)


def run_summary(scrape_sites: DataFrame) -> DataFrame:
    """Sites, successful sites and products of a run; failed sites count too.

    Input is ``flatten_scrape``: at least one row per site.
    """
    sites = scrape_sites.groupBy("site_id").agg(
        F.max("success").alias("success"), F.count("product_id").alias("products"))
    return sites.agg(
        F.count("*").alias("total_sites"), F.count_if("success").alias("successful_sites"),
        F.coalesce(F.sum("products"), F.lit(0)).alias("total_products"))


def successful(scrape_rows: DataFrame) -> DataFrame:
    """Products of the successful sites."""
    return scrape_rows.filter(F.col("success") & F.col("product_id").isNotNull())


def failed_sites(scrape_rows: DataFrame) -> DataFrame:
    """Failed sites with their error."""
    return scrape_rows.filter(~F.col("success")).select("site_name", "error").distinct()


def mean_of_site_means(products: DataFrame) -> DataFrame:
    """Unweighted mean of the sites' means, 0 without any."""
    sites = bench_by_site(products)
    total = F.sum(F.col("avg_price").cast(MONEY))
    return sites.agg(F.coalesce(exact_mean(total, F.count("*")), F.lit(0.0)).alias("overall_avg_price"))


def category_counts(products: DataFrame) -> DataFrame:
    return products.groupBy("category").agg(F.count("*").alias("product_count")).orderBy(
        F.desc("product_count"), "category")


def site_shares(products: DataFrame) -> DataFrame:
    """Share of each site in the number of products."""
    sites = bench_by_site(products).select("site_id", "site_name", "product_count")
    return share_of_total(sites, "product_count", "share_pct")


def site_trend(benchmarks: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Mean of the recorded averages per day and site over the last days, newest first."""
    recent = benchmarks.filter(trailing_days(as_of, days, "date"))
    total = F.sum(F.col("avg_price").cast(MONEY))
    means = recent.groupBy("date", "site_name").agg(ratio(total, F.count("avg_price")).alias("avg_price"))
    return means.orderBy(F.desc("date"), "site_name")


def product_table_stats(products: DataFrame, sites=None, categories=None) -> DataFrame:
    """Number of shown products and their price range; an empty selection shows all."""
    shown = products.filter(one_of("site_name", sites) & one_of("category", categories))
    return shown.agg(F.count("*").alias("shown_products"), F.min("price").alias("min_price"),
                     F.max("price").alias("max_price"))


def changes_by_site(changes: DataFrame) -> DataFrame:
    return changes.groupBy("site_id", "site_name").agg(F.count("*").alias("change_count"))


def freshness(products: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """Newest observation, newest report, and how much both hold."""
    seen = products.agg(F.max("timestamp").alias("last_update"),
                        F.count_distinct("site_id").alias("site_count"), F.count("*").alias("product_count"))
    reported = benchmarks.agg(F.max("timestamp").alias("last_report"))
    return seen.withColumn("last_report", reported.scalar())
