"""Message rows: change digests, batches, no-change digests.

Delivery is not part of the library. A site can have any number of changes, so a digest
is a set of bounded messages, numbered in order, and never one text per site.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.functions.clock import END_OF_DAY_HOUR, local_time
from stallmetrics.operators.benchmark import bench_by_site
from stallmetrics.operators.ordered import running_index, table_index
from stallmetrics.session import written

# Message wording and signs.
UP, DOWN = "📈", "📉"
LINE_FORMAT = "%s *%s*: %.2f₺ → %.2f₺ (%s₺)"
BLOCK_FORMAT = "*%s*\n• Eski: %.2f₺ → Yeni: %.2f₺\n• Fark: %s %s₺"
SITE_FORMAT = "*%s*\n• Ürün: %d\n• Ort: %.2f₺ | Min: %.2f₺ | Max: %.2f₺"
HEADER_FORMAT = "*%d ürünün fiyatı değişti!*"
SITE_HEADER_FORMAT = "*🏪 %s* - %d değişiklik"
NO_CHANGE_FORMAT = "✅ %d site tarandı\n📦 %d ürün kontrol edildi\n✨ Fiyat değişikliği yok"
LINK_FORMAT = " <%s|Ürün>"
BLOCK_LINK_FORMAT = "\n<%s|Ürüne Git>"
MESSAGE_SIZE = 5
# End of fixed values.


def _signed(diff: Column) -> Column:
    text = F.format_string("%.2f", diff)
    return F.when(diff > 0, F.concat(F.lit("+"), text)).otherwise(text)


def _direction(diff: Column) -> Column:
    return F.when(diff > 0, F.lit(UP)).otherwise(F.lit(DOWN))


def change_lines(changes: DataFrame) -> DataFrame:
    """Each change with its one-line and its block text."""
    diff, has_url = F.col("price_diff"), F.coalesce(F.col("url") != "", F.lit(False))
    line = F.format_string(LINE_FORMAT, _direction(diff), F.col("product_name"), F.col("old_price"),
                           F.col("new_price"), _signed(diff))
    block = F.format_string(BLOCK_FORMAT, F.col("product_name"), F.col("old_price"), F.col("new_price"),
                            _direction(diff), _signed(diff))
    link = lambda text: F.when(has_url, F.format_string(text, F.col("url"))).otherwise(F.lit(""))
    return changes.withColumns({
        "line": F.concat(line, link(LINK_FORMAT)), "block": F.concat(block, link(BLOCK_LINK_FORMAT))})


def _messages(placed: DataFrame, keys: list[str], text: str, n: int) -> DataFrame:
    """Texts in messages of n; a group holds at most n texts."""
    parts = placed.withColumn("message_no", F.floor((F.col("pos") - 1) / n) + 1).groupBy(*keys, "message_no").agg(
        F.count("*").alias("change_count"), F.sort_array(F.collect_list(F.struct("pos", text))).alias("__t"))
    return parts.withColumn("message", F.array_join(F.col(f"__t.{text}"), "\n")).drop("__t")


def batch_messages(changes: DataFrame, n: int = MESSAGE_SIZE) -> DataFrame:
    """All changes in the order of site and product, one line each, in messages of n."""
    placed = table_index(change_lines(changes), ["site_id", "product_id"], "pos")
    return _messages(placed, [], "line", n)


def change_digest(changes: DataFrame, n: int = 50) -> DataFrame:
    """Per site a heading with its number of changes, and its changes in messages of n blocks."""
    keys = ["site_id", "site_name"]
    # The changes are few against the snapshots that they come from, and are read several times.
    placed = running_index(written(change_lines(changes), "changes"), keys, ["product_id"], "pos")
    parts = _messages(placed, keys, "block", n)
    # The messages of a site carry its number of changes: n times fewer rows than the changes.
    heads = parts.groupBy(*keys).agg(F.sum("change_count").alias("site_changes"))
    heading = F.format_string(SITE_HEADER_FORMAT, F.col("site_name"), F.col("site_changes"))
    return parts.join(heads, keys).withColumn("heading", heading)


def change_header(changes: DataFrame) -> DataFrame:
    """The opening message: number of changes and of sites with any."""
    counts = changes.groupBy("site_id").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("change_count"), F.count("*").alias("site_count"))
    return counts.withColumn("message", F.format_string(HEADER_FORMAT, F.col("change_count")))


def no_change_digest(products: DataFrame) -> DataFrame:
    """One message row per site with its statistics, below the run's totals."""
    sites = bench_by_site(products)
    body = F.format_string(SITE_FORMAT, F.col("site_name"), F.col("product_count"), F.col("avg_price"),
                           F.col("min_price"), F.col("max_price"))
    return sites.withColumn("message", body)


def no_change_header(summary: DataFrame) -> DataFrame:
    """Totals message of a run without changes; input is ``run_summary``."""
    return summary.withColumn("message", F.format_string(
        NO_CHANGE_FORMAT, F.col("successful_sites"), F.col("total_products")))


def end_of_day_digest(products: DataFrame, now: Column) -> DataFrame:
    """The seasonal form: the same digest, but only in the last run of the day."""
    return no_change_digest(products).filter(F.hour(local_time(now)) == END_OF_DAY_HOUR)
