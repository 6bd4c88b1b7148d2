"""Price snapshots: change detection, comparison, product dimension, history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.functions.filters import trailing_days
from stallmetrics.functions.money import ratio
from stallmetrics.functions.text import name_contains
from stallmetrics.operators.dedupe import first_n, keep_last
from stallmetrics.operators.ordered import SAMPLED_PER_TASK, previous_value, running_index, table_index

KEY = ["site_id", "product_id"]
# Visibility labels, default category.
VISIBLE, HIDDEN, NO_CAP = "Görünür", "Gizli/ekstra", "-"
UNKNOWN_CATEGORY = "Unknown"
# End of fixed values.


def snapshot_of(products: DataFrame, position: list[str]) -> DataFrame:
    """One row per product: the last one delivered."""
    return keep_last(products, KEY, position)


def with_fallback(primary: DataFrame, secondary: DataFrame, keyword: str, key: str = "site_id",
                  name: str = "product_name") -> DataFrame:
    """Primary rows, plus keyword matches of the secondary source for keys without any."""
    spare = secondary.filter(name_contains(F.col(name), keyword))
    spare = spare.join(primary.select(key).distinct(), key, "left_anti")
    return primary.unionByName(spare)


def price_changes(prev: DataFrame, cur: DataFrame, min_abs_change: float = 0.0) -> DataFrame:
    """Products in both snapshots whose price differs. New and removed ones yield nothing.

    Snapshots hold one row per key, so the join is one to one and no key is hot.
    """
    old = prev.select(*KEY, F.col("price").alias("old_price"))
    return changed(cur.join(old, KEY), min_abs_change)


def changed(both: DataFrame, min_abs_change: float = 0.0) -> DataFrame:
    """Products with their price before (``old_price``), those whose price differs from it."""
    both = both.filter(F.col("price") != F.col("old_price"))
    if min_abs_change:
        both = both.filter(F.abs(F.col("price") - F.col("old_price")) >= min_abs_change)
    return both.select(
        *KEY, "site_name", "product_name", "old_price", F.col("price").alias("new_price"),
        (F.col("price") - F.col("old_price")).alias("price_diff"), "url", "category",
    )


def price_changes_single_site(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """The same for a store with one site, keyed by product alone."""
    one = lambda df: df.withColumn("site_id", F.lit(""))
    return price_changes(one(prev), one(cur)).drop("site_id")


def price_comparison(cur: DataFrame, prev: DataFrame) -> DataFrame:
    """Every current product with its previous price, difference and percentage.

    The percentage is 0 for an old price of 0 or less; all three are null without one.
    """
    old = prev.select(*KEY, F.col("price").alias("old_price"))
    diff = F.col("price") - F.col("old_price")
    percent = F.when(F.col("old_price") > 0, F.round(ratio(diff, F.col("old_price")) * 100, 2)).when(
        F.col("old_price").isNotNull(), F.lit(0.0))
    return cur.join(old, KEY, "left").select(
        *KEY, "site_name", "product_name", F.col("price").alias("new_price"), "old_price",
        diff.alias("price_diff"), percent.alias("change_pct"),
        F.coalesce("category", F.lit("-")).alias("category"), F.coalesce("url", F.lit("-")).alias("url"),
    )


def comparison_sheet(comparison: DataFrame) -> DataFrame:
    """The same as display texts: ``-`` where there was no previous price."""
    dash = F.lit("-")
    two = lambda c: F.coalesce(F.format_string("%.2f", F.col(c)), dash)
    had = F.col("old_price").isNotNull()
    return comparison.select(
        "site_name", "product_name", "new_price",
        F.coalesce(F.col("old_price").cast("string"), dash).alias("old_price"),
        F.when(had, two("price_diff")).otherwise(dash).alias("price_diff"),
        F.when(had, F.concat(two("change_pct"), F.lit("%"))).otherwise(dash).alias("change_pct"),
        "category", "url",
    )


def report_blocks(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """All rows in blocks of n, as a report sheet shows them: ``block`` and the row's place in
    it, both from 1, in the order of the given columns."""
    placed = table_index(rows, order, "__place")
    return placed.withColumns({
        "block": F.floor((F.col("__place") - 1) / n) + 1, "place": (F.col("__place") - 1) % n + 1}).drop("__place")


def report_block(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first block of a report: its first n rows. ``report_blocks`` gives the others too."""
    return first_n(rows, [], n, order)


def volatile_products(products: DataFrame, history: DataFrame, as_of, days: int = 30, n: int = 20) -> DataFrame:
    """Products by price spread over the last days.

    The history is folded to one row per product before the join, so the join never
    sees more than one row per key.
    """
    recent = history.filter(trailing_days(as_of, days, "date"))
    spread = recent.groupBy(*KEY).agg(F.min("price").alias("lo"), F.max("price").alias("hi"))
    named = products.select(*KEY, "product_name", "site_name").join(spread, KEY)
    table = named.groupBy("product_name", "site_name").agg(
        F.min("lo").alias("min_price"), F.max("hi").alias("max_price"))
    ranked = table.withColumn("volatility", F.round(F.col("max_price") - F.col("min_price"), 2))
    return ranked.filter(F.col("volatility") > 0).orderBy(
        F.desc("volatility"), "product_name", "site_name").limit(n)


def product_rows(snapshot: DataFrame, seen_at: Column | None = None) -> DataFrame:
    """Snapshot as rows of the product dimension."""
    seen = F.col("timestamp") if seen_at is None else F.coalesce(F.col("timestamp"), seen_at)
    return snapshot.select(
        "product_id", "site_id", "site_name", "product_name",
        F.coalesce("category", F.lit(UNKNOWN_CATEGORY)).alias("category"),
        F.coalesce("url", F.lit("")).alias("url"), seen.alias("first_seen"), seen.alias("last_seen"),
    )


def upsert_products(dim: DataFrame, snapshot: DataFrame) -> DataFrame:
    """New state of the product dimension. A known product takes the new name, category,
    URL and last sighting and keeps its site name and first sighting.

    Of several rows of a (site, product) the newest by timestamp counts.
    """
    fresh = keep_last(product_rows(snapshot), KEY, ["last_seen", "product_name", "category", "url", "site_name"])
    both = dim.alias("t").join(fresh.alias("s"), KEY, "full_outer")
    newer = lambda c: F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c)
    older = lambda c: F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c)
    return both.select(
        "product_id", "site_id", older("site_name"), newer("product_name"), newer("category"), newer("url"),
        older("first_seen"), newer("last_seen"),
    )


def price_changes_over_time(history: DataFrame, order: list[str], per_task: int = SAMPLED_PER_TASK) -> DataFrame:
    """Every price change in a history, against the observation before it.

    ``order`` fixes the sequence within a product. A product with very many observations is
    split over several tasks (see ``ordered``).
    """
    seen = previous_value(history, KEY, order, "price", "old_price", per_task)
    moved = seen.filter(F.col("old_price").isNotNull() & (F.col("price") != F.col("old_price")))
    return moved.withColumnRenamed("price", "new_price").withColumn(
        "price_diff", F.col("new_price") - F.col("old_price"))


def visibility_label(products: DataFrame, caps: DataFrame, position: str = "position",
                     per_task: int = SAMPLED_PER_TASK) -> DataFrame:
    """Label of each product: among the first ``cap`` of its site or beyond.

    ``position`` is unique in a site. ``caps`` has one row per capped site; a site without
    one, or with a null cap or one of 0, has no labels.
    """
    known = caps.filter(F.col("cap") > 0).select("site_id", F.col("cap").alias("__cap"))
    numbered = running_index(products, ["site_id"], [position], "__place", per_task).join(known, "site_id", "left")
    label = (
        F.when(F.col("__cap").isNull(), F.lit(NO_CAP))
        .when(F.col("__place") <= F.col("__cap"), F.lit(VISIBLE)).otherwise(F.lit(HIDDEN))
    )
    return numbered.withColumn("visibility", label).drop("__cap", "__place")


def sort_products(products: DataFrame, mode: str = "price_asc") -> DataFrame:
    """User-selected order of a product table."""
    modes = {
        "price_asc": [F.asc("price")],
        "price_desc": [F.desc("price")],
        "site": [F.asc("site_name")],
        "category": [F.asc("category")],
    }
    return products.orderBy(*modes[mode], *KEY)
