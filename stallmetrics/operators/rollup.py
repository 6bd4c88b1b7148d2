"""A daily roll-up of the order items that answers any range of days without the fact table.

Kept beside the fact, per day and filter columns: sums and counts; distinct integer ids as
bitmaps, which merge by OR and count exactly; distinct texts as rows. Changed days are
refreshed by writing their period anew from that period of the fact.

Null ids and texts are not counted, as in COUNT(DISTINCT); ids of 0 and below have bits of
their own. Rows without a day are left out, as in the reports. A bitmap is a long of 64 neighbouring
ids: scattered ids cost 16 bytes each, and aggregates on longs run on hash maps of bounded memory
(bitmaps of 4 KB were sorted, one for nearly every id when ids are scattered).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallmetrics.functions.clock import comparison_range
from stallmetrics.functions.filters import between_days
from stallmetrics.functions.money import ratio
from stallmetrics.schemas import PARTITION_COLUMN
from stallmetrics.sinks.tables import balanced

DAY, PERIOD = PARTITION_COLUMN, "period"
IDS, TEXTS = ("order_id", "vendor_id"), ("city",)
SUMS, BITMAPS, VALUES = "sums", "bitmaps", "values"


def _parts(rows: DataFrame, dims: list[str], unit: str) -> dict[str, DataFrame]:
    """The three parts of the roll-up of some rows."""
    dated = rows.filter(F.col(DAY).isNotNull()).withColumn(PERIOD, F.date_trunc(unit, DAY).cast("date"))
    cell = [PERIOD, DAY, *dims]
    sums = dated.groupBy(*cell).agg(
        F.count("*").alias("items"), F.sum("order_amount").alias("amount"), F.count("order_amount").alias("amounts"))
    ids = dated.select(*cell, F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("long").alias("id")) for c in IDS])).alias("__s"))
    ids = ids.select(*cell, F.col("__s.name").alias("name"), F.col("__s.id").alias("__id")).filter(F.col("__id").isNotNull())
    bitmaps = ids.groupBy(*cell, "name", F.shiftright("__id", 6).alias("bucket")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(__id & 63 AS INT))")).alias("bitmap"))
    texts = dated.select(*cell, F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in TEXTS])).alias("__s"))
    values = texts.select(*cell, "__s.name", "__s.value").filter(F.col("value").isNotNull()).distinct()
    return {SUMS: sums, BITMAPS: bitmaps, VALUES: values}


def build(fact: DataFrame, path: str, dims: list[str], unit: str = "month") -> None:
    """Write the roll-up of the whole fact, filed by ``unit``."""
    for name, part in _parts(fact, dims, unit).items():
        balanced(part, PERIOD).write.mode("overwrite").partitionBy(PERIOD).parquet(f"{path}/{name}")


def refresh(fact: DataFrame, path: str, dims: list[str], days: list, unit: str = "month") -> None:
    """Write the periods of the changed days anew. Periods without rows any more lose theirs."""
    spark = fact.sparkSession
    starts = spark.createDataFrame([(d,) for d in days], "d date").select(
        F.date_trunc(unit, "d").cast("date").alias("p")).distinct().collect()
    periods = [r["p"] for r in starts]  # no more than the days given
    for p in periods:
        after = F.add_months(F.lit(p), {"month": 1, "quarter": 3, "year": 12}[unit])
        span = (F.col(DAY) >= F.lit(p)) & (F.col(DAY) < after)
        for name, part in _parts(fact.filter(span), dims, unit).items():
            part.drop(PERIOD).hint("rebalance").write.mode("overwrite").parquet(f"{path}/{name}/{PERIOD}={p}")


def load(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in (SUMS, BITMAPS, VALUES)}


def _distinct_ids(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Exact number of distinct ids per key and name: bitmaps merge by OR in each bucket first."""
    merged = bitmaps.groupBy(*keys, "name", "bucket").agg(F.bit_or("bitmap").alias("bitmap"))
    return merged.groupBy(*keys, "name").agg(F.sum(F.bit_count("bitmap")).alias("n"))


def _picked(counts: DataFrame, name: str, column: str) -> Column:
    return F.coalesce(F.max(F.when(F.col("name") == name, F.col("n"))), F.lit(0)).alias(column)


def kpis(parts: dict[str, DataFrame], flt: Column) -> DataFrame:
    """``sales.kpis`` from the roll-up; the filter may use the day and the filter columns."""
    totals = parts[SUMS].filter(flt).agg(
        F.coalesce(F.sum("items"), F.lit(0)).alias("total_items"), F.sum("amount").cast("double").alias("total_revenue"),
        ratio(F.sum("amount"), F.sum("amounts")).alias("avg_order_value"), F.count_distinct(DAY).alias("active_days"))
    ids = _distinct_ids(parts[BITMAPS].filter(flt))
    ids = ids.agg(_picked(ids, "order_id", "total_orders"), _picked(ids, "vendor_id", "unique_vendors"))
    texts = parts[VALUES].filter(flt).filter(F.col("name") == "city").agg(F.count_distinct("value").alias("unique_cities"))
    return totals.select(
        ids.select("total_orders").scalar().alias("total_orders"), "total_items", "total_revenue", "avg_order_value", "active_days",
        texts.scalar().alias("unique_cities"), ids.select("unique_vendors").scalar().alias("unique_vendors"))


def growth(parts: dict[str, DataFrame], start, end, mode: str = "previous_period", flt: Column | None = None) -> DataFrame:
    """``sales.growth`` from the roll-up."""
    spans = {"now": between_days(start, end), "base": between_days(*comparison_range(start, end, mode))}
    flt = F.lit(True) if flt is None else flt

    def spanned(part: str) -> DataFrame:
        """Rows with the span they count in; a row in both counts in both."""
        halves = [parts[part].filter(flt & span).withColumn("span", F.lit(name)) for name, span in spans.items()]
        return halves[0].unionByName(halves[1])

    ids = _distinct_ids(spanned(BITMAPS).filter(F.col("name") == "order_id"), "span")
    in_span = lambda name, value: F.max(F.when(F.col("span") == name, value))
    orders = ids.agg(F.coalesce(in_span("now", F.col("n")), F.lit(0)).alias("total_orders"),
                     F.coalesce(in_span("base", F.col("n")), F.lit(0)).alias("base_orders"))
    amounts = spanned(SUMS).groupBy("span").agg(F.sum("amount").cast("double").alias("amount"))
    revenue = amounts.agg(in_span("now", F.col("amount")).alias("total_revenue"),
                          in_span("base", F.col("amount")).alias("base_revenue"))
    has_base = F.col("base_orders") > 0
    change = lambda now, base: F.when(has_base, ratio(F.col(now) - F.col(base), F.col(base)) * 100)
    both = orders.select("*", revenue.select("total_revenue").scalar().alias("total_revenue"),
                         revenue.select("base_revenue").scalar().alias("base_revenue"))
    return both.select("*", change("total_orders", "base_orders").alias("growth_orders"),
                       change("total_revenue", "base_revenue").alias("growth_revenue"))


def avg_daily_revenue(parts: dict[str, DataFrame], flt: Column) -> DataFrame:
    """``sales.avg_daily_revenue`` from the roll-up."""
    days = parts[SUMS].filter(flt).groupBy(DAY).agg(F.sum("amount").alias("amount"))
    return days.agg(F.coalesce(ratio(F.sum("amount"), F.count("*")), F.lit(0.0)).alias("avg_daily_revenue"))
