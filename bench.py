"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the run.
Each query runs into a no-op sink, so all of its rows are computed and none collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from stallmetrics.plans import QUERIES
from stallmetrics.session import build_session

HEADLINE = [
    "a01_daily_summary", "a02_monthly_summary", "a03_top_cities", "a05_payment_mix", "a07_totals", "a10_top_vendors",
    "a11_top_products", "a12_top_regions", "a13_kpis", "a14_growth_previous_year", "a17_weekday_hour_pivot",
    "a18_top_cities_normalized", "a21_duplicate_summary", "a23_health_by_day", "a25_duplicate_groups",
    "a31_items_per_order", "a33_monthly_coverage", "j10_reconcile_days", "w01_dedupe_exact", "w02_dedupe_fingerprint",
    "w03_dedupe_latest", "j02_price_changes", "j04_price_comparison", "j05_volatile_products", "j08_upsert_products",
    "w09_price_changes_over_time", "w09_price_changes_over_time_split", "w10_visibility_label", "a34_bench_by_site",
    "a36_category_levels", "p24_change_digest", "p06_normalize_turkish", "p10_parse_price", "p23_discover_categories",
    "p22_extract_products", "j01_new_rows", "m04_replace_partition", "m09_repair_dates", "st01_ingest_batch",
    "st06_hourly_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the engine before timing
    times: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "total time of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
