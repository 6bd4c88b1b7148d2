"""Registered queries: price changes, comparison, history and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallmetrics.functions import filters
from stallmetrics.functions.money import exact_mean
from stallmetrics.operators import benchmark, dedupe, ordered, pricing, reports
from stallmetrics.plans.order_reports import round2
from stallmetrics.plans.registry import query
from stallmetrics.plans.views import (
    CUR_DAY, POSITION, PREV_DAY, price_keys, snapshot_sql, table, with_names, with_prices, with_snapshots)

COLUMNS = ["site_id", "site_name", "product_id", "product_name", "price", "url", "category", "timestamp"]


def half_up_mean(dec: str) -> str:
    """Mean of a DECIMAL(18,4) expression to two decimals, half up, in whole numbers."""
    total, n = f"CAST(sum({dec}) * 10000 AS HUGEINT)", f"count({dec})"
    return f"CAST((2 * {total} + 100 * {n}) // (200 * {n}) AS DOUBLE) / 100"


def snapshot(spark, sf, before: str) -> DataFrame:
    """Last observation per site and product before a day. Names are joined afterwards, so
    that neither the shuffle nor the joins carry observations that are not kept."""
    seen = price_keys(spark, sf).filter(F.col("timestamp") < F.lit(before).cast("timestamp_ntz"))
    return with_names(spark, sf, pricing.snapshot_of(seen, POSITION))


def prev(spark, sf):
    return snapshot(spark, sf, PREV_DAY).select(*COLUMNS)


def cur(spark, sf):
    return snapshot(spark, sf, CUR_DAY).select(*COLUMNS)


CHANGES_CTE = """
, changes AS (
  SELECT c.site_id, c.product_id, c.site_name, c.product_name, p.price AS old_price, c.price AS new_price,
         c.price - p.price AS price_diff, c.url, c.category
  FROM cur_snap c JOIN prev_snap p USING (site_id, product_id) WHERE c.price <> p.price)"""


def changes(spark, sf):
    return pricing.price_changes(prev(spark, sf), cur(spark, sf))


@query("w07_latest_snapshot", with_snapshots("SELECT * FROM cur_snap"))
def _(spark, sf):
    return snapshot(spark, sf, CUR_DAY)


@query("j02_price_changes", with_snapshots(CHANGES_CTE + "SELECT * FROM changes"))
def _(spark, sf):
    return changes(spark, sf)


@query("t21_price_changes_of_at_least_100", with_snapshots(
    CHANGES_CTE + "SELECT * FROM changes WHERE abs(price_diff) >= 100"))
def _(spark, sf):
    return pricing.price_changes(prev(spark, sf), cur(spark, sf), 100)


def per_product_sql(name: str, before: str) -> str:
    return snapshot_sql(name, before).replace("PARTITION BY site_id, product_id", "PARTITION BY product_id").replace(
        "seq_b DESC", "seq_b DESC, site_id DESC")


@query("j03_price_changes_single_site", with_prices(
    "," + per_product_sql("p1", PREV_DAY) + "," + per_product_sql("c1", CUR_DAY) + """
SELECT product_id, c1.site_name, c1.product_name, p1.price AS old_price, c1.price AS new_price,
       c1.price - p1.price AS price_diff, c1.url, c1.category
FROM c1 JOIN p1 USING (product_id) WHERE c1.price <> p1.price"""))
def _(spark, sf):
    # The whole table as one store: the last observation of a product anywhere.
    def at(day):
        seen = price_keys(spark, sf).filter(F.col("timestamp") < F.lit(day).cast("timestamp_ntz"))
        last = dedupe.keep_last(seen, ["product_id"], [*POSITION, "site_id"])
        return with_names(spark, sf, last).select(*COLUMNS)
    return pricing.price_changes_single_site(at(PREV_DAY), at(CUR_DAY))


COMPARISON_SQL = f"""
SELECT c.site_id, c.product_id, c.site_name, c.product_name, c.price AS new_price, p.price AS old_price,
       c.price - p.price AS price_diff,
       CASE WHEN p.price > 0 THEN {round2('(c.price - p.price) / p.price * 100')} WHEN p.price IS NOT NULL THEN 0.0 END AS change_pct,
       c.category, c.url
FROM cur_snap c LEFT JOIN prev_snap p USING (site_id, product_id)"""


def comparison(spark, sf):
    return pricing.price_comparison(cur(spark, sf), prev(spark, sf))


@query("j04_price_comparison", with_snapshots(COMPARISON_SQL))
def _(spark, sf):
    return comparison(spark, sf)


@query("j04_comparison_sheet", with_snapshots(f"""
SELECT site_name, product_name, new_price,
       coalesce(CAST(old_price AS VARCHAR), '-') AS old_price,
       coalesce(format('{{:.2f}}', {round2('price_diff')}), '-') AS price_diff,
       coalesce(format('{{:.2f}}%', change_pct), '-') AS change_pct, category, url FROM ({COMPARISON_SQL})"""))
def _(spark, sf):
    return pricing.comparison_sheet(comparison(spark, sf))


@query("f20_changed_rows", with_snapshots(f"SELECT * FROM ({COMPARISON_SQL}) WHERE price_diff IS NOT NULL AND price_diff <> 0"))
def _(spark, sf):
    return comparison(spark, sf).filter(filters.changed())


@query("o06_report_block", with_snapshots(f"SELECT * FROM ({COMPARISON_SQL}) ORDER BY site_id, product_id LIMIT 90"))
def _(spark, sf):
    return pricing.report_block(comparison(spark, sf), ["site_id", "product_id"], 90)


@query("o06_report_blocks", with_snapshots(f"""
SELECT * EXCLUDE (r), (r - 1) // 90 + 1 AS block, (r - 1) % 90 + 1 AS place FROM (
  SELECT site_id, product_id, new_price, row_number() OVER (ORDER BY site_id, product_id) AS r FROM ({COMPARISON_SQL}))"""))
def _(spark, sf):
    rows = comparison(spark, sf).select("site_id", "product_id", "new_price")
    return pricing.report_blocks(rows, ["site_id", "product_id"], 90)


@query("j05_volatile_products", with_prices(f"""
, dim AS (SELECT DISTINCT site_id, product_id, site_name, product_name FROM price_obs)
SELECT product_name, site_name, min(price) AS min_price, max(price) AS max_price,
       {round2('max(price) - min(price)')} AS volatility
FROM dim JOIN (SELECT site_id, product_id, price FROM price_obs WHERE CAST("timestamp" AS DATE) >= DATE '2001-06-01' - 30)
     USING (site_id, product_id)
GROUP BY product_name, site_name HAVING max(price) > min(price)
ORDER BY volatility DESC, product_name, site_name LIMIT 20"""))
def _(spark, sf):
    obs = price_keys(spark, sf)
    dim = with_names(spark, sf, obs.select("site_id", "product_id").distinct())
    history = obs.select("site_id", "product_id", "price", F.to_date("timestamp").alias("date"))
    return pricing.volatile_products(dim, history, "2001-06-01")


@query("j08_upsert_products", with_snapshots("""
SELECT coalesce(p.product_id, c.product_id) AS product_id, coalesce(p.site_id, c.site_id) AS site_id,
       coalesce(p.site_name, c.site_name) AS site_name, coalesce(c.product_name, p.product_name) AS product_name,
       coalesce(c.category, p.category) AS category, coalesce(c.url, p.url) AS url,
       coalesce(p."timestamp", c."timestamp") AS first_seen, coalesce(c."timestamp", p."timestamp") AS last_seen
FROM prev_snap p FULL JOIN cur_snap c ON p.site_id = c.site_id AND p.product_id = c.product_id"""))
def _(spark, sf):
    return pricing.upsert_products(pricing.product_rows(prev(spark, sf)), cur(spark, sf))


LAG_SQL = with_prices("""
SELECT site_id, product_id, "timestamp", old_price, price AS new_price, price - old_price AS price_diff FROM (
  SELECT *, lag(price) OVER (PARTITION BY site_id, product_id ORDER BY "timestamp", seq_a, seq_b) AS old_price FROM price_obs)
WHERE old_price IS NOT NULL AND price <> old_price""")
LAG_COLUMNS = ["site_id", "product_id", "timestamp", "old_price", "new_price", "price_diff"]


@query("w09_price_changes_over_time", LAG_SQL)
def _(spark, sf):
    return pricing.price_changes_over_time(price_keys(spark, sf), POSITION).select(*LAG_COLUMNS)


@query("w09_price_changes_over_time_split", LAG_SQL)
def _(spark, sf):
    # One sampled row makes a key large here, so that some are cut.
    return pricing.price_changes_over_time(price_keys(spark, sf), POSITION, 1).select(*LAG_COLUMNS)


def positions(spark, sf):
    """Observations with one sortable position text per site."""
    parts = [F.date_format("timestamp", "yyyyMMddHHmmss"), F.lpad(F.col("seq_a").cast("string"), 14, "0"),
             F.lpad(F.col("seq_b").cast("string"), 4, "0"), F.lpad(F.col("product_id"), 14, "0")]
    return price_keys(spark, sf).withColumn("position", F.concat(*parts))


CAP_SQL = 'row_number() OVER (PARTITION BY site_id ORDER BY "timestamp", seq_a, seq_b, lpad(product_id, 14, \'0\'))'


@query("w10_visibility_label", with_prices(f"""
SELECT site_id, product_id, seq_a, CASE WHEN s_nationkey >= 10 THEN '-' WHEN rn <= 23 THEN 'Görünür' ELSE 'Gizli/ekstra' END AS visibility
FROM (SELECT *, {CAP_SQL} AS rn FROM price_obs) JOIN supplier ON site_id = CAST(s_suppkey AS VARCHAR)"""))
def _(spark, sf):
    # Some sites have no cap, some an unknown one, some one of 0.
    cap = F.expr("CASE WHEN s_nationkey < 10 THEN 23 WHEN s_nationkey = 10 THEN 0 END")
    caps = table(spark, sf, "supplier").filter("s_nationkey < 12").select(
        F.col("s_suppkey").cast("string").alias("site_id"), cap.alias("cap"))
    labels = pricing.visibility_label(positions(spark, sf), caps)
    return labels.select("site_id", "product_id", "seq_a", "visibility")


@query("w10_running_index", with_prices(f"SELECT site_id, product_id, seq_a, {CAP_SQL} AS index FROM price_obs"))
def _(spark, sf):
    # Two sampled rows make a site large here, so that sites are cut.
    rows = ordered.running_index(positions(spark, sf), ["site_id"], ["position"], per_task=2)
    return rows.select("site_id", "product_id", "seq_a", "index")


@query("w08_first_30_per_site", with_prices(
    f"SELECT site_id, product_id, price FROM (SELECT *, {CAP_SQL} AS rn FROM price_obs) WHERE rn <= 30"))
def _(spark, sf):
    return dedupe.first_n(positions(spark, sf), ["site_id"], 30, ["position"]).select("site_id", "product_id", "price")


@query("w08_first_2000_per_site", with_prices(
    f"SELECT site_id, product_id, price FROM (SELECT *, {CAP_SQL} AS rn FROM price_obs) WHERE rn <= 2000"))
def _(spark, sf):
    rows = dedupe.first_n(positions(spark, sf), ["site_id"], 2000, ["position"])
    return rows.select("site_id", "product_id", "price")


@query("w08_first_100_overall", with_prices("""
SELECT site_id, product_id, price FROM price_obs
ORDER BY "timestamp", seq_a, seq_b, lpad(product_id, 14, '0') LIMIT 100"""))
def _(spark, sf):
    return dedupe.first_n(positions(spark, sf), [], 100, ["position"]).select("site_id", "product_id", "price")


@query("u04_with_fallback", with_snapshots("""
, main AS (SELECT * FROM cur_snap JOIN supplier ON site_id = CAST(s_suppkey AS VARCHAR) WHERE s_acctbal >= 0)
SELECT site_id, product_id, price FROM main UNION ALL
SELECT site_id, product_id, price FROM prev_snap
WHERE lower(product_name) LIKE '%gear%' AND site_id NOT IN (SELECT site_id FROM main)"""))
def _(spark, sf):
    # Suppliers in debt delivered nothing; their rows come from the older snapshot.
    paid = table(spark, sf, "supplier").filter("s_acctbal >= 0").select(
        F.col("s_suppkey").cast("string").alias("site_id"))
    primary = cur(spark, sf).join(paid, "site_id", "left_semi")
    return pricing.with_fallback(primary, prev(spark, sf), "GEAR").select("site_id", "product_id", "price")


@query("u03_concatenate_runs", with_snapshots("""
SELECT site_id, count(*) AS row_count FROM (SELECT * FROM prev_snap UNION ALL SELECT * FROM cur_snap) GROUP BY 1"""))
def _(spark, sf):
    both = prev(spark, sf).unionByName(cur(spark, sf))
    return both.groupBy("site_id").agg(F.count("*").alias("row_count"))


# --- benchmarks ---------------------------------------------------------------------

# A third of the categories is set to price 0 at the sites that are in debt, and one kind
# of site has no positive price at all, so that the positive-price rules matter.
BENCH_SQL = """
, b AS (SELECT c.* REPLACE (CASE WHEN s_nationkey = 3 OR (s_acctbal < 0 AND category < 'Brand#17') THEN 0.0 ELSE price END AS price)
        FROM cur_snap c JOIN supplier ON site_id = CAST(s_suppkey AS VARCHAR)),
kept AS (SELECT * FROM b WHERE site_id IN (SELECT site_id FROM b WHERE price > 0)),
sites AS (SELECT site_id, site_name, count(*) AS product_count, """ + half_up_mean(
    "CASE WHEN price > 0 THEN CAST(price AS DECIMAL(18,4)) END") + """ AS avg_price,
  min(price) FILTER (WHERE price > 0) AS min_price, max(price) FILTER (WHERE price > 0) AS max_price FROM kept GROUP BY 1, 2)
"""
MEAN = half_up_mean("CAST(price AS DECIMAL(18,4))")


def bench_rows(spark, sf):
    site = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("site_id"), "s_nationkey", "s_acctbal")
    zero = (F.col("s_nationkey") == 3) | ((F.col("s_acctbal") < 0) & (F.col("category") < "Brand#17"))
    rows = cur(spark, sf).join(site, "site_id")
    return rows.withColumn("price", F.when(zero, F.lit(0.0)).otherwise(F.col("price"))).select(*COLUMNS)


def with_bench(sql: str) -> str:
    return with_snapshots(BENCH_SQL + sql)


@query("a34_bench_by_site", with_bench("SELECT * FROM sites"))
def _(spark, sf):
    return benchmark.bench_by_site(bench_rows(spark, sf))


@query("a35_bench_by_category", with_bench(
    f"SELECT category, count(*) AS product_count, {MEAN} AS avg_price FROM kept GROUP BY 1"))
def _(spark, sf):
    return benchmark.bench_by_category(bench_rows(spark, sf))


CELLS = f"SELECT category, site_id, site_name, count(*) AS product_count, {MEAN} AS avg_price FROM kept GROUP BY 1, 2, 3"


@query("a36_bench_by_category_site", with_bench(CELLS))
def _(spark, sf):
    return benchmark.bench_by_category_site(bench_rows(spark, sf))


@query("a36_category_levels", with_bench(f"""
SELECT category, site_id, CAST(grouping(site_id) AS INTEGER) AS is_total, count(*) AS product_count, {MEAN} AS avg_price
FROM kept GROUP BY GROUPING SETS ((category), (category, site_id))"""))
def _(spark, sf):
    return benchmark.bench_category_levels(bench_rows(spark, sf))


PIVOT_NATIONS = [f"NATION_{k}" for k in range(25)]


@query("a37_category_site_pivot", with_bench(f"""
, n AS (SELECT k.category, n_name, {MEAN} AS avg_price FROM kept k JOIN supplier ON site_id = CAST(s_suppkey AS VARCHAR)
        JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)
SELECT category, """ + ", ".join(
    f"coalesce(max(avg_price) FILTER (WHERE n_name = '{n}'), 0.0) AS {n}" for n in PIVOT_NATIONS)
    + " FROM n GROUP BY 1"))
def _(spark, sf):
    # Nations stand in for sites, so that the pivot has a fixed, small set of columns.
    home = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    home = home.select(F.col("s_suppkey").cast("string").alias("site_id"), "n_name")
    kept_sites = benchmark.bench_by_site(bench_rows(spark, sf)).select("site_id")
    rows = bench_rows(spark, sf).join(kept_sites, "site_id", "left_semi").join(home, "site_id")
    rows = rows.withColumn("site_id", F.col("n_name")).withColumn("site_name", F.col("n_name"))
    return benchmark.category_site_pivot(rows, PIVOT_NATIONS)


def scrape_rows(spark, sf):
    """Current snapshot as scrape rows: sites in debt failed and keep one empty row."""
    sites = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("site_id"), F.col("s_name").alias("site_name"),
        (F.col("s_acctbal") >= 0).alias("success"))
    sites = sites.withColumn("error", F.when(~F.col("success"), F.lit("timeout")))
    items = cur(spark, sf).drop("site_name")
    return sites.join(items, (sites.site_id == items.site_id) & sites.success, "left").drop(items.site_id)


SCRAPE_CTE = """
, scrape AS (SELECT CAST(s_suppkey AS VARCHAR) AS site_id, s_name AS site_name, s_acctbal >= 0 AS success,
                    c.product_id, c.price FROM supplier
             LEFT JOIN cur_snap c ON c.site_id = CAST(s_suppkey AS VARCHAR) AND s_acctbal >= 0)"""


@query("a38_run_summary", with_snapshots(SCRAPE_CTE + """
SELECT count(DISTINCT site_id) AS total_sites, count(DISTINCT site_id) FILTER (WHERE success) AS successful_sites,
       count(product_id) AS total_products FROM scrape"""))
def _(spark, sf):
    return benchmark.run_summary(scrape_rows(spark, sf))


@query("f17_successful_products", with_snapshots(SCRAPE_CTE + """
SELECT site_id, product_id, price FROM scrape WHERE success AND product_id IS NOT NULL"""))
def _(spark, sf):
    return benchmark.successful(scrape_rows(spark, sf)).select("site_id", "product_id", "price")


@query("f17b_failed_sites", "SELECT s_name AS site_name, 'timeout' AS error FROM supplier WHERE s_acctbal < 0")
def _(spark, sf):
    return benchmark.failed_sites(scrape_rows(spark, sf))


@query("a39_mean_of_site_means", with_bench(f"""
SELECT {half_up_mean('CAST(avg_price AS DECIMAL(18,4))')} AS overall_avg_price FROM sites"""))
def _(spark, sf):
    return benchmark.mean_of_site_means(bench_rows(spark, sf))


@query("a40_category_counts", with_snapshots("SELECT category, count(*) AS product_count FROM cur_snap GROUP BY 1"))
def _(spark, sf):
    return benchmark.category_counts(cur(spark, sf))


@query("a41_site_shares", with_bench(f"""
SELECT site_id, site_name, product_count,
       {round2('product_count * 100.0 / CAST(sum(product_count) OVER () AS DOUBLE)')} AS share_pct FROM sites"""))
def _(spark, sf):
    return benchmark.site_shares(bench_rows(spark, sf))


def bench_history(spark, sf):
    """Benchmark rows per day and site, as the daily runs would have recorded them."""
    obs = price_keys(spark, sf).withColumn("date", F.to_date("timestamp"))
    price = F.col("price").cast("decimal(18,4)")
    daily = obs.groupBy("date", "site_id").agg(
        F.count("*").alias("product_count"),
        exact_mean(F.sum(price), F.count("*")).alias("avg_price"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"))
    names = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("site_id"), F.col("s_name").alias("site_name"))
    return daily.join(names, "site_id").withColumn("timestamp", F.col("date").cast("timestamp_ntz"))


HISTORY_CTE = f"""
, hist AS (SELECT CAST("timestamp" AS DATE) AS date, site_id, site_name, count(*) AS product_count, {MEAN} AS avg_price
           FROM price_obs GROUP BY ALL)"""


@query("a42_site_trend", with_prices(HISTORY_CTE + """
SELECT date, site_name, CAST(sum(CAST(avg_price AS DECIMAL(28,4))) AS DOUBLE) / count(*) AS avg_price
FROM hist WHERE date >= DATE '2001-10-01' - 7 GROUP BY 1, 2"""))
def _(spark, sf):
    return benchmark.site_trend(bench_history(spark, sf), "2001-10-01")


@query("a43_product_table_stats", with_snapshots("""
SELECT count(*) AS shown_products, min(price) AS min_price, max(price) AS max_price FROM cur_snap
WHERE category IN ('Brand#1', 'Brand#2', 'Brand#17')"""))
def _(spark, sf):
    return benchmark.product_table_stats(cur(spark, sf), [], ["Brand#1", "Brand#2", "Brand#17"])


@query("f19_no_selection", with_snapshots("""
SELECT count(*) AS shown_products, min(price) AS min_price, max(price) AS max_price FROM cur_snap"""))
def _(spark, sf):
    return benchmark.product_table_stats(cur(spark, sf))


@query("a44_changes_by_site", with_snapshots(
    CHANGES_CTE + "SELECT site_id, site_name, count(*) AS change_count FROM changes GROUP BY 1, 2"))
def _(spark, sf):
    return benchmark.changes_by_site(changes(spark, sf))


@query("a45_freshness", with_snapshots(HISTORY_CTE + """
SELECT (SELECT max("timestamp") FROM cur_snap) AS last_update, (SELECT count(DISTINCT site_id) FROM cur_snap) AS site_count,
       (SELECT count(*) FROM cur_snap) AS product_count, (SELECT CAST(max(date) AS TIMESTAMP) FROM hist) AS last_report"""))
def _(spark, sf):
    return benchmark.freshness(cur(spark, sf), bench_history(spark, sf))


SORTS = {"price_asc": "price", "price_desc": "price DESC", "site": "site_name", "category": "category"}


def _sorted(mode: str, order: str) -> None:
    @query("o03_sort_products" if mode == "price_desc" else f"o03_sort_by_{mode}", with_snapshots(
        f"SELECT site_id, product_id, price FROM cur_snap ORDER BY {order}, site_id, product_id"))
    def _(spark, sf):
        return pricing.sort_products(cur(spark, sf), mode).select("site_id", "product_id", "price")


for _mode, _order in SORTS.items():
    _sorted(_mode, _order)


@query("o08_categories_by_price", with_bench(
    f"SELECT category, count(*) AS product_count, {MEAN} AS avg_price FROM kept GROUP BY 1"))
def _(spark, sf):
    return benchmark.categories_by_price(bench_rows(spark, sf))


@query("f16_valid_products", with_bench("SELECT site_id, product_id FROM b WHERE price > 0 AND product_name <> ''"))
def _(spark, sf):
    return bench_rows(spark, sf).filter(filters.valid_product("price", "product_name")).select("site_id", "product_id")


# --- messages -----------------------------------------------------------------------

SIGNED = "CASE WHEN price_diff > 0 THEN '+' ELSE '' END || format('{:.2f}', price_diff)"
ARROW = f"CASE WHEN price_diff > 0 THEN '{reports.UP}' ELSE '{reports.DOWN}' END"


LINES_SQL = f"""
SELECT site_id, site_name, product_id, {ARROW} || ' *' || product_name || '*: ' || format('{{:.2f}}', old_price) || '₺ → ' ||
       format('{{:.2f}}', new_price) || '₺ (' || {SIGNED} || '₺) <' || url || '|Ürün>' AS line,
       '*' || product_name || '*' || chr(10) || '• Eski: ' || format('{{:.2f}}', old_price) || '₺ → Yeni: ' ||
       format('{{:.2f}}', new_price) || '₺' || chr(10) || '• Fark: ' || {ARROW} || ' ' || {SIGNED} || '₺' ||
       chr(10) || '<' || url || '|Ürüne Git>' AS block FROM changes"""


@query("p24_change_lines", with_snapshots(CHANGES_CTE + f"SELECT site_id, product_id, line, block FROM ({LINES_SQL})"))
def _(spark, sf):
    return reports.change_lines(changes(spark, sf)).select("site_id", "product_id", "line", "block")


@query("p24_change_digest", with_snapshots(CHANGES_CTE + f"""
, placed AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY product_id) AS pos,
                    count(*) OVER (PARTITION BY site_id) AS n FROM ({LINES_SQL}))
SELECT site_id, (pos - 1) // 50 + 1 AS message_no, count(*) AS change_count,
       '*🏪 ' || site_name || '* - ' || n || ' değişiklik' AS heading, string_agg(block, chr(10) ORDER BY pos) AS message
FROM placed GROUP BY site_id, site_name, n, (pos - 1) // 50 + 1"""))
def _(spark, sf):
    return reports.change_digest(changes(spark, sf)).select(
        "site_id", "message_no", "change_count", "heading", "message")


@query("p24_change_header", with_snapshots(CHANGES_CTE + """
SELECT count(*) AS change_count, count(DISTINCT site_id) AS site_count,
       '*' || count(*) || ' ürünün fiyatı değişti!*' AS message FROM changes"""))
def _(spark, sf):
    return reports.change_header(changes(spark, sf))


@query("p25_batch_messages", with_snapshots(CHANGES_CTE + f"""
, placed AS (SELECT *, row_number() OVER (ORDER BY site_id, product_id) AS pos FROM ({LINES_SQL}))
SELECT (pos - 1) // 5 + 1 AS message_no, count(*) AS change_count, string_agg(line, chr(10) ORDER BY pos) AS message
FROM placed GROUP BY (pos - 1) // 5 + 1"""))
def _(spark, sf):
    return reports.batch_messages(changes(spark, sf))


NO_CHANGE_SQL = """
SELECT site_id, '*' || site_name || '*' || chr(10) || '• Ürün: ' || product_count || chr(10) || '• Ort: ' ||
       format('{:.2f}', avg_price) || '₺ | Min: ' || format('{:.2f}', min_price) || '₺ | Max: ' ||
       format('{:.2f}', max_price) || '₺' AS message FROM sites"""


@query("p26_no_change_digest", with_bench(NO_CHANGE_SQL))
def _(spark, sf):
    return reports.no_change_digest(bench_rows(spark, sf)).select("site_id", "message")


@query("p26_end_of_day_digest", with_bench(NO_CHANGE_SQL))
def _(spark, sf):
    evening = F.lit("2000-01-01 15:30:00").cast("timestamp_ntz")
    return reports.end_of_day_digest(bench_rows(spark, sf), evening).select("site_id", "message")


@query("p26_no_change_header", with_snapshots(SCRAPE_CTE + """
, s AS (SELECT count(DISTINCT site_id) AS total_sites, count(DISTINCT site_id) FILTER (WHERE success) AS successful_sites,
               count(product_id) AS total_products FROM scrape)
SELECT *, '✅ ' || successful_sites || ' site tarandı' || chr(10) || '📦 ' || total_products || ' ürün kontrol edildi' ||
       chr(10) || '✨ Fiyat değişikliği yok' AS message FROM s"""))
def _(spark, sf):
    return reports.no_change_header(benchmark.run_summary(scrape_rows(spark, sf)))
