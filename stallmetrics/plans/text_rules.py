"""Registered queries: row normalisation, price and URL parsing, keys, run slots."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallmetrics.functions import clock, filters, keys, money, text, web
from stallmetrics.operators.ingest import normalize_orders
from stallmetrics.plans.registry import query
from stallmetrics.plans.views import RECORD_SQL, order_items, order_items_dup, table, with_dup_orders, with_orders


def pick(values: list[str], index) -> "F.Column":
    """One of the given texts, by a number column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def pick_sql(values: list[str], index: str) -> str:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"[{listed}][{index} % {len(values)} + 1]"


# spelling -> its normalised form, as worked out by hand
SPELLINGS = {
    "  İstanbul (Avrupa) ": "ISTANBUL-AVRUPA",
    "Ä°STANBUL anadolu": "ISTANBUL-ANADOLU",
    "0STANBUL": "ISTANBUL",
    "ÄŸüven  Åehir": "guven Sehir",
    "Ã¼rgüp   öz": "A¼rgup  oz",
    "Çağrı Şube": "Cagri Sube",
    "ızgara Ä±şık": "izgara isik",
}


@query("p06_normalize_turkish", f"""
SELECT c_custkey, CASE WHEN c_custkey % 7 < 2 THEN {pick_sql(list(SPELLINGS.values()), 'c_custkey')}
       ELSE {pick_sql(list(SPELLINGS.values()), 'c_custkey')} || ' ' || c_name END AS normalized FROM customer""")
def _(spark, sf):
    customers = table(spark, sf, "customer")
    spelled = F.concat(pick(list(SPELLINGS), F.col("c_custkey")), F.lit(" "), F.col("c_name"))
    return customers.select("c_custkey", text.normalize_turkish(spelled).alias("normalized"))


@query("p07_canonical_city", """
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'ISTANBUL-AVRUPA' WHEN 1 THEN 'ISTANBUL-ANADOLU'
       ELSE 'Istanbul ' || c_name END AS city FROM customer""")
def _(spark, sf):
    side = pick(["Avrupa ", "anadolu ", ""], F.col("c_custkey"))
    customers = table(spark, sf, "customer")
    return customers.select("c_custkey", text.canonical_city(
        F.concat(F.lit("Istanbul "), side, F.col("c_name"))).alias("city"))


FLOWERS = ["GUL", "Gül", "Orkide", "papatya", "LILIUM", "gerbera", "lisianthus", "karanfil", "Tulip", "vazo"]
FLOWER_GROUPS = ["Gül", "Gül", "Orkide", "Papatya", "Lilyum", "Gerbera", "Lisyantus", "Karanfil", "Lale", "Karma/Diğer"]


@query("p08_detect_category", f"""
SELECT p_partkey, {pick_sql(FLOWER_GROUPS, 'p_partkey')} AS category,
       CASE WHEN p_name LIKE '%bolt%' OR p_name LIKE '%gear%' THEN 'drive' WHEN p_name LIKE '%ring%' THEN 'seal'
            ELSE 'other' END AS kind FROM part""")
def _(spark, sf):
    part = table(spark, sf, "part")
    rules = [("drive", ["bolt", "gear"]), ("seal", ["ring"])]
    named = F.concat(F.col("p_name"), F.lit(" "), pick(FLOWERS, F.col("p_partkey")))
    return part.select("p_partkey", text.detect_category(named).alias("category"),
                       text.detect_category(F.upper("p_name"), rules, "other").alias("kind"))


@query("p09_name_contains", "SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%gear%'")
def _(spark, sf):
    return table(spark, sf, "part").filter(text.name_contains(F.col("p_name"), "GEAR")).select("p_partkey", "p_name")


def local_price(amount) -> "F.Column":
    """1299.9 as 1.299,90."""
    return F.translate(F.format_number(amount, 2), ",.", ".,")


PRICE_SQL = "CAST(round(CAST(p_retailprice AS DECIMAL(18,4)), 2) AS DOUBLE)"


@query("p10_parse_price", f"""
SELECT p_partkey, {PRICE_SQL} AS last_price, CAST(round(CAST({PRICE_SQL} * 3 AS DECIMAL(18,4)), 2) AS DOUBLE) AS first_price,
       {PRICE_SQL} AS only_price, CAST(0 AS DOUBLE) AS no_price FROM part""")
def _(spark, sf):
    part = table(spark, sf, "part").withColumn("price", F.round("p_retailprice", 2))
    shown = F.concat(local_price(F.round(F.col("price") * 3, 2)), F.lit(" TL "), local_price(F.col("price")), F.lit(" TL"))
    single = F.concat(F.lit("₺"), local_price(F.col("price")), F.lit(" TL"))
    return part.select(
        "p_partkey", money.parse_price(shown, "last").alias("last_price"),
        money.parse_price(shown, "first").alias("first_price"), money.parse_price(single, "strip").alias("only_price"),
        money.parse_price(F.col("p_name"), "last").alias("no_price"))


@query("p11_product_ids", r"""
SELECT page_id, 'shop_' || coalesce(regexp_replace(list_filter(string_split(url, '/'), lambda x: x <> '')[-1], '[^a-zA-Z0-9-]', '_', 'g'),
       CAST(page_id AS VARCHAR)) AS url_id,
       CASE WHEN string_split(url, '-')[-1] <> '' THEN string_split(url, '-')[-1] ELSE 'product_' || page_id END AS href_id
FROM pages""")
def _(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select(
        "page_id", web.product_id_from_url(F.col("url"), F.lit("shop"), F.col("page_id")).alias("url_id"),
        web.product_id_from_href(F.col("url"), F.col("page_id")).alias("href_id"))


@query("p12_absolute_url", """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'https://shop.example/p/' || page_id
       WHEN 2 THEN 'https://shop.example/p/' || page_id ELSE '' END AS link FROM pages""")
def _(spark, sf):
    pages = table(spark, sf, "pages")
    ident = F.col("page_id").cast("string")
    href = (F.when(F.col("page_id") % 4 == 0, F.col("url")).when(F.col("page_id") % 4 == 1, F.concat(F.lit("/p/"), ident))
            .when(F.col("page_id") % 4 == 2, F.concat(F.lit("p/"), ident)))
    return pages.select("page_id", web.absolute_url(href, F.lit("https://shop.example")).alias("link"))


@query("p13_slugs", r"""
SELECT s_suppkey, 'buyuk_carsi_' || lower(s_name) AS underscored, 'buyukcarsi' || lower(s_name) AS compact,
       trim(regexp_replace(lower(s_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM supplier""")
def _(spark, sf):
    shop = F.concat(F.lit("Büyük Çarşı "), F.col("s_name"))
    return table(spark, sf, "supplier").select(
        "s_suppkey", text.site_slug_underscore(shop).alias("underscored"), text.site_slug_compact(shop).alias("compact"),
        text.name_slug(F.concat(F.lit("!"), F.col("s_name"), F.lit("?"))).alias("slug"))


@query("p18_format_money", """
SELECT o_orderkey, '₺' || format('{:,.2f}', o_totalprice) AS shown, format('{:,.2f}₺', o_totalprice) AS shown_after,
       CASE WHEN o_orderstatus = 'P' THEN 'N/A' ELSE format('{:,.2f}₺', o_totalprice) END AS maybe FROM orders""")
def _(spark, sf):
    amount, gap = F.col("o_totalprice"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return table(spark, sf, "orders").select(
        "o_orderkey", money.format_money(amount).alias("shown"), money.format_money(amount, "suffix").alias("shown_after"),
        money.format_money(gap, "suffix").alias("maybe"))


@query("p19_parse_money", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount
FROM orders""")
def _(spark, sf):
    gap = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return table(spark, sf, "orders").select(
        "o_orderkey", money.parse_money(money.format_money(gap, "suffix")).alias("amount"))


def payload(spark, sf):
    """Order items as the payload delivers them: date texts, a list, an odd column name."""
    rows = order_items(spark, sf, "order_id", "product_code_1", "additional_products", "delivery_location_type",
                       "order_created_date_tr", "order_delivery_date", "order_creation_timestamp")
    stamp = F.date_format("order_creation_timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    extra = F.array(F.col("additional_products"), F.when(F.col("delivery_location_type") != "N", F.col("delivery_location_type")))
    return rows.select(
        "order_id", "product_code_1", F.lit("x").alias("teslimat_türü"), extra.alias("additional_products"),
        F.concat(stamp, F.lit("+03:00")).alias("order_created_date"),
        F.col("order_delivery_date").cast("string").alias("order_delivery_date"),
        F.lit("soon").alias("requested_delivery_date"))


@query("p05_normalize_orders", with_orders("""
SELECT order_id, product_code_1, 'x' AS teslimat_turu,
       additional_products || ', ' || CASE WHEN delivery_location_type <> 'N' THEN delivery_location_type ELSE 'None' END AS additional_products,
       CAST(order_creation_timestamp AS DATE) AS order_created_date_tr, order_delivery_date,
       CAST(NULL AS DATE) AS requested_delivery_date FROM order_items"""))
def _(spark, sf):
    return normalize_orders(payload(spark, sf))


@query("p16_all_but", with_orders("""
SELECT * EXCLUDE (order_amount, order_creation_timestamp, requested_delivery_date) FROM order_items"""))
def _(spark, sf):
    return order_items(spark, sf).drop("order_amount", "order_creation_timestamp", "requested_delivery_date")


@query("p17_constant_label", with_orders("""
SELECT 'orders' AS "check", city, count(*) AS total_items FROM order_items GROUP BY city"""))
def _(spark, sf):
    cities = order_items(spark, sf, "city").groupBy("city").agg(F.count("*").alias("total_items"))
    return cities.select(F.lit("orders").alias("check"), "city", "total_items")


@query("p20_row_json", with_orders("SELECT order_id, " + RECORD_SQL + " AS record FROM order_items"))
def _(spark, sf):
    rows = order_items(spark, sf)
    return rows.select("order_id", keys.row_json(rows).alias("record"))


@query("h01_business_key", with_dup_orders("""
SELECT order_id, count(*) AS distinct_keys FROM (
  SELECT DISTINCT additional_products, city, delivery_location_type, district, neighborhood, order_created_date_tr,
         order_id, product_code_1, product_name, rider_id, user_id, vendor_id FROM dup_items) GROUP BY 1"""))
def _(spark, sf):
    rows = order_items_dup(spark, sf, *keys.BUSINESS_KEY)
    return rows.select("order_id", *keys.business_key(rows)).distinct().groupBy("order_id").agg(
        F.count("*").alias("distinct_keys"))


@query("p27_classify_run", """
SELECT event_id, h IN (10, 12, 15, 18) AND minute(t) <= 10 AS scheduled, NOT (h IN (10, 12, 15, 18) AND minute(t) <= 10) AS manual,
       strftime(t, '%H:%M') AS run_time,
       CAST(CASE WHEN h > 18 THEN 18 WHEN h > 15 THEN 15 WHEN h > 12 THEN 12 WHEN h > 10 THEN 10 ELSE 18 END AS INTEGER) AS previous_slot
FROM (SELECT event_id, ts + INTERVAL 3 HOUR AS t, hour(ts + INTERVAL 3 HOUR) AS h FROM events)""")
def _(spark, sf):
    run = clock.classify_run(F.col("ts"))
    return table(spark, sf, "events").select("event_id", run.alias("r")).select("event_id", "r.*")


@query("f15_morning_filter", with_orders("""
SELECT order_id, product_code_1 FROM order_items
WHERE order_created_date_tr = DATE '1997-03-18' AND CASE delivery_status
      WHEN 'O' THEN hour(order_creation_timestamp) < 8 WHEN 'F' THEN TRUE ELSE payment_method < '3' END"""))
def _(spark, sf):
    rows = order_items(spark, sf, "order_id", "product_code_1", "order_created_date_tr", "order_creation_timestamp",
                       "delivery_status", "payment_method")
    # Open orders carry a full time with an offset, finished ones a bare date (midnight),
    # pending ones a text that does not parse, with or without today's plain date.
    stamp = F.concat(F.date_format("order_creation_timestamp", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-07:00"))
    day = F.col("order_created_date_tr").cast("string")
    status, plain = F.col("delivery_status"), F.col("payment_method") < "3"
    shaped = rows.select(
        "order_id", "product_code_1",
        F.when(status == "O", stamp).when(status == "F", day).otherwise(F.lit("")).alias("order_created_date"),
        F.when(status == "P", F.concat(day, F.lit("T99"))).alias("created_at"),
        F.when(plain, day).otherwise(F.lit("1999-01-01")).alias("order_created_date_tr"))
    return filters.morning_filter(shaped, "1997-03-18").select("order_id", "product_code_1")
