"""Registered queries: pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallmetrics.operators import pages as ops
from stallmetrics.plans.price_reports import cur
from stallmetrics.plans.registry import query
from stallmetrics.plans.text_rules import local_price
from stallmetrics.plans.views import SNAPSHOTS_SQL, table, with_snapshots
from stallmetrics.sources.readers import read_pages


def shop_pages(spark, sf):
    """Shop pages made of the current snapshot: up to 50 product cards each, every card
    with an old and a new price, plus one structured-data block per page and a broken one."""
    items = cur(spark, sf).withColumn("page_no", F.floor(F.col("product_id").cast("long") / 50))
    card = F.concat(
        F.lit('<div class="product-card big"><h3 class="title"> '), F.col("product_name"), F.lit(" &amp; co</h3><br>"),
        F.lit('<span class="price">'), local_price(F.round(F.col("price") * 2, 2)), F.lit(" TL <b>"),
        local_price(F.col("price")), F.lit("</b> TL</span><a href=\""), F.col("url"), F.lit('">Git</a></div>'))
    pages = items.groupBy("site_id", "page_no").agg(
        F.sort_array(F.collect_list(F.struct(F.col("product_id").cast("long"), card.alias("card")))).alias("cards"))
    block = F.concat(
        F.lit('<script type="application/ld+json"> {"site": "'), F.col("site_id"), F.lit('", "page": '),
        F.col("page_no").cast("string"), F.lit("} </script><script type='application/ld+json'>{broken</script>"))
    html = F.concat(F.lit("<html><head>"), block, F.lit('</head><body><div class="product-card">No price</div>'),
                    F.array_join("cards.card", "\n"), F.lit("</body></html>"))
    return pages.select(
        (F.col("site_id").cast("long") * 1000000 + F.col("page_no")).alias("page_id"),
        F.concat(F.lit("https://www.shop"), "site_id", F.lit(".example/list?page="), F.col("page_no").cast("string")).alias("url"),
        html.alias("html"))


def shop_sites(spark, sf):
    """Site dimension: one site per supplier; the first box selector matches nothing."""
    selectors = F.struct(
        F.lit("article.card, .product-card").alias("product_box"), F.lit("h2, h3").alias("product_name"),
        F.lit('.fiyat, [class*="price"]').alias("product_price"), F.lit("a[href]").alias("product_link"))
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("shop"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"),
        F.concat(F.lit("https://shop"), F.col("s_suppkey").cast("string"), F.lit(".example")).alias("url"),
        selectors.alias("selectors"))


@query("p22_extract_products", with_snapshots("""
SELECT 'shop' || site_id AS site_id, site_name, 'shop' || site_id || '_' || product_id AS product_id,
       product_name || ' & co' AS product_name, price, 'https://shop' || site_id || '.example' || url AS url,
       'Karma/Diğer' AS category FROM cur_snap WHERE price > 0"""))
def _(spark, sf):
    tasks = 4 * spark.sparkContext.defaultParallelism
    found = ops.extract_products(shop_pages(spark, sf), shop_sites(spark, sf), tasks=tasks)
    return found.select("site_id", "site_name", "product_id", "product_name", "price", "url", "category")


@query("p21_extract_json_ld", f"""
WITH {SNAPSHOTS_SQL}
, p AS (SELECT DISTINCT site_id, CAST(product_id AS BIGINT) // 50 AS page_no FROM cur_snap)
SELECT CAST(site_id AS BIGINT) * 1000000 + page_no AS page_id, 0 AS block_no, site_id AS site, page_no AS page FROM p""")
def _(spark, sf):
    blocks = ops.extract_json_ld(shop_pages(spark, sf))
    parsed = F.from_json("json", "site string, page long")
    return blocks.select("page_id", "block_no", parsed.alias("j")).select("page_id", "block_no", "j.site", "j.page")


@query("p21_json_ld_of_pages", r"""
SELECT page_id, unnest(regexp_extract_all(html, '<script[^>]*application/ld\+json[^>]*>([^<]*)</script>', 1)) AS json FROM pages""")
def _(spark, sf):
    return ops.extract_json_ld(table(spark, sf, "pages")).select("page_id", "json")


PAGE_SELECTORS = {"product_box": "main, article", "product_name": "h1", "product_price": ".price, h1"}


def page_sites(spark, sf):
    """One site per host of the given pages."""
    from stallmetrics.functions.web import url_base, url_host

    selectors = F.struct(*[F.lit(v).alias(k) for k, v in PAGE_SELECTORS.items()], F.lit("a[href]").alias("product_link"))
    hosts = table(spark, sf, "pages").groupBy(url_host(F.col("url")).alias("id")).agg(
        F.min(url_base(F.col("url"))).alias("url"))
    return hosts.select("id", F.col("id").alias("name"), "url", selectors.alias("selectors"))


HEADINGS_SQL = r"""
WITH cards AS (
  SELECT page_id, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) AS base,
         regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^www\.', '') AS site_id,
         regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1) AS card FROM pages),
parts AS (
  SELECT *, trim(replace(replace(replace(replace(replace(
           regexp_replace(regexp_extract(card, '(?s)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g'),
           '&quot;', '"'), '&#39;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS product_name,
         regexp_extract(card, '<a\b[^>]*?\bhref="([^"]*)"', 1) AS href FROM cards),
priced AS (
  SELECT *, coalesce(TRY_CAST(regexp_extract(regexp_replace(replace(regexp_extract_all(product_name, '[\d.,]+')[-1], '.', ''),
           '^([^,]*),', '\1.'), '^(\d+\.?\d*|\.\d+)', 1) AS DOUBLE), 0) AS price,
         CASE WHEN href = '' THEN '' WHEN starts_with(href, 'http') THEN href WHEN starts_with(href, '/') THEN base || href
              ELSE base || '/' || href END AS url FROM parts)
SELECT page_id, site_id, site_id || '_' || CASE WHEN url = '' THEN '0' ELSE
         regexp_replace(list_filter(string_split(url, '/'), lambda p: p <> '')[-1], '[^a-zA-Z0-9-]', '_', 'g') END AS product_id,
       product_name, price, url FROM priced WHERE price > 0 AND product_name <> ''"""


@query("p22_headings_of_pages", HEADINGS_SQL)
def _(spark, sf):
    """Article headings with a number in them, read as cards of the given pages."""
    found = ops.extract_products(table(spark, sf, "pages"), page_sites(spark, sf))
    return found.select("page_id", "site_id", "product_id", "product_name", "price", "url")


KEYWORDS, PRIORITY = ["the", "en", "la", "de"], ["Thnoth", "the", "en"]
LINKS_SQL = r"""
, raw AS (SELECT page_id, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) AS base,
                 regexp_extract_all(html, '<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["''][^>]*>', 1) AS hrefs,
                 regexp_extract_all(html, '<a\b[^>]*?\bhref\s*=\s*["''][^"'']*["''][^>]*>([^<]*)</a>', 1) AS names FROM pages),
links AS (SELECT page_id, base, unnest(hrefs) AS href, trim(unnest(names)) AS name, generate_subscripts(hrefs, 1) AS pos FROM raw),
hits AS (SELECT page_id, pos, name, CASE WHEN starts_with(href, 'http') THEN href ELSE base || href END AS url FROM links
         WHERE (starts_with(href, '/') OR starts_with(href, base)) AND KEYWORD_TEST),
uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY pos) AS rn FROM hits) WHERE rn = 1),
prio AS (SELECT unnest(PRIORITY_LIST) AS p, generate_subscripts(PRIORITY_LIST, 1) AS k),
best AS (SELECT page_id, k, name, url FROM (
           SELECT u.page_id, k, name, url, row_number() OVER (PARTITION BY u.page_id, k ORDER BY pos) AS rn
           FROM uniq u JOIN prio ON contains(lower(u.name), p)) WHERE rn = 1),
chosen AS (SELECT page_id, k AS o, name, url FROM best UNION ALL
           SELECT page_id, pos, name, url FROM uniq WHERE page_id NOT IN (SELECT page_id FROM best))
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY o) - 1 AS INTEGER) AS rank, name AS category, url FROM chosen"""
LINKS_SQL = "WITH one AS (SELECT 1)" + LINKS_SQL.replace(
    "KEYWORD_TEST", "(" + " OR ".join(f"contains(lower(name), '{k}')" for k in KEYWORDS) + ")").replace(
    "PRIORITY_LIST", "[" + ", ".join(f"'{p.lower()}'" for p in PRIORITY) + "]")


@query("p23_discover_categories", LINKS_SQL)
def _(spark, sf):
    return ops.discover_categories(table(spark, sf, "pages"), KEYWORDS, PRIORITY)


CONFIGURED = [("Papatya", "https://shop.example/papatya"), ("Orkide", "https://shop.example/orkide")]


@query("p23_configured_categories", LINKS_SQL.replace("['thnoth', 'the', 'en']", "['thnoth']").replace(
    "UNION ALL\n           SELECT page_id, pos, name, url FROM uniq", "UNION ALL SELECT page_id, n - 100, listed, link FROM pages, (VALUES "
    + ", ".join(f"({k}, '{name}', '{link}')" for k, (name, link) in enumerate(CONFIGURED)) + """) c(n, listed, link)
           WHERE page_id NOT IN (SELECT page_id FROM best)
           UNION ALL SELECT page_id, pos, name, url FROM uniq"""))
def _(spark, sf):
    """A priority name that few pages have: the others take the configured list and what they link to."""
    return ops.discover_categories(table(spark, sf, "pages"), KEYWORDS, PRIORITY[:1], configured=CONFIGURED)


@query("f22_single_category", f"SELECT * FROM ({LINKS_SQL}) WHERE category = 'the'")
def _(spark, sf):
    return ops.discover_categories(table(spark, sf, "pages"), KEYWORDS, PRIORITY, only="the")


@query("s08_read_pages", "SELECT page_id, url, length(html) AS html_length FROM pages")
def _(spark, sf):
    pages = read_pages(spark, f"{sf}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").cast("long").alias("html_length"))
