"""Product, structured-data and link extraction from stored pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.functions.filters import valid_product
from stallmetrics.functions.markup import attribute, find_all, find_first, inner, text_of, visible
from stallmetrics.functions.money import parse_price
from stallmetrics.functions.text import detect_category
from stallmetrics.functions.web import absolute_url, product_id_from_url, url_base, url_host

LD_JSON = r"(?is)<script[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"
ANCHOR = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
# Words and priority of home-page categories.
DISCOVERY_KEYWORDS = [
    "çok satanlar", "yenilebilir", "kişiye özel", "premium", "gürme", "gürme lezzet",
    "aynı gün", "doğum günü", "orkide", "geçmiş olsun",
]
DISCOVERY_PRIORITY = [
    "Çok Satanlar", "Yenilebilir Çiçek", "Doğum Günü", "Orkide / Saksı Çiçekleri", "Hediye",
    "Kişiye Özel", "Hediye Setleri", "El Yapımı Hediye", "Orkide", "Geçmiş Olsun",
]
# End of fixed values.

def extract_json_ld(pages: DataFrame) -> DataFrame:
    """Structured-data blocks of each page, in order; text that is no JSON is dropped."""
    blocks = F.regexp_extract_all("html", F.lit(LD_JSON), F.lit(1))
    # The outer form: a plain explode would repeat the extraction in a pushed-down filter.
    found = pages.select("page_id", "url", F.posexplode_outer(blocks).alias("block_no", "raw"))
    trimmed = found.withColumn("json", F.regexp_replace("raw", r"^\s+|\s+$", ""))
    return trimmed.filter(F.try_parse_json("json").isNotNull()).select("page_id", "url", "block_no", "json")


def match_sites(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """Pages with the site they belong to, by host. The site list is configuration of a
    few entries; Spark broadcasts it by its size."""
    hosts = sites.select(
        F.col("id").alias("site_id"), F.col("name").alias("site_name"), F.col("url").alias("site_url"),
        "selectors", url_host(F.col("url")).alias("host"))
    return pages.withColumn("host", url_host(F.col("url"))).join(hosts, "host").drop("host")


SELECTORS = ["product_box", "product_name", "product_price"]


def inner_or_rest(element: Column) -> Column:
    """Content of an element; of one that is never closed all that follows."""
    return F.coalesce(inner(element), F.regexp_replace(element, "^<[^>]*>", ""))


def extract_products(pages: DataFrame, sites: DataFrame, price_rule: str = "last", scraped_at: Column | None = None,
                     tasks: int | None = None) -> DataFrame:
    """Product rows of the cards on each page. Pages read from files are split already; ``tasks``
    spreads pages that come out of a shuffle, which AQE would merge by size. They are spread once they
    have their site, since that join can be one more shuffle.

    Box, name and price selectors are lists; the first one that matches is used. Cards
    without a name or a positive price are dropped. The distinct selectors of the site list,
    which is configuration, are read when the plan is made and become patterns in it.
    """
    forms = [r.asDict() for r in sites.select(*[F.col(f"selectors.{c}").alias(c) for c in SELECTORS]).distinct().collect()]

    def by_form(find: Callable[[str], Column], column: str) -> Column:
        """What a site's own selector finds."""
        out = F.lit(None)
        for form in {f[column] or "" for f in forms}:
            out = F.when(F.coalesce(F.col(column), F.lit("")) == form, find(form)).otherwise(out)
        return out

    matched = match_sites(pages, sites)
    matched = (matched.repartition(tasks, "page_id") if tasks else matched).select(
        "page_id", "site_id", "site_name", "site_url", *[F.col(f"selectors.{c}").alias(c) for c in SELECTORS],
        visible(F.coalesce("html", F.lit(""))).alias("html"))
    # Outer forms, here and below: through a plain explode, and through no explode at all, the last
    # filter would be pushed down together with all that it is computed from.
    boxes = matched.select(*[c for c in matched.columns if c != "html"], F.posexplode_outer(
        by_form(lambda s: find_all(F.col("html"), s), "product_box")).alias("card_no", "box")).filter(F.col("box").isNotNull())
    first = lambda column: by_form(lambda s: find_first(F.col("box.content"), s), column)
    found = boxes.select("page_id", "site_id", "site_name", "site_url", "card_no", first("product_name").alias("name"),
                         first("product_price").alias("price"),
                         F.coalesce(find_first(F.col("box.content"), "a[href]"), F.col("box.tag")).alias("link"))
    text = lambda element: F.coalesce(text_of(inner_or_rest(element)), F.lit(""))
    fields = F.struct(text(F.col("name")).alias("name"), text(F.col("price")).alias("price_text"),
                      attribute(F.col("link"), "href").alias("href"))
    read = found.select("page_id", "site_id", "site_name", "site_url", "card_no", F.explode_outer(F.array(fields)).alias("c"))
    url = absolute_url(F.col("c.href"), F.col("site_url"))
    stamp = F.current_timestamp() if scraped_at is None else scraped_at
    rows = read.select(
        "page_id", "site_id", "site_name", "card_no",
        product_id_from_url(url, F.col("site_id"), F.col("card_no")).alias("product_id"),
        F.col("c.name").alias("product_name"), parse_price(F.col("c.price_text"), price_rule).alias("price"),
        url.alias("url"), stamp.alias("timestamp"),
    ).filter(valid_product("price", "product_name"))
    return rows.withColumn("category", detect_category(F.col("product_name")))


def _plain(html: Column) -> Column:
    """Text of a short piece of markup: tags dropped, the common entities decoded."""
    text = F.regexp_replace(html, r"(?s)<[^>]*>", "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def discover_categories(pages: DataFrame, keywords: list[str] = DISCOVERY_KEYWORDS,
                        priority: list[str] = DISCOVERY_PRIORITY, only: str | None = None,
                        configured: list[tuple[str, str]] = ()) -> DataFrame:
    """Category links of each page: anchors naming a keyword, first per URL, then the first
    anchor per priority name; when no priority name matches, the ``configured`` (name, link)
    pairs and then all of the anchors.

    Works on arrays inside each page's row, so there is no shuffle. ``only`` restricts the
    result to one category.
    """
    base = url_base(F.col("url"))
    strip = lambda html: F.regexp_replace(_plain(html), r"^\s+|\s+$", "")
    # One pass over the page finds the anchors; their parts are read from the short texts.
    anchors = F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(0))
    links = F.transform(anchors, lambda a: F.struct(
        F.regexp_extract(a, ANCHOR, 1).alias("href"), F.regexp_extract(a, ANCHOR, 2).alias("inner")))
    own = lambda a: a["href"].startswith("/") | a["href"].startswith(F.col("base"))
    named = F.transform(F.filter("links", own), lambda a: F.struct(
        strip(a["inner"]).alias("name"), absolute_url(a["href"], F.col("base")).alias("link")))
    wanted = lambda a: F.exists(F.array(*[F.lit(k.lower()) for k in keywords]), lambda k: F.lower(a["name"]).contains(k))
    rows = pages.select("page_id", base.alias("base"), links.alias("links"))
    rows = rows.select("page_id", "base", F.filter(named, wanted).alias("hits"))
    # First anchor per URL: array_distinct keeps the first occurrence.
    rows = rows.select("page_id", F.transform(
        F.array_distinct(F.col("hits.link")),
        lambda u: F.element_at("hits", F.array_position(F.col("hits.link"), u).cast("int"))).alias("cats"))
    best = F.filter(
        F.transform(F.array(*[F.lit(p.lower()) for p in priority]), lambda p: F.try_element_at(
            F.filter("cats", lambda c: F.lower(c["name"]).contains(p)), F.lit(1))),
        lambda c: c.isNotNull())
    given = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(link).alias("link")) for name, link in configured])
    spare = F.concat(given, F.col("cats")) if configured else F.col("cats")
    chosen = rows.select("page_id", F.when(F.size(best) > 0, best).otherwise(spare).alias("picked"))
    # The outer form: a plain explode would repeat all of the above in a pushed-down filter.
    rows = chosen.select("page_id", F.posexplode_outer("picked").alias("rank", "c")).filter(F.col("c").isNotNull())
    out = rows.select("page_id", "rank", F.col("c.name").alias("category"), F.col("c.link").alias("url"))
    return out.filter(F.col("category") == only) if only else out
