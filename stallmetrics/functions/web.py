"""URL and product-id expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def absolute_url(href: Column, base: Column) -> Column:
    """Link made absolute against the site's base; no link gives an empty text."""
    slash = F.when(href.startswith("/"), F.lit("")).otherwise(F.lit("/"))
    return (
        F.when(href.isNull() | (href == ""), F.lit(""))
        .when(href.startswith("http"), href)
        .otherwise(F.concat(base, slash, href))
    )


def url_base(url: Column) -> Column:
    """Scheme and host of a URL."""
    return F.regexp_extract(url, r"^([a-zA-Z]+://[^/?#]+)", 1)


def url_host(url: Column) -> Column:
    """Host of a URL without a leading ``www.``."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#:]+)", 1)), r"^www\.", "")


def product_id_from_url(url: Column, site_id: Column, index: Column) -> Column:
    """``site_`` + last path part with odd characters as underscores; else ``site_`` + index."""
    last = F.try_element_at(F.filter(F.split(url, "/"), lambda p: p != ""), F.lit(-1))
    tail = F.coalesce(F.regexp_replace(last, "[^a-zA-Z0-9-]", "_"), index.cast("string"))
    return F.concat(site_id, F.lit("_"), tail)


def product_id_from_href(href: Column, index: Column, prefix: str = "product") -> Column:
    """Text behind the last dash of the link; else ``prefix_`` + index."""
    tail = F.substring_index(href, "-", -1)
    return F.when(tail != "", tail).otherwise(F.concat(F.lit(f"{prefix}_"), index.cast("string")))
