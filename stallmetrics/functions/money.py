"""Price texts: parsing and display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEADING_NUMBER = r"^(\d+\.?\d*|\.\d+)"


def _comma_decimal(text: Column) -> Column:
    """Number written with a decimal comma: the first comma is the decimal point and
    reading stops at the next character that is not part of the number; else 0."""
    dotted = F.regexp_replace(text, r"^([^,]*),", "$1.")
    number = F.regexp_extract(dotted, LEADING_NUMBER, 1)
    return F.coalesce(number.try_cast("double"), F.lit(0.0))


def parse_price(col: Column, which: str = "last") -> Column:
    """Price in a text with thousands dots and a decimal comma.

    ``last`` takes the last number (the discounted price comes last), ``first`` the
    first one, ``strip`` reads all digits and commas of the text as one number.
    """
    if which == "last":
        token = F.try_element_at(F.regexp_extract_all(col, F.lit(r"[\d.,]+"), F.lit(0)), F.lit(-1))
    elif which == "first":
        token = F.regexp_extract(col, r"[0-9.,]+", 0)
    elif which == "strip":
        token = F.regexp_replace(col, r"[^0-9,]", "")
    else:
        raise ValueError(f"which must be last, first or strip, not {which!r}")
    return _comma_decimal(F.replace(token, F.lit("."), F.lit("")))


def format_money(col: Column, style: str = "prefix") -> Column:
    """Two decimals with thousands commas; ``prefix`` leaves missing amounts empty,
    ``suffix`` shows them as N/A."""
    text = F.format_number(col, 2)
    if style == "prefix":
        return F.coalesce(F.concat(F.lit("₺"), text), F.lit(""))
    if style == "suffix":
        return F.coalesce(F.concat(text, F.lit("₺")), F.lit("N/A"))
    raise ValueError(f"style must be prefix or suffix, not {style!r}")


def parse_money(col: Column) -> Column:
    """Number behind a displayed amount; null when there is none."""
    return F.regexp_replace(col, "[₺,]", "").try_cast("double")


def exact_sum(col: Column) -> Column:
    """Order-independent sum of prices, as double."""
    return F.sum(col.cast("decimal(18,4)")).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, null when den is 0 or null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def exact_mean(total: Column, n: Column) -> Column:
    """Mean to two decimals, rounded half up on the exact quotient; null when n is 0."""
    quotient = F.try_divide(total.cast("decimal(28,4)"), n.cast("decimal(12,0)"))
    return F.round(quotient, 2).cast("double")
