"""Row identity: business key and whole-row digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields that identify one order item. Codes, amounts, status,
# delivery dates and timestamps change after the fact and are left out.
BUSINESS_KEY = [
    "order_id",
    "product_code_1",
    "user_id",
    "city",
    "district",
    "neighborhood",
    "delivery_location_type",
    "vendor_id",
    "rider_id",
    "additional_products",
    "product_name",
    "order_created_date_tr",
]
# End of fixed values.


ROW_DIGEST = ["digest_1", "digest_2"]
ROW_KEY = ["row_key_1", "row_key_2"]


def digest(terms: list[str], names: list[str]) -> list[Column]:
    """128 bits over the given SQL terms, as two long columns: the row hash under two seeds.

    64 bits would collide at 10^12 rows. The hash skips nulls, so the null flags are
    hashed along as bit masks; otherwise (null, 'a') and ('a', null) would look alike. It
    runs inside generated code, and longs sort and shuffle far cheaper than a text digest over JSON.
    """
    flags = [f"IF(isnull({t}), {1 << i % 60}L, 0L)" for i, t in enumerate(terms)]
    masks = [" + ".join(flags[at:at + 60]) for at in range(0, len(flags), 60)]
    values = ", ".join([*terms, *masks])
    return [F.expr(f"xxhash64({seed}, {values})").alias(name) for seed, name in enumerate(names)]


def business_key(df: DataFrame) -> list[Column]:
    """Digest over the business-key fields as text; an absent column counts as null."""
    return digest([f"CAST({f'`{n}`' if n in df.columns else 'NULL'} AS STRING)" for n in BUSINESS_KEY], ROW_KEY)


def row_digest(df: DataFrame) -> list[Column]:
    """Digest of the whole row."""
    return digest([f"`{c}`" for c in df.columns], ROW_DIGEST)


def row_json(df: DataFrame, *skip: str) -> Column:
    """Whole row as JSON text, nulls kept so that null and absent never look alike."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns if c not in skip]), {"ignoreNullFields": "false"})
