"""Declared schemas; nothing in the library infers one."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(18, 2)

# Column names and types of the published tables and files.
PARTITION_COLUMN = "order_created_date_tr"

ORDER_ITEMS = StructType([
    StructField("order_id", LongType()),
    StructField("order_code", StringType()),
    StructField("product_code_1", StringType()),
    StructField("product_name", StringType()),
    StructField("product_category", IntegerType()),
    StructField("user_id", StringType()),
    StructField("city", StringType()),
    StructField("district", StringType()),
    StructField("neighborhood", StringType()),
    StructField("delivery_location_type", StringType()),
    StructField("vendor_id", LongType()),
    StructField("rider_id", LongType()),
    StructField("additional_products", StringType()),
    StructField("payment_method", StringType()),
    StructField("delivery_status", StringType()),
    StructField("order_amount", MONEY),
    StructField("order_created_date_tr", DateType()),
    StructField("order_delivery_date", DateType()),
    StructField("requested_delivery_date", DateType()),
    StructField("order_creation_timestamp", TimestampType()),
])

# The payload carries dates as text, the extra products as a list, and up to
# three more candidate time fields.
ORDER_PAYLOAD = StructType(
    [
        StructField(f.name, ArrayType(StringType()) if f.name == "additional_products"
                    else StringType() if isinstance(f.dataType, (DateType, TimestampType))
                    else f.dataType)
        for f in ORDER_ITEMS.fields if f.name != PARTITION_COLUMN
    ]
    + [
        StructField("order_created_date", StringType()),
        StructField("created_at", StringType()),
        StructField("timestamp", StringType()),
        StructField("date", StringType()),
    ]
)

FETCH_WATERMARK = StructType([
    StructField("fetch_date", DateType()),
    StructField("last_fetch_timestamp", TimestampType()),
    StructField("updated_at", TimestampType()),
])

_SNAPSHOT_PRODUCT = StructType([
    StructField("name", StringType()),
    StructField("price", DoubleType()),
    StructField("url", StringType()),
    StructField("category", StringType()),
    StructField("timestamp", TimestampType()),
])

SNAPSHOT_DOCUMENT = StructType([
    StructField("last_update", TimestampType()),
    StructField("product_type", StringType()),
    StructField("sites", MapType(StringType(), StructType([
        StructField("name", StringType()),
        StructField("products", MapType(StringType(), _SNAPSHOT_PRODUCT)),
        StructField("scraped_at", TimestampType()),
    ]))),
])

FLAT_SNAPSHOT_MAP = "map<string, struct<name: string, price: double, url: string, timestamp: timestamp>>"

PRODUCT_ROWS = StructType([
    StructField("site_id", StringType()),
    StructField("site_name", StringType()),
    StructField("product_id", StringType()),
    StructField("product_name", StringType()),
    StructField("price", DoubleType()),
    StructField("url", StringType()),
    StructField("category", StringType()),
    StructField("timestamp", TimestampType()),
])

SCRAPE_RESULT = StructType([
    StructField("scrape_date", TimestampType()),
    StructField("total_sites", IntegerType()),
    StructField("successful_sites", IntegerType()),
    StructField("total_products", IntegerType()),
    StructField("sites", ArrayType(StructType([
        StructField("site_id", StringType()),
        StructField("site_name", StringType()),
        StructField("success", BooleanType()),
        StructField("error", StringType()),
        StructField("scraped_at", TimestampType()),
        StructField("products", ArrayType(StructType([
            StructField("id", StringType()),
            StructField("name", StringType()),
            StructField("price", DoubleType()),
            StructField("url", StringType()),
            StructField("category", StringType()),
            StructField("timestamp", TimestampType()),
        ]))),
    ]))),
])

BENCHMARK_REPORT = StructType([
    StructField("date", TimestampType()),
    StructField("price_analysis", StructType([
        StructField("by_site", MapType(StringType(), StructType([
            StructField("product_count", LongType()),
            StructField("avg_price", StringType()),
            StructField("min_price", StringType()),
            StructField("max_price", StringType()),
        ]))),
    ])),
])

SITES_CONFIG = StructType([
    StructField("sites", ArrayType(StructType([
        StructField("id", StringType()),
        StructField("name", StringType()),
        StructField("url", StringType()),
        StructField("category_url", StringType()),
        StructField("enabled", BooleanType()),
        StructField("selectors", StructType([
            StructField("product_box", StringType()),
            StructField("product_name", StringType()),
            StructField("product_price", StringType()),
            StructField("product_link", StringType()),
        ])),
        StructField("pagination", StructType([
            StructField("enabled", BooleanType()),
            StructField("max_pages", IntegerType()),
            StructField("url_pattern", StringType()),
        ])),
    ]))),
])

PAGES = StructType([
    StructField("page_id", LongType()),
    StructField("url", StringType()),
    StructField("html", StringType()),
])

PRODUCTS = StructType([
    StructField("product_id", StringType(), False),
    StructField("site_id", StringType(), False),
    StructField("site_name", StringType(), False),
    StructField("product_name", StringType(), False),
    StructField("category", StringType()),
    StructField("url", StringType()),
    StructField("first_seen", TimestampType(), False),
    StructField("last_seen", TimestampType(), False),
])

PRICE_HISTORY = StructType([
    StructField("product_id", StringType(), False),
    StructField("site_id", StringType(), False),
    StructField("price", DoubleType(), False),
    StructField("timestamp", TimestampType(), False),
    StructField("date", DateType(), False),
])

BENCHMARKS = StructType([
    StructField("date", DateType(), False),
    StructField("timestamp", TimestampType(), False),
    StructField("site_id", StringType(), False),
    StructField("site_name", StringType(), False),
    StructField("product_count", LongType(), False),
    StructField("avg_price", DoubleType(), False),
    StructField("min_price", DoubleType(), False),
    StructField("max_price", DoubleType(), False),
])
# End of fixed values.
