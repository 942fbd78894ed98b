"""Declared schemas (explicit StructTypes; no inference anywhere)."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DecimalType, DoubleType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Raw sales extract (CSV): the 8 delivered columns + total_amount.
RAW_SALES_CSV = _s(
    ("order_id", StringType()), ("product_id", StringType()), ("customer_id", StringType()),
    ("channel", StringType()), ("quantity", LongType()), ("unit_price", DoubleType()),
    ("order_date", TimestampNTZType()), ("region", StringType()), ("total_amount", DoubleType()),
)

# The same by order line, for extracts and feeds that carry the line number.
SALES_LINES_CSV = StructType([RAW_SALES_CSV[0], StructField("line_no", LongType(), True), *RAW_SALES_CSV[1:].fields])

# Raw products extract (CSV).
RAW_PRODUCTS_CSV = _s(
    ("product_id", StringType()), ("product_name", StringType()), ("category", StringType()),
    ("brand", StringType()), ("unit_cost", DecimalType(10, 2)), ("created_date", TimestampNTZType()),
    ("is_active", BooleanType()),
)

# Curated product dimension (type 2).
DIM_PRODUCT = _s(
    ("product_key", StringType()), ("product_id", StringType()), ("product_name", StringType()),
    ("category", StringType()), ("brand", StringType()), ("unit_cost", DecimalType(10, 2)),
    ("effective_date", TimestampNTZType()), ("end_date", TimestampNTZType()), ("is_current", BooleanType()),
    ("record_hash", StringType()), ("created_date", TimestampNTZType()), ("updated_date", TimestampNTZType()),
    ("batch_id", StringType()),
)

# Landed feeds: declared schema + business key (the source systems' clients
# are not part of this engine; files land in a folder per feed).
FEEDS: dict[str, tuple[StructType, list[str]]] = {
    "fba_listing_report": (_s(("sku", StringType()), ("asin", StringType()), ("product_id", StringType()),
                              ("price", DecimalType(10, 2)), ("quantity", LongType()),
                              ("listed_at", TimestampNTZType())), ["sku"]),
    "fba_inventory_transactions": (_s(("transaction_id", StringType()), ("sku", StringType()),
                                      ("fulfillment_center", StringType()), ("movement", StringType()),
                                      ("quantity", LongType()), ("txn_time", TimestampNTZType())),
                                   ["transaction_id"]),
    "erp_sales_orders": (SALES_LINES_CSV, ["order_id", "line_no"]),
    "erp_inventory_transactions": (_s(("transaction_id", StringType()), ("product_id", StringType()),
                                      ("location_id", StringType()), ("movement", StringType()),
                                      ("quantity", LongType()), ("txn_time", TimestampNTZType())),
                                   ["transaction_id"]),
    "erp_customers": (_s(("customer_id", StringType()), ("name", StringType()), ("email", StringType()),
                         ("country", StringType()), ("created_date", TimestampNTZType())), ["customer_id"]),
    "erp_products": (RAW_PRODUCTS_CSV, ["product_id"]),
}
