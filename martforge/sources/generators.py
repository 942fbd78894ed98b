"""Sample sales/product generators (S14), reproducible and distributed.

Ids come from an index column (``spark.range`` or a key of an input table);
the random measures of the source generators are replaced by values derived
from ``xxhash64`` of the index, so re-runs agree and no data passes through
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import format_id, hourly

# Fixed values of the source generators.
CHANNELS = ("Amazon_FBA", "Shopify_DTC", "Retail", "Wholesale")
REGIONS = ("North", "South", "East", "West")
CATEGORIES = ("Electronics", "Clothing", "Home", "Sports")
BRANDS = ("BrandA", "BrandB", "BrandC")
BASE_TS = "2024-01-01 00:00:00"
N_PRODUCTS = 100
N_CUSTOMERS = 500


def _pick(values, seed_col, salt: int):
    idx = F.pmod(F.xxhash64(seed_col, F.lit(salt)), F.lit(len(values))) + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int"))


def _uniform(seed_col, salt: int, lo: float, hi: float):
    """Deterministic value in [lo, hi) with 2 decimals."""
    u = F.pmod(F.xxhash64(seed_col, F.lit(salt)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    return (F.lit(lo) + u * F.lit(hi - lo)).cast("decimal(10,2)")


def sales_backbone(ids: DataFrame, idx: str) -> DataFrame:
    """ids, customer and hourly order time from an index column."""
    i = F.col(idx)
    return ids.select(
        format_id("ORD", 8, i).alias("order_id"),
        format_id("PROD", 5, F.pmod(i, F.lit(N_PRODUCTS)) + 1).alias("product_id"),
        format_id("CUST", 5, F.pmod(i, F.lit(N_CUSTOMERS))).alias("customer_id"),
        hourly(BASE_TS, i).alias("order_date"),
        i.alias("_i"),
    )


def gen_sales(spark: SparkSession, n: int) -> DataFrame:
    b = sales_backbone(spark.range(n), "id")
    i = F.col("_i")
    out = b.withColumns({
        "channel": _pick(CHANNELS, i, 1),
        "quantity": (F.pmod(F.xxhash64(i, F.lit(2)), F.lit(9)) + 1).cast("bigint"),
        "unit_price": _uniform(i, 3, 15.0, 150.0),
        "region": _pick(REGIONS, i, 4),
    })
    out = out.withColumn("total_amount", (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)"))
    return out.select("order_id", "product_id", "customer_id", "channel", "quantity", "unit_price",
                      "order_date", "region", "total_amount")


def gen_products(spark: SparkSession, n: int = N_PRODUCTS) -> DataFrame:
    i = F.col("id") + 1
    return spark.range(n).select(
        format_id("PROD", 5, i).alias("product_id"),
        F.concat(F.lit("Product "), i.cast("string")).alias("product_name"),
        _pick(CATEGORIES, i, 5).alias("category"),
        _pick(BRANDS, i, 6).alias("brand"),
        _uniform(i, 7, 10.0, 100.0).alias("unit_cost"),
        hourly(BASE_TS, F.lit(0)).alias("created_date"),
        F.lit(True).alias("is_active"),
    )
