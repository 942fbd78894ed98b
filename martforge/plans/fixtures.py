"""Deterministic dirt and change sets derived from the input tables.

The input tables are clean (no nulls, no orphan keys), so the operators that
reject, quarantine or detect change get their cases injected here by fixed
key rules. Every row of the input is kept; the rules only alter values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import format_id, money
from . import model
from ..sources.tables import Tables

# Fixed dirt rules (modulus on the numeric business key).
ORDER_NULL_MOD = 97
PRODUCT_NULL_MOD = 89
QTY_NEGATE_MOD = 83
QTY_NULL_MOD = 79
ORPHAN_MOD = 71
ORPHAN_SHIFT = 1_000_000

# Fixed SCD-2 change set: every part is in the batch; price change, re-keyed
# (new) products.
CHANGE_MOD = 10
NEW_MOD = 50
NEW_SHIFT = 1_000_000
DIM_V1_TS = "2024-01-01 00:00:00"


def _num(col: str, skip: int):
    return F.expr(f"cast(substr({col}, {skip}) as bigint)")


def dirty_sales(t: Tables, sold: DataFrame | None = None) -> DataFrame:
    raw = model.raw_sales(t, sold)
    okey = _num("order_id", 5)
    pkey = _num("product_id", 6)
    return raw.select(
        F.when(okey % ORDER_NULL_MOD == 0, F.lit(None).cast("string")).otherwise(F.col("order_id")).alias("order_id"),
        "line_no",
        F.when(pkey % PRODUCT_NULL_MOD == 0, F.lit(None).cast("string")).otherwise(F.col("product_id")).alias("product_id"),
        "customer_id", "channel", "region",
        F.when(okey % QTY_NEGATE_MOD == 0, -F.col("quantity"))
        .when(okey % QTY_NULL_MOD == 0, F.lit(None).cast("bigint"))
        .otherwise(F.col("quantity")).alias("quantity"),
        "unit_price", "total_amount", "order_date", "transaction_time",
    )


def sales_with_orphans(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    pk = F.when(F.col("l_orderkey") % ORPHAN_MOD == 0, F.col("l_partkey") + ORPHAN_SHIFT).otherwise(F.col("l_partkey"))
    return li.select(
        format_id(*model.ORDER_FMT, "l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        format_id(*model.PRODUCT_FMT, pk).alias("product_id"),
    )


def product_source(t: Tables) -> DataFrame:
    """Products as the source system delivers them (curated attribute names)."""
    return t.part.select(
        format_id(*model.PRODUCT_FMT, "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        money("p_retailprice", 10, 2).alias("unit_cost"),
    )


def incoming_products(t: Tables) -> DataFrame:
    """Batch of product records: the whole part table, as a daily full
    extract delivers it. A tenth of the parts arrive with a new cost; a
    fiftieth arrive under a new id (new products), so their old ids are
    absent from the batch and must stay current."""
    key = F.col("p_partkey")
    rekey = key % NEW_MOD == 0
    return t.part.select(
        format_id(*model.PRODUCT_FMT, F.when(rekey, key + NEW_SHIFT).otherwise(key)).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        (money("p_retailprice", 10, 2)
         + F.when(key % CHANGE_MOD == 0, F.lit(1)).otherwise(F.lit(0))
         ).cast("decimal(10,2)").alias("unit_cost"),
    )


def product_supplier_changes(t: Tables) -> DataFrame:
    """Tracked attribute log: (product, ship time) -> supplier, keyed by the
    numeric product source key."""
    li = t.lineitem
    return li.select(
        F.col("l_partkey").alias(model.PRODUCT_JOIN_KEY),
        F.col("l_shipdate").alias("change_time"),
        format_id(*model.LOCATION_FMT, "l_suppkey").alias("supplier_id"),
    )


# Fixed hot key: a third of the orders' lines go to one product.
HOT_MOD = 3
HOT_PRODUCT = 1


def _hot_product(order: str, part: str):
    return F.when(F.col(order) % HOT_MOD == 0, F.lit(HOT_PRODUCT)).otherwise(F.col(part)).cast("bigint").alias(
        model.PRODUCT_JOIN_KEY)


def fine_supplier_changes(t: Tables) -> DataFrame:
    """``product_supplier_changes`` to the second, with the hot product."""
    return t.lineitem.select(
        _hot_product("l_orderkey", "l_partkey"),
        F.expr("l_shipdate + make_dt_interval(0, 0, 0, (l_orderkey * 7919 + l_linenumber * 613) % 86400)")
        .alias("change_time"),
        format_id(*model.LOCATION_FMT, "l_suppkey").alias("supplier_id"),
    )


def fine_sales(t: Tables) -> DataFrame:
    """Order lines sold 90 days after their order date, to the second, with the hot product."""
    li = t.lineitem.select("l_orderkey", F.col("l_linenumber").alias("line_no"), "l_partkey")
    o = t.orders.select("o_orderkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "line_no", _hot_product("l_orderkey", "l_partkey"),
        F.expr("o_orderdate + make_dt_interval(90, 0, 0, l_orderkey * 31 % 86400)").alias("sold_at"))


def inventory_transactions(t: Tables) -> DataFrame:
    """Stock movements: returned lines are receipts, the rest are sales.
    Keyed by the numeric source keys of product and location."""
    li = t.lineitem
    return li.select(
        F.col("l_partkey").alias(model.PRODUCT_JOIN_KEY),
        F.col("l_suppkey").alias(LOCATION_SOURCE_KEY),
        F.col("l_shipdate").alias("txn_time"),
        F.when(F.col("l_returnflag") == "R", F.lit("received")).otherwise(F.lit("sold")).alias("movement"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )


LOCATION_SOURCE_KEY = "location_source_key"
INVENTORY_KEYS = (model.PRODUCT_JOIN_KEY, LOCATION_SOURCE_KEY)


def inventory_ids() -> dict:
    """Output ids of the inventory fact from its numeric keys."""
    return {
        "product_id": format_id(*model.PRODUCT_FMT, model.PRODUCT_JOIN_KEY),
        "location_id": format_id(*model.LOCATION_FMT, LOCATION_SOURCE_KEY),
    }
