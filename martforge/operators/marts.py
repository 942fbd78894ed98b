"""Star joins and mart aggregates.

Plan notes (checked with ``explain``):

* no join is hinted: dimensions are tables whose file sizes the planner knows,
  so small ones are broadcast and larger ones joined by sort-merge, with AQE
  splitting skewed partitions;
* the product is joined once: where the fact already carries its names (the
  cost lookup can bring them), no product dimension is passed;
* the summary's rows are shuffled once, on the group keys, as they are: the
  distinct orders and the sums of a group (one product in one channel on one
  day) are then aggregated in place, where ``count(DISTINCT)`` alone would
  shuffle wide partial rows twice; from a written fact they are dealt by ranges
  of the names, with the measures packed, which takes two thirds of the bytes;
* money sums are exact decimals, converted to double only on output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import date_key, surrogate_key
from ..functions.packing import Words, pack, unpack


def star_join(fact: DataFrame, dim_channel: DataFrame, dim_product: DataFrame | None = None,
              product_key: str = "product_id") -> DataFrame:
    """fact JOIN dim_product ON product key JOIN dim_channel ON channel_id (inner).

    Without ``dim_product`` the fact carries product_name and category.
    ``product_key`` may be a numeric source key both sides carry: it sorts
    on an 8-byte prefix, where text ids with a common prefix do not.
    """
    if dim_product is not None:
        fact = fact.join(dim_product.select(product_key, "product_name", "category"), product_key, "inner")
    return fact.join(dim_channel.select("channel_id", "channel_name"), "channel_id", "inner")


def star_join_date(fact: DataFrame, dim_channel: DataFrame, dim_product: DataFrame | None,
                   dim_date: DataFrame, product_key: str = "product_id") -> DataFrame:
    """Four-way star: + dim_date ON date_key."""
    days = dim_date.select("date_key", F.col("date").alias("calendar_date"))
    return star_join(fact, dim_channel, dim_product, product_key).join(days, "date_key", "inner")


def sales_summary(fact: DataFrame, dim_channel: DataFrame, dim_product: DataFrame | None = None,
                  product_key: str = "product_id", words: Words | None = None) -> DataFrame:
    """Flagship mart: channel x product name x category x day.

    ``words`` packs the rows for the shuffle, which then goes by ranges: ``fact`` is read twice, so it is a table.
    """
    by = ["channel_name", "product_name", "category", "sales_date"]
    j = star_join(fact, dim_channel, dim_product, product_key).select(
        "channel_name", "product_name", "category", F.to_date("transaction_time").alias("sales_date"),
        "quantity_sold", "net_amount", "profit_amount", "order_id")
    if words is None:
        j = j.repartition(*by)
    else:
        ranges = ["product_name", "category", "channel_name", "sales_date"]
        j = unpack(pack(j, words).repartitionByRange(*ranges), words, j)
    return (
        j.groupBy(*by)
        .agg(
            F.sum("quantity_sold").cast("bigint").alias("total_quantity"),
            F.sum("net_amount").cast("double").alias("total_revenue"),
            F.sum("profit_amount").cast("double").alias("total_profit"),
            F.countDistinct("order_id").cast("bigint").alias("order_count"),
        )
    )


def sales_summary_view(fact: DataFrame, dim_channel: DataFrame, dim_product: DataFrame | None,
                       dim_date: DataFrame, product_key: str = "product_id") -> DataFrame:
    """The view form: through the date dimension, no order count.

    The sales day is taken from the fact's transaction time (the calendar
    table has no transaction time of its own).
    """
    j = star_join_date(fact, dim_channel, dim_product, dim_date, product_key)
    return (
        j.groupBy("channel_name", "product_name", "category",
                  F.to_date("transaction_time").alias("sales_date"))
        .agg(
            F.sum("quantity_sold").cast("bigint").alias("total_quantity"),
            F.sum("net_amount").cast("double").alias("total_revenue"),
            F.sum("profit_amount").cast("double").alias("total_profit"),
        )
    )


def daily_channel_product(fact: DataFrame, qty: str = "quantity", amount: str = "total_amount",
                          ts: str = "order_date", keep=()) -> DataFrame:
    """Channel x product x day totals straight from a curated fact (no dims).

    ``keep`` names further columns, each fixed by the day.
    """
    return (
        fact.groupBy("channel", "product_id", F.to_date(ts).alias("sales_date"), *keep)
        .agg(
            F.sum(qty).cast("bigint").alias("total_quantity"),
            F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias("total_revenue"),
            F.countDistinct("order_id").cast("bigint").alias("order_count"),
        )
    )


# Fixed opening stock of a product at a location before its first movement.
OPENING_STOCK = 1000


INVENTORY_KEYS = ("product_id", "location_id")


def inventory_daily(txn: DataFrame, keys=INVENTORY_KEYS) -> DataFrame:
    """Daily roll-up per (day, product, location) of typed movements.

    ``txn`` columns: the two ``keys`` (product, location), txn_time,
    movement ('received' | 'sold' | 'adjusted'), quantity. Partial
    aggregate, so a hot product is combined map-side before the shuffle.
    """
    q = F.col("quantity")
    m = F.col("movement")
    return (
        txn.groupBy(F.to_date("txn_time").alias("inventory_date"), *keys)
        .agg(
            F.sum(F.when(m == "received", q).otherwise(F.lit(0))).cast("bigint").alias("quantity_received"),
            F.sum(F.when(m == "sold", q).otherwise(F.lit(0))).cast("bigint").alias("quantity_sold"),
            F.sum(F.when(m == "adjusted", q).otherwise(F.lit(0))).cast("bigint").alias("quantity_adjusted"),
        )
    )


def roll_forward(daily: DataFrame, opening: int = OPENING_STOCK, keys=INVENTORY_KEYS) -> DataFrame:
    """closing = opening + received - sold + adjusted; opening = previous closing.

    A running sum per (product, location) ordered by day. The window sees one
    row per calendar day of that pair (the input is already at day grain), so
    its size is bounded by the calendar, not by the data volume.
    """
    w = (Window.partitionBy(*keys).orderBy("inventory_date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    net = F.col("quantity_received") - F.col("quantity_sold") + F.col("quantity_adjusted")
    return (
        daily.withColumn("_net", net)
        .withColumn("closing_stock", (F.lit(opening) + F.sum("_net").over(w)).cast("bigint"))
        .withColumn("opening_stock", (F.col("closing_stock") - F.col("_net")).cast("bigint"))
        .drop("_net")
    )


def fact_inventory(txn: DataFrame, products: DataFrame, opening: int = OPENING_STOCK,
                   keys=INVENTORY_KEYS, ids: dict | None = None) -> DataFrame:
    """Core inventory fact: daily roll-up, roll-forward, stock value at unit cost.

    ``keys``: the product and location key columns of ``txn`` (``products``
    carries the same product key). Numeric source keys keep the roll-up's
    shuffle and the window's sort on 8-byte prefixes; ``ids`` then gives the
    columns that turn them into the output ids ``product_id`` and
    ``location_id`` (by default the keys are the ids).
    """
    product_key = keys[0]
    rolled = roll_forward(inventory_daily(txn, keys), opening, keys)
    cost = products.select(product_key, "cost_price")
    j = rolled.join(cost, product_key, "left")
    if ids:
        j = j.withColumns(ids)
    return j.select(
        surrogate_key("product_id", "location_id", "inventory_date").alias("inventory_id"),
        date_key("inventory_date").alias("date_key"),
        "product_id",
        "location_id",
        "opening_stock",
        "closing_stock",
        "quantity_received",
        "quantity_sold",
        "quantity_adjusted",
        (F.col("closing_stock") * F.col("cost_price")).cast("double").alias("stock_value"),
    )
