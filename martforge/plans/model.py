"""The retail star model derived from the input tables.

Mapping (one sale line per lineitem):

* order header = orders joined to customer *before* lineitem, so the large
  line table is shuffled once on the order key instead of twice;
* channel = customer market segment, location = supplier, region = customer
  region, product = part;
* money is exact decimal from the first step (``total_amount`` decimal(12,2),
  discount rate decimal(4,2), unit cost decimal(10,2)); only the final
  outputs are converted.

Every builder is DataFrame -> DataFrame and lazy; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_key, format_id, money, surrogate_key, ts_literal
from ..functions.packing import DAYS, HUNDREDTHS, WHOLE, Field, Form, pack, units, unpack
from ..sources.tables import Tables

# Numeric source key of a product (the part key) that the product dimension
# and the sales fact both carry: the fact's product joins run on it.
PRODUCT_JOIN_KEY = "product_source_key"

# Fixed id formats of the model (prefix, zero-pad width).
ORDER_FMT = ("ORD", 8)
PRODUCT_FMT = ("PROD", 5)
CUSTOMER_FMT = ("CUST", 5)
LOCATION_FMT = ("LOC", 5)

# Words in which rows cross the shuffles of a layered load: a line on its way
# to its order, an order header to its lines, a line to its product and a line
# of the fact to its group of the summary.
LINE_WORDS = {
    "line_a": {"l_partkey": Field(WHOLE, 32), "l_extendedprice": Field(HUNDREDTHS, 32)},
    "line_b": {"l_suppkey": Field(WHOLE, 24), "l_quantity": Field(WHOLE, 12), "l_discount": Field(HUNDREDTHS, 8),
               "l_shipdate": Field(DAYS, 16), "l_linenumber": Field(WHOLE, 4)},
}
HEADER_WORDS = {"header": {"o_custkey": Field(WHOLE, 32), "o_orderdate": Field(DAYS, 16), "c_nationkey": Field(WHOLE, 16)}}
SALE_WORDS = {
    "sale_a": {"l_orderkey": Field(WHOLE, 40), "l_quantity": Field(WHOLE, 12), "l_discount": Field(HUNDREDTHS, 8),
               "l_linenumber": Field(WHOLE, 4)},
    "sale_b": {"o_custkey": Field(WHOLE, 32), "l_extendedprice": Field(HUNDREDTHS, 32)},
    "sale_c": {"l_suppkey": Field(WHOLE, 32), "l_shipdate": Field(DAYS, 16)},
}
ORDER_NUMBER = Form(lambda c: F.substring(c, len(ORDER_FMT[0]) + 2, 20).try_cast("bigint"),
                    lambda n, kind: format_id(*ORDER_FMT, n))
SUMMARY_WORDS = {
    "sum_a": {"order_id": Field(ORDER_NUMBER, 40), "quantity_sold": Field(WHOLE, 24)},
    "sum_b": {"net_amount": Field(units(4), 40)},
    "sum_c": {"profit_amount": Field(units(4), 44, signed=True)},
}


def channel_id(name) -> F.Column:
    """Channel surrogate: ``CH_`` + upper-cased name."""
    return F.concat(F.lit("CH_"), F.upper(name if not isinstance(name, str) else F.col(name)))


def order_headers(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = t.customer.select("c_custkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").drop("c_custkey")


def line_headers(t: Tables) -> DataFrame:
    """lineitem joined to its order header; keys still numeric."""
    li = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate",
    )
    h = order_headers(t)
    return li.join(h, li.l_orderkey == h.o_orderkey, "inner")


def sold_lines(t: Tables) -> DataFrame:
    """lineitem joined to its order header and the customer's nation key: the raw feed and the fact are made from it.

    The rows of ``line_headers`` with ``c_nationkey``; lines and headers cross the shuffle as words.
    """
    li = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate",
    )
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    h = o.join(c, o.o_custkey == c.c_custkey, "inner").drop("c_custkey")
    j = pack(li, LINE_WORDS).join(pack(h, HEADER_WORDS), F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    return unpack(unpack(j, LINE_WORDS, li), HEADER_WORDS, h).drop("o_orderkey")


def sales_lines(t: Tables) -> DataFrame:
    """Sale lines with business ids, exact money and times (no region)."""
    j = line_headers(t)
    return j.select(
        format_id(*ORDER_FMT, "l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        format_id(*PRODUCT_FMT, "l_partkey").alias("product_id"),
        format_id(*CUSTOMER_FMT, "o_custkey").alias("customer_id"),
        format_id(*LOCATION_FMT, "l_suppkey").alias("location_id"),
        F.col("c_mktsegment").alias("channel"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
        money("l_extendedprice", 12, 2).alias("total_amount"),
        money("l_discount", 4, 2).alias("discount_rate"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("transaction_time"),
    )


def customer_geo(t: Tables) -> DataFrame:
    """customer + nation + region (nation/region are tiny; AQE broadcasts them)."""
    return with_geo(t.customer, t)


def with_geo(c: DataFrame, t: Tables) -> DataFrame:
    """Rows with a customer's ``c_nationkey`` + nation + region."""
    n = t.nation
    r = t.region
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "inner")
        .join(r, n.n_regionkey == r.r_regionkey, "inner")
    )


def raw_sales(t: Tables, sold: DataFrame | None = None) -> DataFrame:
    """The raw sales feed: order, product, customer, channel, region, measures.

    ``sold``: the rows of ``sold_lines``, where they are joined already.
    """
    j = raw_lines(t) if sold is None else with_geo(sold, t)
    return j.select(
        format_id(*ORDER_FMT, "l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        format_id(*PRODUCT_FMT, "l_partkey").alias("product_id"),
        format_id(*CUSTOMER_FMT, "o_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("channel"),
        F.col("r_name").alias("region"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
        money("l_extendedprice", 12, 2).alias("total_amount"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("transaction_time"),
    )


def raw_lines(t: Tables) -> DataFrame:
    """lineitem joined to its order header and the customer's region."""
    li = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_shipdate",
    )
    geo = customer_geo(t).select("c_custkey", "c_mktsegment", "r_name")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    h = o.join(geo, o.o_custkey == geo.c_custkey, "inner")
    return li.join(h, li.l_orderkey == h.o_orderkey, "inner")


# --------------------------------------------------------------------------
# Dimensions
# --------------------------------------------------------------------------

def dim_product(t: Tables) -> DataFrame:
    """Core product dimension (current state; one row per product_id)."""
    p = t.part
    return p.select(
        format_id(*PRODUCT_FMT, "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        money("p_retailprice", 10, 2).alias("cost_price"),
        F.lit(True).alias("is_active"),
        F.col("p_partkey").alias(PRODUCT_JOIN_KEY),
    )


def dim_channel(t: Tables) -> DataFrame:
    """Distinct channels (partial aggregate before the shuffle)."""
    seg = t.customer.select(F.col("c_mktsegment").alias("channel_name")).distinct()
    return seg.select(
        channel_id(F.col("channel_name")).alias("channel_id"),
        "channel_name",
        F.lit("market_segment").alias("channel_type"),
    )


def dim_customer(t: Tables) -> DataFrame:
    g = customer_geo(t)
    return g.select(
        format_id(*CUSTOMER_FMT, "c_custkey").alias("customer_id"),
        F.col("c_custkey").cast("string").alias("customer_source_id"),
        channel_id(F.col("c_mktsegment")).alias("channel_id"),
        F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
    )


def dim_location(t: Tables) -> DataFrame:
    s = t.supplier
    n = t.nation
    j = s.join(n, s.s_nationkey == n.n_nationkey, "inner")
    return j.select(
        format_id(*LOCATION_FMT, "s_suppkey").alias("location_id"),
        F.col("s_name").alias("location_name"),
        F.lit("supplier_warehouse").alias("location_type"),
        F.col("n_name").alias("country"),
        F.lit(True).alias("is_active"),
    )


def dim_date(span: DataFrame) -> DataFrame:
    """Date dimension from a one-row (start_date, end_date) frame.

    The span is one row, read on the driver; the calendar is then a
    distributed ``range`` of day offsets from the start. Its size (end -
    start + 1 days) is known by arithmetic before any join decides to
    broadcast it, and the span's scan is not repeated by later uses.
    """
    spark = span.sparkSession
    row = span.first()
    if row is None or row["start_date"] is None:
        days = spark.range(0).select(F.lit(None).cast("date").alias("date"))
    else:
        n_days = (row["end_date"] - row["start_date"]).days + 1
        start = F.lit(row["start_date"].isoformat()).cast("date")
        days = spark.range(n_days).select(F.date_add(start, F.col("id").cast("int")).alias("date"))
    return days.select(
        date_key("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.dayofweek("date").alias("day_of_week"),
        F.col("date").cast("timestamp_ntz").alias("transaction_time"),
    )


def data_date_span(t: Tables) -> DataFrame:
    """(start_date, end_date) over order and ship dates: one partial aggregate."""
    d = t.orders.select(F.col("o_orderdate").alias("d")).unionByName(
        t.lineitem.select(F.col("l_shipdate").alias("d")))
    return d.agg(F.to_date(F.min("d")).alias("start_date"), F.to_date(F.max("d")).alias("end_date"))


# --------------------------------------------------------------------------
# Facts
# --------------------------------------------------------------------------

def with_margin(df: DataFrame) -> DataFrame:
    """discount, net = total - discount, cost = quantity x unit cost, profit = net - cost."""
    disc = F.col("total_amount") * F.col("discount_rate")
    cost = F.col("quantity") * F.col("cost_price")
    return (
        df.withColumn("discount_amount", disc)
        .withColumn("net_amount", F.col("total_amount") - F.col("discount_amount"))
        .withColumn("cost_amount", cost)
        .withColumn("profit_amount", F.col("net_amount") - F.col("cost_amount"))
    )


def fact_sales(t: Tables, products: DataFrame | None = None, carry=(), sold: DataFrame | None = None) -> DataFrame:
    """Core sales fact: lines + product cost -> money chain, keys, date key.

    ``carry`` names columns of the products to keep, so that a mart needs no
    second product join. ``sold``: the rows of ``sold_lines``, where they are joined already.
    """
    return fact_columns(fact_lines(t, products, carry, sold), carry)


def fact_lines(t: Tables, products: DataFrame | None = None, carry=(), sold: DataFrame | None = None) -> DataFrame:
    """Lines joined to their product: numeric keys only, so that they cross shuffles narrow.

    Partitioned and sorted on the numeric product source key.
    """
    lines = (line_headers(t) if sold is None else sold).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "o_custkey", "c_mktsegment", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate", F.col("l_partkey").alias(PRODUCT_JOIN_KEY),
    )
    prods = (products if products is not None else dim_product(t)).select(PRODUCT_JOIN_KEY, "cost_price", *carry)
    if sold is None:
        return lines.join(prods, PRODUCT_JOIN_KEY, "inner")
    return unpack(pack(lines, SALE_WORDS).join(prods, PRODUCT_JOIN_KEY, "inner"), SALE_WORDS, lines)


def fact_columns(lines: DataFrame, carry=()) -> DataFrame:
    """The fact's columns from ``fact_lines``: text ids, hashed key and money chain (and ``carry``)."""
    j = lines.select(
        format_id(*ORDER_FMT, "l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        format_id(*PRODUCT_FMT, PRODUCT_JOIN_KEY).alias("product_id"),
        PRODUCT_JOIN_KEY,
        format_id(*CUSTOMER_FMT, "o_custkey").alias("customer_id"),
        format_id(*LOCATION_FMT, "l_suppkey").alias("location_id"),
        F.col("c_mktsegment").alias("channel"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
        money("l_extendedprice", 12, 2).alias("total_amount"),
        money("l_discount", 4, 2).alias("discount_rate"),
        F.col("l_shipdate").alias("transaction_time"),
        "cost_price", *carry,
    )
    j = with_margin(j)
    return j.select(
        surrogate_key("order_id", "line_no", "product_id").alias("sales_id"),
        date_key("transaction_time").alias("date_key"),
        "product_id",
        "customer_id",
        channel_id(F.col("channel")).alias("channel_id"),
        "location_id",
        "order_id",
        F.col("quantity").alias("quantity_sold"),
        "unit_price",
        "total_amount",
        "discount_amount",
        "net_amount",
        "cost_amount",
        "profit_amount",
        "transaction_time",
        PRODUCT_JOIN_KEY, *carry,
    )
