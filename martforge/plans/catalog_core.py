"""Registered queries: model, star joins, marts, filters, inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import date_key, ts_literal
from ..operators import filters, marts
from ..operators.conform import with_audit, with_total
from ..sources.tables import Tables
from ..sources.writers import as_table
from . import fixtures, model
from .registry import BATCH_TS, register, with_ctes
from .sqlparts import (
    DATE_SPAN, DIM_CHANNEL, DIM_DATE, DIM_PRODUCT, DIRTY_SALES, FACT_CORE, HNULL,
    LINES, ORDER_HEADERS, RAW_SALES, date_key as sql_date_key, sha_of,
)

# The oracles of the marts start from the normalized tables: what each order bought of each
# product on each day, in exact decimals, and then sums over the orders.
BOUGHT = """bought AS (
  SELECT c_mktsegment AS channel_name, p_name AS product_name, p_type AS category, CAST(l_shipdate AS DATE) AS sales_date,
         l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS pieces,
         sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2)))) AS paid,
         sum(CAST(l_quantity AS BIGINT) * CAST(p_retailprice AS DECIMAL(10, 2))) AS spent
  FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
  JOIN part ON p_partkey = l_partkey
  GROUP BY ALL)"""
SUMMED = """channel_name, product_name, category, sales_date, CAST(sum(pieces) AS BIGINT) AS total_quantity,
       CAST(sum(paid) AS DOUBLE) AS total_revenue, CAST(sum(paid) - sum(spent) AS DOUBLE) AS total_profit"""
# One row per order line with its sales id and what it was sold as.
SOLD = f"""sold AS (
  SELECT {sha_of("printf('ORD_%08d', l_orderkey)", 'l_linenumber', "printf('PROD_%05d', l_partkey)")} AS sales_id,
         c_mktsegment AS channel_name, p_name AS product_name, p_type AS category, l_shipdate AS sold_at,
         CAST(l_extendedprice AS DECIMAL(12, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2))) AS paid
  FROM part JOIN lineitem ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey)"""

PRODUCT_NAMES = ("product_name", "category")


def _named_fact(t):
    """The sales fact with its products' names, from the one join that also gives their cost."""
    return model.fact_sales(t, model.dim_product(t), carry=PRODUCT_NAMES)


# ---------------------------------------------------------------- flagship A01
@register("mart_sales_summary", with_ctes(BOUGHT) + f"""
SELECT {SUMMED}, CAST(count(*) AS BIGINT) AS order_count
FROM bought GROUP BY ALL""")
def mart_sales_summary(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return marts.sales_summary(_named_fact(t), as_table(model.dim_channel(t), "dim-channel"))


@register("mart_sales_summary_view", with_ctes(BOUGHT) + f"SELECT {SUMMED} FROM bought GROUP BY ALL")
def mart_sales_summary_view(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return marts.sales_summary_view(_named_fact(t), as_table(model.dim_channel(t), "dim-channel"), None,
                                    as_table(model.dim_date(model.data_date_span(t)), "dim-date"))


@register("star_join", with_ctes(SOLD) + """
SELECT sales_id, channel_name, product_name, category, CAST(paid AS DOUBLE) AS net_amount FROM sold""")
def star_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = marts.star_join(_named_fact(t), as_table(model.dim_channel(t), "dim-channel"))
    return j.select("sales_id", "channel_name", "product_name", "category",
                    F.col("net_amount").cast("double").alias("net_amount"))


@register("star_join_date", with_ctes(SOLD) + f"""
SELECT sales_id, channel_name, product_name, CAST(sold_at AS DATE) AS calendar_date,
       {sql_date_key('sold_at')} AS date_key
FROM sold""")
def star_join_date(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = marts.star_join_date(_named_fact(t), as_table(model.dim_channel(t), "dim-channel"), None,
                             as_table(model.dim_date(model.data_date_span(t)), "dim-date"))
    return j.select("sales_id", "channel_name", "product_name", "calendar_date", "date_key")


# ---------------------------------------------------------------- fact money P13
@register("fact_sales_margin", with_ctes(*FACT_CORE) + """
SELECT sales_id, order_id, product_id, quantity_sold,
       CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(discount_amount AS DOUBLE) AS discount_amount,
       CAST(net_amount AS DOUBLE) AS net_amount,
       CAST(cost_amount AS DOUBLE) AS cost_amount,
       CAST(profit_amount AS DOUBLE) AS profit_amount
FROM fact_sales
""")
def fact_sales_margin(spark, sf_dir):
    f = model.fact_sales(Tables(spark, sf_dir))
    money_cols = ["total_amount", "discount_amount", "net_amount", "cost_amount", "profit_amount"]
    return f.select("sales_id", "order_id", "product_id", "quantity_sold",
                    *[F.col(c).cast("double").alias(c) for c in money_cols])


@register("with_total_amount", with_ctes(RAW_SALES) + """
SELECT order_id, line_no, quantity, unit_price, quantity * unit_price AS total_amount
FROM raw_sales
""")
def with_total_amount(spark, sf_dir):
    raw = model.raw_sales(Tables(spark, sf_dir)).select("order_id", "line_no", "quantity", "unit_price")
    return with_total(raw)


@register("date_key", with_ctes(ORDER_HEADERS, LINES) + f"""
SELECT order_id, line_no, {sql_date_key('transaction_time')} AS date_key,
       {sql_date_key('order_date')} AS order_date_key
FROM lines
""")
def date_key_q(spark, sf_dir):
    lines = model.sales_lines(Tables(spark, sf_dir))
    return lines.select("order_id", "line_no", date_key("transaction_time").alias("date_key"),
                        date_key("order_date").alias("order_date_key"))


# ---------------------------------------------------------------- dimensions
@register("dim_channel", with_ctes(DIM_CHANNEL) + "SELECT * FROM dim_channel")
def dim_channel(spark, sf_dir):
    return model.dim_channel(Tables(spark, sf_dir))


@register("dim_customer", """
SELECT printf('CUST_%05d', c.c_custkey) AS customer_id,
       CAST(c.c_custkey AS VARCHAR) AS customer_source_id,
       'CH_' || upper(c.c_mktsegment) AS channel_id, c.c_name AS customer_name,
       n.n_name AS country, r.r_name AS region
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def dim_customer(spark, sf_dir):
    return model.dim_customer(Tables(spark, sf_dir))


@register("dim_location", """
SELECT printf('LOC_%05d', s.s_suppkey) AS location_id, s.s_name AS location_name,
       'supplier_warehouse' AS location_type, n.n_name AS country, TRUE AS is_active
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
""")
def dim_location(spark, sf_dir):
    return model.dim_location(Tables(spark, sf_dir))


@register("dim_date", with_ctes(DATE_SPAN, DIM_DATE) + "SELECT * FROM dim_date")
def dim_date(spark, sf_dir):
    return model.dim_date(model.data_date_span(Tables(spark, sf_dir)))


# ---------------------------------------------------------------- filters F01-F04, J05
@register("staging_sales_clean", f"""
SELECT printf('ORD_%08d', l_orderkey) AS order_id, printf('PROD_%05d', l_partkey) AS product_id,
       printf('CUST_%05d', o_custkey) AS customer_id, c_mktsegment AS channel, CAST(l_quantity AS BIGINT) AS quantity,
       l_extendedprice / l_quantity AS unit_price, CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS DOUBLE) AS total_amount,
       o_orderdate AS order_date, TIMESTAMP '{BATCH_TS}' AS processed_at,
       strftime(TIMESTAMP '{BATCH_TS}', 'batch_%Y%m%d_%H%M%S') AS batch_id
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
-- the dirt: ids lost, quantities negated or lost
WHERE NOT (l_orderkey % {fixtures.ORDER_NULL_MOD} = 0 OR l_partkey % {fixtures.PRODUCT_NULL_MOD} = 0
           OR l_orderkey % {fixtures.QTY_NEGATE_MOD} = 0 OR l_orderkey % {fixtures.QTY_NULL_MOD} = 0)
  AND least(CAST(l_quantity AS BIGINT), l_extendedprice / l_quantity) > 0""")
def staging_sales_clean(spark, sf_dir):
    raw = with_audit(fixtures.dirty_sales(Tables(spark, sf_dir)), ts_literal(BATCH_TS))
    out = filters.clean_sales(raw)
    return out.withColumn("total_amount", F.col("total_amount").cast("double"))


@register("staging_sales_rejected", with_ctes(RAW_SALES, DIRTY_SALES) + """
SELECT order_id, line_no, product_id, quantity, unit_price, 'FAILED' AS validation_status,
       CASE WHEN order_id IS NULL THEN 'order_id_null'
            WHEN product_id IS NULL THEN 'product_id_null'
            WHEN NOT coalesce(quantity > 0, FALSE) THEN 'quantity_not_positive'
            ELSE 'unit_price_not_positive' END AS reject_reason
FROM dirty_sales
WHERE NOT coalesce(order_id IS NOT NULL AND product_id IS NOT NULL AND quantity > 0 AND unit_price > 0, FALSE)
""")
def staging_sales_rejected(spark, sf_dir):
    _, rejected = filters.split_quarantine(fixtures.dirty_sales(Tables(spark, sf_dir)))
    return rejected.select("order_id", "line_no", "product_id", "quantity", "unit_price",
                           "validation_status", "reject_reason")


@register("daily_load_count", """
SELECT CAST(count(*) AS BIGINT) AS row_count FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-03-15 00:00:00' AND l_shipdate < TIMESTAMP '1998-03-16 00:00:00'
""")
def daily_load_count(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return filters.loaded_on(li, "l_shipdate", "1998-03-15").agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))


@register("orphan_keys", with_ctes(DIM_PRODUCT) + """
SELECT s.order_id, s.line_no, s.product_id
FROM (SELECT printf('ORD_%08d', l_orderkey) AS order_id, l_linenumber AS line_no,
             printf('PROD_%05d', CASE WHEN l_orderkey % 71 = 0 THEN l_partkey + 1000000 ELSE l_partkey END) AS product_id
      FROM lineitem) s
WHERE NOT EXISTS (SELECT 1 FROM dim_product d WHERE d.product_id = s.product_id)
""")
def orphan_keys(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return filters.orphans(fixtures.sales_with_orphans(t), model.dim_product(t), "product_id")


# ---------------------------------------------------------------- inventory A12 + W01
@register("fact_inventory", with_ctes(DIM_PRODUCT) + f"""
, txn AS (
  SELECT printf('PROD_%05d', l_partkey) AS product_id, printf('LOC_%05d', l_suppkey) AS location_id,
         l_shipdate AS txn_time,
         CASE WHEN l_returnflag = 'R' THEN 'received' ELSE 'sold' END AS movement,
         CAST(l_quantity AS BIGINT) AS quantity
  FROM lineitem),
daily AS (
  SELECT CAST(txn_time AS DATE) AS inventory_date, product_id, location_id,
         CAST(sum(CASE WHEN movement = 'received' THEN quantity ELSE 0 END) AS BIGINT) AS quantity_received,
         CAST(sum(CASE WHEN movement = 'sold' THEN quantity ELSE 0 END) AS BIGINT) AS quantity_sold,
         CAST(sum(CASE WHEN movement = 'adjusted' THEN quantity ELSE 0 END) AS BIGINT) AS quantity_adjusted
  FROM txn GROUP BY 1, 2, 3),
rolled AS (
  SELECT *, CAST(1000 + sum(quantity_received - quantity_sold + quantity_adjusted)
         OVER (PARTITION BY product_id, location_id ORDER BY inventory_date
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS closing_stock
  FROM daily)
SELECT {sha_of('r.product_id', 'r.location_id', 'r.inventory_date')} AS inventory_id,
       {sql_date_key('r.inventory_date')} AS date_key, r.product_id, r.location_id,
       CAST(r.closing_stock - (r.quantity_received - r.quantity_sold + r.quantity_adjusted) AS BIGINT) AS opening_stock,
       r.closing_stock, r.quantity_received, r.quantity_sold, r.quantity_adjusted,
       CAST(r.closing_stock * p.cost_price AS DOUBLE) AS stock_value
FROM rolled r LEFT JOIN dim_product p ON r.product_id = p.product_id
""")
def fact_inventory(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return marts.fact_inventory(fixtures.inventory_transactions(t), model.dim_product(t),
                                keys=fixtures.INVENTORY_KEYS, ids=fixtures.inventory_ids())
