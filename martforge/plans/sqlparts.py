"""DuckDB SQL building blocks for the oracle queries (same model as plans.model)."""

from __future__ import annotations

HNULL = "'\\N'"  # SQL literal '\N', the record-hash null marker


def sha_of(*exprs: str) -> str:
    texts = [f"CAST({e} AS VARCHAR)" for e in exprs]
    parts = ", ".join(f"coalesce(length({t}) || ':' || {t}, {HNULL})" for t in texts)
    return f"sha256(concat_ws('|', {parts}))"


def date_key(expr: str) -> str:
    return f"CAST(strftime({expr}, '%Y%m%d') AS INTEGER)"


ORDER_HEADERS = """order_headers AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, c.c_mktsegment
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

LINES = """lines AS (
  SELECT printf('ORD_%08d', l.l_orderkey) AS order_id, l.l_linenumber AS line_no,
         printf('PROD_%05d', l.l_partkey) AS product_id,
         printf('CUST_%05d', h.o_custkey) AS customer_id,
         printf('LOC_%05d', l.l_suppkey) AS location_id, h.c_mktsegment AS channel,
         CAST(l.l_quantity AS BIGINT) AS quantity, l.l_extendedprice / l.l_quantity AS unit_price,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS total_amount,
         CAST(l.l_discount AS DECIMAL(4,2)) AS discount_rate,
         h.o_orderdate AS order_date, l.l_shipdate AS transaction_time
  FROM lineitem l JOIN order_headers h ON l.l_orderkey = h.o_orderkey)"""

RAW_SALES = """raw_sales AS (
  SELECT printf('ORD_%08d', l.l_orderkey) AS order_id, l.l_linenumber AS line_no,
         printf('PROD_%05d', l.l_partkey) AS product_id,
         printf('CUST_%05d', o.o_custkey) AS customer_id,
         c.c_mktsegment AS channel, r.r_name AS region,
         CAST(l.l_quantity AS BIGINT) AS quantity, l.l_extendedprice / l.l_quantity AS unit_price,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS total_amount,
         o.o_orderdate AS order_date, l.l_shipdate AS transaction_time
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

DIRTY_SALES = """dirty_sales AS (
  SELECT CASE WHEN CAST(substr(order_id, 5) AS BIGINT) % 97 = 0 THEN NULL ELSE order_id END AS order_id,
         line_no,
         CASE WHEN CAST(substr(product_id, 6) AS BIGINT) % 89 = 0 THEN NULL ELSE product_id END AS product_id,
         customer_id, channel, region,
         CASE WHEN CAST(substr(order_id, 5) AS BIGINT) % 83 = 0 THEN -quantity
              WHEN CAST(substr(order_id, 5) AS BIGINT) % 79 = 0 THEN NULL
              ELSE quantity END AS quantity,
         unit_price, total_amount, order_date, transaction_time
  FROM raw_sales)"""

DIM_PRODUCT = """dim_product AS (
  SELECT printf('PROD_%05d', p_partkey) AS product_id, p_name AS product_name,
         p_type AS category, p_brand AS brand,
         CAST(p_retailprice AS DECIMAL(10,2)) AS cost_price, TRUE AS is_active
  FROM part)"""

DIM_CHANNEL = """dim_channel AS (
  SELECT 'CH_' || upper(channel_name) AS channel_id, channel_name,
         'market_segment' AS channel_type
  FROM (SELECT DISTINCT c_mktsegment AS channel_name FROM customer))"""

FACT_SALES = f"""fact_sales AS (
  SELECT {sha_of('order_id', 'line_no', 'product_id')} AS sales_id,
         {date_key('transaction_time')} AS date_key,
         product_id, customer_id, 'CH_' || upper(channel) AS channel_id, location_id, order_id,
         quantity AS quantity_sold, unit_price, total_amount,
         total_amount * discount_rate AS discount_amount,
         total_amount - total_amount * discount_rate AS net_amount,
         quantity * cost_price AS cost_amount,
         (total_amount - total_amount * discount_rate) - quantity * cost_price AS profit_amount,
         transaction_time
  FROM lines JOIN dim_product USING (product_id))"""

DATE_SPAN = """date_span AS (
  SELECT CAST(min(d) AS DATE) AS start_date, CAST(max(d) AS DATE) AS end_date
  FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate AS d FROM lineitem))"""

DIM_DATE = f"""dim_date AS (
  SELECT {date_key('g.date')} AS date_key, g.date, CAST(year(g.date) AS INTEGER) AS year,
         CAST(quarter(g.date) AS INTEGER) AS quarter, CAST(month(g.date) AS INTEGER) AS month,
         CAST(day(g.date) AS INTEGER) AS day, CAST(dayofweek(g.date) + 1 AS INTEGER) AS day_of_week,
         CAST(g.date AS TIMESTAMP) AS transaction_time
  FROM (SELECT CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS date
        FROM date_span) g)"""

FACT_CORE = [ORDER_HEADERS, LINES, DIM_PRODUCT, FACT_SALES]
