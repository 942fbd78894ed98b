"""Registered queries: SCD-2 stamps, hashes, keys, merge, history, as-of join."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import format_id, record_hash, surrogate_key, ts_literal
from ..operators import quality, scd2
from ..sources.tables import Tables
from . import curated, fixtures, model
from .registry import BATCH_TS, register, with_ctes
from .sqlparts import LINES, ORDER_HEADERS, sha_of

V1 = fixtures.DIM_V1_TS
OPEN = "2099-12-31 00:00:00"
ATTRS = ("product_name", "category", "brand", "unit_cost")


def _batch_id_sql(ts: str) -> str:
    return f"'batch_' || strftime(TIMESTAMP '{ts}', '%Y%m%d_%H%M%S')"


PRODUCT_SOURCE = """product_source AS (
  SELECT printf('PROD_%05d', p_partkey) AS product_id, p_name AS product_name,
         p_type AS category, p_brand AS brand, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_cost
  FROM part)"""

DIM_V1 = f"""dim_v1 AS (
  SELECT {sha_of('product_id', f"TIMESTAMP '{V1}'")} AS product_key, product_id, product_name, category, brand,
         unit_cost, TIMESTAMP '{V1}' AS effective_date, TIMESTAMP '{OPEN}' AS end_date, TRUE AS is_current,
         {sha_of(*ATTRS)} AS record_hash, TIMESTAMP '{V1}' AS created_date, TIMESTAMP '{V1}' AS updated_date,
         {_batch_id_sql(V1)} AS batch_id
  FROM product_source)"""

INCOMING = f"""incoming AS (
  SELECT printf('PROD_%05d', CASE WHEN p_partkey % 50 = 0 THEN p_partkey + 1000000 ELSE p_partkey END) AS product_id,
         p_name AS product_name, p_type AS category, p_brand AS brand,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) + CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS unit_cost
  FROM part),
inc AS (SELECT *, {sha_of(*ATTRS)} AS record_hash FROM incoming)"""

MERGED = f"""merged AS (
  SELECT d.* FROM dim_v1 d LEFT JOIN inc i ON d.product_id = i.product_id
  WHERE i.product_id IS NULL OR i.record_hash = d.record_hash
  UNION ALL
  SELECT d.product_key, d.product_id, d.product_name, d.category, d.brand, d.unit_cost, d.effective_date,
         TIMESTAMP '{BATCH_TS}', FALSE, d.record_hash, d.created_date, TIMESTAMP '{BATCH_TS}', d.batch_id
  FROM dim_v1 d JOIN inc i ON d.product_id = i.product_id WHERE i.record_hash <> d.record_hash
  UNION ALL
  SELECT {sha_of('i.product_id', f"TIMESTAMP '{BATCH_TS}'")}, i.product_id, i.product_name, i.category, i.brand,
         i.unit_cost, TIMESTAMP '{BATCH_TS}', TIMESTAMP '{OPEN}', TRUE, i.record_hash,
         TIMESTAMP '{BATCH_TS}', TIMESTAMP '{BATCH_TS}', {_batch_id_sql(BATCH_TS)}
  FROM inc i LEFT JOIN dim_v1 d ON d.product_id = i.product_id
  WHERE d.product_id IS NULL OR i.record_hash <> d.record_hash)"""

DIM_OUT = """product_key, product_id, product_name, category, brand, CAST(unit_cost AS DOUBLE) AS unit_cost,
       effective_date, end_date, is_current, record_hash, created_date, updated_date, batch_id"""


def _dim_out(df):
    return df.withColumn("unit_cost", F.col("unit_cost").cast("double"))


def _dim_v1(t):
    return scd2.scd2_initial(fixtures.product_source(t), ts_literal(V1))


def _merged(t):
    return scd2.scd2_merge(_dim_v1(t), fixtures.incoming_products(t), ts_literal(BATCH_TS))


@register("scd2_initial", with_ctes(PRODUCT_SOURCE, DIM_V1) + f"SELECT {DIM_OUT} FROM dim_v1")
def scd2_initial(spark, sf_dir):
    return _dim_out(_dim_v1(Tables(spark, sf_dir)))


@register("record_hash", with_ctes(PRODUCT_SOURCE) + f"""
SELECT product_id, {sha_of(*ATTRS)} AS record_hash,
       {sha_of('product_name', 'NULL', 'brand', 'NULL')} AS record_hash_with_nulls
FROM product_source""")
def record_hash_q(spark, sf_dir):
    p = fixtures.product_source(Tables(spark, sf_dir))
    return p.select("product_id", record_hash(*ATTRS).alias("record_hash"),
                    record_hash("product_name", F.lit(None).cast("string"), "brand",
                                F.lit(None).cast("string")).alias("record_hash_with_nulls"))


@register("surrogate_keys", with_ctes(ORDER_HEADERS, LINES) + f"""
SELECT order_id, line_no, product_id,
       {sha_of('order_id', 'line_no', 'product_id')} AS sales_key,
       {sha_of('product_id', f"TIMESTAMP '{V1}'")} AS product_key
FROM lines""")
def surrogate_keys(spark, sf_dir):
    lines = model.sales_lines(Tables(spark, sf_dir))
    return lines.select("order_id", "line_no", "product_id",
                        surrogate_key("order_id", "line_no", "product_id").alias("sales_key"),
                        surrogate_key("product_id", ts_literal(V1)).alias("product_key"))


@register("scd2_merge", with_ctes(PRODUCT_SOURCE, DIM_V1, INCOMING, MERGED) + f"SELECT {DIM_OUT} FROM merged")
def scd2_merge(spark, sf_dir):
    return _dim_out(_merged(Tables(spark, sf_dir)))


@register("scd2_current", with_ctes(PRODUCT_SOURCE, DIM_V1, INCOMING, MERGED)
          + f"SELECT {DIM_OUT} FROM merged WHERE is_current")
def scd2_current(spark, sf_dir):
    return _dim_out(scd2.current_rows(_merged(Tables(spark, sf_dir))))


HISTORY = f"""changes AS (
  SELECT printf('PROD_%05d', l_partkey) AS product_id, l_shipdate AS change_time,
         printf('LOC_%05d', l_suppkey) AS supplier_id
  FROM lineitem),
per AS (
  SELECT product_id, CAST(date_trunc('day', change_time) AS TIMESTAMP) AS effective_date,
         max({{'t': change_time, 's': supplier_id}}).s AS supplier_id
  FROM changes GROUP BY 1, 2),
chg AS (
  SELECT *, lag(supplier_id) OVER (PARTITION BY product_id ORDER BY effective_date) AS prev FROM per),
kept AS (SELECT product_id, effective_date, supplier_id FROM chg WHERE prev IS NULL OR prev IS DISTINCT FROM supplier_id),
history AS (
  SELECT product_id, effective_date, supplier_id,
         coalesce(lead(effective_date) OVER (PARTITION BY product_id ORDER BY effective_date),
                  TIMESTAMP '{OPEN}') AS end_date
  FROM kept)"""


def _history_by_key(t):
    """Versions keyed by the numeric product source key: the history window
    and the as-of join sort on it (text ids share their first 8 bytes)."""
    return scd2.scd2_history(fixtures.product_supplier_changes(t), model.PRODUCT_JOIN_KEY, "change_time",
                             ["supplier_id"], grain="day")


def _product_id():
    return format_id(*model.PRODUCT_FMT, model.PRODUCT_JOIN_KEY).alias("product_id")


@register("scd2_history", with_ctes(HISTORY) + f"""
SELECT product_id, effective_date, supplier_id, end_date, end_date = TIMESTAMP '{OPEN}' AS is_current FROM history""")
def scd2_history(spark, sf_dir):
    h = _history_by_key(Tables(spark, sf_dir))
    return h.select(_product_id(), "effective_date", "supplier_id", "end_date", "is_current")


@register("asof_product_version", with_ctes(ORDER_HEADERS, LINES, HISTORY) + """
SELECT l.order_id, l.line_no, l.product_id, l.order_date, h.supplier_id, h.effective_date
FROM lines l JOIN history h
  ON l.product_id = h.product_id AND l.order_date >= h.effective_date AND l.order_date < h.end_date""")
def asof_product_version(spark, sf_dir):
    t = Tables(spark, sf_dir)
    facts = model.line_headers(t).select(
        "l_orderkey", F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias(model.PRODUCT_JOIN_KEY),
        F.col("o_orderdate").alias("order_date"))
    versions = _history_by_key(t).select(model.PRODUCT_JOIN_KEY, "effective_date", "end_date", "supplier_id")
    j = scd2.asof_join(facts, versions, model.PRODUCT_JOIN_KEY, "order_date")
    return j.select(format_id(*model.ORDER_FMT, "l_orderkey").alias("order_id"), "line_no", _product_id(),
                    "order_date", "supplier_id", "effective_date")


# Second-grain changes with a hot key: a third of the orders are lines of one product.
FINE_CHANGES = f"""changes AS (
  SELECT CASE WHEN l_orderkey % {fixtures.HOT_MOD} = 0 THEN {fixtures.HOT_PRODUCT} ELSE l_partkey END AS product,
         l_shipdate + to_seconds((l_orderkey * 7919 + l_linenumber * 613) % 86400) AS change_time,
         printf('LOC_%05d', l_suppkey) AS supplier_id
  FROM lineitem),
states AS (
  SELECT product, change_time AS effective_date, max(supplier_id) AS supplier_id FROM changes GROUP BY ALL),
versions AS (
  SELECT product, effective_date, supplier_id,
         coalesce(lead(effective_date) OVER (PARTITION BY product ORDER BY effective_date), TIMESTAMP '{OPEN}') AS end_date
  FROM (SELECT *, lag(supplier_id) OVER (PARTITION BY product ORDER BY effective_date) AS before FROM states)
  WHERE before IS DISTINCT FROM supplier_id)"""


def _fine_history(t):
    return scd2.scd2_history(fixtures.fine_supplier_changes(t), model.PRODUCT_JOIN_KEY, "change_time", ["supplier_id"])


@register("scd2_history_hot_key", with_ctes(FINE_CHANGES) + f"""
SELECT printf('PROD_%05d', product) AS product_id, effective_date, supplier_id, end_date,
       end_date = TIMESTAMP '{OPEN}' AS is_current FROM versions""")
def scd2_history_hot_key(spark, sf_dir):
    h = _fine_history(Tables(spark, sf_dir))
    return h.select(_product_id(), "effective_date", "supplier_id", "end_date", "is_current")


@register("asof_hot_key", with_ctes(FINE_CHANGES) + f""", sold AS (
  SELECT l_orderkey, l_linenumber AS line_no, o_orderdate + INTERVAL 90 DAY + to_seconds(l_orderkey * 31 % 86400) AS sold_at,
         CASE WHEN l_orderkey % {fixtures.HOT_MOD} = 0 THEN {fixtures.HOT_PRODUCT} ELSE l_partkey END AS product
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT printf('ORD_%08d', s.l_orderkey) AS order_id, s.line_no, printf('PROD_%05d', s.product) AS product_id, s.sold_at,
       v.supplier_id, v.effective_date
FROM sold s ASOF LEFT JOIN versions v ON s.product = v.product AND s.sold_at >= v.effective_date""")
def asof_hot_key(spark, sf_dir):
    """Facts and versions to the second; facts before a product's first version keep null versions."""
    t = Tables(spark, sf_dir)
    versions = _fine_history(t).select(model.PRODUCT_JOIN_KEY, "effective_date", "end_date", "supplier_id")
    j = scd2.asof_join(fixtures.fine_sales(t), versions, model.PRODUCT_JOIN_KEY, "sold_at", how="left")
    return j.select(format_id(*model.ORDER_FMT, "l_orderkey").alias("order_id"), "line_no", _product_id(), "sold_at",
                    "supplier_id", "effective_date")



@register("dim_contract", with_ctes(PRODUCT_SOURCE, DIM_V1, INCOMING, MERGED) + f"""
, broken AS (
  SELECT {', '.join(f"count(*) FILTER (WHERE {c} IS NULL) AS \"not_null:{c}\"" for c in curated.DIM_NOT_NULL)},
         count(product_key) - count(DISTINCT product_key) AS "primary_key:product_key",
         count(*) FILTER (WHERE unit_cost < 0) AS "check:unit_cost_non_negative",
         count(*) FILTER (WHERE effective_date >= end_date) AS "check:starts_before_it_ends",
         count(*) FILTER (WHERE is_current <> (end_date = TIMESTAMP '{OPEN}')) AS "check:current_is_open"
  FROM merged)
SELECT rule, CAST(violations AS BIGINT) AS violations FROM (UNPIVOT broken ON COLUMNS(*) INTO NAME rule VALUE violations)""")
def dim_contract(spark, sf_dir):
    """Violations of each rule of the dimension's contract after the change batch."""
    return quality.contract_violations(_merged(Tables(spark, sf_dir)), list(curated.DIM_NOT_NULL), "product_key",
                                       curated.dim_checks())
