"""Registered queries: scorecards, thresholds, profile, contracts, gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import ts_literal
from ..operators import conform, gates, quality
from ..sources.tables import Tables
from . import curated, fixtures, model
from .registry import BATCH_TS, register, with_ctes
from .sqlparts import DIRTY_SALES, RAW_SALES, sha_of

PRODUCT_SOURCE = """product_source AS (
  SELECT printf('PROD_%05d', p_partkey) AS product_id, p_name AS product_name,
         p_type AS category, p_brand AS brand, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_cost
  FROM part)"""


def _suite2_metrics(src: str, name: str = "m") -> str:
    return f"""{name} AS (
  SELECT count(*) AS n,
         count(*) FILTER (WHERE order_id IS NULL) AS oid_nulls,
         count(DISTINCT order_id) AS oid_distinct,
         count(*) FILTER (WHERE product_id IS NULL) AS pid_nulls,
         coalesce(bool_and(coalesce(quantity >= 0 AND quantity <= 1000, FALSE)), TRUE) AS qty_ok,
         coalesce(bool_and(coalesce(unit_price >= 0 AND unit_price <= 10000, FALSE)), TRUE) AS price_ok
  FROM {src})"""


def _suite2_rows(suite: str, m: str = "m") -> str:
    return f"""
  SELECT '{suite}' AS suite, 1 AS check_order, 'row_count_check' AS check_name, n BETWEEN 1 AND 10000000 AS passed, CAST(n AS DOUBLE) AS observed FROM {m}
  UNION ALL SELECT '{suite}', 2, 'order_id_not_null', oid_nulls = 0, CAST(oid_nulls AS DOUBLE) FROM {m}
  UNION ALL SELECT '{suite}', 3, 'product_id_not_null', pid_nulls = 0, CAST(pid_nulls AS DOUBLE) FROM {m}
  UNION ALL SELECT '{suite}', 4, 'quantity_range_check', qty_ok, CAST(CAST(qty_ok AS INTEGER) AS DOUBLE) FROM {m}
  UNION ALL SELECT '{suite}', 5, 'unit_price_range_check', price_ok, CAST(CAST(price_ok AS INTEGER) AS DOUBLE) FROM {m}
  UNION ALL SELECT '{suite}', 6, 'order_id_unique', oid_distinct = n, CAST(oid_distinct AS DOUBLE) FROM {m}"""


def _scored(rows_sql: str) -> str:
    return f"""SELECT suite, check_order, check_name, passed,
       CAST(CASE WHEN passed THEN 100.0 ELSE 0.0 END AS DOUBLE) AS score, observed
FROM ({rows_sql}) x"""


def suite2_sql(src_ctes: list[str], src: str, suite: str) -> str:
    return with_ctes(*src_ctes, _suite2_metrics(src)) + _scored(_suite2_rows(suite))


SUITE1_ROWS = """
  SELECT 'dimensional' AS suite, 1 AS check_order, 'product_id_uniqueness' AS check_name,
         count(DISTINCT product_id) = count(*) AS passed, CAST(count(DISTINCT product_id) AS DOUBLE) AS observed
  FROM product_source
  UNION ALL SELECT 'dimensional', 2, 'product_name_not_null', ok, CAST(CAST(ok AS INTEGER) AS DOUBLE)
  FROM (SELECT coalesce(bool_and(coalesce(product_name IS NOT NULL, FALSE)), TRUE) AS ok FROM product_source)
  UNION ALL SELECT 'dimensional', 3, 'sales_quantity_positive', ok, CAST(CAST(ok AS INTEGER) AS DOUBLE)
  FROM (SELECT coalesce(bool_and(coalesce(quantity > 0, FALSE)), TRUE) AS ok FROM raw_sales)
  UNION ALL SELECT 'dimensional', 4, 'sales_amount_positive', ok, CAST(CAST(ok AS INTEGER) AS DOUBLE)
  FROM (SELECT coalesce(bool_and(coalesce(total_amount > 0, FALSE)), TRUE) AS ok FROM raw_sales)
  UNION ALL SELECT 'dimensional', 5, 'order_id_not_null', ok, CAST(CAST(ok AS INTEGER) AS DOUBLE)
  FROM (SELECT coalesce(bool_and(coalesce(order_id IS NOT NULL, FALSE)), TRUE) AS ok FROM raw_sales)"""


def _suite1(t):
    return quality.dq_dimensional(fixtures.product_source(t), model.raw_sales(t))


@register("dq_suite_sales", suite2_sql([RAW_SALES], "raw_sales", "sales"))
def dq_suite_sales(spark, sf_dir):
    return quality.dq_sales(model.raw_sales(Tables(spark, sf_dir)), "sales")


@register("dq_suite_sales_dirty", suite2_sql([RAW_SALES, DIRTY_SALES], "dirty_sales", "sales"))
def dq_suite_sales_dirty(spark, sf_dir):
    return quality.dq_sales(fixtures.dirty_sales(Tables(spark, sf_dir)), "sales")


@register("dq_suite_dimensional", with_ctes(RAW_SALES, PRODUCT_SOURCE) + _scored(SUITE1_ROWS))
def dq_suite_dimensional(spark, sf_dir):
    return _suite1(Tables(spark, sf_dir))


THRESH_AS_OF = "2024-01-31 00:00:00"


@register("dq_thresholds", f"""
SELECT metric, value, threshold, coalesce(value <= threshold, FALSE) AS passed FROM (
WITH m AS (SELECT count(*) AS n, count(event_id) AS nn, count(DISTINCT event_id) AS nd, max(ts) AS latest FROM events)
SELECT 'null_rate' AS metric, CAST(CASE WHEN n > 0 THEN (n - nn) / n ELSE 0.0 END AS DOUBLE) AS value,
       CAST(0.05 AS DOUBLE) AS threshold FROM m
UNION ALL SELECT 'duplicate_rate', CAST(CASE WHEN n > 0 THEN (nn - nd) / n ELSE 0.0 END AS DOUBLE), 0.01 FROM m
UNION ALL SELECT 'freshness_hours', CAST((epoch_us(TIMESTAMP '{THRESH_AS_OF}') - epoch_us(latest)) / 3.6e9 AS DOUBLE),
       24.0 FROM m
) q
""")
def dq_thresholds(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return quality.dq_thresholds(ev, "event_id", "ts", ts_literal(THRESH_AS_OF))


PROFILE_COLS = ["order_id", "product_id", "customer_id", "quantity"]


@register("profile_sales", with_ctes(RAW_SALES) + "\nUNION ALL ".join(
    f"""SELECT {i} AS column_order, '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min_value,
       CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_count, CAST(count({c}) AS BIGINT) AS non_null_count,
       CAST(count(*) AS BIGINT) AS row_count FROM raw_sales"""
    for i, c in enumerate(PROFILE_COLS)))
def profile_sales(spark, sf_dir):
    return quality.profile(model.raw_sales(Tables(spark, sf_dir)), PROFILE_COLS)


# ------------------------------------------------------------ curated fact, contract
FCT_SQL = f"""fct AS (
  SELECT {sha_of('order_id', 'line_no', 'product_id')} AS sales_key, order_id, product_id, customer_id,
         quantity, unit_price, total_amount, channel, region, order_date,
         TIMESTAMP '{BATCH_TS}' AS load_date,
         'batch_' || strftime(TIMESTAMP '{BATCH_TS}', '%Y%m%d_%H%M%S') AS batch_id,
         'CSV_IMPORT' AS source_system, CAST(NULL AS DOUBLE) AS quality_score, 'PASSED' AS validation_status
  FROM dirty_sales)"""


@register("stage_fact_sales", with_ctes(RAW_SALES, DIRTY_SALES, FCT_SQL) + """
SELECT sales_key, order_id, product_id, customer_id, quantity, unit_price,
       CAST(total_amount AS DOUBLE) AS total_amount, channel, region, order_date, load_date,
       batch_id, source_system, quality_score, validation_status
FROM fct""")
def stage_fact_sales(spark, sf_dir):
    f = curated.fct_sales(fixtures.dirty_sales(Tables(spark, sf_dir)), ts_literal(BATCH_TS))
    return f.withColumns({"total_amount": F.col("total_amount").cast("double"),
                          "quality_score": F.col("quality_score").cast("double")})


def _contract_sql():
    rules = [(f"not_null:{c}", f"count(*) FILTER (WHERE {c} IS NULL)") for c in curated.FCT_NOT_NULL]
    rules.append(("primary_key:sales_key", "count(sales_key) - count(DISTINCT sales_key)"))
    rules += [("check:quantity_positive", "count(*) FILTER (WHERE NOT (quantity > 0))"),
              ("check:unit_price_non_negative", "count(*) FILTER (WHERE NOT (unit_price >= 0))"),
              ("check:total_amount_non_negative", "count(*) FILTER (WHERE NOT (total_amount >= 0))")]
    body = "\nUNION ALL ".join(f"SELECT '{n}' AS rule, CAST({e} AS BIGINT) AS violations FROM fct" for n, e in rules)
    return with_ctes(RAW_SALES, DIRTY_SALES, FCT_SQL) + body


@register("contract_violations", _contract_sql())
def contract_violations(spark, sf_dir):
    f = curated.fct_sales(fixtures.dirty_sales(Tables(spark, sf_dir)), ts_literal(BATCH_TS))
    return quality.contract_violations(f, list(curated.FCT_NOT_NULL), "sales_key", curated.fct_checks(),
                                       curated.fct_key())


# ------------------------------------------------------------ load summary, gates
LOAD_SUMMARY_SQL_CTE = f"""ls AS (
  SELECT (SELECT count(*) FROM product_source) AS dim_product_rows,
         (SELECT count(*) FROM raw_sales) AS fct_sales_rows,
         (SELECT avg(score) FROM ({_scored(SUITE1_ROWS)}) s) AS quality_score,
         TIMESTAMP '{BATCH_TS}' AS load_timestamp)"""


def _load_summary(t):
    return gates.load_summary(fixtures.product_source(t), model.raw_sales(t), _suite1(t), ts_literal(BATCH_TS))


@register("load_summary", with_ctes(RAW_SALES, PRODUCT_SOURCE, LOAD_SUMMARY_SQL_CTE) + """
SELECT CAST(dim_product_rows AS BIGINT) AS dim_product_rows, CAST(fct_sales_rows AS BIGINT) AS fct_sales_rows,
       CAST(quality_score AS DOUBLE) AS quality_score, load_timestamp FROM ls""")
def load_summary(spark, sf_dir):
    return _load_summary(Tables(spark, sf_dir))


@register("validate_warehouse", with_ctes(RAW_SALES, PRODUCT_SOURCE, LOAD_SUMMARY_SQL_CTE) + """
SELECT 'dim_product_rows' AS "check", CAST(dim_product_rows AS DOUBLE) AS observed, dim_product_rows > 0 AS passed FROM ls
UNION ALL SELECT 'fct_sales_rows', CAST(fct_sales_rows AS DOUBLE), fct_sales_rows > 0 FROM ls
UNION ALL SELECT 'quality_score', CAST(quality_score AS DOUBLE), quality_score >= 85.0 FROM ls""")
def validate_warehouse(spark, sf_dir):
    return gates.validate_warehouse(_load_summary(Tables(spark, sf_dir)))


def _post_frame(t):
    """Pre-transform frame (dirty feed) and its transform: names, types, audit."""
    pre = fixtures.dirty_sales(t)
    post = conform.with_audit(conform.conform_types(conform.standardize_columns(pre), safe=True),
                              ts_literal(BATCH_TS))
    return pre, post


def _score_sql(src: str, suite: str) -> str:
    rows = _scored(_suite2_rows(suite, 'm_' + src))
    return (f"(SELECT CASE WHEN count(*) > 0 THEN (count(*) FILTER (WHERE passed) / count(*)) * 100.0 "
            f"ELSE 0.0 END FROM ({rows}) s_{src})")


@register("gate_decisions", with_ctes(RAW_SALES, DIRTY_SALES, PRODUCT_SOURCE,
                                      _suite2_metrics("dirty_sales", "m_dirty_sales")) + f"""
SELECT 'dimensional_gate' AS gate, CAST(s AS DOUBLE) AS score, CAST(85.0 AS DOUBLE) AS threshold, s >= 85.0 AS passed
FROM (SELECT avg(score) AS s FROM ({_scored(SUITE1_ROWS)}) a)
UNION ALL
SELECT 'post_transform_gate', CAST(s AS DOUBLE), CAST(90.0 AS DOUBLE), s >= 90.0
FROM (SELECT {_score_sql('dirty_sales', 'post')} AS s) b""")
def gate_decisions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    g1 = gates.gate(quality.summary(_suite1(t)), "dimensional_gate", gates.DIMENSIONAL_GATE)
    _, post = _post_frame(t)
    g3 = gates.gate(quality.ratio_summary(quality.dq_sales(post, "post")), "post_transform_gate",
                    gates.POST_TRANSFORM_GATE)
    return g1.unionByName(g3)


@register("gate_pre_post", with_ctes(RAW_SALES, DIRTY_SALES,
                                     _suite2_metrics("dirty_sales", "m_dirty_sales")) + f"""
SELECT 'pre_transform' AS gate, CAST(s AS DOUBLE) AS score, CAST(80.0 AS DOUBLE) AS threshold, s >= 80.0 AS passed
FROM (SELECT {_score_sql('dirty_sales', 'pre')} AS s) a
UNION ALL
SELECT 'post_transform', CAST(s AS DOUBLE), CAST(80.0 AS DOUBLE), s >= 80.0
FROM (SELECT {_score_sql('dirty_sales', 'post')} AS s) b""")
def gate_pre_post(spark, sf_dir):
    t = Tables(spark, sf_dir)
    pre, post = _post_frame(t)
    a = gates.gate(quality.ratio_summary(quality.dq_sales(pre, "pre")), "pre_transform", gates.PRE_TRANSFORM_GATE)
    b = gates.gate(quality.ratio_summary(quality.dq_sales(post, "post")), "post_transform", gates.PRE_TRANSFORM_GATE)
    return a.unionByName(b)


@register("conform_types", with_ctes(RAW_SALES, DIRTY_SALES) + """
SELECT order_id, line_no, product_id, customer_id, quantity, unit_price FROM dirty_sales""")
def conform_types_q(spark, sf_dir):
    d = fixtures.dirty_sales(Tables(spark, sf_dir)).select(
        "order_id", "line_no", "product_id", "customer_id", "quantity", "unit_price")
    return conform.conform_types(d, safe=True)


@register("standardize_columns", with_ctes(RAW_SALES) + """
SELECT order_id AS order_id, line_no AS line_no, quantity AS quantity, channel AS channel FROM raw_sales""")
def standardize_columns_q(spark, sf_dir):
    raw = model.raw_sales(Tables(spark, sf_dir)).select(
        F.col("order_id").alias("Order ID"), F.col("line_no").alias("Line No"),
        F.col("quantity").alias("QUANTITY"), F.col("channel").alias("Channel"))
    return conform.standardize_columns(raw)


@register("with_audit", with_ctes(RAW_SALES) + f"""
SELECT order_id, line_no, TIMESTAMP '{BATCH_TS}' AS processed_at,
       'batch_' || strftime(TIMESTAMP '{BATCH_TS}', '%Y%m%d_%H%M%S') AS batch_id FROM raw_sales""")
def with_audit_q(spark, sf_dir):
    raw = model.raw_sales(Tables(spark, sf_dir)).select("order_id", "line_no")
    return conform.with_audit(raw, ts_literal(BATCH_TS))


@register("with_defaults", with_ctes(RAW_SALES, DIRTY_SALES) + """
SELECT order_id, line_no, coalesce(product_id, 'UNKNOWN') AS product_id,
       'CSV_IMPORT' AS source_system, 'PASSED' AS validation_status FROM dirty_sales""")
def with_defaults_q(spark, sf_dir):
    d = fixtures.dirty_sales(Tables(spark, sf_dir)).select("order_id", "line_no", "product_id")
    return conform.with_defaults(d, {
        "product_id": F.lit("UNKNOWN"),
        "source_system": F.lit(curated.SOURCE_SYSTEM_DEFAULT),
        "validation_status": F.lit(curated.VALIDATION_STATUS_DEFAULT),
    })
