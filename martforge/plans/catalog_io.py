"""Registered queries: scans, sinks, ingest, ordering, layers, generators, scalars."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ..functions.columns import file_stem, format_id, sanitize_id, ts_literal
from ..operators import gates, ordering
from ..session import scratch_path
from ..sources import csv as csv_src
from ..sources import generators, ingest, writers
from ..sources.tables import Tables
from . import fixtures, layers, model
from .registry import BATCH_TS, register, with_ctes
from .sqlparts import DIRTY_SALES, FACT_CORE, DIM_CHANNEL, RAW_SALES

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@register("scan_csv_roundtrip", f"SELECT {ORDERS_COLS} FROM orders")
def scan_csv_roundtrip(spark, sf_dir):
    orders = Tables(spark, sf_dir).orders
    path = scratch_path(spark, "csv-roundtrip")
    csv_src.write_csv(orders, path)
    return csv_src.scan_csv(spark, path, orders.schema)


@register("source_row_count", "SELECT CAST(count(*) AS BIGINT) AS total_rows FROM orders")
def source_row_count(spark, sf_dir):
    orders = Tables(spark, sf_dir).orders
    path = scratch_path(spark, "csv-count")
    csv_src.write_csv(orders, path)
    return csv_src.source_row_count(csv_src.scan_csv(spark, path, orders.schema))


@register("ingest_resumable", f"SELECT {ORDERS_COLS} FROM orders")
def ingest_resumable(spark, sf_dir):
    """Landed CSV files -> streaming file source (2 files per micro-batch) ->
    parquet; a second run over the same checkpoint adds nothing."""
    orders = Tables(spark, sf_dir).orders
    base = scratch_path(spark, "ingest")
    # several files (at least 8, more as the data grows), two per micro-batch
    src = ingest.land_files(orders, f"{base}/landing", ingest.session_files(spark, 8), ["o_orderkey"], fmt="csv")
    for _ in range(2):  # second run: resume finds every file committed
        ingest.ingest_resumable(spark, src, orders.schema, f"{base}/out", f"{base}/_checkpoint",
                                fmt="csv", max_files_per_trigger=2)
    return spark.read.schema(orders.schema).parquet(f"{base}/out")


CHUNK = 1000


@register("progress_ledger", f"""
SELECT chunk_no, CAST(least((chunk_no + 1) * {CHUNK}, total) - chunk_no * {CHUNK} AS BIGINT) AS rows_in_chunk,
       CAST(least((chunk_no + 1) * {CHUNK}, total) AS BIGINT) AS processed_rows,
       CAST(total AS BIGINT) AS total_rows,
       CASE WHEN total > 0 THEN (CAST(least((chunk_no + 1) * {CHUNK}, total) AS DOUBLE) / CAST(total AS DOUBLE)) * 100.0
            ELSE 0.0 END AS completion_percentage
FROM (SELECT unnest(generate_series(0, CAST(ceil(count(*) / {CHUNK}.0) AS BIGINT) - 1)) AS chunk_no,
             count(*) AS total FROM orders) g""")
def progress_ledger(spark, sf_dir):
    return ingest.progress_ledger(Tables(spark, sf_dir).orders, CHUNK)


SKIP = 1000
SLICE_START, SLICE_LEN = 2000, 1000


@register("resume_skip_rows", f"SELECT {ORDERS_COLS} FROM orders ORDER BY o_orderkey OFFSET {SKIP}")
def resume_skip_rows(spark, sf_dir):
    return ordering.skip_rows(Tables(spark, sf_dir).orders, ["o_orderkey"], SKIP)


@register("chunk_slice",
          f"SELECT {ORDERS_COLS} FROM orders ORDER BY o_orderkey LIMIT {SLICE_LEN} OFFSET {SLICE_START}")
def chunk_slice(spark, sf_dir):
    return ordering.chunk_slice(Tables(spark, sf_dir).orders, ["o_orderkey"], SLICE_START, SLICE_LEN)


@register("concat_chunks", f"""
SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
UNION ALL
SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' OR o_orderdate IS NULL""")
def concat_chunks(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    a = o.filter(F.col("o_orderdate") < ts_literal("1998-01-01 00:00:00"))
    b = o.filter((F.col("o_orderdate") >= ts_literal("1997-01-01 00:00:00")) | F.col("o_orderdate").isNull())
    return ordering.concat_chunks(a, b)


LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
LI_REST = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@register("dedup_latest", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {', '.join(c + ' DESC' for c in LI_ORDER + LI_REST)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def dedup_latest(spark, sf_dir):
    return ordering.dedup_latest(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"], LI_ORDER)


B1, B2 = "2024-02-01 00:00:00", "2024-02-02 00:00:00"


@register("append_idempotent", f"""
SELECT {ORDERS_COLS},
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 'batch_20240201_000000'
            ELSE 'batch_20240202_000000' END AS batch_id
FROM orders""")
def append_idempotent(spark, sf_dir):
    """Two batches appended, the second one twice: its partition is replaced."""
    from ..functions.columns import batch_id
    o = Tables(spark, sf_dir).orders
    path = scratch_path(spark, "append")
    cut = F.coalesce(F.col("o_orderdate") < ts_literal("1998-01-01 00:00:00"), F.lit(False))
    b1 = o.filter(cut).withColumn("batch_id", batch_id(ts_literal(B1)))
    b2 = o.filter(~cut).withColumn("batch_id", batch_id(ts_literal(B2)))
    for b in (b1, b2, b2):
        writers.append_batch(b, path)
    return spark.read.parquet(path).select(*o.columns, "batch_id")


@register("partitioned_readback", with_ctes(*FACT_CORE) + """
SELECT CAST(transaction_time AS DATE) AS partition_date, CAST(count(*) AS BIGINT) AS row_count,
       CAST(count(DISTINCT channel_id) AS BIGINT) AS channels
FROM fact_sales GROUP BY 1""")
def partitioned_readback(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "fact-partitioned")
    writers.write_partitioned(model.fact_lines(t), path, "l_shipdate",
                              ["c_mktsegment", model.PRODUCT_JOIN_KEY, "o_custkey"],
                              derive=lambda lines: model.fact_columns(lines, carry=["partition_date"]))
    back = spark.read.parquet(path)
    return back.groupBy("partition_date").agg(F.count(F.lit(1)).cast("bigint").alias("row_count"),
                                               F.countDistinct("channel_id").cast("bigint").alias("channels"))


LAYER_SQL = with_ctes(*FACT_CORE, DIM_CHANNEL, RAW_SALES, DIRTY_SALES) + """
, counts AS (
  SELECT 0 AS layer_order, 'raw' AS layer, 'sales_data' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM dirty_sales
  UNION ALL SELECT 1, 'staging', 'sales_clean', count(*) FROM dirty_sales
     WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND quantity > 0 AND unit_price > 0
  UNION ALL SELECT 2, 'core', 'fact_sales', count(*) FROM fact_sales
  UNION ALL SELECT 3, 'mart', 'sales_summary', count(*) FROM (
     SELECT DISTINCT dc.channel_name, dp.product_name, dp.category, CAST(fs.transaction_time AS DATE)
     FROM fact_sales fs JOIN dim_channel dc ON fs.channel_id = dc.channel_id
     JOIN dim_product dp ON fs.product_id = dp.product_id) m)
"""


def _layers(spark, sf_dir):
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "layers")
    return layers.load_layers(spark, t, lambda sold: fixtures.dirty_sales(t, sold), base, ts_literal(BATCH_TS))


@register("load_layers_counts", LAYER_SQL + "SELECT * FROM counts")
def load_layers_counts(spark, sf_dir):
    return _layers(spark, sf_dir)


@register("validate_layers", LAYER_SQL + "SELECT layer_order, layer, rows, rows > 0 AS passed FROM counts")
def validate_layers(spark, sf_dir):
    return gates.validate_layers(_layers(spark, sf_dir))


@register("ingest_feed_incremental", f"SELECT {ORDERS_COLS} FROM orders")
def ingest_feed_incremental(spark, sf_dir):
    """Existing table holds orders before 1998; the landed feed re-delivers
    1997 onwards; only keys not yet present are added."""
    o = Tables(spark, sf_dir).orders
    base = scratch_path(spark, "feed")
    existing_path = writers.replace_table(o.filter(F.col("o_orderdate") < ts_literal("1998-01-01 00:00:00")),
                                          f"{base}/table")
    late = (F.col("o_orderdate") >= ts_literal("1997-01-01 00:00:00")) | F.col("o_orderdate").isNull()
    feed_path = ingest.land_files(o.filter(late),
                                  f"{base}/landing", None, ["o_orderkey"])
    existing = spark.read.parquet(existing_path)
    feed = spark.read.schema(o.schema).parquet(feed_path)
    return ingest.incremental_union(existing, feed, ["o_orderkey"])


@register("gen_sales_backbone", """
SELECT printf('ORD_%08d', o_orderkey) AS order_id, printf('PROD_%05d', o_orderkey % 100 + 1) AS product_id,
       printf('CUST_%05d', o_orderkey % 500) AS customer_id,
       TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(o_orderkey AS BIGINT)) AS order_date
FROM orders""")
def gen_sales_backbone(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return generators.sales_backbone(o, "o_orderkey").drop("_i")


@register("format_ids", """
SELECT o_orderkey, printf('ORD_%08d', o_orderkey) AS order_id, printf('CUST_%05d', o_custkey) AS customer_id,
       printf('ORD_%06d', o_orderkey) AS order_id_short, printf('PROD_%03d', o_orderkey) AS narrow_id
FROM orders""")
def format_ids(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", format_id("ORD", 8, "o_orderkey").alias("order_id"),
                    format_id("CUST", 5, "o_custkey").alias("customer_id"),
                    format_id("ORD", 6, "o_orderkey").alias("order_id_short"),
                    format_id("PROD", 3, "o_orderkey").alias("narrow_id"))


@register("sanitize_id", r"""
SELECT c_custkey, regexp_replace(c_name, '[^\p{L}\p{N}_-]', '', 'g') AS customer_key,
       regexp_replace(c_mktsegment || ' #' || c_name, '[^\p{L}\p{N}_-]', '', 'g') AS job_id
FROM customer""")
def sanitize_id_q(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", sanitize_id("c_name").alias("customer_key"),
                    sanitize_id(F.concat("c_mktsegment", F.lit(" #"), "c_name")).alias("job_id"))


@register("file_stem", "SELECT 'lineitem' AS file_stem, CAST(count(*) AS BIGINT) AS row_count FROM lineitem")
def file_stem_q(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "_metadata.file_path")
    # one row per file before the stem is cut out
    per_file = li.groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy(file_stem("file_path").alias("file_stem")).agg(F.sum("n").cast("bigint").alias("row_count"))


@register("bucketed_product_sales", """
SELECT l_partkey AS product_source_key, p_name AS product_name, CAST(count(*) AS BIGINT) AS lines,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL""")
def bucketed_product_sales(spark, sf_dir):
    """Sales lines and products as tables in equal buckets of the product: joined and summed without an exchange."""
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "bucketed")
    name = base.rsplit("/", 1)[1].replace("-", "_")
    key, n = model.PRODUCT_JOIN_KEY, ingest.session_files(spark)
    lines = writers.write_bucketed(
        t.lineitem.select(F.col("l_partkey").alias(key), F.col("l_quantity").cast("bigint").alias("quantity"), "l_shipdate"),
        f"{base}/lines", f"{name}_lines", key, n, ["l_shipdate"])
    products = writers.write_bucketed(model.dim_product(t).select(key, "product_name"), f"{base}/products",
                                      f"{name}_products", key, n)
    return lines.join(products, key).groupBy(key, "product_name").agg(
        F.count(F.lit(1)).cast("bigint").alias("lines"), F.sum("quantity").cast("bigint").alias("quantity"))


@register("replace_view", f"SELECT {ORDERS_COLS} FROM orders")
def replace_view(spark, sf_dir):
    """A view over orders up to 1997 is replaced by one over all; a write that fails in between changes nothing."""
    o = Tables(spark, sf_dir).orders
    base = scratch_path(spark, "view")
    name = base.rsplit("/", 1)[1].replace("-", "_")
    early = F.col("o_orderdate") < ts_literal("1998-01-01 00:00:00")
    writers.replace_view(o.filter(early), base, name)
    shown = spark.table(name).count()
    try:
        writers.replace_view(o.withColumn("o_orderkey", F.when(early, F.col("o_orderkey")).otherwise(
            F.raise_error(F.lit("refused")).cast("bigint"))), base, name)
    except PySparkException:
        pass
    if spark.table(name).count() != shown:
        raise AssertionError("a failed write changed the view")
    writers.replace_view(o, base, name)
    return spark.table(name)
