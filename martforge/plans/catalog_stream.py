"""Registered queries: tumbling totals, streaming forms, per-batch scorecards."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import batch_id_text, ts_literal
from ..operators import gates, scd2
from ..session import scratch_path
from ..sources import feeds, ingest
from ..sources.tables import Tables
from ..sources.writers import as_table
from ..streaming import batches, landing, runner, windows
from . import dim_store, fixtures, model
from .catalog_scd2 import DIM_OUT, DIM_V1, INCOMING, MERGED, PRODUCT_SOURCE, V1
from .registry import BATCH_TS, register, with_ctes
from .sqlparts import RAW_SALES

BUCKET = "time_bucket(INTERVAL '2 hours', ts)"
TUMBLING_SQL = f"""
SELECT {BUCKET} AS window_start, {BUCKET} + INTERVAL '2 hours' AS window_end,
       CAST(count(*) AS BIGINT) AS event_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events GROUP BY {BUCKET}"""


@register("tumbling_2h", TUMBLING_SQL)
def tumbling_2h(spark, sf_dir):
    return windows.tumbling(Tables(spark, sf_dir).events, "ts")


def _land_events(spark, sf_dir, name):
    ev = Tables(spark, sf_dir).events
    base = scratch_path(spark, name)
    # time-ordered files, read in one micro-batch: no row is late by file order
    ingest.land_files(ev, f"{base}/landing", None, ["ts"])
    return ev.schema, base


@register("stream_tumbling_2h", f"""
SELECT * FROM ({TUMBLING_SQL}) w
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '24 hours'""")
def stream_tumbling_2h(spark, sf_dir):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema, base = _land_events(spark, sf_dir, "stream-tumbling")
    s = runner.read_landed(spark, f"{base}/landing", schema)
    out = runner.run_to_parquet(windows.stream_tumbling(s, "ts"), f"{base}/out", f"{base}/_checkpoint")
    return spark.read.parquet(out)


@register("stream_dedup", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts) AS rn FROM events) WHERE rn = 1""")
def stream_dedup(spark, sf_dir):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema, base = _land_events(spark, sf_dir, "stream-dedup")
    for _ in range(2):
        s = runner.read_landed(spark, f"{base}/landing", schema)
        out = runner.run_to_parquet(windows.stream_dedup(s, ["event_id"], "ts"), f"{base}/out", f"{base}/_checkpoint")
        # a third of the events is delivered again before the second run
        again = spark.read.schema(schema).parquet(f"{base}/landing").filter("event_id % 3 = 0")
        ingest.land_files(as_table(again, "events-again"), f"{base}/landing", None, ["ts"], mode="append")
    return spark.read.schema(schema).parquet(out)


def _per_delivery_sql() -> str:
    m = """m AS (
  SELECT CAST(year(order_date) AS BIGINT) AS delivery, count(*) AS n,
         count(*) FILTER (WHERE order_id IS NULL) AS oid_nulls,
         count(DISTINCT order_id) AS oid_distinct,
         count(*) FILTER (WHERE product_id IS NULL) AS pid_nulls,
         coalesce(bool_and(coalesce(quantity >= 0 AND quantity <= 1000, FALSE)), TRUE) AS qty_ok,
         coalesce(bool_and(coalesce(unit_price >= 0 AND unit_price <= 10000, FALSE)), TRUE) AS price_ok
  FROM raw_sales GROUP BY 1)"""
    cards = """cards AS (
  SELECT delivery, 1 AS check_order, 'row_count_check' AS check_name, n BETWEEN 1 AND 10000000 AS passed,
         CAST(n AS DOUBLE) AS observed FROM m
  UNION ALL SELECT delivery, 2, 'order_id_not_null', oid_nulls = 0, CAST(oid_nulls AS DOUBLE) FROM m
  UNION ALL SELECT delivery, 3, 'product_id_not_null', pid_nulls = 0, CAST(pid_nulls AS DOUBLE) FROM m
  UNION ALL SELECT delivery, 4, 'quantity_range_check', qty_ok, CAST(CAST(qty_ok AS INTEGER) AS DOUBLE) FROM m
  UNION ALL SELECT delivery, 5, 'unit_price_range_check', price_ok, CAST(CAST(price_ok AS INTEGER) AS DOUBLE) FROM m
  UNION ALL SELECT delivery, 6, 'order_id_unique', oid_distinct = n, CAST(oid_distinct AS DOUBLE) FROM m)"""
    return with_ctes(RAW_SALES, m, cards) + f"""
SELECT delivery, check_order, check_name, passed, CAST(CASE WHEN passed THEN 100.0 ELSE 0.0 END AS DOUBLE) AS score,
       observed,
       (count(*) FILTER (WHERE passed) OVER (PARTITION BY delivery)) * 100.0
         / count(*) OVER (PARTITION BY delivery) >= {gates.PRE_TRANSFORM_GATE} AS gate_passed
FROM cards"""


@register("stream_dq_per_batch", _per_delivery_sql())
def stream_dq_per_batch(spark, sf_dir):
    """Raw sales arrive as deliveries, one per order year, landed as files;
    a streaming run scores every delivery of a micro-batch on its own (suite
    2, one grouped aggregate), takes the gate-80 decision per delivery and
    publishes or quarantines it. Scorecards are read by delivery."""
    raw = model.raw_sales(Tables(spark, sf_dir)).withColumn("delivery", F.year("order_date").cast("bigint"))
    base = scratch_path(spark, "stream-dq")
    land = f"{base}/landing"
    ingest.land_files(raw, land, None, ["delivery", "order_id", "line_no"])
    runner.run_foreach_batch(runner.read_landed(spark, land, raw.schema),
                             batches.scored_publisher(base, delivery_col="delivery"), f"{base}/_checkpoint")
    cards = spark.read.parquet(f"{base}/scorecards")
    return cards.select("delivery", "check_order", "check_name", "passed", "score", "observed", "gate_passed")


@register("stream_scd2_apply", with_ctes(PRODUCT_SOURCE, DIM_V1, INCOMING, MERGED) + f"SELECT {DIM_OUT} FROM merged")
def stream_scd2_apply(spark, sf_dir):
    """Two daily product extracts land one after the other (the whole part
    table, then the change batch), each stamped with its snapshot time; a
    streaming run after each landing applies the new files to the versioned
    type-2 dimension. The result is the full dimension (closed and current
    versions), the same rows as the batch merge."""
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "stream-scd2")
    land, dim, ckpt = f"{base}/landing", f"{base}/dim_product", f"{base}/_checkpoint"
    for snap, extract in ((V1, fixtures.product_source(t)), (BATCH_TS, fixtures.incoming_products(t))):
        landed = extract.withColumn("extracted_at", ts_literal(snap))
        schema = landed.schema
        ingest.land_files(landed, land, None, ["product_id"], mode="append")
        runner.run_foreach_batch(runner.read_landed(spark, land, schema), batches.scd2_applier(dim), ckpt)
    out = dim_store.read_dimension(spark, dim)
    return out.withColumn("unit_cost", F.col("unit_cost").cast("double")).select(*scd2.DIM_COLUMNS)


# Landed CSV lines of the orders: some with a quoted text, some too short, some with a number that is none.
QUOTED_MOD, SHORT_MOD, TEXT_MOD = 41, 31, 37
LANDED_SCHEMA = "order_key bigint, customer_key bigint, total double, note string"
MALFORMED_SQL = f"o_orderkey % {SHORT_MOD} = 0 OR o_orderkey % {TEXT_MOD} = 0"


def _land_order_lines(spark, sf_dir, base):
    """Order lines as CSV text under one folder per order year; returns the landing folder."""
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    total = F.col("o_totalprice").cast("string")
    line = (F.when(F.col("o_orderkey") % SHORT_MOD == 0, F.concat_ws(",", key, cust))
            .when(F.col("o_orderkey") % TEXT_MOD == 0, F.concat_ws(",", F.concat(F.lit("no"), key), cust, total, F.lit("x")))
            .when(F.col("o_orderkey") % QUOTED_MOD == 0,
                  F.concat_ws(",", key, cust, total, F.concat(F.lit('"say ""'), "o_orderpriority", F.lit('"", then"'))))
            .otherwise(F.concat_ws(",", key, cust, total, F.col("o_orderpriority"))))
    (Tables(spark, sf_dir).orders.select(line.alias("order_key,customer_key,total,note"),
                                         F.year("o_orderdate").alias("order_year"))
     .repartitionByRange("order_year", F.rand(7)).write.partitionBy("order_year")
     .options(header=True, quote="", sep="\u0001", escapeQuotes=False).csv(f"{base}/landing"))
    return f"{base}/landing"


@register("stream_csv_quarantine", f"""
SELECT 'row' AS state, o_orderkey AS order_key, o_custkey AS customer_key, o_totalprice AS total,
       CASE WHEN o_orderkey % {QUOTED_MOD} = 0 THEN 'say "' || o_orderpriority || '", then' ELSE o_orderpriority END AS note,
       CAST(NULL AS VARCHAR) AS record
FROM orders WHERE NOT ({MALFORMED_SQL})
UNION ALL
SELECT 'malformed', NULL, NULL, NULL, NULL,
       CASE WHEN o_orderkey % {SHORT_MOD} = 0 THEN printf('%d,%d', o_orderkey, o_custkey) ELSE 'no' || o_orderkey END
FROM orders WHERE {MALFORMED_SQL}""")
def stream_csv_quarantine(spark, sf_dir):
    """Landed CSV with quoted texts, short lines and wrong numbers: good rows typed, the others kept as text
    (of a wrong number its first field is shown)."""
    base = scratch_path(spark, "stream-csv")
    schema = StructType.fromDDL(LANDED_SCHEMA)
    landing.ingest_csv(spark, _land_order_lines(spark, sf_dir, base), schema, base, f"{base}/_checkpoint")
    rows = spark.read.schema(schema).parquet(f"{base}/{landing.ROWS}").select(
        F.lit("row").alias("state"), *schema.fieldNames(), F.lit(None).cast("string").alias("record"))
    record = F.when(F.col("record").startswith("no"), F.substring_index("record", ",", 1)).otherwise(F.col("record"))
    bad = spark.read.schema("record string").parquet(f"{base}/{landing.MALFORMED}").select(
        F.lit("malformed").alias("state"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields],
        record.alias("record"))
    return rows.unionByName(bad)


@register("ingest_ledger", f"""
SELECT order_year, records, malformed,
       CAST(sum(records) OVER (ORDER BY order_year) AS BIGINT) AS processed_records,
       CAST(sum(records) OVER () AS BIGINT) AS total_records,
       CAST(sum(records) OVER (ORDER BY order_year) AS DOUBLE) / CAST(sum(records) OVER () AS DOUBLE) * 100.0
         AS completion_percentage
FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(count(*) AS BIGINT) AS records,
             CAST(count(*) FILTER (WHERE {MALFORMED_SQL}) AS BIGINT) AS malformed
      FROM orders GROUP BY ALL) y""")
def ingest_ledger(spark, sf_dir):
    """The recorded ledger of a stream that is run after each year's files have landed."""
    base = scratch_path(spark, "ingest-ledger")
    landed = _land_order_lines(spark, sf_dir, base)
    total = Tables(spark, sf_dir).orders.count()
    years = sorted(r[0] for r in Tables(spark, sf_dir).orders.select(F.year("o_orderdate")).distinct().collect())
    schema = StructType.fromDDL(LANDED_SCHEMA)
    for year in years:  # the years that have landed so far
        so_far = "{" + ",".join(str(y) for y in years if y <= year) + "}"
        landing.ingest_csv(spark, f"{landed}/order_year={so_far}", schema, base, f"{base}/_checkpoint")
    files = landing.ledger(spark, base, total)
    year = F.regexp_extract("source_file", "order_year=(\\d+)", 1).cast("int").alias("order_year")
    return files.groupBy(year).agg(
        F.sum("records").alias("records"), F.sum("malformed").alias("malformed"),
        F.max("processed_records").alias("processed_records"), F.max("total_records").alias("total_records"),
        F.max("completion_percentage").alias("completion_percentage"))


@register("scd2_late_extract", with_ctes(PRODUCT_SOURCE, DIM_V1, INCOMING, MERGED) + f"SELECT {DIM_OUT} FROM merged")
def scd2_late_extract(spark, sf_dir):
    """The change batch arrives before the first extract: the same dimension as in the order of their times."""
    t = Tables(spark, sf_dir)
    base = f"{scratch_path(spark, 'late-scd2')}/dim_product"
    for ts, extract in ((BATCH_TS, fixtures.incoming_products(t)), (V1, fixtures.product_source(t))):
        dim_store.apply_batch(spark, base, extract, ts_literal(ts), batch_id_text(ts))
    out = dim_store.read_dimension(spark, base)
    return out.withColumn("unit_cost", F.col("unit_cost").cast("double")).select(*scd2.DIM_COLUMNS)


@register("stream_dq_sealed", _per_delivery_sql())
def stream_dq_sealed(spark, sf_dir):
    """Each delivery (an order year) lands over three triggers and is scored once, when its last rows are there."""
    raw = model.raw_sales(Tables(spark, sf_dir)).withColumn("delivery", F.year("order_date").cast("bigint"))
    base = scratch_path(spark, "stream-sealed")
    raw = as_table(raw, "sealed-source")  # the joins run once for the manifest and the three landings
    sizes = as_table(raw.groupBy("delivery").agg(F.count(F.lit(1)).alias("rows")), "delivery-manifest")
    for third in range(3):
        ingest.land_files(raw.filter(F.pmod("line_no", F.lit(3)) == third), f"{base}/landing", None,
                          ["delivery", "order_id", "line_no"], mode="append")
        runner.run_foreach_batch(runner.read_landed(spark, f"{base}/landing", raw.schema),
                                 batches.sealed_publisher(base, f"{base}/_checkpoint", lambda: sizes), f"{base}/_checkpoint")
    cards = spark.read.parquet(f"{base}/scorecards")
    return cards.select(F.col("delivery").cast("bigint").alias("delivery"), "check_order", "check_name", "passed", "score",
                        "observed", "gate_passed")


@register("ingest_feed_redelivery", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def ingest_feed_redelivery(spark, sf_dir):
    """Orders land in three deliveries that overlap; what is delivered again (here with another priority) adds nothing."""
    o = Tables(spark, sf_dir).orders
    base = scratch_path(spark, "feed-once")
    year = F.coalesce(F.year("o_orderdate"), F.lit(0))
    seen = None
    for low, high in ((0, 1995), (1994, 1997), (1996, 9999)):
        part = o.filter((year >= low) & (year <= high))
        if seen is not None:
            again = F.when(year <= seen, F.lit("AGAIN")).otherwise(F.col("o_orderpriority"))
            part = part.withColumn("o_orderpriority", again)
        ingest.land_files(part, f"{base}/landing", None, ["o_orderkey"], mode="append")
        feeds.ingest_feed_once(spark, o.schema, ["o_orderkey"], f"{base}/landing", f"{base}/table", f"{base}/_checkpoint")
        seen = high
    return spark.read.schema(o.schema).parquet(f"{base}/table")
