"""The layered load: lines joined once, packed rows in its shuffles, nothing left beside the layers."""

import datetime as dt
import math
from decimal import Decimal

from pyspark.sql import functions as F

from martforge import session
from martforge.functions import packing
from martforge.functions.columns import ts_literal
from martforge.operators import marts
from martforge.plans import fixtures, layers, model
from martforge.sources.tables import Tables

DAY = dt.datetime(1997, 5, 6)
BATCH = "2024-01-01 00:00:00"


def _tables(spark, base):
    """A few orders with what the packed forms do not hold: nulls, repeated keys, fractions, times of day, large numbers."""
    wide = dt.datetime(2600, 1, 1, 3, 4, 5, 678)
    lines = [
        (1, 1, 1, 1, 2.0, 10.5, 0.07, DAY), (1, 2, 1, 2, 3.0, 0.0, 0.0, DAY), (1, 3, 1, 3, 1.0, -7.25, 0.1, DAY),
        (2, 1, 2, 1, 5.0, 99.99, 0.05, wide), (2, 1, 2, 1, 5.0, 99.99, 0.05, wide), (2, 99, 2, 2, 1.0, 1.0, 0.0, DAY),
        (3, 2, None, 1, 4.0, 12345678.91, 0.99, DAY), (4, 2, 1 << 40, 1, 50000.0, 3.0, 0.01, DAY),
        (5, None, 1, 1, 1.0, 1.0, 0.0, DAY), (None, 1, 1, 1, 1.0, 1.0, 0.0, DAY), (77, 1, 1, 1, 1.0, 1.0, 0.0, DAY),
        ((1 << 41) + 3, 2, 1, 1, 2.0, 10.123456, 0.0, DAY), (-6, 3, 1, 300, 2.0, 10.0, 0.0, None), (4, 3, 1, 9, 2.5, 10.0, 0.02, DAY),
        (4, 3, 1, 10, None, 10.0, 0.02, DAY), (4, 3, 1, 11, 0.0, None, 0.02, DAY), (4, 3, 1, 12, 3.0, 8.0, None, DAY),
    ]
    rows = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                            "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz"),
        "orders": ([(1, 1, DAY), (2, 2, DAY), (2, 2, DAY), (3, 3, wide), (4, 1, None), (5, 4, DAY), (6, None, DAY), (9, 1, DAY),
                    ((1 << 41) + 3, 1, DAY), (-6, 2, DAY)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "customer": ([(1, "AUTO", 1, "a"), (2, "HOME", 2, "b"), (3, None, 1, "c"), (4, "auto", None, "d")],
                     "c_custkey long, c_mktsegment string, c_nationkey int, c_name string"),
        "part": ([(1, "bolt", "STEEL", "B", 1.5), (2, "nut", "TIN", "B", 2.5), (3, "bolt", "STEEL", "C", 0.25), (2, "nut", "TIN", "B", 2.5)],
                 "p_partkey long, p_name string, p_type string, p_brand string, p_retailprice double"),
        "nation": ([(1, "N", 1), (2, "M", 1), (2, "M", 2)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(1, "R"), (2, "S")], "r_regionkey int, r_name string"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).repartition(2).write.parquet(f"{base}/{name}.parquet")
    return Tables(spark, base)


def _same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    assert dict(a.dtypes) == dict(b.dtypes)
    got, want = (sorted(map(str, x.select(columns).collect())) for x in (a, b))
    assert got == want


def test_packed_rows_come_back(spark):
    words = {"w": {"d": packing.Field(packing.HUNDREDTHS, 16), "t": packing.Field(packing.DAYS, 16),
                   "n": packing.Field(packing.WHOLE, 8), "m": packing.Field(packing.units(4), 24, signed=True)}}
    day = dt.datetime(2001, 2, 3)
    rows = [(1, 0.07, day, 5, Decimal("-1.2345")), (2, 655.35, day, 255, Decimal("838.8607")),  # these two fit
            (3, 655.36, day, 5, Decimal(0)), (4, -0.0, day, 5, Decimal(0)), (5, math.nan, day, 5, Decimal(0)),
            (6, math.inf, day, 5, Decimal(0)), (7, 0.123, day, 5, Decimal(0)), (8, 1.0, day.replace(hour=1), 5, Decimal(0)),
            (9, 1.0, day, 256, Decimal(0)), (10, 1.0, day, -1, Decimal(0)), (11, 1.0, dt.datetime(1960, 1, 1), 5, Decimal(0)),
            (12, 1.0, day, 5, Decimal("838.8608")), (13, None, day, 5, Decimal(0)), (14, 1.0, None, 5, Decimal(0)),
            (15, 1.0, day, None, Decimal(0)), (16, 1.0, day, 5, None), (17, 1e300, day, 5, Decimal(10) ** 29)]
    df = spark.createDataFrame(rows, "k int, d double, t timestamp_ntz, n bigint, m decimal(34,4)")
    narrow = packing.pack(df, words)
    assert {r.k for r in narrow.filter("w is not null").collect()} == {1, 2}
    assert {r.k for r in narrow.filter("w_rest is null").collect()} == {1, 2}
    _same(packing.unpack(narrow, words, df), df)


def test_joined_lines_give_the_same_feed_and_fact(spark, scratch):
    t = _tables(spark, scratch("odd"))
    sold = model.sold_lines(t)
    _same(sold.drop("c_nationkey"), model.line_headers(t).drop("o_orderkey"))
    _same(fixtures.dirty_sales(t, sold), fixtures.dirty_sales(t))
    _same(model.fact_sales(t, sold=sold, carry=["product_name"]), model.fact_sales(t, carry=["product_name"]))


def test_packed_summary_is_the_summary(spark, scratch):
    t = _tables(spark, scratch("odd"))
    fact = model.fact_sales(t, carry=["product_name", "category"])
    _same(marts.sales_summary(fact, model.dim_channel(t), words=model.SUMMARY_WORDS),
          marts.sales_summary(fact, model.dim_channel(t)))


def test_layers_join_once_and_leave_no_scratch(spark, scratch, monkeypatch):
    """Before, raw and core each joined the lines to their orders, in columns of 8 bytes, and shuffle files stayed."""
    t, base, plans, cleaned = _tables(spark, scratch("odd")), scratch("layers"), {}, []
    replace = layers.replace_table

    def replace_table(df, path):
        plans[path.removeprefix(f"{base}/")] = df._jdf.queryExecution().optimizedPlan().toString()
        cleaned.append(spark.conf.get(next(iter(session.DROP_SHUFFLES)), "false"))
        return replace(df, path)

    monkeypatch.setattr(layers, "replace_table", replace_table)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    counts = layers.load_layers(spark, t, lambda sold: fixtures.dirty_sales(t, sold), base, ts_literal(BATCH))
    got = {r.layer: r.rows for r in counts.collect()}
    assert got == {"raw": fixtures.dirty_sales(t).count(), "staging": spark.read.parquet(f"{base}/staging/sales_clean").count(),
                   "core": model.fact_sales(t).count(),
                   "mart": marts.sales_summary(model.fact_sales(t), model.dim_channel(t), model.dim_product(t)).count()}
    assert got["staging"] > 0
    joined = next(p for p in plans if "sold-lines" in p)
    assert [p for p, plan in plans.items() if "o_orderkey" in plan] == [joined]
    for path, word in (("core/fact_sales", "sale_a"), ("mart/sales_summary", "sum_a")):
        assert word in plans[path]
    assert set(cleaned) == {"true"}
    assert not session.path_exists(spark, joined)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split
    assert spark.conf.get(next(iter(session.DROP_SHUFFLES)), "false") == "false"


def test_a_failed_load_leaves_no_scratch(spark, scratch, monkeypatch):
    t, base, seen = _tables(spark, scratch("odd")), scratch("layers"), []
    monkeypatch.setattr(layers, "scratch_path", lambda s, name: seen.append(session.scratch_path(s, name)) or seen[-1])
    try:
        layers.load_layers(spark, t, lambda sold: sold.select(F.raise_error(F.lit("refused")).alias("x")), base, ts_literal(BATCH))
    except Exception as e:
        assert "refused" in str(e)
    else:
        raise AssertionError("the load went on")
    assert seen and not session.path_exists(spark, seen[0])
