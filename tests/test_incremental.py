"""Incremental layered load: periods touched, rejects, refused batches, order of batches."""

import datetime as dt

import pytest

from martforge.operators import gates
from martforge.plans import incremental as inc

SCHEMA = ("order_id string, line_no bigint, product_id string, customer_id string, channel string, region string, "
          "quantity bigint, unit_price double, total_amount double, order_date timestamp_ntz")


def line(order, day, qty=1, product="P1", channel="Web", no=1, customer="C1", price=2.0):
    when = None if day is None else dt.datetime(2024, 1, day, 10)
    return (order, no, product, customer, channel, None, qty, price, (qty or 0) * price, when)


ONE = [line("A", 1), line("A", 1, 2, no=2), line("B", 2, 3), line("C", 3, 4, "P2", "Shop")]
# day two again: B corrected, a new line, and rows that break one or several rules
TWO = [line("B", 2, 5), line("D", 2, 1, "P2"), line(None, 2, 1), line("E", 2, -1, None), line("F", None, 1),
       *[line(f"G{i}", 2) for i in range(12)]]
THREE = [line("H", 4), line("H", 4), line("C", 3, 9, "P2", "Shop")]
TIMES = ("2024-02-01 00:00:00", "2024-02-02 00:00:00", "2024-02-03 00:00:00")


def mart(spark, base):
    return sorted(tuple(r) for r in spark.read.parquet(f"{base}/{inc.MART}").select(
        "channel", "product_id", "sales_date", "total_quantity", "total_revenue", "order_count").collect())


def load(spark, base, order=(0, 1, 2)):
    for i in order:
        inc.load_batch(spark, base, spark.createDataFrame((ONE, TWO, THREE)[i], SCHEMA), TIMES[i])


@pytest.fixture(scope="module")
def loaded(spark):
    from martforge.session import scratch_path
    base = scratch_path(spark, "incremental")
    load(spark, base)
    return base


def test_newest_clean_record_counts(spark, loaded):
    day = lambda d: dt.date(2024, 1, d)
    assert mart(spark, loaded) == sorted([
        ("Web", "P1", day(1), 3, 6.0, 1), ("Web", "P1", day(2), 17, 34.0, 13), ("Web", "P2", day(2), 1, 2.0, 1),
        ("Shop", "P2", day(3), 9, 18.0, 1), ("Web", "P1", day(4), 1, 2.0, 1)])
    staged = spark.read.parquet(f"{loaded}/{inc.STAGING}")
    assert staged.filter("order_id = 'B' and period = '2024-01-02'").first().batch_id == "batch_20240202_000000"
    core = spark.read.parquet(f"{loaded}/{inc.CORE}")
    assert core.count() == staged.count() == core.select("sales_key").distinct().count()
    assert core.filter("order_id = 'A'").first().batch_id == "batch_20240201_000000"


def test_rejects_carry_every_broken_rule(spark, loaded):
    got = inc.reject_counts(spark, loaded).collect()
    assert {r.batch_id for r in got} == {"batch_20240202_000000"}
    assert {r.rule: r.rejected for r in got} == {"order_id_null": 1, "product_id_null": 1, "quantity_not_positive": 1, "order_date_null": 1,
                     "total_amount_negative": 1}
    raw = spark.read.parquet(f"{loaded}/{inc.RAW}").count()
    assert raw == len(ONE) + len(TWO) + len(THREE)
    assert spark.read.parquet(f"{loaded}/{inc.REJECTS}").count() == 3


def test_other_days_keep_their_files(spark, scratch):
    base = scratch("incremental-files")
    load(spark, base, (0,))
    for table in (inc.STAGING, inc.CORE, inc.MART):
        before = {r[0] for r in spark.read.parquet(f"{base}/{table}").selectExpr("_metadata.file_path").distinct().collect()}
        assert len(before) >= 3
    changed = {}
    for table in (inc.STAGING, inc.CORE, inc.MART):
        changed[table] = inc.touched(lambda: load(spark, base, (1,)), spark, f"{base}/{table}")
    for files in changed.values():
        assert files and all("period=2024-01-02" in f for f in files)


def test_batches_in_any_order_and_again(spark, loaded, scratch):
    base = scratch("incremental-order")
    load(spark, base, (2, 1, 0, 1, 1))
    assert mart(spark, base) == mart(spark, loaded)


def test_line_on_two_days_is_refused(spark, scratch):
    base = scratch("incremental-moved")
    load(spark, base, (0,))
    before = mart(spark, base)
    moved = spark.createDataFrame([line("B", 3, 5), line("D", 2, 1)], SCHEMA)
    with pytest.raises(gates.QualityGateError, match="primary_key"):
        inc.load_batch(spark, base, moved, TIMES[1])
    assert mart(spark, base) == before


def test_refused_batch_changes_nothing(spark, scratch):
    base = scratch("incremental-refused")
    load(spark, base, (0,))
    before = mart(spark, base)
    bad = spark.createDataFrame([line("B", 2, 7), line("X", 2, -1), line(None, 1)], SCHEMA)
    with pytest.raises(gates.QualityGateError, match="clean_rows"):
        inc.load_batch(spark, base, bad, TIMES[1])
    assert mart(spark, base) == before
    assert spark.read.parquet(f"{base}/{inc.REJECTS}").filter("batch_id = 'batch_20240202_000000'").count() == 2
    with pytest.raises(gates.QualityGateError, match="no data"):
        inc.load_batch(spark, base, bad.limit(0), "2024-02-05 00:00:00")
    load(spark, base, (2,))  # the next batch is loaded as usual
    assert len(mart(spark, base)) == len(before) + 1


def test_broken_contract_publishes_nothing(spark, scratch, monkeypatch):
    from pyspark.sql import functions as F
    from martforge.plans import curated
    base = scratch("incremental-contract")
    load(spark, base, (0,))
    before = mart(spark, base)
    monkeypatch.setattr(curated, "fct_checks", lambda: {"small": F.col("quantity") < 5})
    with pytest.raises(gates.QualityGateError, match="core contract: check:small=1"):
        load(spark, base, (1,))
    assert mart(spark, base) == before


def test_layers_must_hold_rows(spark):
    empty = spark.createDataFrame([(i, n, 0 if n == "mart" else 5) for i, n in enumerate(gates.LAYERS)],
                                  "layer_order int, layer string, rows bigint")
    assert {r.layer: r.passed for r in gates.validate_layers(empty).collect()} == {
        "raw": True, "staging": True, "core": True, "mart": False}


def test_view_shows_old_rows_until_the_new_are_written(spark, scratch):
    from pyspark.errors import PySparkException
    from martforge.sources import writers
    base = scratch("view")
    writers.replace_view(spark.range(5), base, "shown_numbers")
    with pytest.raises(PySparkException):
        writers.replace_view(spark.range(9).selectExpr("if(id > 3, cast(raise_error('no') as bigint), id) as id"),
                             base, "shown_numbers")
    assert spark.table("shown_numbers").count() == 5
    writers.replace_view(spark.range(7), base, "shown_numbers")
    assert spark.table("shown_numbers").count() == 7
