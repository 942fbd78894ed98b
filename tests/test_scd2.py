"""SCD-2 merge, history and as-of join."""

from pyspark.sql import functions as F

from martforge.functions.columns import ts_literal
from martforge.operators import scd2

SRC = "product_id string, product_name string, category string, brand string, unit_cost decimal(10,2)"


def _src(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame([(a, b, c, d, Decimal(str(e))) for a, b, c, d, e in rows], SRC)


def test_initial_and_merge(spark):
    v1 = scd2.scd2_initial(_src(spark, [("P1", "A", "x", "b", 1.0), ("P2", "B", "x", "b", 2.0),
                                       ("P3", "C", "x", "b", 3.0)]), ts_literal("2024-01-01 00:00:00"))
    inc = _src(spark, [("P1", "A", "x", "b", 1.0), ("P2", "B", "x", "b", 2.5), ("P4", "D", "y", "b", 4.0)])
    merged = scd2.scd2_merge(v1, inc, ts_literal("2024-02-01 00:00:00")).cache()
    rows = merged.collect()
    assert len(rows) == 5
    cur = {r["product_id"]: r for r in rows if r["is_current"]}
    assert set(cur) == {"P1", "P2", "P3", "P4"}
    assert float(cur["P2"]["unit_cost"]) == 2.5
    closed = [r for r in rows if not r["is_current"]]
    assert len(closed) == 1 and closed[0]["product_id"] == "P2"
    assert str(closed[0]["end_date"]) == "2024-02-01 00:00:00"
    assert len({r["product_key"] for r in rows}) == 5
    # re-running the same batch changes nothing
    again = scd2.scd2_merge(merged, inc, ts_literal("2024-02-01 00:00:00"))
    key = lambda r: (r["product_key"], r["is_current"], str(r["end_date"]))
    assert sorted(map(key, again.collect())) == sorted(map(key, rows))


def test_hash_null_positions_differ(spark):
    from martforge.functions.columns import record_hash
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    hs = [r[0] for r in df.select(record_hash("x", "y")).collect()]
    assert hs[0] != hs[1]


def test_history_collapses_and_chains(spark):
    rows = [("P1", "2024-01-01 10:00:00", "S1"), ("P1", "2024-01-02 09:00:00", "S1"),
            ("P1", "2024-01-03 08:00:00", "S2"), ("P1", "2024-01-03 20:00:00", "S3"),
            ("P1", "2024-01-05 00:00:00", "S3")]
    df = spark.createDataFrame(rows, "product_id string, t string, s string").withColumn(
        "t", F.col("t").cast("timestamp_ntz"))
    h = scd2.scd2_history(df, "product_id", "t", ["s"]).orderBy("effective_date").collect()
    assert [(str(r["effective_date"])[:10], r["s"], str(r["end_date"])[:10], r["is_current"]) for r in h] == [
        ("2024-01-01", "S1", "2024-01-03", False), ("2024-01-03", "S2", "2024-01-03", False),
        ("2024-01-03", "S3", "2099-12-31", True)]
    assert str(h[1]["effective_date"])[11:] == "08:00:00" and str(h[1]["end_date"])[11:] == "20:00:00"
    daily = scd2.scd2_history(df, "product_id", "t", ["s"], grain="day").orderBy("effective_date").collect()
    assert [r["s"] for r in daily] == ["S1", "S3"]


def test_asof_half_open_and_left(spark):
    v = spark.createDataFrame([
        ("P1", "2024-01-01 00:00:00", "2024-03-01 00:00:00", "v1"),
        ("P1", "2024-03-01 00:00:00", "2099-12-31 00:00:00", "v2")],
        "product_id string, effective_date string, end_date string, ver string")
    v = v.select("product_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("effective_date", "end_date")], "ver")
    f = spark.createDataFrame([("P1", "2023-12-31 00:00:00"), ("P1", "2024-02-29 23:59:59"),
                               ("P1", "2024-03-01 00:00:00"), ("P1", "2025-06-01 00:00:00"),
                               ("P2", "2024-02-01 00:00:00")], "product_id string, ts string")
    f = f.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    inner = {str(r["ts"]): r["ver"] for r in scd2.asof_join(f, v, "product_id", "ts").collect()}
    assert inner == {"2024-02-29 23:59:59": "v1", "2024-03-01 00:00:00": "v2", "2025-06-01 00:00:00": "v2"}
    left = scd2.asof_join(f, v, "product_id", "ts", how="left").collect()
    assert len(left) == 5 and sum(r["ver"] is None for r in left) == 2


def test_merge_repeated_key_takes_latest(spark):
    v1 = scd2.scd2_initial(_src(spark, [("P1", "A", "x", "b", 1.0)]), ts_literal("2024-01-01 00:00:00"))
    inc = _src(spark, [("P1", "A", "x", "b", 5.0), ("P1", "A", "x", "b", 7.0), ("P1", "A", "x", "b", 6.0)])
    inc = inc.withColumn("seq", F.monotonically_increasing_id())
    assert scd2.duplicate_keys(inc) == ["P1"]
    merged = scd2.scd2_merge(v1, inc, ts_literal("2024-02-01 00:00:00"), order_cols=["seq"]).collect()
    cur = [r for r in merged if r["is_current"]]
    assert len(merged) == 2 and len(cur) == 1 and float(cur[0]["unit_cost"]) == 6.0


def test_apply_batch_refuses_repeated_key(spark, scratch):
    import pytest
    from martforge.plans import dim_store
    base = scratch("dimstore")
    inc = _src(spark, [("P1", "A", "x", "b", 1.0), ("P1", "A", "x", "b", 2.0)])
    with pytest.raises(ValueError, match="repeats product ids"):
        dim_store.apply_batch(spark, base, inc, ts_literal("2024-01-01 00:00:00"), "batch_20240101_000000")
    assert dim_store.current_path(spark, base) is None


def test_store_writes_history_once(spark, scratch):
    from martforge.plans import dim_store
    base = scratch("dimstore-hist")
    days = [("2024-01-01 00:00:00", "batch_20240101_000000", [("P1", "A", 1.0), ("P2", "B", 2.0)]),
            ("2024-01-02 00:00:00", "batch_20240102_000000", [("P1", "A", 1.0), ("P2", "B", 2.5)]),
            ("2024-01-03 00:00:00", "batch_20240103_000000", [("P1", "A", 1.5), ("P2", "B", 2.5)])]
    for ts, bid, rows in days:
        rows = [(p, n, "x", "b", c) for p, n, c in rows]
        dim_store.apply_batch(spark, base, _src(spark, rows), ts_literal(ts), bid)
    # the third version holds the full current set and only the row it closed
    from martforge.schemas import DIM_PRODUCT
    v3 = spark.read.schema(DIM_PRODUCT).parquet(f"{base}/v=batch_20240103_000000")
    assert v3.filter("is_current").count() == 2
    assert [(r["product_id"], float(r["unit_cost"])) for r in v3.filter("NOT is_current").collect()] == [("P1", 1.0)]
    full = dim_store.read_dimension(spark, base).collect()
    assert sorted((r["product_id"], float(r["unit_cost"]), r["is_current"]) for r in full) == [
        ("P1", 1.0, False), ("P1", 1.5, True), ("P2", 2.0, False), ("P2", 2.5, True)]
    assert dim_store.read_current(spark, base).count() == 2


def test_store_ignores_uncommitted_version(spark, scratch):
    from martforge.plans import dim_store
    base = scratch("dimstore-failed")
    rows = [("P1", "A", "x", "b", 1.0)]
    dim_store.apply_batch(spark, base, _src(spark, rows), ts_literal("2024-01-01 00:00:00"), "batch_20240101_000000")
    # a later batch whose write died before commit: data files but no _SUCCESS marker
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{base}/v=batch_20240102_000000/is_current=true")
    import os
    os.remove(f"{base}/v=batch_20240102_000000/is_current=true/_SUCCESS".replace("file:", ""))
    assert dim_store.committed_versions(spark, base) == ["batch_20240101_000000"]
    assert [r["product_id"] for r in dim_store.read_dimension(spark, base).collect()] == ["P1"]


def test_store_takes_an_extract_in_parts(spark, scratch):
    import pytest
    from martforge.plans import dim_store
    rows = [(f"P{i}", "A", "x", "b", float(i)) for i in range(10)]
    base, ts, bid = scratch("dimstore-parts"), ts_literal("2024-01-05 00:00:00"), "batch_20240105_000000"
    first = [(p, n, c, b, v + 100) for p, n, c, b, v in rows]
    dim_store.apply_batch(spark, base, _src(spark, first), ts_literal("2024-01-01 00:00:00"), "batch_20240101_000000")
    for part in (rows[:5], rows[5:], rows[:5], rows):
        dim_store.apply_batch(spark, base, _src(spark, part), ts, bid)
    assert dim_store.committed_versions(spark, base) == ["batch_20240101_000000", bid, f"{bid}_p00001"]
    full = dim_store.read_dimension(spark, base).collect()
    assert sorted((r["product_id"], float(r["unit_cost"])) for r in full if r["is_current"]) == [
        (p, v) for p, *_, v in rows]
    assert len(full) == 20
    # a redelivery of the older batch changes nothing
    old = ts_literal("2024-01-01 00:00:00"), "batch_20240101_000000"
    dim_store.apply_batch(spark, base, _src(spark, first[:3]), *old)
    assert len(dim_store.committed_versions(spark, base)) == 3
    with pytest.raises(ValueError, match="another part"):
        dim_store.apply_batch(spark, base, _src(spark, [("P1", "B", "x", "b", 1.0)]), ts, bid)
    with pytest.raises(ValueError, match="another part"):
        dim_store.apply_batch(spark, base, _src(spark, [("P1", "B", "x", "b", 1.0)]), *old)
    # other rows for its time are spliced in
    dim_store.apply_batch(spark, base, _src(spark, [("P99", "A", "x", "b", 1.0)]), *old)
    late = [r for r in dim_store.read_dimension(spark, base).collect() if r["product_id"] == "P99"]
    assert [(str(r["effective_date"]), r["is_current"]) for r in late] == [("2024-01-01 00:00:00", True)]
    assert dim_store.read_dimension(spark, base).count() == 21


def test_store_takes_extracts_in_any_order(spark, scratch):
    import itertools
    from martforge.plans import dim_store
    # P1 goes back to its first value, P2 comes late, P3 is in some extracts only
    extracts = [[("P1", 1.0)], [("P1", 2.0), ("P2", 5.0)], [("P1", 1.0), ("P3", 7.0)], [("P1", 1.0), ("P2", 5.0)]]
    def load(name, order):
        base = scratch(name)
        for i in order:
            rows = [(p, "A", "x", "b", v) for p, v in extracts[i]]
            dim_store.apply_batch(spark, base, _src(spark, rows), ts_literal(f"2024-01-0{i + 1} 00:00:00"),
                                  f"batch_2024010{i + 1}_000000")
        return sorted(map(str, dim_store.read_dimension(spark, base).select(*scd2.DIM_COLUMNS).collect())), base
    want, _ = load("dim-sorted", (0, 1, 2, 3))
    assert len(want) == 5
    for n, order in enumerate([(3, 2, 1, 0), (0, 2, 1, 3), (2, 0, 3, 1), (1, 1, 3, 0, 3, 2, 0, 1)]):
        got, base = load(f"dim-shuffled-{n}", order)
        assert got == want, order
        current = dim_store.read_current(spark, base).collect()
        assert sorted((r["product_id"], float(r["unit_cost"])) for r in current) == [("P1", 1.0), ("P2", 5.0), ("P3", 7.0)]


def test_store_sets_keyless_rows_aside(spark, scratch):
    from martforge.plans import dim_store
    base = scratch("dimstore-null")
    rows = [(None, "A", "x", "b", 1.0), ("P1", "A", "x", "b", 1.0)]
    for _ in range(2):
        dim_store.apply_batch(spark, base, _src(spark, rows), ts_literal("2024-01-01 00:00:00"), "batch_20240101_000000")
    assert [r["product_id"] for r in dim_store.read_dimension(spark, base).collect()] == ["P1"]
    assert spark.read.parquet(f"{base}_rejected").filter("product_id is null").count() == 2


def test_hash_keeps_values_apart(spark):
    from martforge.functions.columns import hourly, record_hash
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("\\N", "x"), (None, "x")], "x string, y string")
    assert len({r[0] for r in df.select(record_hash("x", "y")).collect()}) == 4
    far = spark.range(1).select(hourly("2024-01-01 00:00:00", F.lit(26)).alias("a"),
                                hourly("2024-01-01 00:00:00", F.lit(2_400_000_000)).alias("b")).selectExpr(
        "cast(a as string) as a", "datediff(b, timestamp_ntz'2024-01-01 00:00:00') as b").first()
    assert far["a"] == "2024-01-02 02:00:00" and far["b"] == 100_000_000
