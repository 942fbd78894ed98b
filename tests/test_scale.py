"""Work that must not grow faster than the input: partitions, passes and bytes of the table queries."""

import contextlib
import datetime as dt
import io
import random
import re

from pyspark.sql import functions as F

from martforge import session
from martforge.operators import ordering, quality, scd2
from martforge.plans import catalog_stream, model
from martforge.sources import writers
from martforge.sources.tables import Tables
from martforge.streaming import batches

SMALL = "/root/testdata/sf0.001"
DAY0 = dt.datetime(2024, 1, 1)


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def test_table_shuffles_follow_the_input(spark):
    try:
        cores = spark.sparkContext.defaultParallelism
        assert session.size_table_shuffles(spark, 1 << 20) == cores
        assert session.size_table_shuffles(spark, 6 << 30) >= (6 << 30) / session.TABLE_SHUFFLE_BYTES
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(session.TABLE_PARTITION_BYTES)
    finally:
        session.size_for_input(spark, 0)


def test_contract_counts_a_short_form_of_the_key(spark):
    df = spark.createDataFrame([("0a",), ("0a",), ("0b",), (None,)], "k string")
    got = quality.contract_violations(df, ["k"], "k", {}, F.unhex("k"))
    assert {r.rule: r.violations for r in got.collect()} == {"not_null:k": 1, "primary_key:k": 1}


def test_history_sorts_its_segments_once(spark):
    rng = random.Random(5)
    rows = [(1 if i % 2 else rng.randrange(40), DAY0 + dt.timedelta(minutes=rng.randrange(3000)), f"S{rng.randrange(3)}")
            for i in range(4000)]
    changes = spark.createDataFrame(rows, "k long, t timestamp_ntz, s string")
    history = scd2.scd2_history(changes.repartition(4), "k", "t", ["s"])
    assert len(re.findall(r"\+- Window|- Window \[", _plan(history))) <= 4  # two over all rows, two over the borders
    want = []
    last = {}
    for k, t, s in rows:
        last[k, t] = max(last.get((k, t), ""), s)
    for key in {k for k, _ in last}:
        states = sorted((t, s) for (k, t), s in last.items() if k == key)
        kept = [x for i, x in enumerate(states) if not i or states[i - 1][1] != x[1]]
        ends = [t for t, _ in kept[1:]] + [dt.datetime(2099, 12, 31)]
        want += [(key, t, s, e) for (t, s), e in zip(kept, ends)]
    got = [(r.k, r.effective_date, r.s, r.end_date) for r in history.collect()]
    assert sorted(got) == sorted(want)


def test_clustered_dedup_shuffles_once(spark):
    df = spark.createDataFrame([(i % 50, i % 7, i) for i in range(500)] + [(None, 1, 1), (None, 1, None)],
                               "k long, a long, b long")
    one = ordering.dedup_latest(df, ["k"], ["a"], clustered=True)
    assert _plan(one).count("Exchange") == 1
    assert sorted(map(str, one.collect())) == sorted(map(str, ordering.dedup_latest(df, ["k"], ["a"]).collect()))


def test_published_folders_are_moved(spark, scratch):
    path, staged = scratch("table"), scratch("staged")
    spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string").write.partitionBy("p").parquet(path)
    spark.createDataFrame([(3, "b"), (4, "c")], "v int, p string").write.partitionBy("p").parquet(staged)
    files = {r[0].rsplit("/", 1)[1] for r in spark.read.parquet(staged).select("_metadata.file_path").collect()}
    writers.publish_partitions(spark, staged, path)
    back = spark.read.parquet(path)
    assert sorted((r.v, r.p) for r in back.collect()) == [(1, "a"), (3, "b"), (4, "c")]
    assert files <= {r[0].rsplit("/", 1)[1] for r in back.select("_metadata.file_path").collect()}
    assert not session.path_exists(spark, staged)


def test_derived_columns_stay_out_of_the_shuffle(spark, scratch):
    t, path = Tables(spark, SMALL), scratch("derived")
    few = F.col("l_orderkey") < 30
    writers.write_partitioned(model.fact_lines(t).filter(few), path, "l_shipdate", ["c_mktsegment", model.PRODUCT_JOIN_KEY],
                              derive=lambda d: model.fact_columns(d, carry=["partition_date"]))
    back, fact = spark.read.parquet(path), model.fact_columns(model.fact_lines(t).filter(few))
    assert back.filter("partition_date is distinct from to_date(transaction_time)").isEmpty()
    assert sorted(map(str, back.select(*fact.columns).collect())) == sorted(map(str, fact.collect()))


def test_layer_tables_use_the_layer_codec(spark, scratch):
    path = writers.replace_table(spark.range(3).toDF("v"), scratch("codec"))
    assert all(f".{writers.LAYER_CODEC}." in r[0] for r in spark.read.parquet(path).select("_metadata.file_path").collect())


def test_sealed_landings_do_not_join_again(spark, monkeypatch):
    plans, land = [], catalog_stream.ingest.land_files
    monkeypatch.setattr(catalog_stream.ingest, "land_files", lambda df, *a, **b: (plans.append(_plan(df)), land(df, *a, **b))[1])
    assert catalog_stream.stream_dq_sealed(spark, SMALL).count() > 0
    assert len(plans) == 3 and not any("Join" in p for p in plans)


def test_sealed_deliveries_are_published_by_their_gate(spark, scratch, monkeypatch):
    base = scratch("sealed")
    monkeypatch.setattr(batches, "stream_id", lambda *a: "s")
    rows = spark.createDataFrame([(1, "o1", "p", 1, 1.0), (1, "o2", "p", 1, 1.0), (2, None, None, -1, 1.0), (2, None, None, -1, 1.0)],
                                 "delivery long, order_id string, product_id string, quantity long, unit_price double")
    sizes = rows.groupBy("delivery").agg(F.count(F.lit(1)).alias("rows"))
    batches.sealed_publisher(base, f"{base}/_checkpoint", lambda: sizes)(rows, 0)
    for folder, delivery in (("published", 1), ("quarantine", 2)):
        assert {r.delivery for r in spark.read.parquet(f"{base}/{folder}").collect()} == {delivery}
