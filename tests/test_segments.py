"""Segmented windows: hot keys spread over tasks, values carried over borders."""

import datetime as dt
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from martforge.operators import scd2, segments

DAY0 = dt.datetime(2024, 1, 1)


def many_segments(spark, n=16):
    """Small inputs in ``n`` range partitions, as large ones would be."""
    from contextlib import contextmanager

    @contextmanager
    def set_conf():
        keys = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
        old = {k: spark.conf.get(k) for k in keys}
        initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        for k, v in keys.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)
            if initial:
                spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", initial)
    return set_conf()


def hot_rows(n=6000, seed=1):
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 300, n))
    return [(int(k), DAY0 + dt.timedelta(seconds=int(t)), f"S{v}") for k, t, v in zip(
        keys, rng.choice(50_000, n, replace=False), rng.integers(0, 4, n))]


def test_hot_key_is_spread(spark):
    df = spark.createDataFrame(hot_rows(), "k long, t timestamp_ntz, v string")
    with many_segments(spark):
        seg = segments.in_segments(df, ["k"], ["t"])
        sizes = sorted(r["count"] for r in seg.groupBy(segments.SEGMENT).count().collect())
        assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        hot = seg.filter("k = 0").select(segments.SEGMENT).distinct().count()
        assert hot >= 5
        crossing = segments._crossing(seg, ["k"]).count()
        assert 1 <= crossing <= 16


def test_carry_equals_loops(spark):
    rows = [(k, t, v if i % 7 == 0 else None) for i, (k, t, v) in enumerate(hot_rows(3000, 2))]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, v string")
    with many_segments(spark):
        seg = segments.in_segments(df, ["k"], ["t"])
        for inclusive, backwards in ((False, False), (True, False), (False, True), (True, True)):
            got = {(r.k, r.t): r.found for r in segments.carry(
                seg, ["k"], ["t"], F.col("v"), "found", inclusive, backwards).collect()}
            want, last = {}, {}
            for k, t, v in sorted(rows, key=lambda r: r[1], reverse=backwards):
                if inclusive and v is not None:
                    last[k] = v
                want[k, t] = last.get(k)
                if v is not None:
                    last[k] = v
            assert got == want


def test_history_and_asof_in_many_segments(spark):
    rows = hot_rows(4000, 3)
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, v string")
    facts = [(i, k, t + dt.timedelta(seconds=1)) for i, (k, t, _) in enumerate(hot_rows(4000, 4))]
    facts += [(10_000 + i, 0, DAY0 + dt.timedelta(seconds=25_000)) for i in range(500)]  # one key, one time
    facts += [(20_000, None, DAY0), (20_001, 5, None), (20_002, 999, DAY0)]
    fdf = spark.createDataFrame(facts, "id int, k long, at timestamp_ntz")
    with many_segments(spark):
        versions = scd2.scd2_history(df, "k", "t", ["v"])
        got = [(r.k, r.effective_date, r.v, r.end_date) for r in versions.collect()]
        joined = {r.id: (r.v, r.effective_date) for r in scd2.asof_join(fdf, versions, "k", "at", how="left").collect()}
        inner = {r.id for r in scd2.asof_join(fdf, versions, "k", "at").collect()}
    want, by = [], {}
    for k, t, v in sorted(rows):
        kept = by.setdefault(k, [])
        if not kept or kept[-1][1] != v:
            kept.append((t, v))
    for k, kept in by.items():
        want += [(k, t, v, kept[i + 1][0] if i + 1 < len(kept) else dt.datetime(2099, 12, 31)) for i, (t, v) in enumerate(kept)]
    assert Counter(got) == Counter(want)
    for i, k, at in facts:
        before = [(t, v) for t, v in by.get(k, []) if at is not None and t <= at]
        assert joined[i] == ((before[-1][1], before[-1][0]) if before else (None, None))
        assert (i in inner) == bool(before)
    assert len(joined) == len(facts)
