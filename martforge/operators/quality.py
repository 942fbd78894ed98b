"""Data-quality scorecards as DataFrames.

Every suite is ONE aggregate over the input (a single scan, partial
aggregation map-side; exact distinct counts are shuffled on the counted
column, so no group lands in one task), turned into a long table
``(suite, check_order, check_name, passed, score, observed)`` by inlining an
array of structs. The summary is one more aggregate on that small table.

Null semantics follow the source pipelines: a for-all predicate treats a
null as a failure and holds on zero rows (``coalesce(bool_and(coalesce(p,
false)), true)``); distinct counts skip nulls, so a null key also fails a
uniqueness check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed limits of the source pipelines.
ROW_COUNT_MIN = 1
ROW_COUNT_MAX = 10_000_000
QUANTITY_RANGE = (0, 1000)
UNIT_PRICE_RANGE = (0, 10000)

# Fixed thresholds of the warehouse configuration.
NULL_THRESHOLD = 0.05
DUPLICATE_THRESHOLD = 0.01
FRESHNESS_THRESHOLD_HOURS = 24


def for_all(pred: Column) -> Column:
    """True when ``pred`` holds on every row (null counts as false; true on no rows)."""
    return F.coalesce(F.bool_and(F.coalesce(pred, F.lit(False))), F.lit(True))


def _long(metrics: DataFrame, suite: str, checks: list[tuple[str, Column, Column]], by=()) -> DataFrame:
    if not checks:
        return metrics.sparkSession.createDataFrame(
            [], "suite string, check_order int, check_name string, passed boolean, score double, observed double")
    arr = F.array(*[
        F.struct(
            F.lit(i).alias("check_order"),
            F.lit(name).alias("check_name"),
            passed.alias("passed"),
            observed.cast("double").alias("observed"),
        )
        for i, (name, passed, observed) in enumerate(checks, start=1)
    ])
    out = metrics.select(*by, F.inline(arr))
    return out.select(
        *by, F.lit(suite).alias("suite"), "check_order", "check_name", "passed",
        F.when(F.col("passed"), F.lit(100.0)).otherwise(F.lit(0.0)).alias("score"),
        "observed",
    )


def dq_sales(df: DataFrame, suite: str = "sales", by=()) -> DataFrame:
    """Suite 2: up to six checks, each only when its column exists.

    ``by``: score every group (e.g. every delivery of a micro-batch) on its
    own, in the same single aggregate.
    """
    by = list(by)
    cols = set(df.columns)
    aggs = [F.count(F.lit(1)).alias("n")]
    if "order_id" in cols:
        aggs += [F.count_if(F.col("order_id").isNull()).alias("oid_nulls"),
                 F.count_distinct("order_id").alias("oid_distinct")]
    if "product_id" in cols:
        aggs.append(F.count_if(F.col("product_id").isNull()).alias("pid_nulls"))
    if "quantity" in cols:
        lo, hi = QUANTITY_RANGE
        aggs.append(for_all((F.col("quantity") >= lo) & (F.col("quantity") <= hi)).alias("qty_ok"))
    if "unit_price" in cols:
        lo, hi = UNIT_PRICE_RANGE
        aggs.append(for_all((F.col("unit_price") >= lo) & (F.col("unit_price") <= hi)).alias("price_ok"))
    m = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    n = F.col("n")
    checks = [("row_count_check", (n >= ROW_COUNT_MIN) & (n <= ROW_COUNT_MAX), n)]
    if "order_id" in cols:
        checks.append(("order_id_not_null", F.col("oid_nulls") == 0, F.col("oid_nulls")))
    if "product_id" in cols:
        checks.append(("product_id_not_null", F.col("pid_nulls") == 0, F.col("pid_nulls")))
    if "quantity" in cols:
        checks.append(("quantity_range_check", F.col("qty_ok"), F.col("qty_ok").cast("int")))
    if "unit_price" in cols:
        checks.append(("unit_price_range_check", F.col("price_ok"), F.col("price_ok").cast("int")))
    if "order_id" in cols:
        checks.append(("order_id_unique", F.col("oid_distinct") == n, F.col("oid_distinct")))
    return _long(m, suite, checks, by)


SUITE1_PRODUCT_COLS = ("product_id", "product_name")
SUITE1_SALES_COLS = ("quantity", "total_amount", "order_id")


def dq_dimensional(products: DataFrame, sales: DataFrame, suite: str = "dimensional") -> DataFrame:
    """Suite 1: five pass/fail checks, 100 or 0 each.

    A missing column makes the whole suite empty (score 0), as an error in
    the source pipeline does; ``suite_error`` names the problem.
    """
    missing = [c for c in SUITE1_PRODUCT_COLS if c not in products.columns] + \
              [c for c in SUITE1_SALES_COLS if c not in sales.columns]
    if missing:
        return _long(products, suite, [])
    pm = products.agg(
        F.count(F.lit(1)).alias("pn"),
        F.count_distinct("product_id").alias("p_distinct"),
        for_all(F.col("product_name").isNotNull()).alias("name_ok"),
    )
    sm = sales.agg(
        for_all(F.col("quantity") > 0).alias("qty_ok"),
        for_all(F.col("total_amount") > 0).alias("amount_ok"),
        for_all(F.col("order_id").isNotNull()).alias("oid_ok"),
    )
    p_checks = [
        ("product_id_uniqueness", F.col("p_distinct") == F.col("pn"), F.col("p_distinct")),
        ("product_name_not_null", F.col("name_ok"), F.col("name_ok").cast("int")),
    ]
    s_checks = [
        ("sales_quantity_positive", F.col("qty_ok"), F.col("qty_ok").cast("int")),
        ("sales_amount_positive", F.col("amount_ok"), F.col("amount_ok").cast("int")),
        ("order_id_not_null", F.col("oid_ok"), F.col("oid_ok").cast("int")),
    ]
    a = _long(pm, suite, p_checks)
    b = _long(sm, suite, s_checks).withColumn("check_order", F.col("check_order") + len(p_checks))
    return a.unionByName(b)


def suite_error(products: DataFrame, sales: DataFrame) -> str | None:
    missing = [c for c in SUITE1_PRODUCT_COLS if c not in products.columns] + \
              [c for c in SUITE1_SALES_COLS if c not in sales.columns]
    return f"missing columns: {missing}" if missing else None


def summary(checks: DataFrame) -> DataFrame:
    """Suite-1 form. One row: quality_score = sum(score) / n (0 without
    checks), passed_checks, total_checks."""
    return checks.agg(
        F.coalesce(F.avg("score"), F.lit(0.0)).cast("double").alias("quality_score"),
        F.count_if(F.col("passed")).cast("bigint").alias("passed_checks"),
        F.count(F.lit(1)).cast("bigint").alias("total_checks"),
    )


def ratio_summary(checks: DataFrame) -> DataFrame:
    """Suite-2 form. One row: quality_score = (passed / total) * 100 (0
    without checks), passed_checks, total_checks. Same value as the mean of
    100/0 scores up to the last bit, computed in the source's order."""
    m = checks.agg(F.count_if(F.col("passed")).cast("bigint").alias("passed_checks"),
                   F.count(F.lit(1)).cast("bigint").alias("total_checks"))
    score = F.when(F.col("total_checks") > 0,
                   (F.col("passed_checks") / F.col("total_checks")) * F.lit(100.0)).otherwise(F.lit(0.0))
    return m.select(score.cast("double").alias("quality_score"), "passed_checks", "total_checks")


def dq_thresholds(df: DataFrame, key: str, ts: str, as_of: Column,
                  null_threshold: float = NULL_THRESHOLD,
                  duplicate_threshold: float = DUPLICATE_THRESHOLD,
                  freshness_hours: float = FRESHNESS_THRESHOLD_HOURS) -> DataFrame:
    """Null rate and duplicate rate of ``key``, freshness of ``ts`` against ``as_of``.

    Freshness is computed in microseconds (then hours) so it does not depend
    on second-rounding of interval functions.
    """
    m = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(key).alias("nn"),
        F.count_distinct(key).alias("nd"),
        F.max(ts).alias("latest"),
    )
    n = F.col("n")
    null_rate = F.when(n > 0, (n - F.col("nn")) / n).otherwise(F.lit(0.0))
    dup_rate = F.when(n > 0, (F.col("nn") - F.col("nd")) / n).otherwise(F.lit(0.0))
    fresh = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("latest").cast("timestamp"))) / F.lit(3.6e9)
    checks = [
        ("null_rate", null_rate, F.lit(float(null_threshold))),
        ("duplicate_rate", dup_rate, F.lit(float(duplicate_threshold))),
        ("freshness_hours", fresh, F.lit(float(freshness_hours))),
    ]
    arr = F.array(*[F.struct(F.lit(name).alias("metric"), v.cast("double").alias("value"),
                             th.alias("threshold")) for name, v, th in checks])
    out = m.select(F.inline(arr))
    return out.withColumn("passed", F.coalesce(F.col("value") <= F.col("threshold"), F.lit(False)))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Long profile: (column_order, column_name, min_value, distinct_count,
    non_null_count, row_count) per column.

    One pass over the input: every row is inlined into one (column, value)
    row per profiled column, with the value in a slot of its own type (so
    minima compare natively), then grouped by (column, value) - a partial
    aggregate, so a hot value is combined map-side - and finally by column
    (a handful of groups). The input's upstream joins run once, unlike one
    aggregate per column, and no multi-distinct Expand is needed.
    """
    types = dict(df.dtypes)
    slots = sorted({types[c] for c in columns})
    vals = [f"_v{j}" for j in range(len(slots))]
    structs = [
        F.struct(F.lit(i).alias("column_order"),
                 *[(F.col(c) if types[c] == t else F.lit(None).cast(t)).alias(v) for t, v in zip(slots, vals)])
        for i, c in enumerate(columns)
    ]
    per_value = (df.select(F.inline(F.array(*structs)))
                 .groupBy("column_order", *vals).agg(F.count(F.lit(1)).alias("_n")))
    present = None
    for v in vals:
        present = F.col(v).isNotNull() if present is None else (present | F.col(v).isNotNull())
    agg = per_value.groupBy("column_order").agg(
        F.coalesce(*[F.min(v).cast("string") for v in vals]).alias("min_value"),
        F.count_if(present).cast("bigint").alias("distinct_count"),
        F.coalesce(F.sum(F.when(present, F.col("_n"))), F.lit(0)).cast("bigint").alias("non_null_count"),
        F.sum("_n").cast("bigint").alias("row_count"),
    )
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("column_order") + 1)
    return agg.select("column_order", name.alias("column_name"), "min_value", "distinct_count",
                      "non_null_count", "row_count")


def contract_violations(df: DataFrame, not_null: list[str], primary_key: str | None,
                        checks: dict[str, Column], key_value: Column | None = None) -> DataFrame:
    """Violations per declared rule, in one aggregate.

    ``key_value`` is a shorter form of the key, different for different keys, that is counted in its place.

    A CHECK fails only on FALSE (a null passes, as in SQL); the key rule
    counts repeated non-null keys.
    """
    rules: list[tuple[str, Column]] = []
    for c in not_null:
        rules.append((f"not_null:{c}", F.count_if(F.col(c).isNull())))
    if primary_key:
        rules.append((f"primary_key:{primary_key}",
                      F.count(primary_key) - F.count_distinct(primary_key if key_value is None else key_value)))
    for name, pred in checks.items():
        rules.append((f"check:{name}", F.count_if(~pred)))
    m = df.agg(*[e.cast("bigint").alias(f"r{i}") for i, (_, e) in enumerate(rules)])
    arr = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"))
                    for i, (name, _) in enumerate(rules)])
    return m.select(F.inline(arr))
