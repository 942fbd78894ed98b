"""Row filters: staging clean, quarantine, current rows, loaded-on, orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAGING_COLUMNS = (
    "order_id", "product_id", "customer_id", "channel", "quantity", "unit_price",
    "total_amount", "order_date", "processed_at", "batch_id",
)


def clean_rules():
    """Staging rules in order; the first failing one is the quarantine reason."""
    return (
        ("order_id_null", F.col("order_id").isNotNull()),
        ("product_id_null", F.col("product_id").isNotNull()),
        ("quantity_not_positive", F.col("quantity") > 0),
        ("unit_price_not_positive", F.col("unit_price") > 0),
    )


def _pass_all():
    cond = None
    for _, c in clean_rules():
        cond = c if cond is None else (cond & c)
    return cond


def clean_sales(raw: DataFrame, columns=STAGING_COLUMNS) -> DataFrame:
    """Staging filter; a null comparison drops the row (SQL WHERE semantics)."""
    return raw.filter(_pass_all()).select(*[c for c in columns if c in raw.columns])


def with_validation(raw: DataFrame) -> DataFrame:
    """validation_status PASSED/FAILED and the first failing rule."""
    reason = None
    for name, c in reversed(clean_rules()):
        fail = ~F.coalesce(c, F.lit(False))
        reason = F.when(fail, F.lit(name)) if reason is None else F.when(fail, F.lit(name)).otherwise(reason)
    passed = F.coalesce(_pass_all(), F.lit(False))
    return raw.withColumns({
        "validation_status": F.when(passed, F.lit("PASSED")).otherwise(F.lit("FAILED")),
        "reject_reason": reason,
    })


def split_quarantine(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected); the two sides partition the input exactly."""
    v = with_validation(raw)
    return (v.filter(F.col("validation_status") == "PASSED"),
            v.filter(F.col("validation_status") == "FAILED"))


def loaded_on(df: DataFrame, ts_col: str, day: str) -> DataFrame:
    """Rows whose timestamp falls on ``day`` (as a range, so it reaches the scan)."""
    start = F.lit(day).cast("date").cast("timestamp_ntz")
    end = F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz")
    return df.filter((F.col(ts_col) >= start) & (F.col(ts_col) < end))


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row (left anti join)."""
    return fact.join(dim.select(key), key, "left_anti")
