"""Scalar column functions (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the source project's data model.
# End date of an open SCD-2 version, and the record-hash null marker.
OPEN_END = "2099-12-31 00:00:00"
HASH_NULL = "\\N"
HASH_SEP = "|"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def format_id(prefix: str, width: int, col) -> Column:
    """Zero-padded business id, e.g. ``format_id('ORD', 8, 'k')`` -> ORD_00000042.

    Keys that fit the pad take a codegen-friendly ``lpad`` path; wider or
    negative keys fall back to ``format_string``, which widens instead of
    truncating (``lpad`` alone would cut 123456 to 12345).
    """
    k = _c(col)
    fits = (k >= 0) & (k < 10 ** width)
    padded = F.when(fits, F.lpad(k.cast("string"), width, "0")).otherwise(
        F.format_string(f"%0{width}d", k))
    return F.concat(F.lit(f"{prefix}_"), padded)


def sanitize_id(col) -> Column:
    """Keep letters, digits (any script), underscore and hyphen."""
    return F.regexp_replace(_c(col), r"[^\p{L}\p{N}_-]", "")


def batch_id(ts) -> Column:
    """``batch_YYYYMMDD_HHMMSS`` from a batch timestamp."""
    return F.concat(F.lit("batch_"), F.date_format(_c(ts), "yyyyMMdd_HHmmss"))


def batch_id_text(batch_ts: str) -> str:
    """Driver-side twin of ``batch_id`` for a batch time given as text."""
    return "batch_" + batch_ts.replace("-", "").replace(":", "").replace(" ", "_").replace("T", "_")[:15]


def ts_literal(ts: str) -> Column:
    """Wall-clock literal (``timestamp_ntz``; the warehouse has no zones)."""
    return F.lit(ts).cast("timestamp_ntz")


def record_hash(*cols) -> Column:
    """SHA-256 over the tracked attributes.

    Each value is written with its length before it, and null as a marker that
    starts with no digit, so no two lists of values have the same text.
    """
    texts = [_c(c).cast("string") for c in cols]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(HASH_NULL)) for t in texts]
    return F.sha2(F.concat_ws(HASH_SEP, *parts), 256)


def surrogate_key(*cols) -> Column:
    """Deterministic surrogate key from the business key (same rule as the hash)."""
    return record_hash(*cols)


def date_key(ts) -> Column:
    """yyyyMMdd as int."""
    return F.date_format(_c(ts), "yyyyMMdd").cast("int")


def day(ts) -> Column:
    return F.to_date(_c(ts))


def hourly(base: str, i) -> Column:
    """``base + i hours`` (hourly generator grid)."""
    hours = _c(i).cast("bigint")
    days = F.floor(hours / 24).cast("int")
    return ts_literal(base) + F.make_dt_interval(days, F.pmod(hours, F.lit(24)).cast("int"))


def pct(part, total) -> Column:
    """(part / total) * 100 with a zero guard (0 when total is 0)."""
    return F.when(_c(total) > 0, (_c(part) / _c(total)) * F.lit(100.0)).otherwise(F.lit(0.0))


def file_stem(path) -> Column:
    """File name without folder and extension."""
    return F.regexp_extract(_c(path), r"([^/]+?)(\.[^./]*)?$", 1)


def money(col, precision: int = 12, scale: int = 2) -> Column:
    """Exact money value; every money sum is taken over decimals."""
    return _c(col).cast(f"decimal({precision},{scale})")
