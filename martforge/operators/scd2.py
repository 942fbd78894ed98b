"""Type-2 slowly changing dimension.

* ``scd2_merge`` is ONE full outer join between the *current* rows and the
  incoming batch on the business key, followed by an ``explode`` that emits
  0..2 rows per key (kept, closed + new, new). History rows pass through
  without a shuffle. Re-running the same batch is a no-op (hashes equal).
* ``scd2_history`` pre-aggregates the change log to one row per key and time
  (a partial aggregate) and takes each row's neighbours from segments: range
  partitions of (key, time) with a boundary pass, so a hot key is spread.
* ``asof_join`` puts facts and versions in one order of (key, time), in the
  same segments, and carries the last version to each fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import OPEN_END, batch_id, record_hash, surrogate_key, ts_literal
from .segments import SEGMENT, carry, changed_rows, in_segments

PRODUCT_KEY = "product_id"
PRODUCT_ATTRS = ("product_name", "category", "brand", "unit_cost")
SURROGATE = "product_key"

DIM_COLUMNS = (
    "product_key", "product_id", "product_name", "category", "brand", "unit_cost",
    "effective_date", "end_date", "is_current", "record_hash", "created_date",
    "updated_date", "batch_id",
)


def _dim_columns(key: str, attrs, surrogate: str) -> list[str]:
    return [surrogate, key, *attrs, "effective_date", "end_date", "is_current", "record_hash",
            "created_date", "updated_date", "batch_id"]


def scd2_initial(src: DataFrame, batch_ts: Column, key: str = PRODUCT_KEY,
                 attrs=PRODUCT_ATTRS, surrogate: str = SURROGATE) -> DataFrame:
    """First load: every row a current version from ``batch_ts`` to the open end."""
    df = src.withColumns({
        "effective_date": batch_ts,
        "end_date": ts_literal(OPEN_END),
        "is_current": F.lit(True),
        "record_hash": record_hash(*attrs),
        "created_date": batch_ts,
        "updated_date": batch_ts,
        "batch_id": batch_id(batch_ts),
    }).withColumn(surrogate, surrogate_key(key, "effective_date"))
    return df.select(*_dim_columns(key, attrs, surrogate))


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


def duplicate_keys(incoming: DataFrame, key: str = PRODUCT_KEY, sample: int = 5) -> list:
    """Up to ``sample`` business keys that occur more than once in a batch
    (a partial count per key, then a bounded take)."""
    dup = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return [r[key] for r in dup.select(key).limit(sample).collect()]


def scd2_merge(dim: DataFrame, incoming: DataFrame, batch_ts: Column, key: str = PRODUCT_KEY,
               attrs=PRODUCT_ATTRS, surrogate: str = SURROGATE, order_cols=None) -> DataFrame:
    """Apply one batch of records to a type-2 dimension.

    unchanged -> kept; changed -> old version closed at ``batch_ts`` plus a
    new current version; new key -> inserted; key absent from the batch ->
    kept current. ``incoming`` must hold one row per key; when a feed can
    repeat a key, ``order_cols`` names the order whose last record per key
    is the one applied (a partial aggregate, see ``dedup_latest``). Records
    without a key are not applied.
    """
    if order_cols:
        from .ordering import dedup_latest
        incoming = dedup_latest(incoming.select(key, *attrs, *[c for c in order_cols if c not in attrs]),
                                [key], list(order_cols))
    cols = _dim_columns(key, attrs, surrogate)
    cur = current_rows(dim).select(*cols)
    hist = dim.filter(~F.col("is_current")).select(*cols)
    inc = incoming.filter(F.col(key).isNotNull()).select(key, *attrs).withColumn("record_hash", record_hash(*attrs))
    inc = inc.select(key, *[F.col(c).alias(f"_n_{c}") for c in (*attrs, "record_hash")])

    j = cur.join(inc, key, "full_outer")
    has_cur = F.col("record_hash").isNotNull()
    has_new = F.col("_n_record_hash").isNotNull()
    same = F.col("record_hash") == F.col("_n_record_hash")

    def struct_of(overrides: dict[str, Column]) -> Column:
        return F.struct(*[overrides.get(c, F.col(c)).alias(c) for c in cols])

    kept = struct_of({})
    closed = struct_of({"end_date": batch_ts, "is_current": F.lit(False), "updated_date": batch_ts})
    new = struct_of({
        surrogate: surrogate_key(F.col(key), batch_ts),
        **{a: F.col(f"_n_{a}") for a in attrs},
        "effective_date": batch_ts,
        "end_date": ts_literal(OPEN_END),
        "is_current": F.lit(True),
        "record_hash": F.col("_n_record_hash"),
        "created_date": batch_ts,
        "updated_date": batch_ts,
        "batch_id": batch_id(batch_ts),
    })
    rows = (F.when(has_cur & (~has_new | same), F.array(kept))
            .when(has_cur, F.array(closed, new))
            .otherwise(F.array(new)))
    merged = j.select(F.explode(rows).alias("r")).select("r.*")
    return hist.unionByName(merged)


def scd2_history(changes: DataFrame, key: str, ts: str, attrs, grain: str | None = None) -> DataFrame:
    """Versions from a change log: one state per (key, time), equal
    neighbours collapsed, end = next version's start (open end otherwise).

    Every change time counts. With a ``grain`` (such as ``day``) the state of
    a period is the latest change in it and starts with the period. Ties on
    time go to the larger attribute values. The neighbours come from windows
    over segments, so a key's changes spread over several tasks.
    """
    attrs = list(attrs)
    period = (F.date_trunc(grain, F.col(ts)) if grain else F.col(ts)).cast("timestamp_ntz")
    per = changes.groupBy(key, period.alias("effective_date")).agg(
        F.max(F.struct(F.col(ts).alias("_t"), *[F.col(a) for a in attrs])).alias("_s"))
    per = per.select(key, "effective_date", *[F.col(f"_s.{a}").alias(a) for a in attrs])
    seg = in_segments(per, [key], ["effective_date"])
    cur = F.struct(*[F.col(a) for a in attrs])
    out = changed_rows(seg, [key], "effective_date", cur, "end_date").drop(SEGMENT)
    out = out.withColumn("end_date", F.coalesce("end_date", ts_literal(OPEN_END)))
    return out.select(key, "effective_date", *attrs, "end_date", (F.col("end_date") == ts_literal(OPEN_END)).alias("is_current"))


def asof_join(facts: DataFrame, versions: DataFrame, key: str, fact_ts: str,
              eff: str = "effective_date", end: str = "end_date", how: str = "inner") -> DataFrame:
    """Point-in-time join: the version with eff <= fact_ts < end (half-open).

    Versions must not overlap per key, so a fact's only candidate is the last
    version that began at or before it. Both sides are put in one order of
    (key, time), versions before facts, and each fact takes the last version
    carried to it; no version is expanded and a hot key spreads over segments.
    Facts without a key or time match nothing (``left``: with null versions).
    """
    if how not in ("inner", "left"):
        raise ValueError(f"as-of join: {how}")
    known = F.col(key).isNotNull() & F.col(fact_ts).isNotNull()
    v_cols = [c for c in versions.columns if c != key]
    fact = F.struct(*facts.columns)
    version = F.struct(*v_cols)
    v_type, f_type = versions.select(version.alias("v")).schema["v"].dataType, facts.select(fact.alias("f")).schema["f"].dataType
    v = versions.filter((F.col(end) > F.col(eff)) & F.col(key).isNotNull()).select(
        F.col(key).alias("_k"), F.col(eff).cast("timestamp_ntz").alias("_t"), F.lit(0).alias("_kind"),
        F.lit(0).cast("long").alias("_tie"), version.alias("_version"), F.lit(None).cast(f_type).alias("_fact"))
    f = facts.filter(known).select(
        F.col(key).alias("_k"), F.col(fact_ts).cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_kind"),
        F.monotonically_increasing_id().alias("_tie"), F.lit(None).cast(v_type).alias("_version"), fact.alias("_fact"))
    order = ["_t", "_kind", "_tie"]
    found = carry(in_segments(v.unionByName(f), ["_k"], order), ["_k"], order, F.col("_version"), "_at", inclusive=True)
    holds = F.col("_t") < F.col(f"_at.{end}").cast("timestamp_ntz")
    found = found.filter("_kind = 1").withColumn("_at", F.when(holds, F.col("_at")))
    if how == "inner":
        found = found.filter(F.col("_at").isNotNull())
    out = found.select("_fact.*", *[F.col(f"_at.{c}").alias(c) for c in v_cols])
    if how == "left":
        unknown = facts.filter(~F.coalesce(known, F.lit(False)))
        out = out.unionByName(unknown.select("*", *[F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in v_cols]))
    return out
