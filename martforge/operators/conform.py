"""Column conforming: names, types, audit columns, totals, defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import batch_id

# Fixed type map of the sales feed (column -> Spark type), applied when present.
TYPE_MAP = {
    "order_id": "string",
    "product_id": "string",
    "customer_id": "string",
    "quantity": "bigint",
    "unit_price": "double",
}


class SchemaError(ValueError):
    """Column names collide or a required column is missing."""


def standardize_columns(df: DataFrame) -> DataFrame:
    """lower-case names, spaces to underscores; refuse collisions."""
    new = [c.lower().replace(" ", "_") for c in df.columns]
    if len(set(new)) != len(new):
        raise SchemaError(f"column names collide after standardizing: {new}")
    return df.toDF(*new)


def conform_types(df: DataFrame, type_map: dict[str, str] = TYPE_MAP, safe: bool = False) -> DataFrame:
    """Cast the known columns that are present.

    Strict (default) casts run in ANSI mode: bad text raises, nulls stay null.
    A null quantity is refused like an integer cast of a missing value.
    ``safe=True`` uses ``try_cast`` for the quarantine path (bad -> null).
    """
    cols = []
    for c in df.columns:
        if c in type_map:
            target = type_map[c]
            src = F.col(c)
            if safe:
                cols.append(src.try_cast(target).alias(c))
            else:
                casted = src.cast(target)
                if target == "bigint":
                    casted = F.when(src.isNull(),
                                    F.raise_error(F.lit(f"null value in integer column {c}")).cast(target)
                                    ).otherwise(casted)
                cols.append(casted.alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def with_audit(df: DataFrame, batch_ts: Column) -> DataFrame:
    """processed_at + batch_id from a batch timestamp parameter (never the clock)."""
    return df.withColumns({"processed_at": batch_ts, "batch_id": batch_id(batch_ts)})


def with_load_audit(df: DataFrame, batch_ts: Column) -> DataFrame:
    """load_date + batch_id for the fact load."""
    return df.withColumns({"load_date": batch_ts, "batch_id": batch_id(batch_ts)})


def with_total(df: DataFrame, qty: str = "quantity", price: str = "unit_price",
               out: str = "total_amount") -> DataFrame:
    return df.withColumn(out, F.col(qty) * F.col(price))


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill declared column defaults: coalesce when present, add when absent."""
    cols = {}
    for name, value in defaults.items():
        cols[name] = F.coalesce(F.col(name), value) if name in df.columns else value
    return df.withColumns(cols)
