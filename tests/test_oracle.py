"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from martforge.plans.catalog import QUERIES  # noqa: E402
from oracle_check import duck, rows_key  # noqa: E402

SF = "/root/testdata/sf0.001"
TYPE_MAP = {"string": {"VARCHAR"}, "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"},
            "boolean": {"BOOLEAN"}, "date": {"DATE"}, "timestamp_ntz": {"TIMESTAMP"}}
KEYS = sorted(QUERIES)


def test_every_key_has_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["channel_name", "product_name", "category", "sales_date", "total_quantity",
                          "total_revenue", "total_profit", "order_count"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql()[key]
    cols, drows = duck(sql, SF)
    assert sorted(df.columns) == sorted(cols)
    import duckdb
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(sql)
    dtypes = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    for f in df.schema.fields:
        assert dtypes[f.name] in TYPE_MAP[f.dataType.simpleString()], (f.name, f.dataType, dtypes[f.name])
    assert len(rows) == len(drows)
    assert rows_key(rows, df.columns) == rows_key(drows, cols)
