"""Landed CSV: malformed records set aside, recorded ledger, interrupted and resumed runs."""

import os

import pytest
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from martforge.streaming import landing

SCHEMA = StructType().add("id", LongType()).add("name", StringType()).add("price", DoubleType())
FILES = {
    "a.csv": 'id,name,price\n1,"say ""hi"", then",1.5\n2,plain,2\nthree,bad,3\n4,short\n',
    "b.csv": "id,name,price\n5,x,5.0\n6,too,6.0,many\n7,,\n",
    "c.csv": "id,name,price\n8,y,eight\n9,z,9.0\n",
}


def land(folder, *names):
    os.makedirs(folder, exist_ok=True)
    for i, n in enumerate(names):
        with open(f"{folder}/{n}", "w") as f:
            f.write(FILES[n])
        os.utime(f"{folder}/{n}", (1_700_000_000 + i, 1_700_000_000 + i))


def read(spark, base, table):
    return spark.read.parquet(f"{base}/{table}")


def check_all(spark, base):
    rows = sorted((r.id, r.name, r.price) for r in read(spark, base, landing.ROWS).collect())
    assert rows == [(1, 'say "hi", then', 1.5), (2, "plain", 2.0), (5, "x", 5.0), (7, None, None), (9, "z", 9.0)]
    bad = sorted(r.record for r in read(spark, base, landing.MALFORMED).collect())
    assert bad == ["4,short", "6,too,6.0,many", "8,y,eight", "three,bad,3"]


def test_malformed_rows_are_accounted_for(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "out")
    land(src, *FILES)
    landing.ingest_csv(spark, src, SCHEMA, base, f"{base}/_checkpoint")
    check_all(spark, base)
    files = {os.path.basename(r.source_file): (r.records, r.malformed) for r in landing.ledger(spark, base, 9).collect()}
    assert files == {"a.csv": (4, 2), "b.csv": (3, 1), "c.csv": (2, 1)}


def test_ledger_after_an_interrupted_run(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "out")
    land(src, *FILES)

    def fail(epoch_id):
        if epoch_id == 1:
            raise RuntimeError("connection lost")
    with pytest.raises(Exception):
        landing.ingest_csv(spark, src, SCHEMA, base, f"{base}/_checkpoint", files_per_trigger=1, after_write=fail)
    # the second trigger was written but not committed: it is run again and replaces its own output
    for _ in range(2):
        landing.ingest_csv(spark, src, SCHEMA, base, f"{base}/_checkpoint", files_per_trigger=1)
        check_all(spark, base)
        got = landing.ledger(spark, base, 9).orderBy("epoch_id").collect()
        assert [(r.epoch_id, r.records, r.malformed, r.processed_records) for r in got] == [
            (0, 4, 2, 4), (1, 3, 1, 7), (2, 2, 1, 9)]
        assert got[-1].completion_percentage == 100.0 and round(got[0].completion_percentage, 2) == 44.44


def test_new_checkpoint_adds(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "out")
    land(src, "b.csv")
    landing.ingest_csv(spark, src, SCHEMA, base, str(tmp_path / "one"))
    land(str(tmp_path / "more"), "c.csv")
    landing.ingest_csv(spark, str(tmp_path / "more"), SCHEMA, base, str(tmp_path / "two"))
    assert read(spark, base, landing.ROWS).count() == 3
    assert landing.ledger(spark, base, 5).count() == 2
