import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from martforge.session import apply_engine_conf
    ckpt = tempfile.mkdtemp(prefix="martforge-test-ckpt-")
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", ckpt)  # tests set their own shared folder
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_engine_conf(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from martforge.session import scratch_path
    return lambda name: scratch_path(spark, name)
