"""Engine settings: input-sized shuffles and scans, shared work folder."""

from martforge import session


def test_size_for_input_scales_with_bytes(spark):
    cores = spark.sparkContext.defaultParallelism
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert session.size_for_input(spark, 10 * 1024 * 1024) == cores  # small: one per core
        n = session.size_for_input(spark, 64 * (1 << 30))  # 64 GiB -> 512 partitions of 128 MB
        assert n == max(cores, -(-512 // cores) * cores) and n % cores == 0
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(128 * 1024 * 1024)
        assert session.size_for_input(spark, 100 * (1 << 40)) == session.MAX_SHUFFLE_PARTITIONS
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(256 * 1024 * 1024)
        assert spark.conf.get(key) == str(session.MAX_SHUFFLE_PARTITIONS)
    finally:
        session.size_for_input(spark, 0)


def test_input_bytes_and_shared_dir(spark):
    assert session.input_bytes(spark, "/root/testdata/sf0.001") > 0
    assert session.input_bytes(spark, "/root/testdata/no-such-dir") == 0
    d = session.shared_dir(spark)
    assert d == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.scratch_path(spark, "x").startswith(d + "/")
