from cartwise.plans.job import scale_settings
from cartwise.session import checkpoint_dir, scratch_path, shuffle_partitions_for


def test_checkpoint_dir_and_scratch(spark):
    d = checkpoint_dir(spark)
    assert d
    assert scratch_path(spark, "x").startswith(d.rstrip("/"))


def test_shuffle_partitions_for():
    assert shuffle_partitions_for(4096, 2, target_bytes=1024) == 4
    assert shuffle_partitions_for(100, 200) == 200
    assert shuffle_partitions_for(100 * 10**12) > 350_000
    assert shuffle_partitions_for(10**15, 8, most=50_000) == 50_000


def test_scale_settings_are_taken_back(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    with scale_settings(spark, 10 * (256 << 20)):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "10"
    assert {k: spark.conf.get(k) for k in before} == before
