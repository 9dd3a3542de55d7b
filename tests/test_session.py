from kredo.session import cluster_settings, ensure_checkpoint_dir, shared_path


def test_checkpoint_folder_is_the_sessions_and_stable(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    a, b = shared_path(spark, "x"), shared_path(spark, "x")
    assert a == b
    base = ensure_checkpoint_dir(spark)
    if named:
        assert base == named                 # the cluster's folder always wins
    assert a == base.rstrip("/") + "/x"
    assert spark.sparkContext.getCheckpointDir()


def test_cluster_settings_scale_with_input():
    small = cluster_settings(10 << 30, 64)
    big = cluster_settings(100 << 40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) > int(small["spark.sql.shuffle.partitions"]) >= 128
    assert big["spark.sql.adaptive.enabled"] == "true"
    assert int(big["spark.sql.autoBroadcastJoinThreshold"]) <= 64 << 20
