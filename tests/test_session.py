import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from riverbend.session import (SQL_DEFAULTS, apply_defaults, ensure_scratch, is_local_master, join_root, materialize,
                               release, save, scratch_path)


def test_scratch_paths_are_fresh_and_under_the_shared_root(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    assert a.startswith(root.replace("file:", "").rstrip("/"))


def test_remote_root_keeps_its_scheme():
    assert join_root("hdfs://nn:8020/shared/ckpt/", "y") == "hdfs://nn:8020/shared/ckpt/y"
    assert join_root("s3a://bucket/ckpt", "y") == "s3a://bucket/ckpt/y"
    assert join_root("file:/tmp/ckpt", "y") == "file:/tmp/ckpt/y"
    assert join_root("file:///mnt/shared", "y") == "file:///mnt/shared/y"
    assert join_root("/tmp/ckpt", "y") == "/tmp/ckpt/y"


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    saved = materialize(df.groupBy("k").count(), "test-mat")
    plan = saved._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and saved.count() == 7


def test_defaults_only_fill_gaps(spark):
    apply_defaults(spark)
    for key in SQL_DEFAULTS:
        assert spark.conf.get(key, None) is not None


def test_shared_folder_is_required_off_local():
    assert is_local_master("local[8]") and is_local_master("local")
    assert not is_local_master("local-cluster[3,2,1024]") and not is_local_master("yarn")
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None),
                              sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_scratch(cluster)


def test_release_deletes_a_saved_table(spark):
    saved, path = save(spark.range(10), "test-release")
    assert saved.count() == 10
    folder = path.removeprefix("file:")
    assert os.path.isdir(folder)
    release(spark, path)
    assert not os.path.exists(folder)
