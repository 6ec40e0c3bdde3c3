"""Scratch paths live under the session's checkpoint folder and never collide."""

from trendloom.session import checkpoint_root, scratch_path


def test_scratch_paths_under_checkpoint_root(spark):
    root = checkpoint_root(spark).rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root + "/") and b.startswith(root + "/")
    assert a != b
    assert spark.sparkContext.getCheckpointDir() is not None
