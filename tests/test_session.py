from tidemark.session import checkpoint_root, shared_dir


def test_shared_dirs_are_unique_under_the_checkpoint_root(spark):
    root = checkpoint_root(spark).rstrip("/")
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)
    # DataFrame.checkpoint() can use the same shared location
    assert spark.sparkContext.getCheckpointDir()
    assert checkpoint_root(spark).rstrip("/") == root   # stable across calls


def test_shared_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from tidemark.session import checkpoint_root

    sc = SimpleNamespace(getConf=lambda: {}, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=sc))
