import pytest

from marlstone import workspace


def test_intermediates_are_read_back_and_dropped(spark):
    workspace.drop_intermediates(spark)
    kept = workspace.written(spark.range(10), "kept")
    assert kept.count() == 10
    assert workspace.drop_intermediates(spark) == 1
    assert workspace.drop_intermediates(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST|does not exist"):
        kept.count()


def test_a_scope_owns_its_paths_only(spark):
    workspace.drop_intermediates(spark)
    outer = workspace.written(spark.range(3), "outer")
    with workspace.scope(spark):
        inner = workspace.written(spark.range(4), "inner")
        with workspace.scope(spark):
            workspace.written(spark.range(1), "innermost")
        assert inner.count() == 4
    assert outer.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST|does not exist"):
        inner.count()
    assert workspace.drop_intermediates(spark) == 1


def test_named_folder_is_used(spark, monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return "/shared/folder/" if name == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()
        sparkContext = spark.sparkContext

    assert workspace.shared_folder(Session()) == "/shared/folder"
    assert workspace.scratch(Session(), "x").startswith("/shared/folder/x-")


def test_cluster_without_a_folder_is_refused(spark):
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_folder(Session())
