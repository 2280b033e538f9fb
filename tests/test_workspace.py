"""Files written on the way."""

import os

import pytest

from millrace import workspace


def local(path):
    return path.removeprefix("file:")


def test_written_files_can_be_discarded(spark):
    stored = workspace.materialize(spark.range(5), "discarded")
    path = workspace._WRITTEN[-1]
    assert stored.count() == 5 and os.listdir(local(path))
    workspace.discard(spark)
    assert not os.path.exists(local(path)) and not workspace._WRITTEN


def test_files_between_marks_can_be_discarded(spark):
    before = workspace.materialize(spark.range(2), "before")
    mark = workspace.written()
    workspace.materialize(spark.range(3), "way")
    way = workspace._WRITTEN[-1]
    result = workspace.materialize(spark.range(4), "result")
    workspace.discard(spark, since=mark, until=workspace.written() - 1)
    assert before.count() == 2 and result.count() == 4 and not os.path.exists(local(way)) and workspace.written() == mark + 1


def test_a_cluster_must_name_its_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        workspace.shared_root(Session())
