"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from cobasket import session as sessions
from cobasket.session import checkpointed, scratch_path, shared_dir, stored


class Context:
    applicationId = "fake"

    def __init__(self, master, directory=None):
        self.master, self.directory = master, directory

    def getCheckpointDir(self):
        return self.directory

    def setCheckpointDir(self, directory):
        self.directory = directory


def session(master, conf=None, directory=None):
    conf = conf or {}
    return SimpleNamespace(sparkContext=Context(master, directory), conf=SimpleNamespace(get=conf.get))


def test_the_configured_folder_is_used():
    fake = session("spark://host", {"spark.checkpoint.dir": "hdfs://shared/tmp"})
    assert shared_dir(fake) == "hdfs://shared/tmp" == fake.sparkContext.directory
    assert scratch_path(fake, "t").startswith("hdfs://shared/tmp/t-")
    assert scratch_path(fake, "t") != scratch_path(fake, "t")


def test_a_cluster_needs_the_setting():
    with pytest.raises(RuntimeError):
        shared_dir(session("spark://host"))
    assert shared_dir(session("spark://host", directory="hdfs://set/before")) == "hdfs://set/before"


def test_local_mode_makes_its_own_folder():
    fake = session("local[2]")
    assert shared_dir(fake) == shared_dir(fake) == fake.sparkContext.directory


def test_checkpoint_cuts_the_plan(spark):
    df = checkpointed(spark.range(10).filter("id % 2 = 0"))
    assert df.count() == 5
    assert "Filter" not in df._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_are_read_back_and_removed(spark, monkeypatch):
    monkeypatch.setattr(sessions, "_scratch", {})
    one = stored(spark.range(10).selectExpr("id", "id % 3 AS k"), "one")
    assert one.count() == 10 and "Range" not in one._jdf.queryExecution().executedPlan().toString()
    path = sessions._scratch[spark.sparkContext.applicationId][0]
    system, found = sessions.file_of(spark, path)
    assert system.exists(found) and sessions.remove_scratch(spark) == 1 and not system.exists(found)
    assert sessions.remove_scratch(spark) == 0
