"""Where intermediate data goes: the named folder, the folder set on the context, a temp folder on one machine only."""

import os

import pytest

from riskframe import session


class _Context:
    def __init__(self, master, conf=None, own=None):
        self.master, self.conf, self.own = master, conf, own

    def getConf(self):
        return {"spark.checkpoint.dir": self.conf} if self.conf else {}

    def getCheckpointDir(self):
        return self.own

    def setCheckpointDir(self, path):
        self.own = f"{path}/some-id"


class _Session:
    def __init__(self, *a, **k):
        self.sparkContext, self.conf = _Context(*a, **k), _Conf()


class _Conf(dict):
    def set(self, k, v):
        self[k] = v


def test_named_folder_is_used():
    assert session.ensure_checkpoint_dir(_Session("yarn", conf="hdfs://x/ck")) == "hdfs://x/ck"


def test_folder_of_the_context_is_used():
    assert session.ensure_checkpoint_dir(_Session("yarn", own="hdfs://x/set/id-1")) == "hdfs://x/set"


def test_no_folder_on_a_cluster_is_an_error():
    for master in ("yarn", "local-cluster[3,2,1024]", "spark://h:7077"):
        with pytest.raises(RuntimeError):
            session.ensure_checkpoint_dir(_Session(master))


def test_one_machine_gets_a_temp_folder():
    s = _Session("local[2]")
    path = session.ensure_checkpoint_dir(s)
    assert os.path.isdir(path) and s.conf[session.SCRATCH] == path and session.ensure_checkpoint_dir(s) == path


def test_scratch_removes_what_a_query_wrote(spark):
    with session.scratch(spark) as path:
        assert session.materialize(spark.range(5), "t").count() == 5
        assert os.path.isdir(path.removeprefix("file://").removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file://").removeprefix("file:"))
    assert spark.conf.get(session.SCRATCH, None) is None
