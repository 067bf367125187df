import pytest

from crawlflow.session import shared_dir


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, name, default=None):
        assert name == "spark.checkpoint.dir"
        return self.value


class Context:
    def __init__(self, master, folder):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, conf=None, master="local[2]", folder=None):
        self.conf, self.sparkContext = Conf(conf), Context(master, folder)


def test_named_folder_comes_first():
    assert shared_dir(Session("hdfs:///c", folder="/x")) == "hdfs:///c"
    assert shared_dir(Session(None, "spark://m", "hdfs:///d")) == "hdfs:///d"


def test_cluster_without_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_dir(Session(None, "spark://m"))


def test_local_session_gets_a_folder():
    session = Session()
    assert shared_dir(session) == shared_dir(session)
