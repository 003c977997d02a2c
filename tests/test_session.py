import pytest

from fitloom import session


class Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class Fake:
    """Just enough of a session to see which folder is chosen."""

    def __init__(self, master, named=None, current=None):
        self.master, self.current, self.named = master, current, named
        self.sparkContext = self
        self.conf = Conf({"spark.checkpoint.dir": named} if named else {})

    def getConf(self):
        return Conf({})

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


def test_the_named_folder_is_used():
    fake = Fake("spark://host", named="hdfs://shared/cp/")
    assert session.shared_dir(fake) == "hdfs://shared/cp" and fake.current == "hdfs://shared/cp/"
    assert session.scratch_path(fake, "x").startswith("hdfs://shared/cp/fitloom/x-")


def test_a_folder_already_set_is_kept():
    assert session.shared_dir(Fake("spark://host", current="s3a://b/cp")) == "s3a://b/cp"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        session.shared_dir(Fake("spark://host"))
