import pytest

from tallygrove.sources.scratch import scratch_path


class Conf(dict):
    pass


class Session:
    """What ``scratch_path`` reads of a session."""

    def __init__(self, **settings):
        self.conf = Conf({name.replace("__", "."): value for name, value in settings.items()})


def test_the_checkpoint_folder_comes_first():
    session = Session(spark__checkpoint__dir="file:/shared/", spark__master="spark://host:7077")
    assert scratch_path(session, "a").startswith("file:/shared/a-")
    assert scratch_path(session, "a") != scratch_path(session, "a")


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_the_warehouse_of_a_single_process(master):
    session = Session(spark__sql__warehouse__dir="file:/w", spark__master=master)
    assert scratch_path(session, "a").startswith("file:/w/scratch/a-")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_local_warehouse_is_refused_on_a_cluster(master):
    session = Session(spark__sql__warehouse__dir="file:/w", spark__master=master)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session, "a")
    shared = Session(spark__sql__warehouse__dir="hdfs://nn/w", spark__master=master)
    assert scratch_path(shared, "a").startswith("hdfs://nn/w/scratch/a-")
