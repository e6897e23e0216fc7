import os
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

import pytest

from salesloom import scratch


def test_landed_files_go_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    path = scratch.scratch_path(spark, "x")
    assert path.startswith(root + "/x-") and not os.path.exists(path)
    landed = scratch.land(spark.range(5), "kept")
    assert landed.count() == 5


def test_temporary_deletes_at_the_end_and_after_errors(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    os.makedirs(root, exist_ok=True)
    before = set(os.listdir(root))
    with scratch.temporary(spark):
        scratch.land(spark.range(5), "gone")
        kept = scratch.land(spark.range(3), "kept", keep=True)
        assert len(set(os.listdir(root)) - before) == 2
    assert kept.count() == 3
    assert [n.split("-")[0] for n in set(os.listdir(root)) - before] == ["kept"]
    with pytest.raises(KeyError):
        with scratch.temporary(spark):
            scratch.land(spark.range(5), "gone")
            raise KeyError
    assert len(set(os.listdir(root)) - before) == 1


def test_scopes_of_other_threads_are_left_alone(spark):
    with scratch.temporary(spark):
        with ThreadPoolExecutor(1) as pool:
            own = pool.submit(copy_context().run, scratch.land, spark.range(1), "own").result()
            other = pool.submit(scratch.land, spark.range(2), "other").result()
        assert (own.count(), other.count()) == (1, 2)
        gone = own.inputFiles()[0].removeprefix("file:").lstrip("/")
        assert os.path.exists("/" + gone)
    assert not os.path.exists("/" + gone)
    assert other.count() == 2


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Session:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_path(Session(spark_master="yarn"), "x")
    shared = Session(spark_master="yarn", **{"spark_checkpoint_dir": "hdfs://c/tmp/"})
    assert scratch.scratch_path(shared, "x").startswith("hdfs://c/tmp/x-")
    assert os.path.isdir(os.path.dirname(scratch.scratch_path(Session(spark_master="local[2]"), "x")))


def test_release_deletes_what_queries_landed(spark, monkeypatch):
    from salesloom import scratch
    from salesloom.operators.ordinal import with_ordinal
    from salesloom.scratch import release

    monkeypatch.setattr(scratch, "_loose", [])  # other tests use sessions that are none
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert with_ordinal(spark.range(5), ["id"]).count() == 5
    assert set(os.listdir(folder)) > before
    release(spark)
    assert set(os.listdir(folder)) == before
