"""Tables that are published together, with the driver killed between any two steps."""

import os
import shutil

import pytest
from conftest import rows_of

from salesloom.sinks import tables
from salesloom.sinks.tables import ParquetSink, Run, content_digest, restore_snapshot, save_snapshot


class Killed(BaseException):
    """Not an error that the code under test could handle."""


STEPS = ("rename", "delete", "write_line")


def version(spark, n):
    return {name: spark.createDataFrame([(n, name)], "v int, name string").coalesce(1) for name in ("a", "b", "c")}


def publish(spark, sink, n, names="abc"):
    with Run(sink) as run:
        for name, df in version(spark, n).items():
            if name in names:
                run.replace(name, df)


def stop_at(monkeypatch, step, error):
    """Raises at the step-th of the calls that change files; gives the counter."""
    count = [0]
    for name in STEPS:
        def call(*args, _was=getattr(tables, name), **options):
            if count[0] == step:
                count[0] += 1000
                raise error
            if count[0] < 1000 or not isinstance(error, Killed):
                count[0] += 1
                return _was(*args, **options)
            return None  # the driver is gone

        monkeypatch.setattr(tables, name, call)
    return count


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Tables a and b of version 1; c is new in version 2."""
    root = tmp_path_factory.mktemp("stored") / "t"
    publish(spark, ParquetSink(spark, str(root)), 1, "ab")
    return root


def versions(spark, root):
    """Version by table, through a sink of another driver; nothing but tables is left."""
    sink = ParquetSink(spark, str(root))
    sink.recover()
    found = {n: rows_of(sink.read(n))[0][0] for n in sorted(os.listdir(root)) if not n.startswith(("_run", "."))}
    assert not sink.pending()
    return found


@pytest.mark.parametrize("error", [Killed(), OSError("full")])
def test_any_step_leaves_one_version(spark, stored, tmp_path, monkeypatch, error):
    seen = set()
    for step in range(40):
        root = tmp_path / str(step)
        shutil.copytree(stored, root)
        with monkeypatch.context() as patch:
            count = stop_at(patch, step, error)
            try:
                publish(spark, ParquetSink(spark, str(root)), 2)
                done = True
            except type(error):
                done = False
        got = versions(spark, root)
        assert got in ({"a": 1, "b": 1}, {"a": 2, "b": 2, "c": 2}), (step, got)
        if done and count[0] < 1000:
            assert got == {"a": 2, "b": 2, "c": 2}
            break
        seen.add(got["a"])
        publish(spark, ParquetSink(spark, str(root)), 3)  # and the folder is as good as before
        assert versions(spark, root) == {"a": 3, "b": 3, "c": 3}
    assert step > 8
    assert seen == {1, 2}


def test_killed_again_while_recovering(spark, stored, tmp_path, monkeypatch):
    for step in range(3, 8):
        for second in range(6):
            root = tmp_path / f"{step}-{second}"
            shutil.copytree(stored, root)
            for at, act in ((step, lambda s: publish(spark, s, 2)), (second, lambda s: s.recover())):
                with monkeypatch.context() as patch:
                    stop_at(patch, at, Killed())
                    try:
                        act(ParquetSink(spark, str(root)))
                    except Killed:
                        pass
            assert set(versions(spark, root).values()) in ({1}, {2})


def test_digest_is_of_rows_and_not_of_their_order(spark):
    rows = [(1, None, "x"), (None, 1, "x"), (3, 4, None), (3, 4, None)]
    frame = spark.createDataFrame(rows, "a int, b int, c string")
    digest = content_digest(frame)
    assert digest == content_digest(frame.repartition(3))
    for other in (rows[:3], rows + rows[:1], [(None, 1, "x"), *rows[1:]], [(1, None, "y"), *rows[1:]]):
        assert digest != content_digest(spark.createDataFrame(other, "a int, b int, c string"))
    assert content_digest(frame.limit(0))["rows"] == "0"


def test_restore_takes_all_tables_or_none(spark, tmp_path):
    folder, live = str(tmp_path / "snapshot"), ParquetSink(spark, str(tmp_path / "live"))
    publish(spark, live, 1)
    save_snapshot(spark, {n: df for n, df in version(spark, 2).items() if n != "c"}, folder)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        restore_snapshot(spark, folder, ["a", "c"], live)
    assert versions(spark, tmp_path / "live") == {"a": 1, "b": 1, "c": 1}
    version(spark, 9)["b"].write.mode("overwrite").parquet(f"{folder}/b")  # changed behind the snapshot's back
    with pytest.raises(ValueError, match="table b is not as it was saved"):
        restore_snapshot(spark, folder, ["a", "b"], live)
    assert versions(spark, tmp_path / "live") == {"a": 1, "b": 1, "c": 1}
    save_snapshot(spark, {"b": version(spark, 2)["b"]}, folder)
    restore_snapshot(spark, folder, ["a", "b"], live)
    assert versions(spark, tmp_path / "live") == {"a": 2, "b": 2, "c": 1}


def test_a_folder_without_digests(spark, tmp_path):
    folder, live = str(tmp_path / "plain"), ParquetSink(spark, str(tmp_path / "live"))
    version(spark, 5)["a"].write.parquet(f"{folder}/a")
    with pytest.raises(ValueError, match="not as it was saved"):
        restore_snapshot(spark, folder, ["a"], live)
    restore_snapshot(spark, folder, ["a"], live, verify=False)
    assert versions(spark, tmp_path / "live") == {"a": 5}
