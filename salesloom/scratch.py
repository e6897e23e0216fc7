"""Where intermediate tables are landed.

A landed table cuts lineage: an executor lost later re-reads files, and neither repeats outside
lookups nor re-draws range bounds. The place is the shared folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_own_root: str | None = None
# Per context: two refreshes in one process must not delete each other's files.
_landed: ContextVar[list[str] | None] = ContextVar("landed", default=None)
# Folders landed outside of such a block; a list only grows at its end, also from several threads.
_loose: list[str] = []


def scratch_path(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A new, unused folder name below the session's shared scratch folder.

    Inside :func:`temporary` it is deleted when the block ends, and else by :func:`release`, unless
    ``keep`` is set.
    """
    path = f"{_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    landed = _landed.get()
    if not keep:
        (_loose if landed is None else landed).append(path)
    return path


def land(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet and return a frame that reads it back."""
    path = scratch_path(df.sparkSession, label, keep)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete what was landed in the block when it ends, also after an error.

    Frames that still read those files must not be used afterwards. Threads started in the block
    belong to it if they run in a copy of its context.
    """
    paths: list[str] = []
    outer = _landed.set(paths)
    try:
        yield
    finally:
        _landed.reset(outer)
        for path in paths:
            delete(spark, path)


def release(spark: SparkSession) -> None:
    """Delete all that was landed outside of :func:`temporary`; frames that read it end here.

    Operators give lazy frames that read landed files, so only the caller knows when that is.
    """
    while _loose:
        delete(spark, _loose.pop())


def _file(spark: SparkSession, path: str):
    # Spark has no calls of its own to delete or rename a folder on the cluster's file system.
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it."""
    files, target = _file(spark, path)
    files.delete(target, True)


def rename(spark: SparkSession, path: str, to: str, missing_ok: bool = False) -> None:
    """Give a folder another name that is not yet used."""
    files, source = _file(spark, path)
    if missing_ok and not files.exists(source):
        return
    _, target = _file(spark, to)
    if files.exists(target):
        raise FileExistsError(to)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{path} could not be renamed to {to}")


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _file(spark, path)
    return files.exists(target)


def write_line(spark: SparkSession, path: str, line: str) -> None:
    """A new small file with one line of text."""
    files, target = _file(spark, path)
    out = files.create(target, False)
    out.write(bytearray(line.encode("utf-8")))
    out.close()


def read_line(spark: SparkSession, path: str) -> str:
    """The first line of a small file."""
    files, target = _file(spark, path)
    java = spark.sparkContext._jvm.java.io
    reader = java.BufferedReader(java.InputStreamReader(files.open(target), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def _root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    global _own_root
    if _own_root is None:
        _own_root = tempfile.mkdtemp(prefix="salesloom-")
        atexit.register(shutil.rmtree, _own_root, ignore_errors=True)
    return _own_root
