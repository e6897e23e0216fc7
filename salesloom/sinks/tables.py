"""Full-refresh tables. ``replace`` drops what was there and returns the stored table.

:class:`Run` replaces several tables together: they are written beside the stored ones, and only
when all of them are there do they take their place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.columns import q
from salesloom.scratch import delete, exists, land, read_line, rename, scratch_path, write_line

# Journals of a folder of tables: of a publish that is decided, and of one that is being taken back.
_FORTH, _BACK = "_publish", "_undo"
_DIGESTS = "_digests"


@dataclass(frozen=True)
class ParquetSink:
    """One folder per table below ``root``.

    Several tables are published together by a journal: a file that names the staged tables takes its place by one
    rename, and with that the publish is decided. If the driver is killed while the tables are being renamed, the next
    one that reads or writes through a sink finishes what the journal says. One writer at a time.
    """

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        self.recover()
        df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name, df)

    def read(self, name: str, like: DataFrame | None = None) -> DataFrame:
        self.recover()
        reader = self.spark.read if like is None else self.spark.read.schema(like.schema)
        return reader.parquet(self.path(name))

    def staging(self) -> ParquetSink:
        return ParquetSink(self.spark, self.path(f"_run-{uuid.uuid4().hex}"))

    def publish(self, staged: ParquetSink, names: list[str]) -> None:
        """Swap in staged tables by renaming folders; old ones are put back if that fails."""
        self.recover()
        write_line(self.spark, staged.path(_FORTH), json.dumps({"staged": staged.root, "names": names}))
        rename(self.spark, staged.path(_FORTH), self.path(_FORTH))
        try:
            self._finish(staged, names)
        except Exception:
            rename(self.spark, self.path(_FORTH), self.path(_BACK))
            self._take_back(staged, names)
            raise

    def pending(self) -> bool:
        """Whether a publish was begun and has not come to its end."""
        return exists(self.spark, self.path(_FORTH)) or exists(self.spark, self.path(_BACK))

    def recover(self) -> None:
        """Finish a publish, or the undoing of one, that a killed driver has left."""
        for journal, go_on in ((_BACK, self._take_back), (_FORTH, self._finish)):
            if exists(self.spark, self.path(journal)):
                left = json.loads(read_line(self.spark, self.path(journal)))
                staged = ParquetSink(self.spark, left["staged"])
                go_on(staged, left["names"])
                delete(self.spark, staged.root)

    def _finish(self, staged: ParquetSink, names: list[str]) -> None:
        """Each step shows by what is where whether it was done, so this may be begun anew at any point."""
        for name in names:
            if exists(self.spark, staged.path(name)):
                rename(self.spark, self.path(name), staged.path(f"_old-{name}"), missing_ok=True)
                rename(self.spark, staged.path(name), self.path(name))
        delete(self.spark, self.path(_FORTH))

    def _take_back(self, staged: ParquetSink, names: list[str]) -> None:
        for name in names:
            if not exists(self.spark, staged.path(name)):
                rename(self.spark, self.path(name), staged.path(name))
            rename(self.spark, staged.path(f"_old-{name}"), self.path(name), missing_ok=True)
        delete(self.spark, self.path(_BACK))


@dataclass(frozen=True)
class CatalogSink:
    """Catalog tables in ``database``; with ``root`` their files lie below it."""

    spark: SparkSession
    database: str = "default"
    root: str | None = None

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        writer = df.write.mode("overwrite").format("parquet")
        if self.root is not None:
            writer = writer.option("path", f"{self.root.rstrip('/')}/{name}")
        writer.saveAsTable(f"{self.database}.{name}")
        return self.read(name)

    def read(self, name: str, like: DataFrame | None = None) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")


@dataclass(frozen=True)
class JdbcSink:
    """Database tables, inserted in batches over a bounded number of connections.

    ``replace`` lands the rows first and returns the landed frame, so that later steps neither
    compute them again nor read them back through the database. The landed files stay in the
    scratch folder until the caller deletes them; a :class:`Run` has a folder of its own instead.
    """

    spark: SparkSession
    url: str
    batch_size: int = 1000
    connections: int = 8
    properties: dict[str, str] = field(default_factory=dict)

    def write_options(self, name: str) -> dict[str, str]:
        return {
            **self.properties,
            "url": self.url,
            "dbtable": name,
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.connections),
        }

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        landed = land(df, name, keep=True)
        self.write(name, landed)
        return landed

    def write(self, name: str, df: DataFrame) -> None:
        df.write.format("jdbc").mode("overwrite").options(**self.write_options(name)).save()

    def read_options(self, name: str) -> dict[str, str]:
        return {**self.properties, "url": self.url, "dbtable": name}

    def read(self, name: str, like: DataFrame | None = None) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.read_options(name)).load()


Sink = ParquetSink | CatalogSink | JdbcSink


class Run:
    """Tables that replace those of ``sink`` together, once all are written.

    Until ``publish`` the stored tables stay as they are, so an error leaves them readable and
    unchanged. Folders are renamed; tables of a catalog or a database are then written from the
    staged files, one after the other.
    """

    def __init__(self, sink: Sink):
        self.sink = sink
        if isinstance(sink, ParquetSink):
            self.staged = sink.staging()
        else:
            self.staged = ParquetSink(sink.spark, scratch_path(sink.spark, "run", keep=True))
        self.frames: dict[str, DataFrame] = {}

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        self.frames[name] = self.staged.replace(name, df)
        return self.frames[name]

    def __enter__(self) -> Run:
        return self

    def __exit__(self, error, *_) -> None:
        try:
            if error is None:
                self.publish()
        finally:
            # Else the staged folder holds tables that the journal still has to move.
            if not (isinstance(self.sink, ParquetSink) and self.sink.pending()):
                delete(self.sink.spark, self.staged.root)

    def publish(self) -> None:
        if isinstance(self.sink, ParquetSink):
            self.sink.publish(self.staged, list(self.frames))
            return
        for name, df in self.frames.items():
            if isinstance(self.sink, JdbcSink):
                self.sink.write(name, df)
            else:
                self.sink.replace(name, df)

    def stored(self) -> dict[str, DataFrame]:
        """The tables as they are stored after the run."""
        return {name: self.sink.read(name, df) for name, df in self.frames.items()}


def content_digest(df: DataFrame) -> dict[str, str]:
    """Row count and two sums of row hashes: the same for equal rows in any order and partitioning."""
    # A hash passes over NULLs, so which columns are NULL is hashed as well.
    row = [q(c) for c in df.columns] + [q(c).isNull() for c in df.columns]
    first, second = F.xxhash64(*row), F.xxhash64(F.lit("second"), *row)
    sums = [F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)) for h in (first, second)]
    rows, *found = df.agg(F.count(F.lit(1)), *sums).first()
    return {"rows": str(rows), "first": str(found[0]), "second": str(found[1])}


def save_snapshot(spark: SparkSession, tables: dict[str, DataFrame], folder: str) -> None:
    """Store tables, all or none, and the digests of their contents for a later :func:`restore_snapshot`."""
    store = ParquetSink(spark, folder)
    with Run(store) as run:
        for name, df in tables.items():
            run.replace(name, df)
    digests = _digests(store) | {n: content_digest(df) for n, df in run.stored().items()}
    path = store.path(_DIGESTS)
    delete(spark, path)
    write_line(spark, path, json.dumps(digests))


def _digests(store: ParquetSink) -> dict[str, dict[str, str]]:
    path = store.path(_DIGESTS)
    return json.loads(read_line(store.spark, path)) if exists(store.spark, path) else {}


def restore_snapshot(
    spark: SparkSession, folder: str, names: Iterable[str], target: Sink, verify: bool = True
) -> dict[str, DataFrame]:
    """Replace the target's tables by those of a snapshot: all of them or none.

    Before any table is replaced, each one is read and held against the digest that was saved with it; a table
    that is missing, changed or has no digest stops the restore. ``verify=False`` leaves that out, for folders that
    :func:`save_snapshot` did not write.
    """
    store = ParquetSink(spark, folder)
    saved = {name: store.read(name) for name in names}
    if verify:
        digests = _digests(store)
        for name, df in saved.items():
            if digests.get(name) != content_digest(df):
                raise ValueError(f"snapshot table {name} is not as it was saved")
    with Run(target) as run:
        for name, df in saved.items():
            run.replace(name, df.select(*[q(c) for c in df.columns]))
    return run.stored()
