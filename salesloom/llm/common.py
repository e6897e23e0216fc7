"""Small helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import wraps
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesloom.functions.columns import q

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rows of an Arrow batch where the session has Spark's default of 10,000: texts are long.
BATCH_ROWS = 1000
# What separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of the words of a text; empty for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def others(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """The columns of ``df`` but for those that the operator gives itself (names in any case)."""
    own = {n.lower() for n in names}
    return [q(c) for c in df.columns if c.lower() not in own]


def any_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Lets the caller's columns have any name.

    All columns that operators add for their own use begin with an underscore. Columns of the given frames that do,
    too, have other names while the operator runs; arguments that name them follow, and so does the result.
    """

    @wraps(operator)
    def run(*args, **options):
        frames = [x for x in (*args, *options.values()) if isinstance(x, DataFrame)]
        taken = {c.lower() for f in frames for c in f.columns}
        clashing = sorted({c for f in frames for c in f.columns if c.startswith("_")})
        if not clashing:
            return operator(*args, **options)
        inside = {}
        for i, c in enumerate(clashing):
            name = f"given {i}"
            while name in taken:
                name += "."
            inside[c] = name
        back = {v: k for k, v in inside.items()}

        def renamed(x):
            if isinstance(x, DataFrame):
                return x.select(*[q(c).alias(inside.get(c, c)) for c in x.columns])
            return inside.get(x, x) if isinstance(x, str) else x

        out = operator(*map(renamed, args), **{k: renamed(v) for k, v in options.items()})
        return out.select(*[q(c).alias(back.get(c, c)) for c in out.columns])

    return run


def spread(df: DataFrame, column: str) -> DataFrame:
    """Deal rows out evenly: by the hash of a column and of the row's place in its partition.

    Rows with the same value, exact copies too, go to many tasks.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, q(column), F.spark_partition_id())


def small_batches(spark: SparkSession) -> None:
    """Sets the session's Arrow batch to ``BATCH_ROWS`` rows, unless the user has set it.

    It is read when a query runs, so it stays set.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


#: What this Python worker remembers from one task to the next, by the call that it is for.
_remembered: dict[str, Any] = {}


def remembered(call: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept by this Python worker for the tasks of the same call that follow."""
    if call not in _remembered:
        _remembered[call] = make()
    return _remembered[call]


def forget_others(call: str | None) -> None:
    """Frees what this Python worker remembers for other calls."""
    for other in _remembered.keys() - {call}:
        del _remembered[other]


def own_memory(run: Callable, call: str | None = None) -> Callable:
    """``run``, in a worker that remembers nothing of other calls.

    Spark hands a Python worker on from one job to the next, with all that it holds: without this, what one call
    remembers would lie beside the memory of the jobs that follow.
    """

    def begin(batches: Iterator) -> Iterator:
        forget_others(call)
        yield from run(batches)

    return begin


def map_arrow(
    df: DataFrame, keep: Sequence[Column], inputs: Sequence[Column], run: Callable, made: StructType,
    call: str | None = None,
) -> DataFrame:
    """``keep`` and the ``made`` columns that ``run`` computes from ``inputs`` in Arrow batches.

    ``run`` gets batches of ``_row`` and the inputs and gives batches of ``_row`` and ``made``. What is
    kept travels in one struct, so that its names can be anything. ``call``: under which name ``run``
    remembers anything in its workers.
    """
    small_batches(df.sparkSession)
    packed = df.select(F.struct(*keep, F.lit(0).alias("_pad")).alias("_row"), *inputs)
    schema = StructType([packed.schema["_row"], *made.fields])
    return packed.mapInArrow(own_memory(run, call), schema).select("_row.*", *made.names).drop("_pad")
