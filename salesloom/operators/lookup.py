"""Enrichment by an outside lookup, run on Spark partitions."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from salesloom.functions.columns import q
from salesloom.functions.payload import extract_payload
from salesloom.operators.joins import lookup_join
from salesloom.scratch import exists, land

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Fetch = Callable[..., "str | None"]


class LookupFailed(Exception):
    """Raised by a lookup whose key has no answer. Any other exception stops the job."""


@dataclass(frozen=True)
class LookupMemory:
    """Answers that outlive a run: a folder of rows of key, payload and time, on the cluster's file system.

    Only keys without an answer are asked, in ``waves`` jobs that each add their answers, so a run that
    fails loses one wave at most. A failed lookup is not remembered and is asked again by the next run. Answers older
    than ``max_age_seconds`` are asked again as well, and of several answers the latest counts. Runs
    may share a folder; they only add files.
    """

    path: str
    max_age_seconds: float | None = None
    waves: int = 8

    def answers(self, spark: SparkSession, keys: StructType, since: int | None) -> DataFrame:
        """``_known0, ..., payload``: the latest answer of each key from ``since`` (microseconds) on."""
        schema = StructType([*keys.fields, StructField("payload", StringType()), _ASKED_AT])
        if exists(spark, self.path):
            rows = spark.read.schema(schema).parquet(self.path)
        else:
            rows = spark.createDataFrame([], schema)
        if since is not None:
            rows = rows.where(F.unix_micros("asked_at") >= since)
        known = [q(c).alias(f"_known{i}") for i, c in enumerate(keys.fieldNames())]
        latest = F.max_by("payload", F.struct("asked_at", "payload"))
        return rows.groupBy(*known).agg(latest.alias("payload"))

    def since(self, spark: SparkSession) -> int | None:
        if self.max_age_seconds is None:
            return None
        now = spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
        return now - int(self.max_age_seconds * 1_000_000)


_ASKED_AT = StructField("asked_at", TimestampType())


def lookup_payloads(
    df: DataFrame,
    key_cols: list[str],
    fetch_factory: Callable[[], Fetch],
    partitions: int | None = None,
    threads: int = 5,
    on_missing: str = "drop",
    memory: LookupMemory | None = None,
) -> DataFrame:
    """``key_cols, payload``: one call of the lookup per distinct key without NULLs.

    A key with a NULL is a failed lookup.

    ``fetch_factory`` runs once per partition and returns a function of the key values that
    gives the payload text, or None. ``partitions`` times ``threads`` calls run at once at most.
    A failed lookup (None or :class:`LookupFailed`) gives no row, or with ``on_missing="fail"``
    stops the job. The result is landed: recomputing it would call the lookup again. With a ``memory``
    only keys that it has no answer for are asked.
    """
    if on_missing not in ("drop", "fail"):
        raise ValueError(f"on_missing must be 'drop' or 'fail', not {on_missing!r}")
    spark = df.sparkSession
    names = [f"key{i}" for i in range(len(key_cols))]  # Python tasks take no dotted names
    keys = df.select(*[q(c).alias(n) for c, n in zip(key_cols, names)])
    keys = keys.where(_has_key(names, on_missing))
    width = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType(
        [keys.schema[n] for n in names] + [StructField("payload", StringType())]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch = fetch_factory()

        def call(key):
            try:
                found = fetch(*key)
            except LookupFailed:
                found = None
            if found is None and on_missing == "fail":
                raise LookupFailed(f"no answer for {key}")
            return found

        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                payloads = list(pool.map(call, batch.itertuples(index=False, name=None)))
                yield batch.assign(payload=pd.Series(payloads, dtype=object, index=batch.index))

    def ask(keys: DataFrame) -> DataFrame:
        found = keys.repartition(width, *names).mapInPandas(run, schema)
        return found.where(F.col("payload").isNotNull())

    if memory is None:
        answered = ask(keys.distinct())
    else:
        answered = _remembered(land(keys.distinct(), "wanted"), names, ask, memory)
    return land(answered.toDF(*key_cols, "payload"), "lookup")


def _remembered(
    wanted: DataFrame, names: list[str], ask: Callable[[DataFrame], DataFrame], memory: LookupMemory
) -> DataFrame:
    """Answers of the ``wanted`` keys; those that the memory does not know are asked and added to it."""
    spark = wanted.sparkSession
    since = memory.since(spark)
    pairs = [(name, f"_known{i}") for i, name in enumerate(names)]
    known = land(memory.answers(spark, wanted.schema, since), "known")
    new = lookup_join(wanted, known, pairs, "left").where(F.col("payload").isNull())
    new = land(new.select(*names), "asked")
    waves = min(memory.waves, new.count())
    for wave in range(waves):
        part = new.where(F.pmod(F.xxhash64(*names), F.lit(waves)) == wave)
        ask(part).withColumn("asked_at", F.current_timestamp()).write.mode("append").parquet(memory.path)
    if waves:
        known = land(memory.answers(spark, wanted.schema, since), "known")
    return lookup_join(wanted, known, pairs).select(*names, "payload")


def _has_key(names: list[str], on_missing: str):
    """Whether no part of the key is missing; raises if a failed lookup is to stop the job."""
    complete = F.lit(True)
    for name in names:
        complete = complete & q(name).isNotNull()
    if on_missing == "fail":
        stop = F.raise_error(F.lit("lookup key with a NULL")).cast("boolean")
        return F.when(complete, F.lit(True)).otherwise(stop)
    return complete


def lookup_weather(
    users: DataFrame,
    payloads: DataFrame,
    key_cols: list[str],
    id_col: str = "id",
    on_missing: str = "drop",
    **options,
) -> DataFrame:
    """Join looked-up payloads back to the users and extract them.

    Returns the 14 weather columns and ``user_info_table_id``, the user's own id (not a row
    position, which is right only while ids are 1..N in order).
    """
    people = users.select(
        q(id_col).alias("user_info_table_id"),
        *[q(c).alias(f"_key{i}") for i, c in enumerate(key_cols)],
    ).where(_has_key([f"_key{i}" for i in range(len(key_cols))], on_missing))
    keyed = payloads.select(
        *[q(c).alias(f"_found{i}") for i, c in enumerate(key_cols)], F.col("payload")
    )
    pairs = [(f"_key{i}", f"_found{i}") for i in range(len(key_cols))]
    joined = lookup_join(people, keyed, pairs, "inner", **options)
    return extract_payload(joined.select("user_info_table_id", "payload"), on_missing=on_missing)
