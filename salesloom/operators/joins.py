"""Joins of sales with users and weather.

The reference table (users, weather) is broadcast only after its size was checked. Beyond that
both sides are shuffled, and keys that hold many rows are split over several tasks.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType

from salesloom.functions.columns import q
from salesloom.scratch import land

MIB = 1024 * 1024
# Uncompressed bytes of a reference table that may be broadcast.
BROADCAST_LIMIT = 64 * MIB
# Uncompressed bytes of a key's rows that one task takes. A key with more is split.
HOT_BYTES = 256 * MIB
# Cells of the byte histogram: so many for each share of HOT_BYTES in the table, within these bounds.
CELLS_A_SHARE, LEAST_CELLS, MOST_CELLS = 16, 1 << 10, 1 << 22

_UNITS = {"B": 1, "KiB": 2**10, "MiB": 2**20, "GiB": 2**30, "TiB": 2**40, "PiB": 2**50}


def estimated_bytes(df: DataFrame) -> float:
    """Catalyst's size estimate of ``df``. Runs no job; joins are much overestimated."""
    text = df.sparkSession.sql("EXPLAIN COST SELECT * FROM {df}", df=df).first()[0]
    found = re.search(r"sizeInBytes=([0-9.E+-]+) (\w+)", text)
    if found is None or found.group(2) not in _UNITS:
        return math.inf
    return float(found.group(1)) * _UNITS[found.group(2)]


def _row_bytes(df: DataFrame) -> Column:
    """Uncompressed size of a row: 16 bytes, 8 a column, and all text."""
    size = F.lit(16 + 8 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(q(field.name)), F.lit(0))
        elif not isinstance(field.dataType, AtomicType):
            text = q(field.name).cast("string")
            size = size + F.coalesce(F.octet_length(text), F.lit(0))
    return size


def measured_bytes(df: DataFrame) -> int:
    """Uncompressed size of ``df`` by one aggregate."""
    return df.agg(F.sum(_row_bytes(df))).first()[0] or 0


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_bytes: int = HOT_BYTES, row_bytes: Column | None = None
) -> DataFrame:
    """``_hot``, ``_salts``: hashes of keys with more than ``hot_bytes``, and the tasks each needs.

    In two levels. A histogram adds up bytes by cells of the key's hash, in each task first, so the
    shuffle has rows for cells and not for keys. A hot key's cell has at least the key's bytes, so
    only the keys of cells above ``hot_bytes`` are added up one by one; mostly there is no such cell, and the
    table is read once. There are at most size / ``hot_bytes`` such cells and hot keys, none
    is left out, and each key gets as many salts as it has shares of ``hot_bytes``. The result is landed.
    """
    size = _row_bytes(df) if row_bytes is None else row_bytes
    rows = df.select(F.xxhash64(*[q(k) for k in keys]).alias("_hot"), size.alias("_bytes"))
    cell = F.pmod(F.col("_hot"), F.lit(_cells(df, hot_bytes)))
    histogram = rows.groupBy(cell.alias("_cell")).agg(F.sum("_bytes").alias("_bytes"))
    crowded = land(histogram.where(F.col("_bytes") > hot_bytes).select("_cell"), "cells")
    if not crowded.limit(1).count():
        return crowded.select(F.col("_cell").alias("_hot"), F.lit(1).alias("_salts"))
    # At most size / hot_bytes rows of 8 bytes.
    few = rows.join(F.broadcast(crowded), cell == F.col("_cell"), "left_semi")
    per_key = few.groupBy("_hot").agg(F.sum("_bytes").alias("_bytes"))
    salts = F.ceil(F.col("_bytes") / hot_bytes).cast("int")
    return land(per_key.where(F.col("_bytes") > hot_bytes).select("_hot", salts.alias("_salts")), "hot")


def _cells(df: DataFrame, hot_bytes: int) -> int:
    """Enough cells that one without a hot key stays far below ``hot_bytes``."""
    shares = CELLS_A_SHARE * estimated_bytes(df) / hot_bytes
    return int(min(MOST_CELLS, max(LEAST_CELLS, shares)))


def lookup_join(
    facts: DataFrame,
    reference: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    broadcast_limit: int = BROADCAST_LIMIT,
    hot_bytes: int = HOT_BYTES,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Equi-join a long table with a reference table.

    ``how`` is ``"inner"``, ``"left"`` or ``"left_semi"``.

    1. Catalyst estimates the reference below its own broadcast threshold: plain join, and
       Catalyst broadcasts it.
    2. Its measured size is at most ``broadcast_limit`` (0 turns this off): broadcast hint.
    3. Otherwise a shuffle join. Rows of ``facts`` with a hot key are spread over as many salts as
       the key needs, and the reference rows of just those keys are repeated once per salt.

    The result is the same in all three. The third reads ``facts`` once more to find the hot keys.
    Where ``facts`` is itself the result of a costly step, ``keys_from`` names a cheaper frame that holds
    the same keys as often.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"how must be 'inner', 'left' or 'left_semi', not {how!r}")
    shared = set(facts.columns) & set(reference.columns)
    if shared:
        raise ValueError(f"columns on both sides, rename one: {sorted(shared)}")
    for left, right in on:
        kinds = facts.schema[left].dataType, reference.schema[right].dataType
        if kinds[0] != kinds[1]:
            raise ValueError(f"key types differ: {left} {kinds[0]}, {right} {kinds[1]}")

    spark = facts.sparkSession
    if broadcast_limit > 0:
        if estimated_bytes(reference) <= _auto_broadcast_bytes(spark):
            return facts.join(reference, _equal(on), how)
        if measured_bytes(reference) <= broadcast_limit:
            return facts.join(F.broadcast(reference), _equal(on), how)
    names = [left for left, _ in on]
    if keys_from is None:
        hot = hot_keys(facts, names, hot_bytes)
    else:
        hot = hot_keys(keys_from, names, hot_bytes, F.lit(16 + 8 * len(facts.columns)))
    if not hot.limit(1).count():
        return facts.join(reference, _equal(on), how)
    return _salted_join(facts, reference, on, how, hot)


def _auto_broadcast_bytes(spark) -> float:
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", text.strip().lower())
    return int(found.group(1)) * 1024 ** " kmgtp".index(found.group(2) or " ")


def _equal(on: Sequence[tuple[str, str]]):
    condition = F.lit(True)
    for left, right in on:
        condition = condition & (q(left) == q(right))
    return condition


def salt(df: DataFrame, salts: Column) -> Column:
    """A number below ``salts`` for each row, by its content and the partition it lies in.

    Rows of one key spread though they all lie in one partition, and so do exact copies that come
    from several. A task that is run again gives the same numbers, in whatever order it reads its rows.
    """
    content = [q(f.name) for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    return F.pmod(F.xxhash64(*content, F.spark_partition_id()), salts).cast("int")


def _salted_join(facts, reference, on, how, hot):
    fact_key = F.xxhash64(*[q(left) for left, _ in on])
    ref_key = F.xxhash64(*[q(right) for _, right in on])
    # At most size / hot_bytes rows of 12 bytes.
    hot = F.broadcast(hot)
    salted_facts = (
        facts.withColumn("_fact_salt", salt(facts, F.lit(1 << 30)))
        .join(hot, fact_key == F.col("_hot"), "left")
        .withColumn("_fact_salt", F.coalesce(F.col("_fact_salt") % F.col("_salts"), F.lit(0)))
        .drop("_hot", "_salts")
    )
    repeats = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    salted_reference = (
        reference.join(hot, ref_key == F.col("_hot"), "left")
        .withColumn("_ref_salt", F.explode(repeats))
        .drop("_hot", "_salts")
    )
    condition = _equal(on) & (F.col("_fact_salt") == F.col("_ref_salt"))
    return salted_facts.join(salted_reference, condition, how).drop("_fact_salt", "_ref_salt")


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Raise unless each key occurs once; a repeated one would multiply sales rows."""
    columns = [q(k) for k in keys]
    repeated = df.groupBy(*columns).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"repeated key {', '.join(keys)}: {repeated[0].asDict()}")
    return df


def users_with_weather(users: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather columns, then user columns; every user once, NULLs where there is no weather."""
    joined = weather.join(users, q("user_info_table_id") == q("id"), "right")
    return joined.select(*[q(c) for c in weather.columns + users.columns])


def sales_with_users(sales: DataFrame, users: DataFrame, **options) -> DataFrame:
    """Sales of known customers, with the customer's columns."""
    return lookup_join(sales, users, [("customer_id", "id")], "inner", **options)


def enrich_sales(
    sales: DataFrame,
    users: DataFrame,
    weather: DataFrame,
    check_unique: bool = True,
    **options,
) -> DataFrame:
    """The wide table: sales columns, weather columns, user columns.

    Sales of unknown customers and weather of unknown users are left out; customers without
    weather keep NULLs. Users and weather are joined first, so the long table moves once.
    """
    if check_unique:
        require_unique(weather, "user_info_table_id")
    profile = users_with_weather(users, weather)
    wide = lookup_join(sales, profile, [("customer_id", "id")], "inner", **options)
    return wide.select(*[q(c) for c in sales.columns + profile.columns])
