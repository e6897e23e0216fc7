"""Single-key aggregates with the missing-value and tie rules of an in-memory data frame.

* rows with a NULL key are left out;
* NULL and NaN values are missing: a total without values is 0, a mean without values NULL;
* amounts are added as exact decimals, so a result does not depend on partitioning;
* a top-k keeps the lower key on equal values.

Every aggregate is a partial aggregate before its shuffle, so a key that holds a third of the
rows reaches its reducer as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from salesloom.functions.columns import exact_sum, money_count, money_sum, period_start, q


def _parts(df: DataFrame, value: str) -> tuple[Column, Column]:
    """Sum and count of the values present: decimal sum for amounts, long for whole numbers."""
    kind = df.schema[value].dataType
    if isinstance(kind, (DoubleType, FloatType)):
        return money_sum(q(value)), money_count(q(value))
    if isinstance(kind, DecimalType):
        wide = f"decimal(38,{kind.scale})"
        return exact_sum(q(value), wide), F.count(q(value))
    return exact_sum(q(value).cast("long"), "long"), F.count(q(value))


def _is_amount(df: DataFrame, value: str) -> bool:
    return isinstance(df.schema[value].dataType, (DoubleType, FloatType, DecimalType))


def partial_sums(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys, <value>_sum, <value>_n``: exact parts that can be added up again later.

    NULL keys are kept here; they are dropped by whoever finishes the aggregate.
    """
    total, n = _parts(df, value)
    return df.groupBy(*[q(k) for k in keys]).agg(
        total.alias(f"{value}_sum"), n.alias(f"{value}_n")
    )


def total_by(df: DataFrame, key: str, value: str, alias: str | None = None) -> DataFrame:
    """``key, sum(value)``. Amounts (also partial decimal sums) come out as double."""
    kind = "double" if _is_amount(df, value) else "long"
    total = F.coalesce(_parts(df, value)[0].cast(kind), F.lit(0).cast(kind))
    return df.where(q(key).isNotNull()).groupBy(q(key)).agg(total.alias(alias or value))


def average_by(df: DataFrame, key: str, value: str, alias: str | None = None) -> DataFrame:
    """``key, mean(value)`` over the rows that have a value."""
    total, n = _parts(df, value)
    mean = F.try_divide(total.cast("double"), n.cast("double"))
    return df.where(q(key).isNotNull()).groupBy(q(key)).agg(mean.alias(alias or value))


def average_of_parts(parts: DataFrame, key: str, value: str) -> DataFrame:
    """``key, mean`` from the output of :func:`partial_sums` over finer keys."""
    total, _ = _parts(parts, f"{value}_sum")
    mean = F.try_divide(total.cast("double"), F.sum(q(f"{value}_n")).cast("double"))
    return parts.where(q(key).isNotNull()).groupBy(q(key)).agg(mean.alias(value))


def largest(totals: DataFrame, key: str, value: str, n: int = 5) -> DataFrame:
    """The ``n`` rows with the largest value; each task passes on at most ``n`` rows."""
    return totals.orderBy(q(value).desc(), q(key).asc()).limit(n)


def top_k(df: DataFrame, key: str, value: str, n: int = 5) -> DataFrame:
    return largest(total_by(df, key, value), key, value, n)


def period_totals(df: DataFrame, day: str, value: str, period: str) -> DataFrame:
    """Totals per month or quarter, keyed by its first day. Periods without rows are absent."""
    return total_by(df.withColumn(day, period_start(q(day), period)), day, value)


def present(df: DataFrame, *keys: str) -> DataFrame:
    """Order rows for reading; tables themselves are stored unordered."""
    return df.orderBy(*[q(k).asc() for k in keys])


def preview(df: DataFrame, *keys: str, n: int = 5) -> DataFrame:
    """First ``n`` rows in key order."""
    return present(df, *keys).limit(n)
