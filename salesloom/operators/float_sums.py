"""Totals and means of doubles of any size and any number of digits, rounded once.

:func:`salesloom.operators.aggregates.total_by` adds amounts of money and stops at what is no amount. Here every
double has a place: the sum is the double nearest to the true one, infinities follow IEEE 754, NULL and NaN are
missing. Parts can be stored and added up again later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.columns import q
from salesloom.functions.floats import DIGITS, digits_sum, double_digits

_SUMS = [f"d{i}" for i in range(DIGITS)]
_COUNTS = ["n", "over", "under"]


def float_parts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys, place, d0 .. d3, n, over, under``: sums of digits, values, and infinities of either sign.

    One row per key and place of the leading digit: values of similar size share one. Digits are below 2**24, so
    2**38 values fit a long. Rows are added up in each task before the shuffle.
    """
    x = q(value).cast("double")
    rows = df.select(
        *[q(k) for k in keys], double_digits(x).alias("_digits"),
        (x.isNotNull() & ~F.isnan(x)).alias("_given"), (x == float("inf")).alias("_over"),
        (x == float("-inf")).alias("_under"),
    )
    return rows.groupBy(*[q(k) for k in keys], F.col("_digits.place").alias("place")).agg(
        *[F.sum(F.col("_digits")[d]).alias(d) for d in _SUMS],
        F.count_if("_given").alias("n"), F.count_if("_over").alias("over"), F.count_if("_under").alias("under"),
    )


def merge_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts of several tables, or of finer keys, as parts of ``keys``."""
    return parts.groupBy(*[q(k) for k in keys], "place").agg(*[F.sum(c).alias(c) for c in [*_SUMS, *_COUNTS]])


def finish_parts(parts: DataFrame, keys: Sequence[str], total: str = "total", mean: str = "mean") -> DataFrame:
    """``keys, total, mean``; rows with a NULL key are left out. A key has at most 88 places.

    A total without values is 0, a mean without values NULL; both infinities together give NaN.
    """
    known = F.lit(True)
    for k in keys:
        known = known & q(k).isNotNull()
    gathered = parts.where(known).groupBy(*[q(k) for k in keys]).agg(
        F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", *_SUMS))).alias("_parts"),
        *[F.sum(c).alias(f"_{c}") for c in _COUNTS],
    )
    summed = gathered.withColumn("_total", _with_infinities(digits_sum(F.col("_parts"))))
    return summed.select(
        *[q(k) for k in keys], F.col("_total").alias(total),
        F.try_divide(F.col("_total"), F.col("_n").cast("double")).alias(mean),
    )


def _with_infinities(total: Column) -> Column:
    over, under = F.col("_over") > 0, F.col("_under") > 0
    return (
        F.when(over & under, F.lit(float("nan"))).when(over, F.lit(float("inf")))
        .when(under, F.lit(float("-inf"))).otherwise(total)
    )


def float_totals(df: DataFrame, key: str, value: str, total: str = "total", mean: str = "mean") -> DataFrame:
    """``key, total, mean`` of all doubles of a key."""
    return finish_parts(float_parts(df, [key], value), [key], total, mean)
