"""Column helpers shared by every operator. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts of at most four decimals are added as whole units of a ten-thousandth, in two longs: the
# units above and below 2**20. A decimal sum is as exact but takes several times as long per row.
UNITS = 10_000
LOW_BITS = 20
# The high part of one amount stays below 2**40.
MONEY_LIMIT = 9e13
# Amounts with more decimals, up to twenty, are added as decimals of this kind.
EXACT = "decimal(38,20)"

PERIODS = ("month", "quarter")


def q(name: str) -> Column:
    """Column by its literal name: ``q("address.city")`` is one column, not a field path."""
    return F.col("`" + name.replace("`", "``") + "`")


def _amount(value: Column) -> Column:
    """A floating amount; NaN is missing.

    An amount that does not fit raises in every ANSI mode: a cast alone could turn an infinity into
    NULL and drop it from the sum.
    """
    amount = value.cast("double")
    return (
        F.when(F.isnan(amount), F.lit(None))
        .when(F.abs(amount) < MONEY_LIMIT, amount)
        .when(amount.isNotNull(), F.raise_error(F.lit("amount too large")).cast("double"))
    )


def _in_units(amount: Column) -> Column:
    """Whether an amount has at most four decimals: its units give the same number again."""
    return F.rint(amount * UNITS) / F.lit(float(UNITS)) == amount


def money_units(value: Column) -> Column:
    """A floating amount in whole units; 0 if it has more decimals than four. NaN is missing."""
    amount = _amount(value)
    return F.when(_in_units(amount), F.rint(amount * UNITS).cast("long")).when(
        amount.isNotNull(), F.lit(0).cast("long")
    )


def money_rest(value: Column) -> Column:
    """A floating amount with more than four decimals, all of its digits; else NULL.

    An amount that needs more than twenty decimals raises: no digit is dropped.
    """
    amount = _amount(value)
    exact = amount.try_cast(EXACT)
    lost = F.raise_error(F.concat(F.lit("amount with too many digits: "), amount.cast("string")))
    return F.when(
        ~_in_units(amount), F.when(exact.cast("double") == amount, exact).otherwise(lost.cast(EXACT))
    )


def exact_sum(value: Column, kind: str) -> Column:
    """Aggregate: sum that raises in every ANSI mode where it does not fit ``kind``."""
    total = F.try_sum(value)
    too_large = F.raise_error(F.lit("total too large")).cast(kind)
    return F.when(total.isNull() & (F.count(value) > 0), too_large).otherwise(total.cast(kind))


def money_sum(value: Column) -> Column:
    """Aggregate: exact sum of floating amounts as a decimal, all digits of each amount kept.

    The result does not depend on the order or the partitioning of the rows.
    """
    units = money_units(value)
    high = F.try_sum(F.shiftright(units, LOW_BITS))
    low = F.sum(units.bitwiseAND(F.lit((1 << LOW_BITS) - 1)))
    step = F.lit(1 << LOW_BITS).cast("decimal(7,0)")
    total = high.cast("decimal(19,0)") * step + low.cast("decimal(19,0)")
    fitting = (total * F.lit("0.0001").cast("decimal(4,4)")).try_cast(EXACT)
    rest = F.coalesce(exact_sum(money_rest(value), EXACT), F.lit(0).cast(EXACT))
    exact = F.try_add(fitting, rest).try_cast(EXACT)
    overflow = F.raise_error(F.lit("total too large")).cast(EXACT)
    return F.when(exact.isNull() & low.isNotNull(), overflow).otherwise(exact)


def money_count(value: Column) -> Column:
    """Aggregate: how many amounts are present."""
    return F.count(money_units(value))


def parse_date(value: Column, on_bad: str = "fail", format: str | None = None) -> Column:
    """``yyyy-MM-dd`` text, or text of another ``format``, to a date; dates and timestamps are cast.

    The whole text must be a date; blanks around it do not count. ``on_bad="fail"`` raises on any other
    text whatever the session's ANSI mode is; ``on_bad="null"`` turns it into NULL.
    """
    if on_bad not in ("fail", "null"):
        raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")
    text = F.trim(value.cast("string"))
    if format is not None:
        parsed = F.try_to_timestamp(text, F.lit(format)).cast("date")
    else:
        # Other texts are dates and timestamps that were cast to text above.
        day = F.typeof(value).isin("date", "timestamp", "timestamp_ntz")
        parsed = F.when(day | text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), value.try_cast("date"))
    if on_bad == "null":
        return parsed
    return F.when(
        value.isNotNull() & parsed.isNull(),
        F.raise_error(F.concat(F.lit("unreadable date: "), text)).cast("date"),
    ).otherwise(parsed)


def period_start(day: Column, period: str) -> Column:
    """First day of the month or quarter that holds ``day``, as a date."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, not {period!r}")
    return F.trunc(day, period)


def first_element(array: Column) -> Column:
    """Element 0, or NULL for an empty array (a plain index raises under ANSI)."""
    return F.get(array, F.lit(0))
