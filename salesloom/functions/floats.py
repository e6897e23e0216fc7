"""Exact sums of doubles of any size, as JVM expressions.

A double is a whole number of some power of two, so it has digits to the base 2**24: at most four that are not
zero, next to each other. Digits are added up as longs, which is exact in any order; carries and the one
rounding come last. The result is the double nearest to the true sum, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS, DIGITS = 24, 4
_BASE = 1 << BITS
#: Leading digits that decide the rounding; with what follows them as one more bit they fit a decimal.
_LEADING = 5
_WIDE = "decimal(38,0)"


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def _scaled(x: Column, exponent: Column) -> Column:
    """``x * 2**exponent`` in two steps, as one power alone may be too small or too large for a double."""
    half = F.floor(exponent / 2)
    return x * _power(half) * _power(exponent - half)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def double_digits(value: Column) -> Column:
    """Struct of ``place`` and ``d0`` to ``d3``: ``value`` is their sum, d0 * 2**(24 * place) and so on downwards.

    Digits have the value's sign. NULL for NULL, NaN, infinities and zero.
    """

    def digits(x: Column, size: Column, place: Column) -> Column:
        rest, out = _scaled(size, -BITS * place), []
        for _ in range(DIGITS - 1):
            whole = F.floor(rest)
            out.append(whole)
            rest = (rest - whole) * _BASE
        out.append(rest.cast("long"))
        sign = F.signum(x).cast("long")
        return F.struct(place.alias("place"), *[(sign * d).alias(f"d{i}") for i, d in enumerate(out)])

    def located(x: Column) -> Column:
        size = F.abs(x)
        about = F.floor(F.log2(size))
        # The logarithm may be rounded over a power of two.
        exact = about + F.when(_scaled(size, -about) >= 2, 1).when(_scaled(size, -about) < 1, -1).otherwise(0)
        return _let(F.floor(exact / BITS), lambda place: digits(x, size, place))

    x = value.cast("double")
    usable = ~F.isnan(x) & (F.abs(x) < float("inf")) & (x != 0)
    return F.when(usable, _let(x, located))


def digits_sum(parts: Column) -> Column:
    """The double nearest to the sum of ``parts``: an array of structs as :func:`double_digits` makes,
    with digits of any size and sign up to 2**62. An empty array gives 0, a sum beyond all doubles an infinity.
    """

    def column(place: Column) -> Column:
        """Sum of the digits at a place."""

        def at(part: Column) -> Column:
            own = F.lit(0).cast("long")
            for i in range(DIGITS):
                own = F.when(part["place"] - i == place, part[f"d{i}"]).otherwise(own)
            return own

        return F.aggregate(F.transform(parts, at), F.lit(0).cast("long"), lambda total, d: total + d)

    def carried(columns: Column) -> Column:
        """Digits from 0 to 2**24 - 1, lowest first, and what is carried out of the last one."""
        start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<long>").alias("out"))

        def step(state: Column, d: Column) -> Column:
            total = state["carry"] + d
            low = total.bitwiseAND(F.lit(_BASE - 1).cast("long"))
            return F.struct(F.shiftright(total, BITS).alias("carry"), F.concat(state["out"], F.array(low)).alias("out"))

        return F.aggregate(columns, start, step)

    def rounded(state: Column, lowest: Column) -> Column:
        carry = state["carry"]
        top = [F.shiftright(carry, BITS * i).bitwiseAND(F.lit(_BASE - 1).cast("long")) for i in range(3)]
        return _let(F.concat(state["out"], F.array(*top)), lambda all_: leading(all_, lowest))

    def leading(digits: Column, lowest: Column) -> Column:
        last = F.array_max(F.transform(digits, lambda d, i: F.when(d != 0, i)))

        def number(h: Column) -> Column:
            wide = F.lit(0).cast(_WIDE)
            for i in range(_LEADING):
                digit = F.coalesce(F.get(digits, h - i), F.lit(0)).cast("decimal(8,0)")
                digit = F.when(h >= i, digit).otherwise(F.lit(0).cast("decimal(8,0)"))
                wide = (wide * F.lit(_BASE).cast("decimal(8,0)") + digit).cast(_WIDE)
            more = F.exists(F.slice(digits, 1, F.greatest(h - (_LEADING - 1), F.lit(0))), lambda d: d != 0)
            doubled = (wide * F.lit(2).cast("decimal(1,0)") + F.when(more, 1).otherwise(0).cast("decimal(1,0)")).cast(_WIDE)
            return _scaled(doubled.cast("double"), BITS * (lowest + h - (_LEADING - 1)) - 1)

        return F.when(last.isNull(), F.lit(0.0)).otherwise(_let(last, number))

    def total(lowest: Column) -> Column:
        highest = F.array_max(F.transform(parts, lambda p: p["place"]))
        columns = F.transform(F.sequence(lowest, highest), column)

        def signed(c: Column) -> Column:
            def by_sign(state: Column) -> Column:
                negated = carried(F.transform(c, lambda d: -d))
                return F.when(state["carry"] < 0, -_let(negated, lambda s: rounded(s, lowest))).otherwise(
                    rounded(state, lowest)
                )

            return _let(carried(c), by_sign)

        return _let(columns, signed)

    lowest = F.array_min(F.transform(parts, lambda p: p["place"])) - (DIGITS - 1)
    return F.when(F.size(parts) == 0, F.lit(0.0)).otherwise(_let(lowest, total))
