"""Sums of money that do not depend on the order of addition.

Adding doubles gives a result that varies with the partitioning, so equal
customers could rank differently from run to run. Amounts are therefore added
as whole ten-thousandths in a decimal, which is exact, merges across any
number of aggregation levels, and is divided back once at the end. What is left
of an amount, digits after the fourth decimal, is added beside it as a double, so
nothing is lost; for amounts of up to four decimals it is exactly zero. The exact
part covers amounts below 1e14; larger ones (and NaN) are all added as doubles.

A sum NAME travels as two columns, ``NAME_units`` and ``NAME_rest``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

_UNITS_PER_ONE = 10_000
_FITS_BELOW = 1e14
_PART_BITS = 20


def _fits(amount: Column) -> Column:
    return F.abs(amount) < _FITS_BELOW


def _sum_units(amount: Column) -> Column:
    """The exact sum, added up in three parts of some 20 bits and put together once per group.

    A long holds a part's sum over 8e12 rows, and longs are added in place where a decimal sum
    makes new objects for every row.
    """
    whole = F.when(_fits(amount), F.rint(amount * _UNITS_PER_ONE).cast("long"))
    least = 2**_PART_BITS - 1
    low, middle = (part.bitwiseAND(F.lit(least)) for part in (whole, F.shiftright(whole, _PART_BITS)))
    parts = F.shiftright(whole, 2 * _PART_BITS), middle, low

    def weighted(place: int, part: Column) -> Column:
        return F.sum(part).cast("decimal(19,0)") * F.lit(Decimal(2 ** (_PART_BITS * place)))

    high, middle, low = (weighted(place, part) for place, part in zip((2, 1, 0), parts))
    return (high + middle + low).cast("decimal(28,0)")


def _rest(amount: Column) -> Column:
    exact = F.rint(amount * _UNITS_PER_ONE) / _UNITS_PER_ONE
    return F.when(_fits(amount), amount - exact).otherwise(amount)


def _value(units: Column, rest: Column) -> Column:
    exact = units.cast("double") / _UNITS_PER_ONE
    return F.coalesce(exact + rest, exact, rest)


def money_parts(amount: Column, name: str) -> list[Column]:
    """First-level aggregates of a money column."""
    return [
        _sum_units(amount).alias(f"{name}_units"),
        F.sum(_rest(amount)).alias(f"{name}_rest"),
    ]


def money_merge(name: str) -> list[Column]:
    """Aggregates that add up earlier sums of the same name."""
    return [F.sum(column).alias(column) for column in (f"{name}_units", f"{name}_rest")]


def money_value(name: str) -> Column:
    """The double value of a finished sum; NULL if every amount was NULL."""
    return _value(F.col(f"{name}_units"), F.col(f"{name}_rest"))


def money_sum(amount: Column) -> Column:
    """The same sum as one aggregate expression."""
    return _value(_sum_units(amount), F.sum(_rest(amount)))


def money_avg(amount: Column) -> Column:
    return money_sum(amount) / F.count(amount)
