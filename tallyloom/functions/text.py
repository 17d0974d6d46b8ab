"""Cleaning and parsing of raw text columns.

Spark runs in ANSI mode, where a failed cast raises. Raw text is parsed with
``try_cast`` throughout, so a malformed value becomes NULL and the row stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

_DATE_AND_TIME = (
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    r"([ T][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}([.][0-9]{0,9})?)?)?$"
)
_INTEGER_PART = r"^([+-]?[0-9]+)([.][0-9]*)?$"


def has_key(*names: str) -> Column:
    """True where every named column is neither NULL nor empty."""
    return reduce(
        lambda left, right: left & right,
        [F.col(name).isNotNull() & (F.col(name) != "") for name in names],
    )


def lower_trim(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def upper_trim(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def blank_to_null(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def to_int(name: str) -> Column:
    """Whole number, or the whole part of a decimal number, else NULL.

    The pattern is only evaluated for text that is not a plain integer.
    """
    whole = F.regexp_extract(F.trim(F.col(name)), _INTEGER_PART, 1)
    return F.coalesce(F.col(name).try_cast("int"), whole.try_cast("int"))


def to_double(name: str) -> Column:
    return F.col(name).try_cast("double")


def _dated(name: str) -> Column:
    """The text if it has the form of a date or time without a zone, else NULL."""
    return F.when(F.trim(F.col(name)).rlike(_DATE_AND_TIME), F.col(name))


def to_timestamp(name: str) -> Column:
    """Timestamp without time zone; a lone year, or a text with a zone, is malformed."""
    return _dated(name).try_cast("timestamp_ntz")


def to_date(name: str) -> Column:
    return _dated(name).try_cast("date")


def day_of(name: str) -> Column:
    """The first ten characters, kept as text even if malformed."""
    return F.substring(F.col(name), 1, 10)


def month_of(name: str) -> Column:
    """The first seven characters, kept as text."""
    return F.substring(F.col(name), 1, 7)


def months_between(start: str, end: str) -> Column:
    """Whole calendar months from one YYYY-MM text column to another."""
    first, last = (
        F.concat(F.col(name), F.lit("-01")).try_cast("date") for name in (start, end)
    )
    return (F.year(last) - F.year(first)) * 12 + (F.month(last) - F.month(first))
