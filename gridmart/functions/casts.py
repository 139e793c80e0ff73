"""Casts of source text: a value that does not parse becomes NULL, it never fails the job.

``try_cast`` to a number raises and swallows one exception per bad value, about 20 microseconds for an
integer. Feeds mark missing values with text such as ``ND``, so text that cannot be a number is screened
out by a cheap pattern first; the screen removes only text the cast would reject anyway.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_text(text: Column) -> Column:
    return text


def as_int(text: Column) -> Column:
    return F.when(~text.rlike("[A-Za-z.]|^$"), text.try_cast("int"))


def as_double(text: Column) -> Column:
    return F.when(text.rlike("[0-9]|(?i)nan|inf"), text.try_cast("double"))


def as_date(text: Column) -> Column:
    return text.try_cast("date")


def as_instant(text: Column) -> Column:
    """Instant of an ISO text; an offset is honoured, text without one is in session time (UTC)."""
    return text.try_cast("timestamp")


def month_of_period(period: Column) -> Column:
    """First day of a ``YYYY-MM`` period, NULL for quarters and other text."""
    return F.concat(period, F.lit("-01")).try_cast("date")


def padded_code(code: Column, width: int = 5) -> Column:
    """Code with its lost leading zeros restored; longer text is cut to ``width``."""
    return F.lpad(code, width, "0")


def clean_code(code: Column) -> Column:
    return F.upper(F.trim(code))
