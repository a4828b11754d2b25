"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | dt.date | Column) -> Column:
    """A date literal from ISO text or a ``date``; a column passes through."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def month_bucket(date: str | Column) -> Column:
    """The first day of the month of a date."""
    return F.trunc(date, "month")


def month_series(first: Column, last: Column) -> Column:
    """Every month start from ``first`` to ``last``, both included; empty when ``last`` is earlier."""
    months = F.sequence(first, F.greatest(first, last), F.expr("interval 1 month"))
    return F.when(first <= last, months).otherwise(F.array().cast("array<date>"))
