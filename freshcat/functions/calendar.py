"""Calendar generators (X14-X16): month and day lists as array columns.

These replace Python loops over ``relativedelta``/``timedelta``: the list is an array
expression evaluated per row, and ``explode`` turns it into rows, so a calendar joins
like any other frame.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_sequence(start: Column, months_back: int) -> Column:
    """First days of ``months_back`` months, newest (``start``'s month) first.

    ``start`` may be a date or timestamp; the month is truncated first.
    """
    first = F.trunc(F.to_date(start), "month")
    return F.sequence(first, F.add_months(first, -(months_back - 1)), F.expr("INTERVAL -1 MONTH"))


def month_range(newest: Column, oldest: Column) -> Column:
    """First days of every month from ``newest`` back to ``oldest``, both included."""
    return F.sequence(
        F.trunc(F.to_date(newest), "month"),
        F.trunc(F.to_date(oldest), "month"),
        F.expr("INTERVAL -1 MONTH"),
    )


def day_sequence(start: Column, days: int) -> Column:
    """``days`` consecutive dates beginning at ``start``."""
    first = F.to_date(start)
    return F.sequence(first, F.date_add(first, days - 1))


def month_key(column: Column, fmt: str = "yyyyMM") -> Column:
    """Date -> month text (``yyyyMM`` for paths, ``yyyy-MM`` for arguments)."""
    return F.date_format(column, fmt)
