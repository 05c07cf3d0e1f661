"""Calendar columns with fixed, locale-independent conventions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# A Sunday: weekday number n is this date plus n days.
SUNDAY = dt.date(2023, 1, 1)

# Names are blank-padded to this width, so that 'May      ' compares equal
# across every mart that shows a name.
NAME_WIDTH = 9


def as_date(value: dt.date | str | None) -> Column:
    """The reporting date as a DATE column; today when none is given."""
    if value is None:
        return F.current_date()
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def weekday_number(day: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return (F.dayofweek(day) - 1).cast("int")


def weekday_name(number: Column) -> Column:
    return F.rpad(F.date_format(F.date_add(F.lit(SUNDAY), number), "EEEE"), NAME_WIDTH, " ")


def month_name(number: Column) -> Column:
    return F.rpad(F.date_format(F.make_date(F.lit(2023), number, F.lit(1)), "MMMM"), NAME_WIDTH, " ")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.trunc(day, "week")


def month_label(start: Column) -> Column:
    return F.date_format(start, "yyyy-MM")


def days_in_month(start: Column) -> Column:
    return F.dayofmonth(F.last_day(start))
