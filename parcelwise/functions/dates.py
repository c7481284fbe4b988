"""Calendar fields, whole-day and complete-hour differences, month filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from .numbers import fixed


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar days from ``start`` to ``end``; negative when ``end`` is earlier."""
    return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")


def stage_days(start: Column | str, end: Column | str) -> Column:
    """Complete hours between two instants, as days with three decimals.

    ``timestampdiff`` would read local times in the session time zone and lose or gain an
    hour at a clock change; the difference of two local times does not.
    """
    a, b = (F.col(x) if isinstance(x, str) else x for x in (start, end))
    hours = F.extract(F.lit("DAY"), b - a) * 24 + F.extract(F.lit("HOUR"), b - a)
    return fixed(hours.cast("double") / F.lit(24.0), 3)


def month_of(d: Column | str) -> Column:
    return F.trunc(d, "month")


def week_start(d: Column) -> Column:
    """The Sunday on or before ``d``."""
    return F.date_sub(d, F.dayofweek(d) - 1)


def sunday_week(d: Column) -> Column:
    """Week of the year, 0-53; week 1 begins on the first Sunday."""
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / F.lit(7)).cast("bigint")


def months_shift(d: date, months: int) -> Column:
    return F.add_months(F.lit(d), months)


def purchased_between(first: date, last: date, date_col: str = "order_purchase_date",
                      partition_col: str | None = "purchase_month") -> Column:
    """Date range that also states the range on the month partition.

    Spark prunes directories only from a predicate on the partition column itself, and
    does not derive it from the date, so both are written.
    """
    pred = F.col(date_col).between(F.lit(first), F.lit(last))
    if partition_col is None:
        return pred
    return pred & F.col(partition_col).between(F.lit(first.replace(day=1)),
                                               F.lit(last.replace(day=1)))
