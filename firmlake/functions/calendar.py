"""Batch calendar on business dates. No function reads the clock.

The Column functions work on a date column, so that one plan can cover many business dates. The plain twins give a
literal partition for file scans.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAILY, MONTHLY, HALF_YEAR = "daily", "monthly", "half_year"


def key_of(date: Column) -> Column:
    """Date as a yyyyMMdd partition key."""
    return F.date_format(date, "yyyyMMdd")


def previous_key(key: Column) -> Column:
    return key_of(F.date_sub(F.to_date(key, "yyyyMMdd"), 1))


def _check(monthly_day: int) -> None:
    if not 1 <= monthly_day <= 28:
        raise ValueError("the monthly batch day must exist in every month: 1..28")


def _day_of(year: Column, month: Column, monthly_day: int) -> Column:
    return F.make_date(year, month, F.lit(monthly_day))


def last_monthly_batch(date: Column, monthly_day: int = 5) -> Column:
    """Partition written by the last monthly batch: the day before the batch day of this or the previous month."""
    _check(monthly_day)
    this_month = _day_of(F.year(date), F.month(date), monthly_day)
    batch = F.when(F.dayofmonth(date) >= monthly_day, this_month).otherwise(F.add_months(this_month, -1))
    return key_of(F.date_sub(batch, 1))


def last_half_year_batch(
    date: Column, monthly_day: int = 5, months: Sequence[int] = (1, 7), strict: bool = False
) -> Column:
    """Partition of the last batch in one of ``months``.

    The plain rule looks at the month only, so it names this month's batch before the batch day as well; ``strict``
    waits for the day.
    """
    _check(monthly_day)
    ordered = sorted(months)
    result = _day_of(F.year(date) - 1, F.lit(ordered[-1]), monthly_day)
    for month in ordered:
        batch = _day_of(F.year(date), F.lit(month), monthly_day)
        reached = date >= batch if strict else F.month(date) >= month
        result = F.when(reached, batch).otherwise(result)
    return key_of(F.date_sub(result, 1))


def run_partition(date: Column, frequency: Column, half_year_init: Column | None = None, monthly_day: int = 5,
                  months: Sequence[int] = (1, 7)) -> Column:
    """Partition an interface writes on ``date``: yesterday for daily ones, the monthly batch partition otherwise.

    ``half_year_init`` marks interfaces with half-year months in an initial load; those write the half-year partition.
    """
    monthly = last_monthly_batch(date, monthly_day)
    if half_year_init is not None:
        monthly = F.when(half_year_init, last_half_year_batch(date, monthly_day, months)).otherwise(monthly)
    return F.when(frequency == DAILY, key_of(F.date_sub(date, 1))).otherwise(monthly)


def is_monthly_day(date: Column, monthly_day: int = 5) -> Column:
    return F.dayofmonth(date) == monthly_day


def is_run_day(date: Column, frequency: Column, monthly_day: int = 5, months: Sequence[int] = (1, 7)) -> Column:
    batch_day = is_monthly_day(date, monthly_day)
    return (
        F.when(frequency == MONTHLY, batch_day)
        .when(frequency == HALF_YEAR, batch_day & F.month(date).isin(list(months)))
        .otherwise(F.lit(True))
    )


def monthly_batch_key(date: dt.date, monthly_day: int = 5) -> str:
    _check(monthly_day)
    first = date.replace(day=1)
    if date.day < monthly_day:
        first = (first - dt.timedelta(days=1)).replace(day=1)
    return f"{first + dt.timedelta(days=monthly_day - 2):%Y%m%d}"


def half_year_batch_key(date: dt.date, monthly_day: int = 5, months: Sequence[int] = (1, 7)) -> str:
    _check(monthly_day)
    passed = [m for m in months if m <= date.month]
    first = dt.date(date.year, max(passed), 1) if passed else dt.date(date.year - 1, max(months), 1)
    return f"{first + dt.timedelta(days=monthly_day - 2):%Y%m%d}"


def previous_day_key(date: dt.date) -> str:
    return f"{date - dt.timedelta(days=1):%Y%m%d}"
