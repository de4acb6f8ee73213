import datetime as dt

import pytest
from pyspark.sql import functions as F

from firmlake.functions import calendar as cal


def key(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "day, expected",
    [("2026-06-17", "20260604"), ("2026-06-05", "20260604"), ("2026-06-03", "20260504"), ("2026-01-03", "20251204"), ("2026-03-04", "20260204")],
)
def test_monthly(spark, day, expected):
    date = dt.date.fromisoformat(day)
    assert key(spark, cal.last_monthly_batch(F.lit(date))) == expected
    assert cal.monthly_batch_key(date) == expected


@pytest.mark.parametrize(
    "day, months, expected, strict",
    [
        ("2026-08-10", (1, 7), "20260704", "20260704"), ("2026-03-15", (1, 7), "20260104", "20260104"),
        ("2026-07-05", (1, 7), "20260704", "20260704"), ("2026-02-10", (4, 10), "20251004", "20251004"),
        # the plain rule looks at the month only, the strict one waits for the batch day
        ("2026-07-02", (7, 1), "20260704", "20260104"), ("2026-01-02", (1, 7), "20260104", "20250704"),
    ],
)
def test_half_year(spark, day, months, expected, strict):
    date = dt.date.fromisoformat(day)
    assert key(spark, cal.last_half_year_batch(F.lit(date), months=months)) == expected
    assert key(spark, cal.last_half_year_batch(F.lit(date), months=months, strict=True)) == strict
    assert cal.half_year_batch_key(date, months=months) == expected


def test_first_day_batch_reaches_into_the_month_before(spark):
    date = dt.date(2026, 3, 1)
    assert key(spark, cal.last_monthly_batch(F.lit(date), 1)) == cal.monthly_batch_key(date, 1) == "20260228"


def test_batch_day_must_exist_in_every_month():
    for day in (0, 29):
        with pytest.raises(ValueError):
            cal.monthly_batch_key(dt.date(2026, 1, 1), day)


def test_run_partition(spark):
    date = F.lit(dt.date(2026, 3, 1))
    assert key(spark, cal.run_partition(date, F.lit("daily"))) == "20260228"
    assert key(spark, cal.run_partition(date, F.lit("monthly"))) == "20260204"
    assert key(spark, cal.run_partition(date, F.lit("monthly"), F.lit(True))) == "20260104"
    assert key(spark, cal.previous_key(F.lit("20240301"))) == "20240229"
    assert cal.previous_day_key(dt.date(2024, 3, 1)) == "20240229"


@pytest.mark.parametrize("day, monthly, half", [("2026-07-05", True, True), ("2026-06-05", True, False), ("2026-07-06", False, False)])
def test_run_days(spark, day, monthly, half):
    date = F.lit(dt.date.fromisoformat(day))
    assert key(spark, cal.is_run_day(date, F.lit("daily"))) is True
    assert key(spark, cal.is_run_day(date, F.lit("monthly"))) is monthly
    assert key(spark, cal.is_run_day(date, F.lit("half_year"))) is half
