"""Calendar columns and indicators (Spark numbering: 1 = Sunday)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's dayofweek numbers Sunday as 1, so Monday is 2;
# the fourth quarter is months 10, 11 and 12.
MONDAY = 2
SUNDAY = 1
Q4_MONTHS = (10, 11, 12)


def calendar_columns(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day_of_week": F.dayofweek(date),
        "week_of_year": F.weekofyear(date),
        "year_month": F.date_format(date, "yyyy-MM"),
    }


def indicator(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def is_q4(month: Column) -> Column:
    return indicator(month.isin(*Q4_MONTHS))


def is_monday(day_of_week: Column) -> Column:
    return indicator(day_of_week == MONDAY)
