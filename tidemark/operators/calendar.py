"""Date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import fiscal_period, fiscal_quarter, fiscal_year


def date_spine(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last date of ``column``.

    Two numbers are aggregated; the days are generated by the executors.
    """
    span = df.agg(F.min(column).cast("date").alias("lo"), F.max(column).cast("date").alias("hi"))
    return span.where("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("date"))


def with_calendar(df: DataFrame, day: str = "date") -> DataFrame:
    """Calendar attributes; weekdays count from Monday = 1."""
    d = F.col(day)
    weekday = F.weekday(d) + 1
    return df.withColumns(
        {
            "date_sk": (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint"),
            "day": F.dayofmonth(d).cast("bigint"),
            "month": F.month(d).cast("bigint"),
            "month_name": F.date_format(d, "MMMM"),
            "quarter": F.quarter(d).cast("bigint"),
            "year": F.year(d).cast("bigint"),
            "day_of_week": weekday.cast("bigint"),
            "day_name": F.date_format(d, "EEEE"),
            "is_weekend": weekday >= 6,
            "is_month_end": d == F.last_day(d),
            "is_month_start": F.dayofmonth(d) == 1,
            "is_quarter_end": d == F.last_day(F.add_months(F.trunc(d, "quarter"), 2)),
            "is_quarter_start": d == F.trunc(d, "quarter"),
        }
    )


def with_fiscal(df: DataFrame, day: str = "date", start_month: int = 7) -> DataFrame:
    d: Column = F.col(day)
    return df.withColumns(
        {
            "fiscal_year": fiscal_year(d, start_month).cast("bigint"),
            "fiscal_quarter": fiscal_quarter(d, start_month).cast("bigint"),
            "fiscal_period": fiscal_period(d, start_month).cast("bigint"),
        }
    )
