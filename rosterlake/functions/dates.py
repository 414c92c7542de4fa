"""Calendar helpers: spines and month buckets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.schemas import HISTORY_YEARS


def date_lit(day: dt.date) -> Column:
    return F.lit(day).cast("date")


def history_start(as_of: dt.date, years: int = HISTORY_YEARS) -> Column:
    """First day of the history: ``years`` before ``as_of``; 29 Feb becomes 28 Feb."""
    return F.add_months(date_lit(as_of), -12 * years)


def month_start(day: Column) -> Column:
    return F.trunc(day.cast("date"), "MM")


def year_month(day: Column) -> Column:
    return F.date_format(day.cast("date"), "yyyy-MM")


def day_spine(spark: SparkSession, as_of: dt.date, years: int = HISTORY_YEARS) -> DataFrame:
    """Every day of the history, both ends included."""
    days = F.sequence(history_start(as_of, years), date_lit(as_of), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date"))


def month_spine(spark: SparkSession, as_of: dt.date, years: int = HISTORY_YEARS) -> DataFrame:
    """First day of every month of the history, the current month included."""
    months = F.sequence(
        F.trunc(history_start(as_of, years), "MM"),
        F.trunc(date_lit(as_of), "MM"),
        F.expr("interval 1 month"),
    )
    return spark.range(1).select(F.explode(months).alias("month_start"))
