"""Employment spells against a day spine.

A spell is half-open: the hire day counts, the termination day does not.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.functions.dates import date_lit, history_start
from rosterlake.schemas import HISTORY_YEARS


def _clipped(employees: DataFrame, as_of: dt.date, years: int) -> DataFrame:
    """Spells cut to the history as ``[_from, _until)``; empty ones are dropped."""
    after_end = F.date_add(date_lit(as_of), 1)
    return (
        employees.where(F.col("hire_date").isNotNull())
        .withColumn("_from", F.greatest("hire_date", history_start(as_of, years)))
        .withColumn("_until", F.least(F.coalesce("termination_date", after_end), after_end))
        .where("_from < _until")
    )


def active_totals(
    employees: DataFrame, measures: Mapping[str, Column], least: Mapping[str, Column], as_of: dt.date,
    years: int = HISTORY_YEARS,
) -> DataFrame:
    """Per day the employees employed, sums of ``measures`` and minima of ``least`` over them.

    Sums follow from the days on which they change, like a headcount. A minimum has no
    inverse, so each day takes the least value per (first day, day after the last), of
    which there are at most as many as pairs of days in the history, whatever the
    number of employees.
    """
    spells = _clipped(employees, as_of, years)
    pairs = spells.groupBy("_from", "_until").agg(
        F.count("*").alias("employees"),
        *[F.sum(c).alias(n) for n, c in measures.items()],
        *[F.min(c).alias(n) for n, c in least.items()],
    )
    days = F.sequence("_from", F.date_sub("_until", 1), F.expr("interval 1 day"))
    return pairs.withColumn("date", F.explode(days)).groupBy("date").agg(
        F.sum("employees").alias("employees"),
        *[F.sum(n).alias(n) for n in measures],
        *[F.min(n).alias(n) for n in least],
    )


def headcount(
    employees: DataFrame, keys: Sequence[str], as_of: dt.date, years: int = HISTORY_YEARS
) -> DataFrame:
    """Employees per day and ``keys`` from the days on which the count changes.

    Each spell adds +1 on its first day and -1 on the day after its last. The
    changes are summed before the shuffle, so what travels is at most one row
    per task, key and day of the history whatever the number of employees, and
    a running sum has at most one row per day to sort.
    """
    after_end = F.date_add(date_lit(as_of), 1)
    changes = _clipped(employees, as_of, years).select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("_from").alias("day"), F.lit(1).alias("delta")),
                F.struct(F.col("_until").alias("day"), F.lit(-1).alias("delta")),
            )
        ).alias("change"),
    )
    daily = changes.groupBy(*keys, F.col("change.day").alias("day")).agg(
        F.sum("change.delta").alias("delta")
    )
    by_day = Window.partitionBy(*keys).orderBy("day")
    runs = daily.select(
        *keys,
        "day",
        F.sum("delta").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("headcount"),
        F.coalesce(F.lead("day").over(by_day), after_end).alias("_next"),
    ).where("headcount > 0 AND day < _next")
    days = F.sequence("day", F.date_sub("_next", 1), F.expr("interval 1 day"))
    return runs.select(F.explode(days).alias("date"), *keys, "headcount")
