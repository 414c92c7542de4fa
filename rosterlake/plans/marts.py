"""Employee dimension, daily headcount and monthly attrition."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.functions.dates import (
    date_lit,
    history_start,
    month_start,
    year_month,
)
from rosterlake.functions.exact import rounded_quotient
from rosterlake.functions.values import full_name, is_voluntary
from rosterlake.operators.dedup import newest_per_key
from rosterlake.operators.intervals import headcount
from rosterlake.operators.lineage import made_from
from rosterlake.schemas import NUMERIC, ROLLING_MONTHS, SENSITIVE_FIELDS

HEADCOUNT_KEYS = ("department", "level", "employment_type")
MONTHLY = (
    "month_start", "headcount_sum", "cells",
    "voluntary_terminations", "involuntary_terminations", "total_terminations",
)


def without_sensitive(df: DataFrame) -> DataFrame:
    """Guard: refuse a frame with a column that is made from a sensitive one, by any name."""
    leaked = made_from(df, SENSITIVE_FIELDS)
    if leaked:
        told = ", ".join(f"{column} (from {', '.join(made)})" for column, made in leaked.items())
        raise ValueError(f"sensitive columns must not leave staging: {told}")
    return df


def dim_employees(staged: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """One row per employee, the most recently ingested, without pay and rating."""
    # Narrow first, so that the sensitive columns are neither read nor shuffled.
    slim = staged.drop(*SENSITIVE_FIELDS)
    newest = newest_per_key(slim, "employee_id", "ingested_at", "source_system")
    dimension = newest.select(
        "employee_id",
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "email",
        "department",
        "job_title",
        "level",
        "hire_date",
        "termination_date",
        "is_active",
        "employment_type",
        "manager_id",
        "location",
        F.col("ingested_at").alias("created_at"),
        (F.current_timestamp() if run_ts is None else run_ts).alias("updated_at"),
    )
    return without_sensitive(dimension)


def fct_headcount_daily(employees: DataFrame, as_of: dt.date) -> DataFrame:
    """Employees per day, department, level and employment type; no zero rows."""
    return headcount(employees, HEADCOUNT_KEYS, as_of)


def monthly_terminations(employees: DataFrame) -> DataFrame:
    """Terminations per month and department. An employee without an id is
    neither voluntary nor involuntary and counts in the total only."""
    voluntary = is_voluntary(F.col("employee_id"))
    return (
        employees.where(F.col("termination_date").isNotNull())
        .groupBy(month_start(F.col("termination_date")).alias("month_start"), "department")
        .agg(
            F.count_if(voluntary).alias("voluntary_terminations"),
            F.count_if(~voluntary).alias("involuntary_terminations"),
            F.count("*").alias("total_terminations"),
        )
    )


def monthly_headcount(daily: DataFrame) -> DataFrame:
    """Sum and number of headcount cells per month and department.

    A cell is one daily row, so their mean is the mean per level and type.
    """
    return daily.groupBy(month_start(F.col("date")).alias("month_start"), "department").agg(
        F.sum("headcount").alias("headcount_sum"), F.count("*").alias("cells")
    )


def month_days(month: Column, as_of: dt.date) -> Column:
    """Days of the month that are on the day spine."""
    from_day = F.greatest(month, history_start(as_of))
    to_day = F.least(F.last_day(month), date_lit(as_of))
    return (F.datediff(to_day, from_day) + 1).cast("bigint")


def monthly_balance(employees: DataFrame, as_of: dt.date) -> DataFrame:
    """Per month and department the sum and number of headcount cells and the terminations.

    One pass over the employees: each gives the days on which a count changes and the
    day of the termination, which are summed before the shuffle to at most one row per
    task, key and day. The running counts are cut at month ends instead of being spread
    over days, and meet the terminations in one aggregate. Months without a headcount
    are no rows; terminations without a department count nowhere.
    """
    first_month, after_end = F.trunc(history_start(as_of), "MM"), F.date_add(date_lit(as_of), 1)
    start, until = F.greatest("hire_date", history_start(as_of)), F.least(
        F.coalesce("termination_date", after_end), after_end
    )
    left = F.col("termination_date")
    voluntary = is_voluntary(F.col("employee_id"))

    def event(day, delta, yes=F.lit(0), no=F.lit(0), total=F.lit(0)):
        return F.struct(
            day.alias("day"), delta.alias("delta"), yes.alias("yes"), no.alias("no"), total.alias("total")
        )

    spell = F.col("hire_date").isNotNull() & (start < until)
    counted = left.isNotNull() & left.between(first_month, F.last_day(date_lit(as_of)))
    chosen = F.coalesce(voluntary, F.lit(False)).cast("int")
    other = F.coalesce(~voluntary, F.lit(False)).cast("int")
    events = F.array_compact(
        F.array(
            F.when(spell, event(start, F.lit(1))),
            F.when(spell, event(until, F.lit(-1))),
            F.when(counted, event(left, F.lit(0), chosen, other, F.lit(1))),
        )
    )
    sums = ("delta", "yes", "no", "total")
    daily = (
        employees.select(*HEADCOUNT_KEYS, F.explode(events).alias("e"))
        .groupBy(*HEADCOUNT_KEYS, F.col("e.day").alias("day"))
        .agg(*[F.sum(f"e.{c}").alias(c) for c in sums])
    )
    by_day = Window.partitionBy(*HEADCOUNT_KEYS).orderBy("day")
    runs = daily.select(
        "department",
        "day",
        *sums[1:],
        F.sum("delta").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("count"),
        F.coalesce(F.lead("day").over(by_day), F.col("day")).alias("next"),
    )
    zero = F.lit(0).cast("bigint")

    def part(month, headcount, cells, yes=zero, no=zero, total=zero):
        named = zip((month, headcount, cells, yes, no, total), MONTHLY)
        return F.struct(*[c.alias(n) for c, n in named])

    def month_of_run(m):
        days = F.datediff(F.least("next", F.add_months(m, 1)), F.greatest("day", m)).cast("bigint")
        return part(m, F.col("count") * days, days)

    months = F.sequence(F.trunc("day", "MM"), F.trunc(F.date_sub("next", 1), "MM"), F.expr("interval 1 month"))
    running = F.when((F.col("count") > 0) & (F.col("day") < F.col("next")), F.transform(months, month_of_run))
    ended = F.when(
        F.col("department").isNotNull() & (F.col("total") > 0),
        F.array(part(F.trunc("day", "MM"), zero, zero, *[F.col(c) for c in sums[1:]])),
    )
    none = F.array_compact(F.array(F.when(F.lit(False), part(F.trunc("day", "MM"), zero, zero))))
    parts = F.concat(F.coalesce(running, none), F.coalesce(ended, none))
    grouped = (
        runs.select("department", F.explode(parts).alias("p"))
        .groupBy(F.col("p.month_start").alias("month_start"), "department")
        .agg(*[F.sum(f"p.{c}").alias(c) for c in MONTHLY[1:]])
    )
    return grouped.where("cells > 0")


def on_month_spine(months: DataFrame, monthly: DataFrame) -> DataFrame:
    """Rows of ``monthly`` on the spine. The spine has 12 rows a year, so it is
    broadcast."""
    return monthly.join(F.broadcast(months), "month_start")


def rolling_mean(rate: str) -> Column:
    """Mean of up to twelve rows per department, in the integer unit of ``rate``."""
    rows = (
        Window.partitionBy("department")
        .orderBy("month_start")
        .rowsBetween(-(ROLLING_MONTHS - 1), Window.currentRow)
    )
    return rounded_quotient(F.sum(rate).over(rows), F.count(rate).over(rows))


def fct_attrition_monthly(
    employees: DataFrame, as_of: dt.date, corrected: bool = False
) -> DataFrame:
    """Monthly terminations and attrition rates by department.

    The rate divides by the mean of headcount *cells*. ``corrected`` divides by
    the mean daily headcount of the department; give it employees staged
    without the retention cut.
    """
    monthly = monthly_balance(employees, as_of)
    if corrected:
        monthly = monthly.withColumn("cells", month_days(F.col("month_start"), as_of))
    total, summed, cells = (F.col(c) for c in ("total_terminations", "headcount_sum", "cells"))
    rates = monthly.withColumn(
        "rate_hundredths",
        F.when(summed > 0, rounded_quotient(10000 * total * cells, summed)).otherwise(0),
    )
    return rates.select(
        year_month(F.col("month_start")).alias("year_month"),
        "department",
        "voluntary_terminations",
        "involuntary_terminations",
        "total_terminations",
        (rounded_quotient(10 * summed, cells) / 10).alias("avg_headcount"),
        (F.col("rate_hundredths") / 100).alias("attrition_rate_pct"),
        (rolling_mean("rate_hundredths") / 100).alias("rolling_12m_attrition_rate_pct"),
    )


def serve(df: DataFrame, numerics: Iterable[str]) -> DataFrame:
    """Unbounded numerics as decimals with six places, ties away from zero."""
    return df.withColumns({c: F.col(c).cast(NUMERIC) for c in numerics})
