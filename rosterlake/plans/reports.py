"""Recruiting funnel and the ordered reading of reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions.dates import year_month
from rosterlake.functions.exact import rounded_quotient

FUNNEL_STAGES = ("applied", "phone_screen", "interview", "offer", "hired")

# Columns of the staged applications that the funnel reads.
FUNNEL_INPUTS = ("job_id", "job_title", "department", "stage", "applied_at", "time_in_stage_days")

# Columns a report is read by.
REPORT_ORDER = {
    "fct_headcount_daily": ("date", "department", "level"),
    "fct_attrition_monthly": ("department", "year_month"),
    "rpt_recruiting_funnel": ("year_month", "job_id"),
}


def _max_text(column: str, collation: str | None) -> Column:
    """Last text in the order of a collation, or of its bytes."""
    if collation is None:
        return F.max(column).alias(column)
    return F.collate(F.max(F.collate(column, collation)), "UTF8_BINARY").alias(column)


def funnel_counts(staged: DataFrame, collation: str | None = None) -> DataFrame:
    """Applications per job and month by current stage, with sum and number of
    days to hire.

    Counts are taken per title and department first. That step aggregates by
    hash (a ``max`` of text cannot) and spreads a popular job over many tasks;
    the second step sees a few rows per job and month.
    """
    hired_days = F.when(F.col("stage") == "hired", F.col("time_in_stage_days"))
    keys = ("job_id", "year_month")
    measures = [f"{s}_count" for s in FUNNEL_STAGES] + ["days_sum", "days_n"]
    by_title = (
        staged.withColumn("year_month", year_month(F.col("applied_at")))
        .groupBy(*keys, "job_title", "department")
        .agg(
            *[F.count_if(F.col("stage") == s).alias(f"{s}_count") for s in FUNNEL_STAGES],
            F.sum(hired_days).alias("days_sum"),
            F.count(hired_days).alias("days_n"),
        )
    )
    return by_title.groupBy(*keys).agg(
        _max_text("job_title", collation),
        _max_text("department", collation),
        *[F.sum(m).alias(m) for m in measures],
    )


def _rate(num: Column, den: Column, scale: int) -> Column:
    """``num / den`` rounded to one part in ``scale``; zero without a divisor."""
    return F.when(den > 0, rounded_quotient(scale * num, den)).otherwise(F.lit(0))


def rpt_recruiting_funnel(staged: DataFrame, collation: str | None = None) -> DataFrame:
    """Funnel by job and month. An application counts in its current stage only,
    so more may be hired than are on offer; a rejected one only makes the row.

    Where a job has several titles or departments the last one is shown, by bytes or, as
    databases order text, by a ``collation`` such as ``UNICODE`` or ``de``.
    """
    days, days_n = F.col("days_sum"), F.col("days_n")
    hired, offers = F.col("hired_count"), F.col("offer_count")
    return funnel_counts(staged, collation).select(
        "job_id",
        "year_month",
        "job_title",
        "department",
        *[f"{s}_count" for s in FUNNEL_STAGES],
        (_rate(days, days_n, 10) / 10).alias("application_to_hire_days_avg"),
        (_rate(hired, offers, 10000) / 100).alias("offer_acceptance_rate_pct"),
    )


def ordered(df: DataFrame, report: str) -> DataFrame:
    """A report in its reading order, NULLs last. Tables themselves have no order."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in REPORT_ORDER[report]])


def preview(df: DataFrame, report: str, n: int = 10) -> DataFrame:
    return ordered(df, report).limit(n)
