"""Checks declared for each model."""

from __future__ import annotations

from rosterlake.operators.quality import Check, accepted_values, expression, not_null, unique
from rosterlake.schemas import EMPLOYMENT_TYPES, LEVELS, STAGES

CHECKS: dict[str, list[Check]] = {
    "stg_employees": [
        not_null("stg_employees", "employee_id"),
        accepted_values("stg_employees", "employment_type", EMPLOYMENT_TYPES),
        not_null("stg_employees", "is_active"),
    ],
    "stg_job_applications": [
        not_null("stg_job_applications", "application_id"),
        accepted_values("stg_job_applications", "stage", STAGES),
    ],
    "dim_employees": [
        not_null("dim_employees", "employee_id"),
        unique("dim_employees", "employee_id"),
        not_null("dim_employees", "full_name"),
        accepted_values("dim_employees", "level", LEVELS),
        expression("dim_employees", "employee_id", "employee_id IS NULL", ["employee_id"]),
    ],
    "fct_headcount_daily": [
        not_null("fct_headcount_daily", "date"),
        not_null("fct_headcount_daily", "headcount"),
        expression(
            "fct_headcount_daily",
            "headcount",
            "headcount < 0",
            ["date", "department", "level", "headcount"],
        ),
    ],
    "fct_attrition_monthly": [
        not_null("fct_attrition_monthly", "year_month"),
        not_null("fct_attrition_monthly", "attrition_rate_pct"),
    ],
    "rpt_recruiting_funnel": [
        not_null("rpt_recruiting_funnel", "job_id"),
        not_null("rpt_recruiting_funnel", "offer_acceptance_rate_pct"),
    ],
}
