"""Canonical records, table schemas and the fixed values of the domain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One canonical field: its name, how it is read and whether it must be present."""

    name: str
    kind: str = "text"  # text | date | timestamp | decimal
    required: bool = True


# Unbounded numerics are served with six decimals.
NUMERIC = T.DecimalType(38, 6)

# Columns of the models that are such numerics.
SERVED_NUMERICS = {
    "fct_attrition_monthly": ("avg_headcount", "attrition_rate_pct", "rolling_12m_attrition_rate_pct"),
    "rpt_recruiting_funnel": ("application_to_hire_days_avg", "offer_acceptance_rate_pct"),
}

KIND_TYPES = {
    "text": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "decimal": NUMERIC,
}

# Envelope around a payload; ``source`` is the folder a row lives in.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("payload", T.VariantType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
    ]
)

RAW_REQUIRED = ("id", "source_id", "payload", "batch_id")

DRIFT_LOG_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("detected_at", T.TimestampType()),
        T.StructField("field_name", T.StringType()),
        T.StructField("change_type", T.StringType()),
        T.StructField("old_type", T.StringType()),
        T.StructField("new_type", T.StringType()),
        T.StructField("is_pii", T.BooleanType()),
    ]
)

DRIFT_LOG_REQUIRED = ("id", "source", "entity", "field_name", "change_type")

# ---------------------------------------------------------------------------
# They have to equal what the sources and consumers already use.
# ---------------------------------------------------------------------------

EMPLOYEE_FIELDS = (
    Field("source_id"),
    Field("first_name"),
    Field("last_name"),
    Field("email"),
    Field("department"),
    Field("job_title"),
    Field("hire_date", "date"),
    Field("termination_date", "date", required=False),
    Field("manager_id", required=False),
    Field("employment_type"),
    Field("level"),
    Field("location"),
    Field("salary", "decimal", required=False),
    Field("performance_rating", required=False),
)

APPLICATION_FIELDS = (
    Field("source_id"),
    Field("candidate_id"),
    Field("job_id"),
    Field("job_title"),
    Field("department"),
    Field("stage"),
    Field("applied_at", "timestamp"),
    Field("stage_changed_at", "timestamp"),
    Field("recruiter_id", required=False),
)

ENTITY_FIELDS = {"employees": EMPLOYEE_FIELDS, "job_applications": APPLICATION_FIELDS}

WORKER_FIELD_MAP = {
    "Worker_ID": "source_id",
    "Legal_First_Name": "first_name",
    "Legal_Last_Name": "last_name",
    "Work_Email": "email",
    "Cost_Center": "department",
    "Job_Title": "job_title",
    "Hire_Date": "hire_date",
    "Termination_Date": "termination_date",
    "Worker_Type": "employment_type",
    "Management_Level": "level",
    "Location": "location",
    "Manager_ID": "manager_id",
    "Base_Pay": "salary",
    "Performance_Rating": "performance_rating",
}
APPLICATION_FIELD_MAP = {
    "id": "source_id",
    "candidate_id": "candidate_id",
    "job_id": "job_id",
    "job_title": "job_title",
    "department": "department",
    "status": "stage",
    "applied_at": "applied_at",
    "last_activity_at": "stage_changed_at",
    "recruiter_id": "recruiter_id",
}

APPLICATION_STATUS_STAGE = {
    "active": "applied",
    "submitted": "applied",
    "phone_screen": "phone_screen",
    "interviewing": "interview",
    "offer_extended": "offer",
    "hired": "hired",
    "rejected": "rejected",
}
DEFAULT_STAGE = "applied"
DEFAULT_EMPLOYMENT_TYPE = "full_time"

EMPLOYMENT_TYPES = ("full_time", "part_time", "contractor")
STAGES = ("applied", "phone_screen", "interview", "offer", "hired", "rejected")
LEVELS = ("IC1", "IC2", "IC3", "IC4", "IC5", "IC6", "M1", "M2", "M3", "M4", "M5")

EMPLOYEE_SOURCES = ("workday", "airtable")
APPLICATION_SOURCES = ("greenhouse", "airtable")

PII_FIELDS = ("email", "first_name", "last_name", "salary", "performance_rating", "ssn")
SENSITIVE_FIELDS = ("salary", "performance_rating")


EMPLOYEE_BASELINE = {
    "source_id": "str",
    "first_name": "str",
    "last_name": "str",
    "email": "str",
    "department": "str",
    "job_title": "str",
    "hire_date": "str",
    "employment_type": "str",
    "level": "str",
    "location": "str",
}
APPLICATION_BASELINE = {
    "source_id": "str",
    "candidate_id": "str",
    "job_id": "str",
    "job_title": "str",
    "department": "str",
    "stage": "str",
    "applied_at": "str",
    "stage_changed_at": "str",
}
BASELINES = {"employees": EMPLOYEE_BASELINE, "job_applications": APPLICATION_BASELINE}

RETENTION_DAYS = 90
HISTORY_YEARS = 2
ROLLING_MONTHS = 12
PII_ALERT = "PII schema drift detected in fields: "
SOURCE_ID_LIMIT = 255

# Code points with the Unicode property White_Space.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
