"""Staging views: raw payloads as typed columns.

A staging model is written once, as SQL. It is applied to any frame of raw rows, and it
is the text of the catalog views that other sessions read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.functions.values import is_active, is_retained
from rosterlake.schemas import (
    APPLICATION_FIELDS,
    APPLICATION_SOURCES,
    EMPLOYEE_FIELDS,
    EMPLOYEE_SOURCES,
    NUMERIC,
    RETENTION_DAYS,
    Field,
)

EMPLOYEE_COLUMNS = (
    "source_id AS employee_id",
    "source AS source_system",
    "first_name",
    "last_name",
    "email",
    "department",
    "job_title",
    "level",
    "employment_type",
    "location",
    "manager_id",
    "CAST(hire_date AS DATE) AS hire_date",
    "CAST(nullif(termination_date, '') AS DATE) AS termination_date",
    f"CAST(nullif(salary, '') AS {NUMERIC.simpleString()}) AS salary",
    "nullif(performance_rating, '') AS performance_rating",
    "ingested_at",
)
APPLICATION_COLUMNS = (
    "source_id AS application_id",
    "source AS source_system",
    "candidate_id",
    "job_id",
    "job_title",
    "department",
    "stage",
    "recruiter_id",
    "CAST(applied_at AS TIMESTAMP_NTZ) AS applied_at",
    "CAST(stage_changed_at AS TIMESTAMP_NTZ) AS stage_changed_at",
)
# Whole 24-hour spans, toward zero.
TIME_IN_STAGE = "CAST(EXTRACT(DAY FROM stage_changed_at - applied_at) AS BIGINT) AS time_in_stage_days"


def _active(as_of: dt.date) -> str:
    return f"({is_active(as_of)}) AS is_active"


def scan_raw(raw: DataFrame, sources: Iterable[str]) -> DataFrame:
    return raw.where(F.col("source").isin(*sources))


def _member_texts(fields: Sequence[Field]) -> list[str]:
    """Members of a VARIANT as text, JSON null as NULL; the parquet scan narrows to them."""
    return [f"variant_get(payload, '$.{f.name}', 'string') AS {f.name}" for f in fields]


def _payload_texts(raw: DataFrame, fields: Sequence[Field], *kept: str) -> DataFrame:
    """Payload members as text next to ``kept`` columns.

    A JSON text goes through ``json_tuple``: a generator parses it once, where a filter
    on a plain expression would be pushed below and parse it again.
    """
    if isinstance(raw.schema["payload"].dataType, T.VariantType):
        return raw.selectExpr(*kept, *_member_texts(fields))
    names = [f.name for f in fields]
    return raw.select(*kept, F.json_tuple("payload", *names).alias(*names))


def flatten_employees(raw: DataFrame) -> DataFrame:
    """Employee payloads as typed columns; malformed dates and numbers are errors."""
    return _payload_texts(raw, EMPLOYEE_FIELDS, "source", "ingested_at").selectExpr(*EMPLOYEE_COLUMNS)


def stg_employees(
    raw: DataFrame, as_of: dt.date, retention_days: int | None = RETENTION_DAYS
) -> DataFrame:
    """Employees of the sources that own employees, without those who left more
    than ``retention_days`` before ``as_of``."""
    flat = flatten_employees(scan_raw(raw, EMPLOYEE_SOURCES))
    return flat.where(is_retained(as_of, retention_days)).selectExpr("*", _active(as_of))


def flatten_applications(raw: DataFrame) -> DataFrame:
    """Application payloads as typed columns with the days spent on the last move."""
    texts = _payload_texts(raw, APPLICATION_FIELDS, "source")
    return texts.selectExpr(*APPLICATION_COLUMNS).selectExpr("*", TIME_IN_STAGE)


def stg_job_applications(raw: DataFrame) -> DataFrame:
    return flatten_applications(scan_raw(raw, APPLICATION_SOURCES))


def _view(spark: SparkSession, name: str, raw: str, fields, sources, kept, columns, final: str) -> None:
    listed = ", ".join(f"'{s}'" for s in sources)
    texts = f"SELECT {', '.join([*kept, *_member_texts(fields)])} FROM {raw} WHERE source IN ({listed})"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {final.format(f'(SELECT {", ".join(columns)} FROM ({texts}))')}")


def create_views(
    spark: SparkSession,
    schema: str,
    employees: str,
    applications: str,
    as_of: dt.date,
    retention_days: int | None = RETENTION_DAYS,
) -> None:
    """Both models as catalog views over the raw tables, for readers in any session.

    Like every view of a run they hold its ``as_of``: a day later the next run replaces them.
    """
    _view(
        spark, f"{schema}.stg_employees", employees, EMPLOYEE_FIELDS, EMPLOYEE_SOURCES,
        ("source", "ingested_at"), EMPLOYEE_COLUMNS,
        f"SELECT *, {_active(as_of)} FROM {{}} WHERE {is_retained(as_of, retention_days)}",
    )
    _view(
        spark, f"{schema}.stg_job_applications", applications, APPLICATION_FIELDS, APPLICATION_SOURCES,
        ("source",), APPLICATION_COLUMNS, f"SELECT *, {TIME_IN_STAGE} FROM {{}}",
    )
