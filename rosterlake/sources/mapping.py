"""Source-native records to canonical field names.

Mapping keeps every value as an untyped variant: whether a key was missing or
held null decides later if a record is valid, and a typed read loses that.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.functions.values import default_missing, members, stage_of
from rosterlake.schemas import (
    APPLICATION_FIELDS,
    DEFAULT_EMPLOYMENT_TYPE,
    EMPLOYEE_FIELDS,
    WORKER_FIELD_MAP,
)


def rename_members(
    records: DataFrame, field_map: Mapping[str, str], keep: Iterable[str] = ()
) -> DataFrame:
    """Pick and rename object members; members outside the map are dropped."""
    keep = list(keep)
    picked = records.select(*keep, members(F.col("record"), field_map).alias("_m"))
    return picked.select(*keep, *[F.col("_m")[src].alias(dst) for src, dst in field_map.items()])


def map_workers(records: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    return rename_members(records, WORKER_FIELD_MAP, keep)


def map_applications(records: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    keep = list(keep)
    same = ("candidate_id", "job_id", "job_title", "department", "applied_at", "recruiter_id")
    field_map = {"id": "source_id", "status": "status", "last_activity_at": "changed"}
    picked = rename_members(records, field_map | {name: name for name in same}, keep)
    return picked.select(
        *keep,
        "source_id",
        *same,
        stage_of(F.variant_get("status", "$", "string")).alias("stage"),
        # Falls back on a missing key only: an explicit null stays and is invalid.
        F.coalesce("changed", "applied_at").alias("stage_changed_at"),
    )


def map_wrapped_employees(records: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    mapped = rename_members(records, {f.name: f.name for f in EMPLOYEE_FIELDS}, keep)
    return mapped.withColumn(
        "employment_type",
        default_missing(F.col("employment_type"), f'"{DEFAULT_EMPLOYMENT_TYPE}"'),
    )


def map_wrapped_applications(records: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    return rename_members(records, {f.name: f.name for f in APPLICATION_FIELDS}, keep)
