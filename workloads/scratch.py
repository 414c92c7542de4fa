"""Work folders and catalog schemas of the queries that write: dumped pages, tables, logs."""

import uuid

from pyspark.sql import SparkSession

from rosterlake.operators.tables import create_schema
from rosterlake.session import shared_folder as work_folder

__all__ = ["work_folder", "work_schema"]


def work_schema(spark: SparkSession, purpose: str) -> str:
    """A new schema whose tables lie in a work folder."""
    name = f"{purpose}_{uuid.uuid4().hex}"
    create_schema(spark, name, f"{work_folder(spark, purpose)}/{name}")
    return name
