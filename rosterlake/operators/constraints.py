"""Columns that must not be null, enforced by the plan that writes them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enforced(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``df``, whose job fails on the first row that lacks a required value.

    The check is part of the projection that is written, so it costs no pass, and
    nothing of a refused batch becomes the table.
    """
    def checked(name: str):
        refusal = F.raise_error(F.lit(f"null in column {name}, which must have a value"))
        return F.when(F.col(name).isNull(), refusal).otherwise(F.col(name)).alias(name)

    return df.select(*[checked(c) if c in required else F.col(c) for c in df.columns])


def refused(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows that lack a required value, with the names of the empty columns."""
    empty = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    named = df.withColumn("null_columns", F.array_join(empty, ","))
    return named.where("null_columns > ''")
