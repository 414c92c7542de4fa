"""Newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, key: str, newest: str, tie_break: str) -> DataFrame:
    """Row with the greatest ``newest`` per ``key``; a NULL counts as newest.

    ``tie_break`` makes the choice repeatable. Ranks above 1 are cut in every
    task before the shuffle.
    """
    order = Window.partitionBy(key).orderBy(F.desc_nulls_first(newest), F.asc_nulls_last(tie_break))
    ranked = df.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") == 1).drop("_rank")
