"""The derived inputs as DataFrames."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workloads.recipes import ctes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Recipes that have been written already: ``(sf_dir, name)`` to folder.
PREPARED: dict[tuple[str, str], str] = {}


def prepare(spark: SparkSession, sf_dir: str, names: Iterable[str], folder: str, files: int) -> None:
    """Write recipes in ``files`` files each, so that what reads them later does not build them."""
    for name in names:
        derived(spark, sf_dir, name).repartition(files).write.parquet(f"{folder}/{name}")
        PREPARED[sf_dir, name] = f"{folder}/{name}"


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Recipe ``name`` over the tables of ``sf_dir``."""
    if (sf_dir, name) in PREPARED:
        return spark.read.parquet(PREPARED[sf_dir, name])
    orders = table(spark, sf_dir, "orders")
    orders.createOrReplaceTempView("rosterlake_orders")
    for other in ("customer", "region"):
        table(spark, sf_dir, other).createOrReplaceTempView(f"rosterlake_{other}")
    own = r"\b(from|join) (orders|customer|region)\b"
    text = re.sub(own, r"\1 rosterlake_\2", ctes(name, "spark"))
    return spark.sql(f"with {text} select * from {name}")


def records(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A recipe of JSON payloads as ``(k, record)``; ``k`` is the record order."""
    return derived(spark, sf_dir, name).select("k", F.parse_json("payload").alias("record"))
