"""Catalog tables that are replaced as a whole.

``schema.name`` is a view. Every write is a table of its own, ``name__v<n>_<token>``, and
becomes the table when the view is pointed to it, after the job has succeeded and the
checks have passed: one step, so readers of any session see the old or the new version,
and a job that dies leaves the old one. The version before stays for readers that have
planned on it. Of two runs that replace a table at once, the one that ends later fails.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rosterlake.schemas import NUMERIC

VERSION = "rosterlake.version"
COMPRESSION = "zstd"  # of stored rows; a third smaller than Spark's default


class UnknownData(RuntimeError):
    """Files where a new schema should begin: the catalog that knew them is gone."""


class Conflict(RuntimeError):
    """Somebody else has replaced the table meanwhile."""


def create_schema(spark: SparkSession, schema: str, location: str) -> None:
    """A schema whose tables lie below ``location``; an existing one must lie there too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    folder = files.makeQualified(path).toUri().getPath()
    if spark.catalog.databaseExists(schema):
        known = spark.catalog.getDatabase(schema).locationUri
        if spark._jvm.org.apache.hadoop.fs.Path(known).toUri().getPath() != folder:
            raise ValueError(f"schema {schema} lies in {known}, not in {location}")
        return
    if files.exists(path) and len(files.listStatus(path)):
        raise UnknownData(f"{location} holds data, but the catalog has no schema {schema}")
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{location}'")


def versions(spark: SparkSession, name: str) -> list[str]:
    """Version tables of ``name``, committed or not, in the order of their numbers."""
    schema, table = name.split(".")
    if not spark.catalog.databaseExists(schema):
        return []
    found = [r.tableName for r in spark.sql(f"SHOW TABLES IN {schema} LIKE '{table}__v*'").collect()]
    known = [t for t in found if re.fullmatch(rf"{re.escape(table)}__v\d+_[0-9a-f]+", t)]
    return [f"{schema}.{t}" for t in sorted(known, key=_number)]


def _number(table: str) -> int:
    return int(table.rpartition("__v")[2].split("_")[0])


def current(spark: SparkSession, name: str) -> str | None:
    """The version table that the view reads."""
    if not spark.catalog.tableExists(name):
        return None
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return properties[VERSION]


@dataclass(frozen=True)
class Written:
    """A version that is written and not yet the table."""

    spark: SparkSession
    name: str
    before: str | None
    table: str

    def discard(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def commit(self, numerics: Iterable[str] = ()) -> None:
        """Point the view here, then drop versions that nobody needs.

        Unbounded ``numerics`` are served as decimals with six places.
        """
        spark, numerics = self.spark, set(numerics)
        if current(spark, self.name) != self.before:
            self.discard()
            raise Conflict(f"{self.name} is no longer {self.before}")
        columns = [
            f"CAST(`{c}` AS {NUMERIC.simpleString()}) AS `{c}`" if c in numerics else f"`{c}`"
            for c in spark.table(self.table).columns
        ]
        spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('{VERSION}' = '{self.table}') "
            f"AS SELECT {', '.join(columns)} FROM {self.table}"
        )
        for other in versions(spark, self.name):
            if other not in (self.before, self.table) and _number(other) < _number(self.table):
                spark.sql(f"DROP TABLE IF EXISTS {other}")


def write(
    df: DataFrame,
    name: str,
    buckets: tuple[int, str] | None = None,
    clustered: Sequence[str] = (),
) -> Written:
    """Write the next version of ``name``.

    ``buckets`` is a number and the column whose hash says in which file a row lies.
    ``clustered`` columns are range-partitioned and sorted, so that the statistics of a
    file let a reader of a few values skip the others.
    """
    spark = df.sparkSession
    found = versions(spark, name)
    number = _number(found[-1]) + 1 if found else 1
    target = Written(spark, name, current(spark, name), f"{name}__v{number}_{uuid.uuid4().hex[:8]}")
    laid = df.repartitionByRange(*clustered).sortWithinPartitions(*clustered) if clustered else df
    writer = laid.write.option("compression", COMPRESSION)
    if buckets:
        writer = writer.bucketBy(*buckets).sortBy(buckets[1])
    try:
        writer.saveAsTable(target.table)
    except Exception:
        target.discard()
        raise
    return target


def replace(
    df: DataFrame,
    name: str,
    check: Callable[[DataFrame], object] | None = None,
    numerics: Iterable[str] = (),
    clustered: Sequence[str] = (),
) -> object:
    """Write ``df`` as the table and give what ``check`` says about it.

    A version whose check raises, or whose job fails, is dropped; the table is as before.
    """
    written = write(df, name, clustered=clustered)
    try:
        verdict = check(df.sparkSession.table(written.table)) if check else None
    except Exception:
        written.discard()
        raise
    written.commit(numerics)
    return verdict


def read(spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Current version of a table as it was written; an empty frame when a schema is
    given and nothing has ever been written."""
    table = current(spark, name)
    if table is not None:
        return spark.table(table)
    if schema is None:
        raise FileNotFoundError(f"no table {name}")
    return spark.createDataFrame([], schema)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Full rebuild of a table; gives back what was written."""
    replace(df, name)
    return read(df.sparkSession, name)
