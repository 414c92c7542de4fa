"""Keyed upsert into the raw tables.

A raw table is one catalog table per source, so a batch rewrites rows of its source only
and readers prune by source. The table is bucketed by its key: the merge reads it where
it lies, without a shuffle, and only the batch is dealt out to its buckets. The number of
buckets follows the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterlake.operators import tables
from rosterlake.operators.constraints import enforced
from rosterlake.schemas import RAW_REQUIRED, RAW_SCHEMA

KEYS = ("source", "source_id")
BUCKET_BYTES = 256 << 20
MOST_BUCKETS = 100_000  # Spark's own limit
UNKNOWN_BYTES = 1 << 60  # plans without statistics count as larger


def surrogate_id(*key: Column) -> Column:
    """UUID-shaped id of a new row, derived from its key.

    A random id would change when a lost executor's task runs again.
    """
    digest = F.md5(F.to_json(F.struct(*key)))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def last_per_key(
    batch: DataFrame, order: Sequence[str], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Of records that repeat a key within a batch, the last in record order.

    Keeping rank 1 lets Spark cut each key to one row per task before the
    shuffle, so a key that repeats a lot does not travel.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    ranked = batch.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.where(F.col("_rank") == 1).drop("_rank", *order)


def merge(
    target: DataFrame, batch: DataFrame, keys: Sequence[str] = KEYS, new_id: Column | None = None
) -> DataFrame:
    """Content of ``target`` after the upsert: one full outer join on the key.

    New keys get an id, known keys keep theirs and take payload, load time and
    batch from ``batch``; all other rows stay as they are. ``batch`` has one row
    per key.
    """
    replaced = ("payload", "ingested_at", "batch_id")
    old = target.select(
        *keys, "id", F.lit(True).alias("_known"), *[F.col(c).alias(f"_old_{c}") for c in replaced]
    )
    joined = old.join(batch.select(*keys, *replaced, F.lit(True).alias("_sent")), list(keys), "full_outer")
    return joined.select(
        F.when(F.col("_known"), F.col("id"))
        .otherwise(surrogate_id(*map(F.col, keys)) if new_id is None else new_id)
        .alias("id"),
        *keys,
        *[F.when(F.col("_sent"), F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in replaced],
    )


def source_table(table: str, source: str) -> str:
    return f"{table}_{source}"


def plan_bytes(df: DataFrame) -> int | None:
    """Size that the plan is known to have."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < UNKNOWN_BYTES else None


def bucket_count(target: DataFrame | None, known: int | None, batch: DataFrame) -> int:
    """Buckets of the next version: as many as now until they are over twice too large.

    A first batch of unknown size takes the shuffle partitions of the session.
    """
    sizes = [plan_bytes(f) for f in (target, batch) if f is not None]
    if None in sizes:
        return known or int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(MOST_BUCKETS, max(1, -(-sum(sizes) // BUCKET_BYTES)))
    return known if known and wanted <= 2 * known else wanted


def dealt_buckets(wanted: int, partitions: int) -> int:
    """Buckets of a first version, from a batch that lies in ``partitions`` by the hash of its key.

    A number that divides ``partitions``, so that a partition belongs to one bucket and its
    rows need not be dealt out again; ``wanted`` if there is none up to twice as large.
    """
    return next((n for n in range(wanted, min(2 * wanted, partitions) + 1) if partitions % n == 0), wanted)


def _buckets(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(int(r.data_type) for r in rows if r.col_name == "Num Buckets")


def write_upsert(
    spark: SparkSession, table: str, batch: DataFrame, source: str, order: Sequence[str]
) -> tables.Written:
    """Write the next version of one source's rows; it counts once it is committed.

    A row without a key, payload or batch fails the job, so nothing of the batch counts.
    """
    name = source_table(table, source)
    rows = last_per_key(batch.drop("source"), order, ("source_id",))
    before = tables.current(spark, name)
    target = spark.table(before) if before else None
    known = _buckets(spark, before) if before else None
    buckets = bucket_count(target, known, batch)
    dealt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if target is None:
        target = spark.createDataFrame([], RAW_SCHEMA)
        buckets = dealt_buckets(buckets, dealt)
    new_id = surrogate_id(F.lit(source).alias("source"), F.col("source_id"))
    merged = merge(target, rows, ("source_id",), new_id)
    if buckets != known and (before or dealt % buckets):
        # Dealt by the same hash that the table uses, so a bucket is one file. The first
        # batch lies by that hash already: a second shuffle would hold its payloads twice.
        merged = merged.repartition(buckets, "source_id")
    complete = enforced(merged.select(*RAW_SCHEMA.names), RAW_REQUIRED)
    return tables.write(complete, name, buckets=(buckets, "source_id"))


def upsert(
    spark: SparkSession, table: str, batch: DataFrame, source: str, order: Sequence[str]
) -> None:
    """Upsert envelope rows of one source."""
    write_upsert(spark, table, batch, source, order).commit()


def read_raw(spark: SparkSession, table: str, sources: Iterable[str]) -> DataFrame:
    """Raw rows of the named sources; the tables of other sources are not touched."""
    frames = [
        tables.read(spark, source_table(table, s), RAW_SCHEMA).withColumn("source", F.lit(s))
        for s in sources
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def serve_raw(spark: SparkSession, table: str, sources: Iterable[str]) -> None:
    """``table`` as a view over the sources that have rows, for readers by SQL."""
    columns = ", ".join(f"`{c}`" for c in RAW_SCHEMA.names)
    parts = [
        f"SELECT {columns}, '{s}' AS source FROM {source_table(table, s)}"
        for s in sources
        if tables.current(spark, source_table(table, s))
    ]
    if not parts:
        empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in RAW_SCHEMA)
        parts = [f"SELECT {empty}, '' AS source WHERE false"]
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS {' UNION ALL '.join(parts)}")
