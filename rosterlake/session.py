"""Session settings the jobs rely on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings; safe to apply to a session that somebody else created.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Bad casts must stop a model build instead of turning into nulls.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A record that repeats a key keeps the last value, as JSONB does.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark``."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within the block the shuffle files of a job go when the job ends.

    Spark keeps them until the driver collects its garbage, so a run of many jobs would
    have all of them on disk. Only for frames that one job reads: a second job on the same
    frame makes its shuffles again. Later jobs of the session are as before.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def local_session(cpus: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rosterlake")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that driver and executors share, removed when Spark exits.

    It lies below ``spark.checkpoint.dir``; a session without that setting takes the
    warehouse. A folder on local disks is refused unless the master is local too or
    the cluster itself named it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    base = named or spark.conf.get("spark.sql.warehouse.dir")
    plain = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/rosterlake-{purpose}-{uuid.uuid4().hex}")
    files = plain.getFileSystem(spark._jsc.hadoopConfiguration())
    folder = files.makeQualified(plain)
    if not named and folder.toUri().getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{base} is a local folder; set spark.checkpoint.dir to a shared one")
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return folder.toString()
