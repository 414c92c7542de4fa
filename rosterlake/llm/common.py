"""Small helpers that the corpus operators share."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.session import shared_folder

# A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % n


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without columns whose names, in any case, are among ``names``."""
    taken = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in taken])


class Scratch:
    """Tables of one operator call in the shared folder.

    A written table cuts the lineage: a lost executor repeats a read, not the work
    before it. ``drop`` frees a table as soon as a later one has replaced it; what is
    left goes when Spark ends.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.root, self.count = spark, shared_folder(spark, purpose), 0

    def save(self, df: DataFrame, name: str = "t") -> DataFrame:
        self.count += 1
        path = f"{self.root}/{name}-{self.count}"
        df.write.parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved.scratch_path = path
        # Spark deletes the shuffle files of a finished job once the driver has collected
        # what refers to them; in a chain of jobs they would fill the disks until then.
        self.spark._jvm.System.gc()
        return saved

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(frame.scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of every text, an empty one for null."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each hold about ``most`` bytes; a text is never cut."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.binary())), 0)
        block = np.cumsum(sizes.to_numpy(zero_copy_only=False)) // most
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)


def with_columns(
    df: DataFrame, added: Sequence[T.StructField], compute, text: str = "text"
) -> DataFrame:
    """``df`` with columns that ``compute(texts, batch) -> list of arrays`` adds, batch by batch.

    Every column of a row passes through. An input column with the name of an added
    one is replaced.
    """
    kept = without(df, [f.name for f in added])
    names = [f.name.lower() for f in df.schema]
    if text.lower() not in [c.lower() for c in kept.columns]:
        raise ValueError(f"column {text} would be replaced ({names})")
    place = [c.lower() for c in kept.columns].index(text.lower())
    schema = T.StructType([*kept.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place):
            if batch.num_rows:
                more = compute(texts_of(batch.column(place)), batch)
                fields = [pa.field(f.name, a.type) for f, a in zip(added, more)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *more], schema=pa.schema([*batch.schema, *fields])
                )

    return kept.mapInArrow(run, schema)


def word_counts(
    docs: DataFrame, by: str, text: str = "text", lowered: bool = False, most: int = 200_000
) -> DataFrame:
    """``(by, word, n)``: how often every word occurs per value of ``by``, over whole texts.

    A task hands out counts whenever it holds ``most`` different words, so its memory is
    bounded and the shuffle carries counts instead of occurrences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush():
            for value, counts in held.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([value] * len(counts), pa.string()),
                        pa.array(list(counts.keys()), pa.binary()).cast(pa.string()),
                        pa.array(list(counts.values()), pa.int64()),
                    ],
                    ["by", "word", "n"],
                )
            held.clear()

        for batch in slices(batches, 1):
            for value, data in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                words = (data.lower() if lowered else data).split()
                held.setdefault(value, Counter()).update(words)
            if sum(map(len, held.values())) > most:
                yield from flush()
        yield from flush()

    rows = docs.select(F.col(by).cast("string").alias("by"), text)
    return rows.mapInArrow(run, "by string, word string, n bigint").groupBy("by", "word").agg(
        F.sum("n").alias("n")
    )
