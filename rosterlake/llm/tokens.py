"""Token ids in ORC files.

Documents are range-partitioned and sorted by id, so every file holds a run of ids and
the stripes and row groups inside it hold short runs: their min/max statistics and the
Bloom filters on the id let a reader skip nearly all of a file, and stripes are read in
parallel. Ids are integer arrays, which ORC run-length encodes.

A file does not know how many ids come before it. ``with_starts`` adds that from a count
per file and a running sum inside it; no window spans more than a file's rows.

Cases: a null or empty text has only the end id; a null id sorts first; rows that
repeat an id are ordered by a hash of their text; an empty table gives an empty result;
other columns are not written. A text is encoded whole, however long.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import Scratch, slices, texts_of

END_ID = 2
STRIPE_BYTES = 16 << 20
ROWS_PER_INDEX = 1000
CACHED_WORDS = 500_000
WORDS_PER_LINE = 5000
SIGNS = b".,;:!?*#$%&"

ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(STRIPE_BYTES),
    "orc.create.index": "true",
    "orc.row.index.stride": str(ROWS_PER_INDEX),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
SCHEMA = "doc_id bigint, n_tokens bigint, ids array<int>"


class WordEncoder:
    """Encodes texts word by word.

    The tokenizer splits at white space first and its normaliser joins nothing across
    it, so the ids of a text are those of its words in a row. A worker encodes a word
    once: the new words of a batch go to the tokenizer in long lines, and the offsets
    of the ids tell the words apart. The memory is bounded: words that have not been seen
    for ``CACHED_WORDS`` others are forgotten.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def learn(self, words: list[bytes]) -> None:
        """Put the ids of new words into the cache."""
        for at in range(0, len(words), WORDS_PER_LINE):
            some = words[at : at + WORDS_PER_LINE]
            texts = [w.decode() for w in some]
            done = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ids = np.array(done.ids, "<u4")
            places = np.array([start for start, _ in done.offsets], np.int64)
            ends = np.cumsum([len(t) + 1 for t in texts])
            cuts = np.searchsorted(places, ends)
            packed, start = ids.tobytes(), 0
            for word, cut in zip(some, (4 * cuts).tolist()):
                self.known[word] = packed[start:cut]
                start = cut

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of every text as little-endian 32-bit integers."""
        if len(self.known) > CACHED_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        # The normaliser lowers letters anyway; only a special token's name may not be lowered.
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        new = set(chain.from_iterable(split)).difference(known)
        again = new.intersection(older)
        known.update(zip(again, map(older.__getitem__, again)))
        new -= again
        # Signs after a letter or digit are a piece of their own, so the parts are learned once.
        ends = {w: w.rstrip(SIGNS) for w in new}
        ends = {w: core for w, core in ends.items() if len(core) < len(w) and core[-1:].isalnum()}
        parts = {*new.difference(ends), *ends.values(), *[w[len(core) :] for w, core in ends.items()]}
        self.learn(list(parts.difference(known)))
        for w, core in ends.items():
            known[w] = known[core] + known[w[len(core) :]]
        return [b"".join(map(known.__getitem__, words)) for words in split]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def encoded(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of every row, in the order of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        end = np.asarray([END_ID], "<u4").tobytes()
        for batch in slices(batches, 1, 4 << 20):
            parts = [ids + end for ids in words.encode(texts_of(batch.column(1)))]
            sizes = np.fromiter((len(p) // 4 for p in parts), np.int64, len(parts))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32())
            ids = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(sizes), ids], ["doc_id", "n_tokens", "ids"]
            )

    return docs.select(key, text).mapInArrow(run, SCHEMA)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text"
) -> None:
    """Write the ids of ``docs`` in ascending order of ``key`` as ORC below ``path``.

    The committer of the writer keeps files of failed attempts out of the table.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    order = [F.col("_key"), F.xxhash64("_text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    encoded(ranged, tokenizer, "_key", "_text").write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_crc32)`` from the files below ``path``, with the place of a row
    in its file. Splits of a file are read in parallel, each a run of whole stripes."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            ends = lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
            counts = np.diff(ends).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(sums, pa.int64()), *batch.columns[2:]],
                ["doc_id", "n_tokens", "ids_crc32", "_file", "_row"],
            )

    stored = spark.read.schema(SCHEMA).orc(path).select(
        "doc_id",
        "ids",
        F.col("_metadata.file_name").alias("_file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_row"),
    )
    return stored.mapInArrow(
        digests,
        "doc_id bigint, n_tokens bigint, ids_crc32 bigint, _file string, _row struct<a:bigint,b:bigint>",
    )


def with_starts(read: DataFrame) -> DataFrame:
    """Adds ``start`` to saved rows of ``read_tokens``; part files are numbered in range order."""
    files = read.groupBy("_file").agg(F.sum("n_tokens").alias("_ids"))
    number = F.regexp_extract("_file", r"part-(\d+)", 1).cast("long")
    earlier = Window.orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("_file", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_file").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    running = read.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    joined = running.join(before, "_file")
    return joined.select(
        "doc_id", (F.col("_before") + F.col("_inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(
    docs: DataFrame, scratch: Scratch, tokenizer: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write the ids of ``docs`` and give what the files say about every document."""
    path = f"{scratch.root}/orc"
    write_tokens(docs, path, tokenizer, key, text)
    return with_starts(scratch.save(read_tokens(docs.sparkSession, path), "read"))
