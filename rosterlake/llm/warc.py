"""Web pages as WARC archives, written in shards that a rerun repeats byte for byte.

Pages are dealt to shards by their id and digest along bounds that follow from the data
alone: narrow rows of id, digest and size are sorted, their sizes summed, and a bound is
set each time a shard is full. Inside a shard records go by id. A shard is one task of
its own, and rolls to a further file when the compressed size is reached. A shard has
``SHARD_BYTES`` of payload at any size of the corpus; the bounds are 16 bytes a shard. Headers, record ids and digests
are made anew from the payload; the date is a parameter. So neither a rerun nor a
retried task changes a file.

A task writes under a temporary name of its own and returns what it wrote; these rows
are saved first, as the manifest. Only then are the files of the manifest renamed.
Files of failed or doubled attempts are not in it and keep their temporary names; a
commit that was cut off can be repeated.

Of pages with equal payloads the one with the smallest id is a response, the others
revisit it and carry no payload.

Cases: a null html is an empty payload; a null url is written as ``urn:none``; a null
id sorts first and reads back as null; rows that repeat an id are each a record; an
empty table gives no file and an empty result; other columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import Scratch, slices, texts_of

SHARD_BYTES = 64 << 20  # payload bytes of a shard
FILE_BYTES = 16 << 20  # compressed bytes after which a file is full
MIN_REVISIT_BYTES = 0
FILES_PER_TASK = 4
DATE = "2024-03-15T06:00:00Z"
SPACE = uuid.UUID("5f2c3c1e-6d0a-5b0e-9a51-0d7c2b1e4f60")

MANIFEST = (
    "shard bigint, number bigint, temporary string, name string, bytes bigint, records bigint, "
    "first_id bigint, last_id bigint, crc32 bigint"
)
READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def digested(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """Pages with size, SHA-1 for the record and SHA-256 to tell equal payloads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            data = texts_of(batch.column(2))
            more = [
                pa.array([len(d) for d in data], pa.int64()),
                pa.array([base32_sha1(d) for d in data]),
                pa.array([hashlib.sha256(d).digest() for d in data], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *batch.columns[1:], *more],
                ["page_id", "url", "html", "size", "digest", "same"],
            )

    return pages.select(key, url, html).mapInArrow(
        run, "page_id bigint, url string, html string, size bigint, digest string, same binary"
    )


NULL_ID = -(1 << 63)


@dataclass(frozen=True)
class Bounds:
    """First id and digest of all shards but the first, in order."""

    ids: np.ndarray
    digests: list[str]

    @property
    def shards(self) -> int:
        return len(self.ids) + 1

    def shard(self, ids: pa.Array, digests: pa.Array) -> np.ndarray:
        """Number of bounds up to a key; a null id comes first."""
        numbers = ids.fill_null(NULL_ID).to_numpy()
        low, high = (np.searchsorted(self.ids, numbers, side=s) for s in ("left", "right"))
        for row in np.flatnonzero(low < high):  # ids at which a shard begins
            low[row] = bisect_right(self.digests, digests[row].as_py(), low[row], high[row])
        return low


def shard_bounds(sizes: DataFrame, scratch: Scratch, shard_bytes: int = SHARD_BYTES) -> Bounds:
    """Where shards begin, from ``(page_id, digest, size)``.

    The sort is by Spark's ranges, but the sums do not depend on where those fall.
    """
    order = ["page_id", "digest", "size"]
    ranged = sizes.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = scratch.save(
        ranged.select(*order, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
        "ranged",
    )
    parts = rows.groupBy("part").agg(F.sum("size").alias("bytes"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("part", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    running = rows.withColumn("own", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(before, "part")
    shard = F.floor((F.col("before") + F.col("own")) / shard_bytes)
    key = F.struct(F.coalesce("page_id", F.lit(NULL_ID)).alias("id"), "digest")
    firsts = running.groupBy(shard.alias("shard")).agg(F.min(key).alias("first")).where("shard > 0")
    found = sorted({(r["first"]["id"], r["first"]["digest"]) for r in firsts.collect()})  # a row per shard
    scratch.drop(rows)
    return Bounds(np.array([i for i, _ in found], np.int64), [d for _, d in found])


def record(page_id, url: str | None, payload: bytes | None, size: int, digest: str, refers_to, date: str) -> bytes:
    """One WARC record; without payload it is a revisit of ``refers_to``."""

    def urn(number) -> str:
        return f"<urn:uuid:{uuid.uuid5(SPACE, f'{number}')}>"

    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    target = "".join(c for c in url or "urn:none" if c not in "\r\n")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if payload is not None else 'revisit'}",
        f"WARC-Record-ID: {urn(f'{page_id}:{digest}')}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
    ]
    if payload is None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {urn(f'{refers_to}:{digest}')}",
            f"X-Refers-To-Page-Id: {refers_to}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member without time stamp."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Files:
    """The rolling files of one shard."""

    def __init__(self, root: str, shard: int, file_bytes: int):
        self.files, self.root = fs.FileSystem.from_uri(root)
        self.shard, self.file_bytes = shard, file_bytes
        self.number, self.out = 0, None

    def add(self, page_id, data: bytes):
        if self.out is None:
            self.temporary = f"_temporary/{self.shard:06d}-{self.number:05d}-{uuid.uuid4().hex}"
            self.files.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out = self.files.open_output_stream(f"{self.root}/{self.temporary}", compression=None)
            self.bytes = self.records = self.crc = 0
            self.first = page_id
        member = gzip_member(data)
        self.out.write(member)
        self.bytes += len(member)
        self.crc = zlib.crc32(member, self.crc)
        self.records += 1
        self.last = page_id
        if self.bytes >= self.file_bytes:
            yield self.close()

    def close(self):
        self.out.close()
        self.out = None
        name = f"pages-{self.shard:06d}-{self.number:05d}.warc.gz"
        row = (self.shard, self.number, self.temporary, name, self.bytes, self.records, self.first, self.last, self.crc)
        self.number += 1
        return row


def write_archives(
    pages: DataFrame, root: str, scratch: Scratch, key: str = "page_id", url: str = "url", html: str = "html",
    shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, min_revisit_bytes: int = MIN_REVISIT_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Write the pages below ``root``; gives the committed manifest."""
    narrow = scratch.save(digested(pages, key, url, html).select("page_id", "size", "same", "digest"), "narrow")
    bounds = shard_bounds(narrow.select("page_id", "digest", "size"), scratch, shard_bytes)
    first = narrow.where(F.col("size") >= min_revisit_bytes).groupBy("same").agg(
        F.min("page_id").alias("first"), F.count("*").alias("copies")
    )
    repeated = first.where("copies > 1").select("same", "first")

    # Rows that share the smallest id of a payload are all responses; they name no other page.
    revisits = narrow.join(repeated, "same").where("page_id <> first")
    revisits = revisits.select("page_id", "same", "digest", "first").distinct()

    # A revisit travels as a note that sorts before the page itself, so payloads are
    # shuffled once, to their shard.
    text, number = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    notes = revisits.select(
        "page_id", text.alias("url"), text.alias("html"), number.alias("size"), text.alias("digest"), "same",
        F.col("first").alias("refers_to"), F.col("digest").alias("begin"),
    )
    whole = digested(pages, key, url, html).withColumn("refers_to", number).withColumn("begin", F.col("digest"))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = bounds.shard(batch.column(0), batch.column(7))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:7], pa.array(shard.astype(np.int32))], [*batch.schema.names[:7], "shard"]
            )

    columns = (
        "page_id bigint, url string, html string, size bigint, digest string, same binary, "
        "refers_to bigint, shard int"
    )
    # Partition n is shard n, so no two shards meet in a task.
    sharded = notes.unionByName(whole).mapInArrow(dealt, columns).repartitionById(
        bounds.shards, "shard"
    ).sortWithinPartitions("page_id", F.col("digest").asc_nulls_first(), "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rolled():
            files, noted, noted_id = None, {}, None
            for batch in slices(batches, 2):
                data = texts_of(batch.column(2))
                fields = zip(*[batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5, 6, 7)])
                for payload, (page_id, link, size, digest, same, refers_to, shard) in zip(data, fields):
                    if digest is None:
                        noted = {**(noted if noted_id == page_id else {}), same: refers_to}
                        noted_id = page_id
                        continue
                    if files is None or files.shard != shard:
                        if files is not None and files.out is not None:
                            yield files.close()
                        files = _Files(root, shard, file_bytes)
                    first_id = noted.get(same) if page_id is not None and noted_id == page_id else None
                    body = payload if first_id is None else None
                    yield from files.add(page_id, record(page_id, link, body, size, digest, first_id, date))
            if files is not None and files.out is not None:
                yield files.close()

        names = ["shard", "number", "temporary", "name", "bytes", "records", "first_id", "last_id", "crc32"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 5]
        for row in rolled():
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)

    manifest = f"{root}/manifest"
    sharded.mapInArrow(write, MANIFEST).write.parquet(manifest)
    scratch.drop(narrow)
    return commit(pages.sparkSession, root, manifest)


def commit(spark: SparkSession, root: str, manifest: str) -> DataFrame:
    """Give the files of a saved manifest their names; repeating it does no harm."""
    listed = spark.read.schema(MANIFEST).parquet(manifest)

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for temporary, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = files.get_file_info(f"{base}/{temporary}").type
                if held == fs.FileType.File:
                    files.move(f"{base}/{temporary}", f"{base}/{name}")
                elif files.get_file_info(f"{base}/{name}").type != fs.FileType.File:
                    raise FileNotFoundError(f"{root}/{name}")
            yield batch.select([1])

    done = listed.select("temporary", "name").mapInArrow(rename, "name string")
    done.agg(F.count("*")).first()
    return listed


def parsed(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record in a gzipped archive, one member after the other."""
    held = b""
    unpacker = zlib.decompressobj(31)
    out: list[bytes] = []
    for chunk in chunks:
        held = chunk
        while held:
            out.append(unpacker.decompress(held))
            held = unpacker.unused_data
            if unpacker.eof:
                yield _split(b"".join(out))
                unpacker, out = zlib.decompressobj(31), []
            else:
                break
    if out:
        raise ValueError("an archive ends inside a record")


def _split(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def read_archives(spark: SparkSession, root: str, listed: DataFrame) -> DataFrame:
    """A row per record of the archives in the manifest; payloads are checked against their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(root)

        def chunks(name: str) -> Iterator[bytes]:
            with files.open_input_stream(f"{base}/{name}", compression=None) as stream:
                while data := stream.read(1 << 20):
                    yield data

        def number(text: str | None):
            return int(text) if text else None

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                for headers, block in parsed(chunks(name)):
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind = headers["WARC-Type"]
                    if kind == "response" and base32_sha1(payload) != digest:
                        raise ValueError(f"{name}: payload and digest differ")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    refers = number(headers.get("X-Refers-To-Page-Id"))
                    rows.append((number(headers["X-Page-Id"]), size, digest, kind, refers))
                columns = zip(*rows)
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names)

    # The rows are few, the files behind them are not: the number of tasks is set here.
    tasks = max(1, -(-listed.count() // FILES_PER_TASK))
    return listed.select("name").repartition(tasks, "name").mapInArrow(run, READ)


def round_trip(pages: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """Write the archives, then read every record back."""
    root = f"{scratch.root}/archive"
    listed = write_archives(pages, root, scratch, **options)
    return read_archives(pages.sparkSession, root, listed)
