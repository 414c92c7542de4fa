"""Scans of dumped source pages.

A page is one JSON body ``{"data": [...], "_links": {...}}`` and takes one line
of a text file (or a whole file). Every record comes out as a VARIANT with its
place in the source: ``(src_file, src_block, src_row)``. Rows of one file split
stay in one task and in order, so the triple sorts records as the source sent
them without any global numbering job. ``src_file`` is a path whose last number is
padded, so ``page-10`` comes after ``page-2``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_ORDER = ("src_file", "src_block", "src_row")
RECORD_COLUMNS = "src_file string, src_block bigint, src_row bigint, record variant"


def page_records(pages: DataFrame, page: str = "page") -> DataFrame:
    """Explode the ``data`` array of parsed pages; a page without it has no records."""
    data = F.variant_get(F.col(page), "$.data", "array<variant>")
    kept = [c for c in pages.columns if c != page]
    return pages.select(*kept, F.posexplode(data).alias("pos", "record"))


def with_file_order(rows: DataFrame, path: Column, name: str) -> DataFrame:
    """``rows`` with text that sorts files by path, the last number of a file name by its value.

    It is made for every line, so one pattern looks at the file name alone, and what is
    used again is a step of its own.
    """
    file_name = F.substring_index(path, "/", -1)
    kept = rows.columns
    found = rows.select(*kept, path.alias("_path"), F.regexp_extract(file_name, r"[0-9]+[^0-9]*$", 0).alias("_tail"))
    found = found.select(*kept, "_path", "_tail", F.regexp_extract("_tail", r"^[0-9]*", 0).alias("_number"))
    padded = F.concat(
        F.left("_path", F.length("_path") - F.length("_tail")),
        F.lpad("_number", 20, "0"),
        F.substring("_tail", F.length("_number") + 1, F.length("_tail")),
    )
    return found.select(*kept, F.when(F.col("_tail") != "", padded).otherwise(F.col("_path")).alias(name))


PLACE = ("_metadata.file_path", "_metadata.file_block_start")


def _page_lines(spark: SparkSession, path: str | list[str], whole_files: bool) -> DataFrame:
    file, block = map(F.col, PLACE)
    lines = spark.read.text(path, wholetext=whole_files).select(file.alias("file"), block.alias("src_block"), "value")
    placed = with_file_order(lines, F.col("file"), "src_file").select("src_file", "src_block", "value")
    # Not by length, which counts the characters of every body.
    return placed.where(F.trim("value") != "")


def _page_elements(spark: SparkSession, path: str | list[str], whole_files: bool) -> DataFrame:
    """``(src_file, src_block, record)``: the elements of the array of every page, as VARIANT.

    The body is never one VARIANT, whose size is limited: the JSON reader makes one of each
    element and skips the other members. The array is exploded where it is parsed: of a
    column of its own Spark would first test the size, and parse every body twice.
    """
    shape = "data array<variant>"
    if whole_files:
        reader = spark.read.schema(shape).option("multiLine", True).option("mode", "FAILFAST")
        file, block = map(F.col, PLACE)
        bodies = reader.json(path).select(file.alias("file"), block.alias("src_block"), "data")
        placed = with_file_order(bodies, F.col("file"), "src_file")
        return placed.select("src_file", "src_block", F.explode("data").alias("record"))
    body = F.from_json("value", shape, {"mode": "FAILFAST"})
    return _page_lines(spark, path, False).select("src_file", "src_block", F.explode(body["data"]).alias("record"))


def _numbered(records: DataFrame, record: Column) -> DataFrame:
    return records.select(
        "src_file", "src_block", F.monotonically_increasing_id().alias("src_row"), record.alias("record")
    )


def read_pages(spark: SparkSession, path: str | list[str], whole_files: bool = False) -> DataFrame:
    """Records of all pages below ``path``. A body that is not JSON fails the job."""
    return _numbered(_page_elements(spark, path, whole_files), F.col("record"))


def unwrap_fields(row: Column) -> Column:
    """The ``fields`` object of a wrapped row, an empty object when it has none."""
    return F.coalesce(F.variant_get(row, "$.fields", "variant"), F.parse_json(F.lit("{}")))


def read_wrapped(spark: SparkSession, path: str | list[str], whole_files: bool = False) -> DataFrame:
    """Records of rows that arrive as ``{"fields": {...}}``, one row per line."""
    lines = _page_lines(spark, path, whole_files)
    parsed = lines.select("src_file", "src_block", F.parse_json("value").alias("row"))
    return _numbered(parsed, unwrap_fields(F.col("row")))


def no_records(spark: SparkSession) -> DataFrame:
    """What a source yields that is not configured."""
    return spark.createDataFrame([], RECORD_COLUMNS)


def first_records(records: DataFrame, n: int, order: Sequence[str] = RECORD_ORDER) -> DataFrame:
    """The first ``n`` records in source order. Each task keeps its own first ``n``."""
    return records.orderBy(*order).limit(n)
