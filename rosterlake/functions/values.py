"""Scalar expressions on text, JSON values and people attributes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterlake.schemas import APPLICATION_STATUS_STAGE, DEFAULT_STAGE, RETENTION_DAYS, WHITE_SPACE


def strip(text: Column) -> Column:
    """Drop leading and trailing white space, all of Unicode and not only blanks.

    Trimming looks every character up in the list. A text that begins and ends with a
    printed ASCII character has nothing to drop and is spared that.
    """
    ends = (F.ascii(text), F.ascii(F.substring(text, -1, 1)))
    printed = ends[0].between(33, 126) & ends[1].between(33, 126)
    return F.when(printed, text).otherwise(F.btrim(text, F.lit(WHITE_SPACE)))


def members(record: Column, keys: Iterable[str]) -> Column:
    """Struct of untyped members of a JSON object, read in one pass.

    A member is SQL NULL when its key is missing and a variant null when the key
    is there and holds null. What is no object has no members.
    """
    shape = ", ".join(f"`{key}`: variant" for key in keys)
    return F.try_variant_get(record, "$", f"struct<{shape}>")


def member_text(record: Column, key: str) -> Column:
    """Member as text; a missing key and a JSON null are both SQL NULL."""
    return F.variant_get(record, f"$.{key}", "string")


def default_missing(value: Column, default_json: str) -> Column:
    """Default for a missing key only; an explicit null stays null."""
    return F.coalesce(value, F.parse_json(F.lit(default_json)))


def stage_of(status: Column) -> Column:
    """Stage for a source status; unknown, null and missing are ``applied``."""
    pairs = [F.lit(x) for pair in APPLICATION_STATUS_STAGE.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), status), F.lit(DEFAULT_STAGE))


def type_name(kind: Column) -> Column:
    """Variant type, as ``schema_of_variant`` spells it, in the vocabulary of the drift log."""
    whole_number = kind.startswith("DECIMAL(") & kind.endswith(",0)")
    digits = F.regexp_extract(kind, r"^DECIMAL\((\d+),", 1)
    return (
        F.when(kind == "STRING", "str")
        .when(kind == "BIGINT", "int")
        .when(kind == "BOOLEAN", "bool")
        .when(kind == "VOID", "NoneType")
        .when(kind.startswith("OBJECT"), "dict")
        .when(kind.startswith("ARRAY"), "list")
        # Integers beyond 64 bits arrive as wide decimals without a fraction.
        .when(whole_number & (digits.try_cast("int") > 18), "int")
        .otherwise("float")
    )


def full_name(first: Column, last: Column) -> Column:
    """NULL as soon as one part is NULL."""
    return F.concat(first, F.lit(" "), last)


def is_voluntary(employee_id: Column) -> Column:
    """Fixed demo split: the first 32 bits of the id's MD5 are not a multiple of 4.

    Only the eighth hex digit decides divisibility by four.
    """
    return ~F.substring(F.md5(employee_id), 8, 1).isin("0", "4", "8", "c")


# The staging views are SQL, so these predicates are too.


def is_active(as_of: dt.date) -> str:
    return f"termination_date IS NULL OR termination_date > DATE'{as_of}'"


def is_retained(as_of: dt.date, days: int | None = RETENTION_DAYS) -> str:
    """Still employed, or left less than ``days`` days ago; ``None`` keeps everybody."""
    if days is None:
        return "true"
    return f"termination_date IS NULL OR termination_date > date_sub(DATE'{as_of}', {days})"
