"""Typed validation of mapped records and the admission of a batch."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.functions.values import strip
from rosterlake.schemas import KIND_TYPES, SOURCE_ID_LIMIT, Field

# Accepted spellings; a date may carry a midnight time.
DATE_TEXT = (
    r"^\d{4}-\d{2}-\d{2}([Tt _]00:00(:00([.,]0{1,9})?)?([Zz]|[+-]\d{2}:?\d{2})?)?$"
)
TIMESTAMP_TEXT = (
    r"^\d{4}-\d{2}-\d{2}([Tt _]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?([Zz]|[+-]\d{2}:?\d{2})?)?$"
)


WHOLE_NUMBER, ANY_NUMBER = r"^[+-]?\d+$", r"^[+-]?\d+(\.\d+)?$"
NUMBER_KIND = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"
# Seconds since 1970 up to here, milliseconds beyond; dates run from 1600 to 9999.
MILLISECONDS_FROM = 20_000_000_000
FIRST_SECOND, LAST_SECOND = -11_676_096_000, 253_402_300_799


class InvalidBatch(ValueError):
    """A strict batch held at least one invalid record."""


def sent(name: str) -> str:
    """Column of a value as the source sent it, for kinds whose typed form loses some of it."""
    return f"{name}__sent"


def _micros(field: Field, text: Column, kind: Column) -> Column:
    """Microseconds since 1970 of a time that is sent as a number, NULL for other texts.

    Text holds a whole number where a date is wanted, and any plain number for a time.
    """
    spelled = text.rlike(WHOLE_NUMBER if field.kind == "date" else ANY_NUMBER)
    is_number = kind.rlike(NUMBER_KIND) | ((kind == "STRING") & spelled)
    number = text.try_cast("decimal(38,9)")
    in_millis = F.abs(number) > MILLISECONDS_FROM
    known = F.when(in_millis, number.between(1000 * FIRST_SECOND, 1000 * LAST_SECOND + 999)).otherwise(
        number.between(FIRST_SECOND, LAST_SECOND)
    )
    micros = number * F.when(in_millis, F.lit(1_000)).otherwise(F.lit(1_000_000))
    return F.when(is_number & known, F.round(micros).cast("bigint"))


def _as_sent(field: Field, text: Column, value: Column, micros: Column) -> Column:
    """All digits of a number; a time in ISO spelling with its fraction and offset."""
    if field.kind == "decimal":
        return F.when(value.isNotNull(), strip(text))
    iso = F.translate(text, "t_ z,", "TTTZ.")
    day_only = F.concat(iso, F.lit("T00:00:00"))
    minutes = F.regexp_replace(iso, r"^(.{13}:\d{2})([Z+-]|$)", "$1:00$2")
    part = F.pmod(micros, F.lit(1_000_000))
    fraction = F.when(part != 0, F.concat(F.lit("."), F.lpad(part.cast("string"), 6, "0"))).otherwise(F.lit(""))
    counted = F.concat(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))
    spelled = F.when(F.length(iso) == 10, day_only).otherwise(minutes)
    return F.when(value.isNotNull(), F.when(text.rlike(TIMESTAMP_TEXT), spelled).otherwise(counted))


def _parsed(field: Field, text: Column, micros: Column) -> Column:
    """Typed value of a field, NULL when the text does not spell one."""
    if field.kind == "text":
        return strip(text)
    if field.kind == "date":
        spelled = F.when(text.rlike(DATE_TEXT), F.substring(text, 1, 10).try_cast("date"))
        day = F.lit(86_400_000_000)
        counted = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(micros / day).cast("int"))
        return F.coalesce(spelled, F.when(micros % day == 0, counted))
    if field.kind == "timestamp":
        plain = F.regexp_replace(F.translate(text, "tT_,", "   ."), r"([Zz]|[+-]\d{2}:?\d{2})$", "")
        plain = F.when(F.length(text) == 10, text).otherwise(plain)
        spelled = F.when(text.rlike(TIMESTAMP_TEXT), plain.try_cast("timestamp_ntz"))
        return F.coalesce(spelled, F.timestamp_micros(micros).cast("timestamp_ntz"))
    return text.try_cast(KIND_TYPES["decimal"])


def validate(mapped: DataFrame, fields: Sequence[Field], keep: Iterable[str] = ()) -> DataFrame:
    """Canonical typed columns, numbers and times also as sent, plus ``errors``: a
    comma-separated ``field:reason`` per broken rule, an empty text for a valid record.

    Reasons: ``missing`` (no such key), ``null``, ``type`` (not a JSON string; dates and
    times may be numbers), ``value`` (does not parse) and ``length``. Two narrow projections, so every
    value is read from the record once.
    """
    keep = list(keep)
    read = []
    for f in fields:
        source = F.col(f.name)
        if isinstance(mapped.schema[f.name].dataType, T.VariantType):
            text = F.variant_get(source, "$", "string")
            kind = F.schema_of_variant(source)
        else:
            text = source
            kind = F.when(source.isNotNull(), "STRING")
        read += [kind.alias(f"{f.name}__kind"), text.alias(f"{f.name}__text")]
    read_frame = mapped.select(*keep, *read)

    typed, rules = [], []
    for f in fields:
        kind, text = F.col(f"{f.name}__kind"), F.col(f"{f.name}__text")
        micros = _micros(f, text, kind) if f.kind in ("date", "timestamp") else F.lit(None)
        value = _parsed(f, text, micros)
        typed.append(value.alias(f.name))
        if f.kind in ("decimal", "timestamp"):
            typed.append(_as_sent(f, text, value, micros).alias(sent(f.name)))
        broken = []
        if f.required:
            broken += [(kind.isNull(), "missing"), (kind == "VOID", "null")]
        if f.kind == "text":
            broken.append((~kind.isin("STRING", "VOID"), "type"))
        elif f.kind != "decimal":
            broken.append((~(kind.isin("STRING", "VOID") | kind.rlike(NUMBER_KIND)), "type"))
        if f.kind != "text":
            broken.append((text.isNotNull() & value.isNull(), "value"))
        if f.name == "source_id":
            broken.append((F.length(value) > SOURCE_ID_LIMIT, "length"))
        rules.append(F.coalesce(*[F.when(when, f"{f.name}:{why}") for when, why in broken]))
    # Not concat_ws: all rules in one generated method are too long for the JIT
    # compiler, which makes the step half as fast again. The array is interpreted for
    # every row, so only records that break a rule get there.
    told = F.array_join(F.array_compact(F.array(*rules)), ",")
    errors = F.when(F.coalesce(*rules).isNull(), F.lit("")).otherwise(told)
    return read_frame.select(*keep, *typed, errors.alias("errors"))


def batch_summary(validated: DataFrame) -> DataFrame:
    """One row: records delivered and records that break a rule."""
    return validated.agg(
        F.count("*").alias("records"),
        F.count_if(F.col("errors") > "").alias("invalid"),
    )


def valid_records(landed: DataFrame) -> DataFrame:
    """Records that break no rule. For landed data: on a lazy frame the filter
    would be pushed down and read every record a second time."""
    return landed.where(F.col("errors") == "")


def rejected_records(landed: DataFrame) -> DataFrame:
    return landed.where(F.col("errors") > "")


def counted(validated: DataFrame, more: Iterable[Column] = ()) -> tuple[DataFrame, Observation]:
    """``validated`` with the figures of :func:`batch_summary`, and ``more`` aggregates,
    taken while it is written."""
    seen = Observation()
    figures = (F.count(F.lit(1)).alias("records"), F.count_if(F.col("errors") > "").alias("invalid"))
    return validated.observe(seen, *figures, *more), seen


def admit(
    landed: DataFrame, source: str, rejected: str, strict: bool = True, figures: dict | None = None
) -> tuple[DataFrame, int]:
    """Valid records of a batch and their number.

    Invalid records are written with their errors to ``rejected``. A strict
    batch is all or nothing: one invalid record refuses it. ``figures`` are the counts
    of the write; without them they are taken here.
    """
    figures = figures or batch_summary(landed).first().asDict()
    records, invalid = figures["records"], figures["invalid"]
    if invalid:
        rejected_records(landed).write.mode("overwrite").parquet(rejected)
        if strict:
            raise InvalidBatch(
                f"{source}: {invalid} of {records} records are invalid, see {rejected}"
            )
    return valid_records(landed), records - invalid
