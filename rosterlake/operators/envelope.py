"""Raw envelope: source, key, JSON payload, load time and batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.operators.validate import sent
from rosterlake.schemas import Field


def _json_text(field: Field) -> Column:
    """A value in the spelling a JSON payload uses: nothing the source sent is rounded."""
    if field.kind in ("decimal", "timestamp"):
        return F.col(sent(field.name))
    return F.col(field.name).cast("string")


def payload_struct(fields: Sequence[Field]) -> Column:
    return F.struct(*[_json_text(f).alias(f.name) for f in fields])


def to_envelope(
    valid: DataFrame,
    fields: Sequence[Field],
    source: str,
    batch_id: str,
    ingested_at: dt.datetime,
    keep: Iterable[str] = (),
    as_text: bool = False,
) -> DataFrame:
    """Envelope rows of canonical records; the payload names every field, nulls too.

    Tables hold the payload as VARIANT, which parquet splits into one column per
    field; ``as_text`` gives the JSON text instead.
    """
    body = payload_struct(fields)
    payload = (
        F.to_json(body, {"ignoreNullFields": "false"}) if as_text else F.to_variant_object(body)
    )
    return valid.select(
        *keep,
        F.lit(source).alias("source"),
        "source_id",
        payload.alias("payload"),
        F.lit(ingested_at).cast("timestamp").alias("ingested_at"),
        F.lit(batch_id).alias("batch_id"),
    )
