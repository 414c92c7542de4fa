"""Schema drift: observed field types against a baseline."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.functions.values import members, type_name
from rosterlake.operators.constraints import enforced
from rosterlake.schemas import DRIFT_LOG_REQUIRED, DRIFT_LOG_SCHEMA, PII_ALERT, Field


def infer_schema(
    records: DataFrame, order: Sequence[str], names: Sequence[str] | None = None
) -> DataFrame:
    """Per field the type of its first non-null value in record order.

    ``record`` is a JSON object; its top-level members count. The last order
    column is a bigint. Members are first reduced to one row per leading order
    columns, field and type with a plain ``min``, which hash-aggregates before
    the shuffle; only that remainder (file splits x fields) is compared by the
    full order. A field that only ever holds null is a ``NoneType``. With ``names`` only
    these fields are looked at.
    """
    *leading, last = order
    spark = records.sparkSession
    found = records.select(*order, "record").lateralJoin(
        spark.tvf.variant_explode(F.col("record").outer())
    )
    if names is not None:
        found = found.where(F.col("key").isin(*names))
    seen = (
        # A step of its own, so that a value is classified once.
        found.select(*order, "key", F.schema_of_variant("value").alias("kind"))
        .select(*order, F.col("key").alias("field_name"), type_name(F.col("kind")).alias("type"))
        .groupBy(*leading, "field_name", "type")
        .agg(F.min(last).alias(last))
    )
    first = F.min_by(
        F.when(F.col("type") != "NoneType", F.col("type")),
        F.when(F.col("type") != "NoneType", F.struct(*order)),
    )
    return seen.groupBy("field_name").agg(F.coalesce(first, F.lit("NoneType")).alias("type_name"))


def canonical_state(fields: Sequence[Field]) -> list[Column]:
    """Aggregates of a batch of validated records, from which its fields follow.

    They are taken while the batch is written: a canonical record names every field,
    and a value in it is text.
    """
    valid = F.col("errors") == ""
    return [F.count_if(valid & F.col(f.name).isNotNull()).alias(f"seen_{f.name}") for f in fields]


def canonical_types(
    spark: SparkSession, figures: Mapping[str, int], fields: Sequence[Field]
) -> DataFrame:
    """What :func:`infer_schema` says of the valid records that ``figures`` were taken of."""
    some = figures["records"] > figures["invalid"]
    rows = [(f.name, "str" if figures[f"seen_{f.name}"] else "NoneType") for f in fields if some]
    return spark.createDataFrame(rows, "field_name string, type_name string")


def _kind(value: Column) -> Column:
    return F.when(~F.is_variant_null(value), F.schema_of_variant(value))


def with_kinds(records: DataFrame, names: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``records`` with what :func:`raw_state` compares: the place in the source and the kind
    of each field known by name, for which a record is unpacked once instead of once a field."""
    picked = records.withColumn("_members", members(F.col("record"), names))
    kinds = [_kind(F.col("_members")[name]).alias(f"_kind_{i}") for i, name in enumerate(names)]
    return picked.select(*records.columns, F.struct(*order).alias("_place"), *kinds)


def raw_state(names: Sequence[str], order: Sequence[str], unpacked: bool = False) -> list[Column]:
    """The same for records as sent: their common shape, and of the fields known by name
    the type of the first value. ``unpacked`` records come from :func:`with_kinds`."""
    state = [F.schema_of_variant_agg("record").alias("shape")]
    place = F.col("_place") if unpacked else F.struct(*order)
    for i, name in enumerate(names):
        value = F.try_variant_get("record", f"$['{name}']", "variant")
        kind = F.col(f"_kind_{i}") if unpacked else _kind(value)
        state.append(F.min_by(kind, F.when(kind.isNotNull(), place)).alias(f"first_{i}"))
    return state


# Shapes that only arise where all values of a field are of that type.
SURE_KINDS = {
    T.StringType: "STRING",
    T.LongType: "BIGINT",
    T.BooleanType: "BOOLEAN",
    T.NullType: "VOID",
    T.ArrayType: "ARRAY",
    T.StructType: "OBJECT",
}


def raw_types(
    spark: SparkSession,
    figures: Mapping[str, str | None],
    names: Sequence[str],
    look: Callable[[list[str] | None], DataFrame],
) -> DataFrame:
    """What :func:`infer_schema` says of the records that ``figures`` were taken of.

    Only fields that nobody knows and that hold values of several types, or numbers with a
    fraction, are left open by the state; ``look`` reads those in the stored records. It is
    asked for all fields where some record is no object.
    """
    shape = figures["shape"]
    if shape == "VOID" or shape is None:
        return spark.createDataFrame([], "field_name string, type_name string")
    if not shape.startswith("OBJECT<"):
        return look(None)
    first = {name: figures[f"first_{i}"] for i, name in enumerate(names)}
    kinds, open_fields = [], []
    for field in T.DataType.fromDDL(shape.replace("OBJECT<", "STRUCT<")).fields:
        kind = first.get(field.name) or SURE_KINDS.get(type(field.dataType))
        if kind is None:
            open_fields.append(field.name)
        else:
            kinds.append((field.name, kind))
    known = spark.createDataFrame(kinds, "field_name string, kind string")
    found = known.select("field_name", type_name(F.col("kind")).alias("type_name"))
    return found.unionByName(look(open_fields)) if open_fields else found


def baseline_frame(spark: SparkSession, baseline: Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame(list(baseline.items()), "field_name string, old_type string")


def native_names(fields: Mapping[str, str], field_map: Mapping[str, str]) -> dict[str, str]:
    """A baseline in canonical names, renamed to the names the source uses."""
    return {src: fields[dst] for src, dst in field_map.items() if dst in fields}


def native_pii(pii: Sequence[str], field_map: Mapping[str, str]) -> list[str]:
    """PII names as the source spells them, the canonical spelling included."""
    return [*pii, *[src for src, dst in field_map.items() if dst in pii]]


def detect_drift(
    observed: DataFrame, baseline: Mapping[str, str], pii: Sequence[str]
) -> DataFrame:
    """Drift events: fields added, removed or of another type.

    Both sides have one row per field name.
    """
    known = baseline_frame(observed.sparkSession, baseline)
    both = observed.join(known, "field_name", "full_outer")
    old, new = F.col("old_type"), F.col("type_name")
    change = (
        F.when(old.isNull(), "added")
        .when(new.isNull(), "removed")
        .when((old != new) & (new != "NoneType"), "type_changed")
    )
    return both.select(
        "field_name",
        change.alias("change_type"),
        "old_type",
        new.alias("new_type"),
        F.col("field_name").isin(*pii).alias("is_pii"),
    ).where("change_type IS NOT NULL")


def log_rows(events: DataFrame, source: str, entity: str, detected_at: dt.datetime) -> DataFrame:
    """Events as rows of the drift log, each with an id that a rerun repeats."""
    at = F.lit(detected_at).cast("timestamp")
    key = F.xxhash64(F.lit(source), F.lit(entity), at, F.col("field_name"), F.col("change_type"))
    return events.select(
        # Non-negative, as a serial number is.
        key.bitwiseAND(F.lit(2**63 - 1)).alias("id"),
        F.lit(source).alias("source"),
        F.lit(entity).alias("entity"),
        at.alias("detected_at"),
        "field_name",
        "change_type",
        "old_type",
        "new_type",
        "is_pii",
    )


def append_log(rows: DataFrame, source: str, detected_at: dt.datetime, log: str) -> None:
    """Write what was found in one source at one time to the log table.

    The log is partitioned by both, and their partition is written as a whole: a run that
    is repeated leaves each event once, and one that finds nothing leaves none.
    """
    spark = rows.sparkSession
    kept = [f for f in DRIFT_LOG_SCHEMA if f.name not in LOG_PARTITION]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in (*kept, *LOG_PARTITION.values()))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {log} ({columns}) USING parquet PARTITIONED BY ({', '.join(LOG_PARTITION)})"
    )
    at = detected_at if detected_at.tzinfo else detected_at.replace(tzinfo=dt.timezone.utc)
    partition = f"source = '{source}', detected_at = TIMESTAMP'{at.isoformat(sep=' ')}'"
    complete = enforced(rows, DRIFT_LOG_REQUIRED).select(*[f.name for f in kept])
    spark.sql(f"INSERT OVERWRITE TABLE {log} PARTITION ({partition}) SELECT * FROM {{rows}}", rows=complete)


LOG_PARTITION = {name: DRIFT_LOG_SCHEMA[name] for name in ("source", "detected_at")}


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.table(log).select(*DRIFT_LOG_SCHEMA.names)


def pii_alert(events: DataFrame) -> DataFrame:
    """One message naming the drifted PII fields, no row when there are none.

    PII names are a fixed short list, so the collected array is short too.
    """
    names = F.array_join(F.array_sort(F.collect_set("field_name")), ", ")
    return (
        events.where("is_pii")
        .agg(F.count("*").alias("events"), names.alias("fields"))
        .where("events > 0")
        .select(
            "events", F.concat(F.lit(PII_ALERT), "fields").alias("message")
        )
    )
