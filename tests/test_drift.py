import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rosterlake.operators.drift import (
    append_log,
    detect_drift,
    infer_schema,
    log_rows,
    native_names,
    native_pii,
    pii_alert,
    raw_state,
    raw_types,
    read_log,
    with_kinds,
)
from rosterlake.schemas import EMPLOYEE_BASELINE, PII_FIELDS, WORKER_FIELD_MAP
from tests.conftest import RUN_TS
from tests.people import record_frame, worker

BASELINE = {"badge": "int", "phone": "str", "skills": "list", "remote": "bool"}
PII = ("phone", "iban")
SAME = {"badge": 7, "phone": "+1", "skills": [], "remote": True}


def types(spark, *records):
    return {r.field_name: r.type_name for r in infer_schema(record_frame(spark, records), ["k"]).collect()}


def events(spark, *records, baseline=BASELINE, pii=PII):
    found = detect_drift(infer_schema(record_frame(spark, records), ["k"]), baseline, pii)
    return {tuple(r) for r in found.collect()}


@pytest.mark.parametrize(
    "value, name",
    [
        ("1", "int"), ("1.0", "float"), ("1e5", "float"), ("1.25", "float"), ('"x"', "str"),
        ("true", "bool"), ("null", "NoneType"), ("[1, 2]", "list"), ('{"a": {"b": 1}}', "dict"),
        ("9007199254740993", "int"), ("12345678901234567890123", "int"),
    ],
)
def test_type_names(spark, value, name):
    assert types(spark, '{"f": %s}' % value) == {"f": name}


def test_first_non_null_value_decides(spark):
    assert types(spark, {"a": None, "b": 1}, {"a": "x", "b": "y"}, {"a": 5}) == {"a": "str", "b": "int"}


def test_field_with_nulls_only(spark):
    assert types(spark, {"a": None}, {"a": None}) == {"a": "NoneType"}


def test_order_spans_several_columns(spark):
    frame = record_frame(spark, [{"a": 1}, {"a": "x"}, {"a": True}]).selectExpr(
        "concat('file-', 3 - k) as src_file", "k as src_row", "record"
    )
    assert [r.type_name for r in infer_schema(frame, ["src_file", "src_row"]).collect()] == ["bool"]


def test_no_drift_on_the_same_shape(spark):
    assert events(spark, SAME, SAME | {"skills": ["sql"]}) == set()


def test_several_changes_at_once(spark):
    changed = {"badge": "7a", "skills": {"sql": 1}, "remote": True, "iban": "DE", "desk": None}
    assert events(spark, changed) == {
        ("badge", "type_changed", "int", "str", False),
        ("skills", "type_changed", "list", "dict", False),
        ("phone", "removed", "str", None, True),
        ("iban", "added", None, "str", True),
        ("desk", "added", None, "NoneType", False),
    }


def test_change_of_type_behind_leading_nulls(spark):
    nothing = SAME | {"remote": None}
    assert events(spark, nothing, nothing) == set()
    late = events(spark, nothing, SAME | {"remote": "no"}, SAME)
    assert late == {("remote", "type_changed", "bool", "str", False)}


def test_late_field_of_one_record(spark):
    records = [SAME] * 60 + [SAME | {"iban": 3}] + [SAME] * 5
    assert events(spark, *records) == {("iban", "added", None, "int", True)}


def test_no_records_remove_every_field(spark):
    found = events(spark, SAME, baseline=BASELINE)
    assert found == set()
    none = infer_schema(record_frame(spark, [SAME]).where("k < 0"), ["k"])
    assert {(r.field_name, r.change_type) for r in detect_drift(none, BASELINE, PII).collect()} == {
        (f, "removed") for f in BASELINE
    }


def test_new_source_field_shows_on_raw_records(spark):
    found = events(
        spark,
        worker(1, ssn="000"),
        baseline=native_names(EMPLOYEE_BASELINE, WORKER_FIELD_MAP),
        pii=native_pii(PII_FIELDS, WORKER_FIELD_MAP),
    )
    assert ("ssn", "added", None, "str", True) in found
    assert ("Base_Pay", "added", None, "float", True) in found
    assert len(found) == 5


def test_alert_names_pii_fields(spark):
    records = record_frame(spark, [SAME | {"phone": 5, "iban": "1", "team": 1}])
    found = detect_drift(infer_schema(records, ["k"]), BASELINE, PII)
    assert tuple(pii_alert(found).first()) == (2, "PII schema drift detected in fields: iban, phone")


def test_no_alert_without_pii(spark):
    records = record_frame(spark, [SAME | {"team": 1}])
    assert pii_alert(detect_drift(infer_schema(records, ["k"]), BASELINE, PII)).count() == 0


def drifted(spark, *records):
    return detect_drift(infer_schema(record_frame(spark, records), ["k"]), BASELINE, PII)


def append(events, source, at, log, entity="employees"):
    append_log(log_rows(events, source, entity, at), source, at, log)


def test_a_repeated_append_gives_each_event_once(spark, schema):
    log, later = f"{schema}.schema_drift_log", RUN_TS + dt.timedelta(days=1)
    found, none = drifted(spark, SAME | {"t": 1}), drifted(spark, SAME)
    for source, at in (("workday", RUN_TS), ("airtable", RUN_TS), ("workday", later), ("workday", RUN_TS)):
        append(found, source, at, log)
    rows = read_log(spark, log).collect()
    assert sorted((r.source, r.detected_at.day, r.field_name, r.change_type) for r in rows) == [
        ("airtable", 15, "t", "added"), ("workday", 15, "t", "added"), ("workday", 16, "t", "added"),
    ]
    assert len({r.id for r in rows}) == 3 and all(r.id >= 0 for r in rows)
    append(drifted(spark, SAME | {"u": 1}), "workday", RUN_TS, log)  # the run again, with other data
    append(none, "workday", later, log)
    assert sorted((r.source, r.field_name) for r in read_log(spark, log).collect()) == [("airtable", "t"), ("workday", "u")]


def test_log_refuses_an_event_without_a_field(spark, schema):
    nameless = drifted(spark, SAME | {"t": 1}).withColumn("field_name", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="null in column field_name"):
        append(nameless, "workday", RUN_TS, f"{schema}.schema_drift_log")


def landed_types(spark, records, known):
    """Types as a landing takes them, and how often it had to look at the records again."""
    frame = record_frame(spark, records).repartition(3)
    figures = frame.agg(*raw_state(known, ["k"])).first().asDict()
    asked = []

    def look(names):
        asked.append(names)
        return infer_schema(frame, ["k"], names)

    found = raw_types(spark, figures, known, look)
    return {r.field_name: r.type_name for r in found.collect()}, asked


@pytest.mark.parametrize("seed", range(4))
def test_landing_state_equals_the_second_pass(spark, seed):
    rnd = random.Random(seed)
    samples = [None, 1, 2.5, True, "x", [1], {"z": 1}, 10**25, 1e300, -0.0]
    one_kind = {f: rnd.choice(samples) for f in "efgh"}
    records = [
        {f: one_kind.get(f, rnd.choice(samples)) for f in "abcdefgh" if rnd.random() < 0.4} for _ in range(50)
    ]
    want = {r.field_name: r.type_name for r in infer_schema(record_frame(spark, records), ["k"]).collect()}
    found, asked = landed_types(spark, records, ["a", "b", "e", "missing"])
    assert found == want
    assert not any("a" in names or "b" in names for names in asked)


@pytest.mark.parametrize("seed", range(2))
def test_unpacked_records_give_the_same_state(spark, seed):
    rnd = random.Random(seed)
    samples = [None, 1, 2.5, True, "x", [1], {"z": 1}, 10**25]
    records = [{f: rnd.choice(samples) for f in "abc" if rnd.random() < 0.5} for _ in range(30)] + ["5", "[1]"]
    frame, known = record_frame(spark, records).repartition(3), ["a", "b", "missing"]
    unpacked = with_kinds(frame, known, ["k"])
    want = frame.agg(*raw_state(known, ["k"])).first()
    assert unpacked.agg(*raw_state(known, ["k"], unpacked=True)).first() == want
    assert unpacked._jdf.queryExecution().optimizedPlan().toString().count("try_variant_get") == 1


def test_known_fields_need_no_second_look(spark):
    records = [SAME | {"badge": v} for v in (None, 1.5, "x")] + [SAME | {"new": "y"}]
    found, asked = landed_types(spark, records, list(BASELINE))
    assert found["badge"] == "float" and found["new"] == "str" and asked == []
    assert landed_types(spark, [SAME, "5"], list(BASELINE))[1] == [None]
    assert landed_types(spark, ["{}"], list(BASELINE))[0] == {}


def test_types_are_reduced_before_the_ordered_step(spark):
    plan = infer_schema(record_frame(spark, [SAME]), ["k"])._jdf.queryExecution().sparkPlan().toString()
    assert "partial_min(k" in plan and "HashAggregate" in plan and "Join" not in plan
