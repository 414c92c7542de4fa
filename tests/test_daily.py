import datetime as dt
import gzip
import json
import os
import re
import time
import uuid
from dataclasses import replace

import pytest

from rosterlake.__main__ import parse
from rosterlake.operators import tables
from rosterlake.operators.drift import read_log
from rosterlake.operators.quality import QualityError
from rosterlake.operators.upsert import read_raw
from rosterlake.operators.validate import InvalidBatch
from rosterlake.plans import daily, staging
from rosterlake.plans.daily import RunConfig, run_daily
from rosterlake.schemas import APPLICATION_SOURCES, EMPLOYEE_SOURCES
from rosterlake.session import SHUFFLE_CLEANUP
from rosterlake.sources.pages import RECORD_ORDER
from rosterlake.sources.registry import SOURCES
from tests.conftest import AS_OF, RUN_TS
from tests.people import application, worker, write_pages
from workloads.frames import derived
from workloads.queries import dumped


def config(folder, workers, applications, wrapped=None, **kwargs):
    dumps = {
        "workday": {"employees": write_pages(folder, "workers", [workers])},
        "greenhouse": {"job_applications": write_pages(folder, "applications", [applications])},
    }
    if wrapped:
        dumps["airtable"] = wrapped
    return RunConfig(f"{folder}/lake", dumps, AS_OF, RUN_TS, prefix=f"t{uuid.uuid4().hex}_", **kwargs)


def wrapped_rows(folder, name, rows):
    os.makedirs(f"{folder}/{name}")
    with open(f"{folder}/{name}/rows.json", "w", encoding="utf-8") as out:
        out.write("\n".join(json.dumps({"fields": r}) for r in rows))
    return f"{folder}/{name}"


AIR = {
    "source_id": "x1", "first_name": "Eve", "last_name": "K", "email": "e@x", "department": "Data",
    "job_title": "T", "hire_date": "2023-02-01", "level": "M1", "location": "Remote - US",
}
APPLIED = {
    "source_id": "p1", "candidate_id": "c", "job_id": "J", "job_title": "T", "department": "D",
    "stage": "hired", "applied_at": "2024-01-01", "stage_changed_at": "2024-01-03",
}


def test_full_run(spark, folder):
    cfg = config(folder, [worker(i) for i in range(20)], [application(i) for i in range(7)])
    result = run_daily(spark, cfg)
    stats = {s.source: s for s in result.stats}
    assert (stats["workday"].rows, stats["greenhouse"].rows) == (20, 7)
    assert stats["airtable"].skipped and stats["airtable"].error is None
    # Optional fields are not in the baseline, so every run reports them.
    assert result.drift_events == 5
    assert result.alert == "PII schema drift detected in fields: performance_rating, salary"
    assert tables.read(spark, cfg.model("dim_employees")).count() == 20
    assert tables.read(spark, cfg.model("rpt_recruiting_funnel")).count() == 1
    assert all(c.failures == 0 for checks in result.checks.values() for c in checks)
    assert sum(len(c) for c in result.checks.values()) == 17
    other = spark.newSession()
    assert other.table(cfg.staged("stg_employees")).count() == 20
    assert other.table(cfg.staged("stg_job_applications")).count() == 7
    assert dict(other.table(cfg.model("fct_attrition_monthly")).dtypes)["avg_headcount"] == "decimal(38,6)"
    run_daily(spark, cfg)
    assert read_raw(spark, cfg.raw("employees"), ["workday"]).count() == 20
    assert other.table(cfg.raw("employees")).count() == 20
    assert read_log(spark, cfg.drift_log).count() == 5  # the same run again
    run_daily(spark, replace(cfg, run_ts=RUN_TS + dt.timedelta(days=1)))
    assert read_log(spark, cfg.drift_log).count() == 10


def shuffles_on_disk(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return set(re.findall(r"/shuffle_(\d+)_", files.mkString("\n")))


def test_a_run_leaves_the_shuffles_of_no_table(spark, folder, monkeypatch):
    made, write = set(), tables.write

    def written(df, name, *args, **kwargs):
        before = shuffles_on_disk(spark)
        version = write(df, name, *args, **kwargs)
        if "analytics" in name:  # those of the funnel may show beside those of employees
            made.update(shuffles_on_disk(spark) - before)
        return version

    monkeypatch.setattr(tables, "write", written)
    run_daily(spark, config(folder, [worker(i) for i in range(20)], []))
    until = time.monotonic() + 20  # they go a moment after their job
    while made & shuffles_on_disk(spark) and time.monotonic() < until:
        time.sleep(0.2)
    assert not made & shuffles_on_disk(spark)
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None


def test_dumps_are_compressed_and_in_order(spark, folder):
    orders = spark.range(450).selectExpr(
        "id o_orderkey", "id % 9 o_custkey", "'O' o_orderstatus", "1.5D o_totalprice",
        "timestamp_ntz'1995-01-01' + make_dt_interval(cast(id as int)) o_orderdate", "'1-URGENT' o_orderpriority",
    )
    sf = f"{folder}/sf"
    orders.repartition(3).write.parquet(f"{sf}/orders.parquet")
    for other in ("customer", "region"):
        spark.range(2).write.parquet(f"{sf}/{other}.parquet")
    dumps = dumped(spark, sf, folder)
    for source, (entity, recipe, column, order) in {
        "greenhouse": ("job_applications", "application_pages", "page", "first_k"),
        "airtable": ("employees", "wrapped_employees", "page_row", "k"),
    }.items():
        path = dumps[source][entity]
        assert {f.split(".", 1)[1] for f in os.listdir(path) if f.startswith("part")} == {"txt.gz"}
        want = [r[0] for r in derived(spark, sf, recipe).orderBy(order).select(column).collect()]
        files = sorted(f"{path}/{f}" for f in os.listdir(path) if f.startswith("part"))
        got = [line for f in files for line in gzip.open(f, "rt", encoding="utf-8").read().splitlines()]
        assert got == want and len(got) > 4
    read = SOURCES["greenhouse"].read(spark, dumps["greenhouse"]["job_applications"])
    ids = [r.id for r in read.orderBy(*RECORD_ORDER).selectExpr("variant_get(record, '$.id', 'string') id").collect()]
    assert ids == [f"A{i}" for i in range(450)]


def test_sources_merge_one_at_a_time(spark, folder, monkeypatch):
    running, most = [], []
    upsert = daily.write_upsert

    def watched(*args):
        running.append(1)
        most.append(len(running))
        try:
            return upsert(*args)
        finally:
            running.pop()

    monkeypatch.setattr(daily, "write_upsert", watched)
    air = {"employees": wrapped_rows(folder, "air", [AIR]), "job_applications": wrapped_rows(folder, "apps", [APPLIED])}
    run_daily(spark, config(folder, [worker(1)], [application(1)], air))
    assert most == [1, 1, 1, 1]


def test_staging_views_equal_the_models(spark, folder):
    left = worker(2, Termination_Date="2023-01-15", Hire_Date="2022-01-10", Base_Pay=None)
    cfg = config(folder, [worker(1), left, worker(3, Performance_Rating="")], [application(1), application(2)])
    run_daily(spark, cfg)
    raw = read_raw(spark, cfg.raw("employees"), EMPLOYEE_SOURCES)
    view, model = spark.table(cfg.staged("stg_employees")), staging.stg_employees(raw, AS_OF)
    assert view.schema == model.schema and sorted(view.collect()) == sorted(model.collect())
    raw = read_raw(spark, cfg.raw("job_applications"), APPLICATION_SOURCES)
    view, model = spark.table(cfg.staged("stg_job_applications")), staging.stg_job_applications(raw)
    assert view.schema == model.schema and sorted(view.collect()) == sorted(model.collect())
    slim = spark.table(cfg.staged("stg_employees")).select("department")
    plan = slim._jdf.queryExecution().executedPlan().toString()
    assert "salary" not in plan


def test_drift_of_every_source_shows(spark, folder):
    wrapped = {
        "employees": wrapped_rows(folder, "air-emp", [AIR | {"iban": "x"}]),
        "job_applications": wrapped_rows(folder, "air-app", [APPLIED | {"referrer": {"a": 1}, "score": 1.5}]),
    }
    applications = [application(1, rank=3), application(2, email="a@b")]
    cfg = config(folder, [worker(1, ssn=5)], applications, wrapped, drift_raw=True)
    result = run_daily(spark, cfg)
    added = {
        (r.source, r.entity, r.field_name, r.new_type, r.is_pii)
        for r in read_log(spark, cfg.drift_log).where("change_type = 'added'").collect()
    }
    assert {
        ("workday", "employees", "ssn", "int", True), ("airtable", "employees", "iban", "str", False),
        ("airtable", "job_applications", "referrer", "dict", False),
        ("airtable", "job_applications", "score", "float", False),
        ("greenhouse", "job_applications", "rank", "int", False),
        ("greenhouse", "job_applications", "email", "str", True),
    } <= added
    assert "ssn" in result.alert and "email" in result.alert


def test_ssn_shows_in_raw_mode_only(spark, folder):
    workers = [worker(i, ssn="000") for i in range(3)]
    cfg = config(folder, workers, [application(1)], drift_raw=True)
    result = run_daily(spark, cfg)
    assert "ssn" in result.alert
    assert spark.sql(f"select count(*) n from {cfg.model('dim_employees')}").first().n == 3
    canonical = run_daily(spark, replace(cfg, drift_raw=False))
    assert "ssn" not in canonical.alert


def test_drift_finds_a_late_field(spark, folder):
    workers = [worker(i, **({"ssn": "000"} if i == 59 else {})) for i in range(60)]
    cfg = config(folder, workers, [application(1)], drift_raw=True)
    assert "ssn" in run_daily(spark, cfg).alert
    sampled = replace(cfg, drift_sample=50)
    assert "ssn" not in run_daily(spark, sampled).alert


def test_failed_checks_keep_the_published_version(spark, folder):
    cfg = config(folder, [worker(1)], [application(1)])
    run_daily(spark, cfg)
    for n in range(3):
        bad = [worker(1), worker(2, Management_Level="X9")]
        dumps = {**cfg.dumps, "workday": {"employees": write_pages(folder, f"bad{n}", [bad])}}
        with pytest.raises(QualityError):
            run_daily(spark, replace(cfg, dumps=dumps))
        assert spark.table(cfg.model("dim_employees")).count() == 1
        assert tables.read(spark, cfg.model("dim_employees")).count() == 1


def test_failed_staging_check_keeps_the_model(spark, folder):
    cfg = config(folder, [worker(1)], [application(1)])
    run_daily(spark, cfg)
    bad = [worker(1), worker(2, Worker_Type="intern"), worker(3, Worker_Type="intern")]
    dumps = {**cfg.dumps, "workday": {"employees": write_pages(folder, "bad", [bad])}}
    with pytest.raises(QualityError, match=r"accepted_values_stg_employees_employment_type \(1\)"):
        run_daily(spark, replace(cfg, dumps=dumps))
    assert spark.table(cfg.model("dim_employees")).count() == 1


def test_corrected_run_counts_everybody_who_left(spark, folder):
    left = worker(2, Hire_Date="2022-01-01", Termination_Date="2023-06-15")
    cfg = config(folder, [worker(1), left], [application(1)], corrected=True)
    run_daily(spark, cfg)
    rows = tables.read(spark, cfg.model("fct_attrition_monthly")).where("year_month = '2023-06'").collect()
    assert [r.total_terminations for r in rows] == [1]


def test_unknown_entity_is_refused_before_anything_lands(spark, folder):
    cfg = config(folder, [worker(1)], [application(1)])
    dumps = {**cfg.dumps, "greenhouse": {**cfg.dumps["greenhouse"], "employees": folder}}
    with pytest.raises(NotImplementedError):
        run_daily(spark, replace(cfg, dumps=dumps))
    assert not os.path.exists(cfg.root)


def test_optional_source_lands_both_entities(spark, folder):
    wrapped = {
        "employees": wrapped_rows(folder, "air-emp", [AIR]),
        "job_applications": wrapped_rows(folder, "air-app", [APPLIED]),
    }
    cfg = config(folder, [worker(1)], [application(1)], wrapped)
    stats = {s.source: s for s in run_daily(spark, cfg).stats}
    assert stats["airtable"].rows == 2 and not stats["airtable"].skipped
    dim = tables.read(spark, cfg.model("dim_employees"))
    assert {(r.employee_id, r.employment_type) for r in dim.collect()} == {("w-1", "full_time"), ("x1", "full_time")}


def test_optional_source_that_fails_is_skipped_whole(spark, folder):
    wrapped = {
        "employees": wrapped_rows(folder, "air-emp", [AIR]),
        "job_applications": wrapped_rows(folder, "air-app", [{"source_id": "p1"}]),
    }
    cfg = config(folder, [worker(1)], [application(1)], wrapped)
    stats = {s.source: s for s in run_daily(spark, cfg).stats}
    assert stats["airtable"].skipped and "invalid" in stats["airtable"].error
    assert read_raw(spark, cfg.raw("employees"), ["airtable"]).count() == 0
    missing = replace(cfg, dumps={**cfg.dumps, "airtable": {"employees": f"{folder}/nowhere"}})
    assert {s.source: s.skipped for s in run_daily(spark, missing).stats}["airtable"]


def test_invalid_core_batch_stops_the_run(spark, folder):
    cfg = config(folder, [worker(1), worker(2, Hire_Date="")], [application(1)])
    with pytest.raises(InvalidBatch):
        run_daily(spark, cfg)
    assert read_raw(spark, cfg.raw("employees"), ["workday"]).count() == 0


def test_quarantine_keeps_the_valid_records(spark, folder):
    cfg = config(folder, [worker(1), worker(2, Hire_Date="")], [application(1)], strict=False)
    result = run_daily(spark, cfg, batch_id="b1")
    assert result.stats[0].rows == 1
    rejected = spark.read.parquet(cfg.rejected("employees", "workday", "b1")).collect()
    assert [(r.source_id, r.errors) for r in rejected] == [("w-2", "hire_date:value")]
    assert not os.path.exists(cfg.batch("b1"))


def test_failed_check_stops_later_models(spark, folder):
    cfg = config(folder, [worker(1, Management_Level="X9")], [application(1)])
    with pytest.raises(QualityError, match="accepted_values_dim_employees_level"):
        run_daily(spark, cfg)
    assert tables.current(spark, cfg.model("fct_headcount_daily")) is None
    # The other branch does not read the failed model.
    assert tables.read(spark, cfg.model("rpt_recruiting_funnel")).count() == 1


def test_empty_batch_writes_nothing(spark, folder):
    cfg = config(folder, [worker(1)], [])
    stats = {s.source: s.rows for s in run_daily(spark, cfg).stats}
    assert stats["greenhouse"] == 0
    assert tables.versions(spark, f"{cfg.raw('job_applications')}_greenhouse") == []


def test_core_source_must_be_configured(spark, folder):
    cfg = RunConfig(f"{folder}/lake", {}, AS_OF, RUN_TS)
    with pytest.raises(ValueError, match="workday"):
        run_daily(spark, cfg)


def test_command_line():
    cfg = parse(
        ["--root", "r", "--dump", "workday/employees=a=b", "--dump", "airtable/employees=c",
         "--as-of", "2024-03-15", "--lenient", "--corrected"]
    )
    assert cfg.dumps == {"workday": {"employees": "a=b"}, "airtable": {"employees": "c"}}
    assert (cfg.as_of, cfg.strict, cfg.drift_sample, cfg.prefix) == (AS_OF, False, None, "") and cfg.corrected
    with pytest.raises(SystemExit):
        parse(["--root", "r", "--dump", "workday=a"])
