"""One query per operator over the inputs derived from the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterlake.functions import dates, values
from rosterlake.functions.exact import rounded_quotient
from rosterlake.operators import drift, quality, tables, upsert
from rosterlake.operators.constraints import refused
from rosterlake.operators.dedup import newest_per_key
from rosterlake.operators.envelope import to_envelope
from rosterlake.operators.intervals import active_totals, headcount
from rosterlake.operators.validate import batch_summary, validate
from rosterlake.plans import marts, reports, staging
from rosterlake.plans.checks import CHECKS
from rosterlake.plans.daily import RunConfig, RunResult, canonical_records, run_daily
from rosterlake.schemas import (
    APPLICATION_FIELDS,
    EMPLOYEE_BASELINE,
    EMPLOYEE_FIELDS,
    EMPLOYEE_SOURCES,
    LEVELS,
    PII_FIELDS,
    WORKER_FIELD_MAP,
)
from rosterlake.session import configure, passing_shuffles
from rosterlake.sources import mapping, pages
from rosterlake.sources.registry import SOURCES
from workloads.frames import derived, records, table
from workloads.recipes import AS_OF, BATCH_ID, RUN_TS
from workloads.scratch import work_folder, work_schema

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def run_ts_ntz() -> Column:
    return F.lit("2001-08-01 06:00:00").cast("timestamp_ntz")


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    QUERIES[build.__name__] = run
    return build


# --- shared inputs -----------------------------------------------------------


def workers(spark, sf):
    return records(spark, sf, "native_workers")


def checked_workers(spark, sf, recipe="native_workers"):
    mapped = mapping.map_workers(records(spark, sf, recipe), ["k"])
    return validate(mapped, EMPLOYEE_FIELDS, ["k"])


def landed(df: DataFrame) -> DataFrame:
    """Validated records as the daily run has them: written once, then read."""
    path = f"{work_folder(df.sparkSession, 'landing')}/records"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checked_applications(spark, sf):
    mapped = mapping.map_applications(records(spark, sf, "native_applications"), ["k"])
    return validate(mapped, APPLICATION_FIELDS, ["k"])


def staged(spark, sf, retention_days=90):
    return staging.stg_employees(derived(spark, sf, "raw_employees"), AS_OF, retention_days)


def dim(spark, sf, retention_days=90):
    return marts.dim_employees(staged(spark, sf, retention_days), run_ts_ntz())


def daily(spark, sf):
    return marts.fct_headcount_daily(dim(spark, sf), AS_OF)


def attrition(spark, sf):
    return marts.fct_attrition_monthly(dim(spark, sf), AS_OF)


def applications(spark, sf):
    return staging.stg_job_applications(derived(spark, sf, "raw_applications"))


def funnel(spark, sf):
    return reports.rpt_recruiting_funnel(applications(spark, sf))


def without_ids(spark, sf):
    """Employees of whom some have no id."""
    emp = derived(spark, sf, "emp")
    return emp.withColumn("employee_id", F.when(F.col("k") % 1009 != 0, F.col("employee_id")))


def written_text(df: DataFrame, purpose: str, column: str) -> str:
    """A dump of one text column; its path has a blank, as paths may."""
    path = f"{work_folder(df.sparkSession, purpose)}/a dump"
    df.select(column).write.text(path)
    return path


# --- sources, scans, sinks ---------------------------------------------------


def numbered(found: DataFrame) -> DataFrame:
    """Records with their place in the order of the source: the place in the file after
    the records of the files before."""
    inside = F.row_number().over(Window.partitionBy("src_file").orderBy("src_block", "src_row"))
    ahead = Window.orderBy("src_file").rowsBetween(Window.unboundedPreceding, -1)
    files = found.groupBy("src_file").agg(F.count("*").alias("n"))
    before = files.select("src_file", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    placed = found.withColumn("inside", inside).join(before, "src_file")
    return placed.withColumn("place", F.col("before") + F.col("inside"))


@query
def scan_pages(spark, sf):
    """All members of all records, with the place of a record in its page file."""
    path = written_text(derived(spark, sf, "worker_pages").orderBy("first_k"), "pages", "page")
    found = pages.read_pages(spark, path)
    names = [*WORKER_FIELD_MAP, "ssn"]
    members = [values.member_text(F.col("record"), n).alias(n.lower()) for n in names]
    return numbered(found).select("place", *members)


@query
def scan_wrapped(spark, sf):
    path = written_text(derived(spark, sf, "wrapped_employees").orderBy("k"), "wrapped", "page_row")
    found = pages.read_wrapped(spark, path)
    names = [f.name for f in EMPLOYEE_FIELDS]
    members = [values.member_text(F.col("record"), n).alias(n) for n in names]
    return numbered(found).select("place", *members)


@query
def scan_optional_missing(spark, sf):
    delivered = workers(spark, sf).select(F.lit("workday").alias("source"))
    absent = pages.no_records(spark).select(F.lit("airtable").alias("source"))
    return delivered.unionByName(absent).groupBy("source").agg(F.count("*").alias("n_records"))


@query
def envelope(spark, sf):
    rows = to_envelope(
        checked_workers(spark, sf), EMPLOYEE_FIELDS, "workday", BATCH_ID, RUN_TS, as_text=True
    )
    return rows.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


@query
def envelope_offsets(spark, sf):
    """Times keep the fraction and the offset that the source sent."""
    mapped = mapping.map_applications(records(spark, sf, "offset_applications"), ["k"])
    checked = validate(mapped, APPLICATION_FIELDS, ["k"])
    rows = to_envelope(checked, APPLICATION_FIELDS, "greenhouse", BATCH_ID, RUN_TS, ["k"], as_text=True)
    return rows.select("k", *[F.get_json_object("payload", f"$.{c}").alias(c) for c in ("applied_at", "stage")])


@query
def raw_scan(spark, sf):
    raw = derived(spark, sf, "raw_employees")
    return staging.scan_raw(raw, EMPLOYEE_SOURCES).select("source", "source_id", "ingested_at")


@query
def materialize_roundtrip(spark, sf):
    return tables.materialize(funnel(spark, sf), f"{work_schema(spark, 'funnel')}.rpt_recruiting_funnel")


@query
def drift_log(spark, sf):
    """Events of two days; the first day is logged twice, as a repeated run does."""
    log = f"{work_schema(spark, 'drift')}.schema_drift_log"
    found = raw_drift(spark, sf).persist()
    for day in (0, 1, 0):
        at = RUN_TS + dt.timedelta(days=day)
        drift.append_log(drift.log_rows(found, "workday", "employees", at), "workday", at, log)
    found.unpersist()
    return logged(spark, log)


def logged(spark, log):
    rows = drift.read_log(spark, log)
    return rows.drop("id").withColumn("detected_at", F.col("detected_at").cast("timestamp_ntz"))


@query
def serve_decimals(spark, sf):
    rates = ["avg_headcount", "attrition_rate_pct", "rolling_12m_attrition_rate_pct"]
    return marts.serve(attrition(spark, sf), rates).select("year_month", "department", *rates)


# --- mapping and validation --------------------------------------------------


@query
def map_workers(spark, sf):
    mapped = mapping.map_workers(workers(spark, sf), ["k"])
    ended = F.col("termination_date")
    return mapped.select(
        "k",
        *[F.variant_get(F.col(f.name), "$", "string").alias(f.name) for f in EMPLOYEE_FIELDS],
        F.when(ended.isNull(), "missing")
        .when(F.is_variant_null(ended), "null")
        .otherwise("value")
        .alias("termination_state"),
    )


@query
def map_status_stage(spark, sf):
    status = values.member_text(F.col("record"), "status")
    found = records(spark, sf, "native_applications")
    return found.select("k", status.alias("status"), values.stage_of(status).alias("stage"))


@query
def map_applications(spark, sf):
    return checked_applications(spark, sf).select("k", *[f.name for f in APPLICATION_FIELDS], "errors")


@query
def default_missing(spark, sf):
    rows = derived(spark, sf, "wrapped_employees").select(
        "k", pages.unwrap_fields(F.parse_json("page_row")).alias("record")
    )
    kind = F.col("employment_type")
    return mapping.map_wrapped_employees(rows, ["k"]).select(
        "k",
        F.variant_get(kind, "$", "string").alias("employment_type"),
        F.is_variant_null(kind).alias("explicit_null"),
    )


@query
def strip_strings(spark, sf):
    padded = table(spark, sf, "customer").select(
        "c_custkey",
        F.expr("chr(9)||' '||c_name||' '||chr(160)||chr(10)").alias("padded"),
    )
    return padded.select("c_custkey", values.strip(F.col("padded")).alias("c_name"))


@query
def validate_records(spark, sf):
    checked = checked_workers(spark, sf, "dirty_workers")
    return checked.select("k", *[f.name for f in EMPLOYEE_FIELDS], "errors")


@query
def validate_epoch(spark, sf):
    """Dates as numbers of seconds or milliseconds, as numbers and as text."""
    return checked_workers(spark, sf, "epoch_workers").select("k", "hire_date", "errors")


@query
def envelope_epoch(spark, sf):
    """Times as numbers, typed and as the payload spells them."""
    mapped = mapping.map_applications(records(spark, sf, "epoch_applications"), ["k"])
    checked = validate(mapped, APPLICATION_FIELDS, ["k"])
    rows = to_envelope(checked, APPLICATION_FIELDS, "greenhouse", BATCH_ID, RUN_TS, ["k", "applied_at", "errors"], as_text=True)
    sent = F.get_json_object("payload", "$.applied_at").alias("payload_applied_at")
    return rows.select("k", "applied_at", sent, "errors")


@query
def refused_rows(spark, sf):
    """Raw rows that a write would refuse, and why."""
    rows = derived(spark, sf, "raw_employees").select(
        "k",
        "source",
        F.when(F.col("k") % 97 != 0, F.col("source_id")).alias("source_id"),
        F.when(F.col("k") % 89 != 0, F.col("payload")).alias("payload"),
        F.when(F.col("k") % 83 != 0, F.lit(BATCH_ID)).alias("batch_id"),
    )
    return refused(rows, ["source_id", "payload", "batch_id"]).select("k", "source", "null_columns")


@query
def source_capabilities(spark, sf):
    """How many of the given records each source could deliver as each entity; what a source
    does not own is refused before any record is read."""
    delivered = {"employees": workers(spark, sf), "job_applications": records(spark, sf, "native_applications")}
    parts = []
    for source in SOURCES.values():
        for entity, found in delivered.items():
            try:
                source.mapping(entity)
            except NotImplementedError as refusal:
                note, found = str(refusal), found.where("false")
            else:
                note = "owned"
            named = (F.lit(source.name).alias("source"), F.lit(entity).alias("entity"), F.lit(note).alias("note"))
            counted = found.agg(F.count("*").alias("n_records"))
            parts.append(counted.select(*named, F.lit(source.optional).alias("optional"), "n_records"))
    return reduce(DataFrame.unionByName, parts)


@query
def validate_summary(spark, sf):
    return batch_summary(checked_workers(spark, sf, "dirty_workers"))


@query
def batch_stats(spark, sf):
    parts = [
        (checked_workers(spark, sf), "workday"),
        (checked_applications(spark, sf), "greenhouse"),
    ]
    frames = [batch_summary(f).select(F.lit(s).alias("source"), "records", "invalid") for f, s in parts]
    return reduce(DataFrame.unionByName, frames)


@query
def flatten_employees(spark, sf):
    return staging.flatten_employees(derived(spark, sf, "raw_employees"))


@query
def flatten_applications(spark, sf):
    return staging.flatten_applications(derived(spark, sf, "raw_applications"))


@query
def active_flag(spark, sf):
    return derived(spark, sf, "emp").select("employee_id", F.expr(values.is_active(AS_OF)).alias("is_active"))


@query
def retention_filter(spark, sf):
    kept = derived(spark, sf, "emp").where(values.is_retained(AS_OF))
    return kept.select("employee_id", "termination_date")


# --- joins and aggregations --------------------------------------------------


@query
def interval_join_active(spark, sf):
    spells = derived(spark, sf, "emp").select("k", "hire_date", "termination_date")
    return active_totals(spells, {"key_sum": F.col("k")}, {"first_hire": F.col("hire_date")}, AS_OF)


@query
def headcount_changepoints(spark, sf):
    return headcount(derived(spark, sf, "emp"), marts.HEADCOUNT_KEYS, AS_OF)


@query
def month_spine_join(spark, sf):
    months = dates.month_spine(spark, AS_OF)
    return marts.on_month_spine(months, marts.monthly_headcount(daily(spark, sf)))


@query
def left_join_terminations(spark, sf):
    return marts.monthly_balance(dim(spark, sf), AS_OF)


@query
def filtered_counts(spark, sf):
    return marts.monthly_terminations(without_ids(spark, sf))


@query
def avg_headcount_cells(spark, sf):
    summed = marts.monthly_headcount(daily(spark, sf))
    mean = rounded_quotient(10 * F.col("headcount_sum"), F.col("cells")) / 10
    return summed.withColumn("avg_headcount", mean)


@query
def global_count(spark, sf):
    return dim(spark, sf).agg(F.count("*").alias("n"))


# --- windows, sorts, limits --------------------------------------------------


@query
def dedup_latest(spark, sf):
    newest = newest_per_key(staged(spark, sf), "employee_id", "ingested_at", "source_system")
    return newest.select("employee_id", "source_system", "job_title", "ingested_at")


@query
def rolling_12m(spark, sf):
    kept = ("year_month", "department", "attrition_rate_pct", "rolling_12m_attrition_rate_pct")
    return attrition(spark, sf).select(*kept)


@query
def sorted_report(spark, sf):
    return reports.ordered(attrition(spark, sf), "fct_attrition_monthly")


@query
def preview_limit(spark, sf):
    return reports.preview(funnel(spark, sf), "rpt_recruiting_funnel", 10)


@query
def drift_sample(spark, sf):
    """The first records of a dump in the order of its pages."""
    path = written_text(derived(spark, sf, "worker_pages").orderBy("first_k"), "sample", "page")
    first = pages.first_records(pages.read_pages(spark, path), 50)
    return first.select(values.member_text(F.col("record"), "Worker_ID").alias("worker_id"))


# --- scalar functions --------------------------------------------------------


@query
def full_name(spark, sf):
    rows = staging.flatten_employees(derived(spark, sf, "raw_employees"))
    name = values.full_name(F.col("first_name"), F.col("last_name"))
    return rows.select("employee_id", "source_system", name.alias("full_name"))


@query
def month_bucket(spark, sf):
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.month_start(day).alias("month_start"),
        dates.year_month(day).alias("year_month"),
    )


@query
def date_spine(spark, sf):
    hires = derived(spark, sf, "emp").groupBy(F.col("hire_date").alias("date")).agg(
        F.count("*").alias("hires")
    )
    joined = dates.day_spine(spark, AS_OF).join(hires, "date", "left")
    return joined.select("date", F.coalesce("hires", F.lit(0).cast("bigint")).alias("hires"))


@query
def month_spine(spark, sf):
    hires = derived(spark, sf, "emp").groupBy(
        dates.month_start(F.col("hire_date")).alias("month_start")
    ).agg(F.count("*").alias("hires"))
    joined = dates.month_spine(spark, AS_OF).join(hires, "month_start", "left")
    return joined.select("month_start", F.coalesce("hires", F.lit(0).cast("bigint")).alias("hires"))


@query
def time_in_stage_days(spark, sf):
    return applications(spark, sf).select("application_id", "source_system", "time_in_stage_days")


@query
def voluntary_split(spark, sf):
    emp = without_ids(spark, sf)
    return emp.select("k", values.is_voluntary(F.col("employee_id")).alias("is_voluntary"))


# --- upsert ------------------------------------------------------------------


def _first_load(spark, sf):
    return derived(spark, sf, "emp").select(
        F.expr("case when k%2=0 then 'workday' else 'airtable' end").alias("source"),
        F.concat(F.lit("E"), "k").alias("source_id"),
        F.concat(F.lit("id-"), "k").alias("id"),
        F.to_json(F.struct("department", "level")).alias("payload"),
        F.lit("2001-07-31 06:00:00").cast("timestamp_ntz").alias("ingested_at"),
        F.lit("b1").alias("batch_id"),
    )


def _second_load(spark, sf):
    """As many rows again; half of them hit a key of the first load."""
    return derived(spark, sf, "emp").select(
        F.lit("workday").alias("source"),
        F.expr("'E'||(2*k)").alias("source_id"),
        F.to_json(F.struct("employment_type", "level")).alias("payload"),
        run_ts_ntz().alias("ingested_at"),
        F.lit("b2").alias("batch_id"),
    )


@query
def upsert_raw(spark, sf):
    merged = upsert.merge(_first_load(spark, sf), _second_load(spark, sf))
    kept = F.when(F.col("id").startswith("id-"), F.col("id")).otherwise("new")
    return merged.withColumn("id", kept)


@query
def upsert_idempotent(spark, sf):
    """The same batch lands twice in a real table, with unchanged ids."""
    raw = f"{work_schema(spark, 'raw')}.employees"
    checked = landed(checked_workers(spark, sf))
    batch = to_envelope(checked, EMPLOYEE_FIELDS, "workday", BATCH_ID, RUN_TS, ["k"])
    upsert.upsert(spark, raw, batch, "workday", ["k"])
    first = upsert.read_raw(spark, raw, ["workday"]).select("source", "source_id", F.col("id").alias("first_id"))
    upsert.upsert(spark, raw, batch, "workday", ["k"])
    again = upsert.read_raw(spark, raw, ["workday"])
    both = again.join(first, ["source", "source_id"], "left")
    return both.select(
        "source",
        "source_id",
        (F.col("id") == F.col("first_id")).alias("same_id"),
        values.member_text(F.col("payload"), "email").alias("email"),
        "batch_id",
    )


@query
def upsert_two_batches(spark, sf):
    """Two different batches land in a real table; ids of the first stay."""
    raw = f"{work_schema(spark, 'raw')}.employees"
    checked = landed(checked_workers(spark, sf))
    later_id = BATCH_ID[:-1] + "2"
    first = checked.where("k % 3 <> 0")
    second = checked.where("k % 2 = 0").withColumn("job_title", F.lit("Lead"))
    batch = to_envelope(first, EMPLOYEE_FIELDS, "workday", BATCH_ID, RUN_TS, ["k"])
    upsert.upsert(spark, raw, batch, "workday", ["k"])
    before = upsert.read_raw(spark, raw, ["workday"]).select("source_id", F.col("id").alias("first_id"))
    batch = to_envelope(second, EMPLOYEE_FIELDS, "workday", later_id, RUN_TS, ["k"])
    upsert.upsert(spark, raw, batch, "workday", ["k"])
    both = upsert.read_raw(spark, raw, ["workday"]).join(before, "source_id", "left")
    return both.select(
        "source",
        "source_id",
        "batch_id",
        values.member_text(F.col("payload"), "job_title").alias("job_title"),
        (F.col("id") == F.coalesce("first_id", "id")).alias("id_kept"),
    )


@query
def upsert_last_wins(spark, sf):
    batch = table(spark, sf, "events").select("user_id", "event_id", "event_type", "props")
    return upsert.last_per_key(batch, ["event_id"], ["user_id"])


# --- schema drift ------------------------------------------------------------


def raw_drift(spark, sf):
    observed = drift.infer_schema(workers(spark, sf), ["k"])
    baseline = drift.native_names(EMPLOYEE_BASELINE, WORKER_FIELD_MAP)
    return drift.detect_drift(observed, baseline, drift.native_pii(PII_FIELDS, WORKER_FIELD_MAP))


@query
def infer_schema(spark, sf):
    return drift.infer_schema(workers(spark, sf), ["k"])


@query
def drift_events(spark, sf):
    canonical = canonical_records(landed(checked_workers(spark, sf)), ["k"])
    observed = drift.infer_schema(canonical, ["k"])
    # Two further baseline fields show a removal and a change of type.
    baseline = EMPLOYEE_BASELINE | {"salary": "float", "badge": "str"}
    return drift.detect_drift(observed, baseline, PII_FIELDS)


@query
def drift_raw(spark, sf):
    return raw_drift(spark, sf)


@query
def pii_alert(spark, sf):
    return drift.pii_alert(raw_drift(spark, sf))


# --- data quality ------------------------------------------------------------


@query
def dq_not_null(spark, sf):
    failing = quality.failing_rows(dim(spark, sf), quality.not_null("dim_employees", "full_name"))
    return failing.select("employee_id", "full_name", "email")


@query
def dq_unique(spark, sf):
    return quality.failing_rows(staged(spark, sf), quality.unique("stg_employees", "employee_id"))


@query
def dq_accepted_values(spark, sf):
    return quality.failing_rows(dim(spark, sf), quality.accepted_values("dim_employees", "level", LEVELS))


@query
def dq_headcount_positive(spark, sf):
    return quality.failing_rows(daily(spark, sf), CHECKS["fct_headcount_daily"][-1])


@query
def dq_no_null_id(spark, sf):
    return quality.failing_rows(dim(spark, sf), CHECKS["dim_employees"][-1])


@query
def dq_summary(spark, sf):
    schema = work_schema(spark, "checked")

    def built(name, frame):
        return tables.materialize(frame, f"{schema}.{name}")

    employees = built("dim_employees", dim(spark, sf))
    counted = built("fct_headcount_daily", marts.fct_headcount_daily(employees, AS_OF))
    frames = {
        "stg_employees": staged(spark, sf),
        "stg_job_applications": applications(spark, sf),
        "dim_employees": employees,
        "fct_headcount_daily": counted,
        "fct_attrition_monthly": marts.fct_attrition_monthly(employees, AS_OF),
        "rpt_recruiting_funnel": funnel(spark, sf),
    }
    parts = [quality.summarize(frame, CHECKS[name]) for name, frame in frames.items()]
    return reduce(DataFrame.unionByName, parts)


# --- models ------------------------------------------------------------------


@query
def stg_employees(spark, sf):
    return staged(spark, sf)


@query
def stg_job_applications(spark, sf):
    return applications(spark, sf)


@query
def dim_employees(spark, sf):
    return dim(spark, sf)


@query
def fct_headcount_daily(spark, sf):
    return daily(spark, sf)


@query
def fct_attrition_monthly(spark, sf):
    return attrition(spark, sf)


@query
def rpt_recruiting_funnel(spark, sf):
    return funnel(spark, sf)


@query
def funnel_collated(spark, sf):
    """Titles that differ in case and accents, the last one as a database orders text."""
    titles = F.array(*[F.lit(t) for t in ("zeta", "Zeta", "Élan", "elan", "Alpha", "ångström", "beta", "Äpfel")])
    mixed = F.element_at(titles, (F.crc32("application_id") % 8 + 1).cast("int"))
    staged_rows = applications(spark, sf).withColumn("job_title", mixed)
    kept = ("job_id", "year_month", "job_title", "department", "applied_count")
    return reports.rpt_recruiting_funnel(staged_rows, collation="UNICODE").select(*kept)


@query
def attrition_corrected(spark, sf):
    employees = dim(spark, sf, retention_days=None)
    return marts.fct_attrition_monthly(employees, AS_OF, corrected=True)


def dumped(spark, sf, root, workers="worker_pages") -> dict[str, dict[str, str]]:
    """Page dumps of all three sources."""
    paths = {
        "workday": ("employees", workers, "page", "first_k"),
        "greenhouse": ("job_applications", "application_pages", "page", "first_k"),
        "airtable": ("employees", "wrapped_employees", "page_row", "k"),
    }
    dumps = {}
    for source, (entity, recipe, column, order) in paths.items():
        path = f"{root}/dump/{source}"
        # Pages lie in the order of their records, however many tasks write them.
        pages = derived(spark, sf, recipe).orderBy(order).select(column)
        pages.write.option("zlib.compress.level", "BEST_SPEED").text(path, compression="gzip")
        dumps[source] = {entity: path}
    return dumps


def run_config(spark, sf, purpose, workers="worker_pages", **options) -> RunConfig:
    root = work_folder(spark, purpose)
    prefix = f"{purpose}_{uuid.uuid4().hex}_"
    with passing_shuffles(spark):
        dumps = dumped(spark, sf, root, workers)
    return RunConfig(root, dumps, AS_OF, RUN_TS, strict=False, prefix=prefix, **options)


@query
def run_stats(spark, sf):
    """A complete run over the dumped pages of three sources, from files to checked models."""
    return run_daily(spark, run_config(spark, sf, "run")).stats_frame(spark)


_finished: dict[tuple[str, str], tuple[RunConfig, RunResult]] = {}


def finished(spark, sf) -> tuple[RunConfig, RunResult]:
    """One run serves all queries that look at what it built."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _finished:
        cfg = run_config(spark, sf, "finished")
        _finished[key] = cfg, run_daily(spark, cfg)
    return _finished[key]


@query
def run_dim_employees(spark, sf):
    """Read as the catalog serves it."""
    cfg, _ = finished(spark, sf)
    served = spark.table(cfg.model("dim_employees"))
    return served.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at")})


@query
def run_attrition(spark, sf):
    cfg, _ = finished(spark, sf)
    return tables.read(spark, cfg.model("fct_attrition_monthly"))


@query
def run_headcount(spark, sf):
    cfg, _ = finished(spark, sf)
    return tables.read(spark, cfg.model("fct_headcount_daily"))


@query
def run_headcount_month(spark, sf):
    """One month of the stored table, which is laid out by date."""
    cfg, _ = finished(spark, sf)
    month = F.col("date").between(dt.date(2001, 3, 1), dt.date(2001, 3, 31))
    return spark.table(cfg.model("fct_headcount_daily")).where(month)


@query
def run_funnel(spark, sf):
    cfg, _ = finished(spark, sf)
    return tables.read(spark, cfg.model("rpt_recruiting_funnel"))


@query
def run_drift_log(spark, sf):
    cfg, _ = finished(spark, sf)
    return logged(spark, cfg.drift_log)


@query
def run_alert(spark, sf):
    """The message of a run and the number of events behind it."""
    _, result = finished(spark, sf)
    rows = [(result.drift_events, result.alert)]
    return spark.createDataFrame(rows, "drift_events bigint, alert string")


@query
def run_staged_employees(spark, sf):
    """The staging view, as another session reads it."""
    cfg, _ = finished(spark, sf)
    rows = configure(spark.newSession()).table(cfg.staged("stg_employees"))
    return rows.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


@query
def run_staged_applications(spark, sf):
    cfg, _ = finished(spark, sf)
    return configure(spark.newSession()).table(cfg.staged("stg_job_applications"))


@query
def run_checks(spark, sf):
    _, result = finished(spark, sf)
    rows = [tuple(r) for passed in result.checks.values() for r in passed]
    return spark.createDataFrame(rows, "check_name string, table_name string, column_name string, failures bigint")


@query
def drift_late_field(spark, sf):
    """A field that only late records have, found by a run over records as sent."""
    cfg = run_config(spark, sf, "late", "late_worker_pages", drift_raw=True)
    run_daily(spark, cfg)
    return drift.read_log(spark, cfg.drift_log).drop("id", "detected_at")
