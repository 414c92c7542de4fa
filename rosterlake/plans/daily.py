"""The daily run: extract, drift, models with their checks, PII alert."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.operators import drift as drift_ops
from rosterlake.operators import tables
from rosterlake.operators.envelope import payload_struct, to_envelope
from rosterlake.operators.quality import gate, verdict, watched
from rosterlake.operators.upsert import serve_raw, write_upsert
from rosterlake.operators.validate import admit, counted, valid_records, validate
from rosterlake.plans import marts, reports, staging
from rosterlake.plans.checks import CHECKS
from rosterlake.schemas import (
    APPLICATION_SOURCES,
    BASELINES,
    ENTITY_FIELDS,
    EMPLOYEE_FIELDS,
    EMPLOYEE_SOURCES,
    PII_FIELDS,
    RETENTION_DAYS,
    SENSITIVE_FIELDS,
    SERVED_NUMERICS,
)
from rosterlake.session import configure, passing_shuffles
from rosterlake.sources.pages import RECORD_ORDER, first_records
from rosterlake.sources.registry import SOURCES, Source

log = logging.getLogger(__name__)

STATS_COLUMNS = "source string, rows bigint, skipped boolean, error string"
LAYERS = ("raw", "staging", "analytics")
# A merge deals out the payloads of its batch. One at a time fills the cluster, several
# would have all their batches on disk once more at the same time.
MERGING = Lock()


@dataclass(frozen=True)
class RunConfig:
    """One run. ``dumps`` maps a source to the page folder of each entity.

    Tables belong to the catalog schemas ``<prefix>raw``, ``<prefix>staging`` and
    ``<prefix>analytics``, whose files lie below ``root``.
    """

    root: str
    dumps: Mapping[str, Mapping[str, str]]
    as_of: dt.date
    run_ts: dt.datetime
    strict: bool = True  # one invalid record refuses its source's batch
    drift_raw: bool = False  # look at records before mapping, so new fields show
    drift_sample: int | None = None  # look at the first n records only
    retention_days: int | None = RETENTION_DAYS
    corrected: bool = False  # attrition by mean headcount, over all leavers
    collation: str | None = None  # order of titles in the funnel, by bytes if not given
    prefix: str = ""  # keeps the schemas of several roots in one catalog apart

    def schema(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def raw(self, entity: str) -> str:
        return f"{self.schema('raw')}.{entity}"

    def staged(self, name: str) -> str:
        return f"{self.schema('staging')}.{name}"

    def model(self, name: str) -> str:
        return f"{self.schema('analytics')}.{name}"

    @property
    def drift_log(self) -> str:
        return self.raw("schema_drift_log")

    def batch(self, batch_id: str) -> str:
        return f"{self.root}/landing/batch={batch_id}"

    def landing(self, entity: str, source: str, batch_id: str) -> str:
        return f"{self.batch(batch_id)}/{entity}/source={source}"

    def rejected(self, entity: str, source: str, batch_id: str) -> str:
        return f"{self.root}/rejected/{entity}/source={source}/batch={batch_id}"

    @property
    def retention(self) -> int | None:
        """The corrected rate needs everybody who left."""
        return None if self.corrected else self.retention_days


@dataclass
class SourceStats:
    source: str
    rows: int
    skipped: bool = False
    error: str | None = None


@dataclass
class RunResult:
    stats: list[SourceStats] = field(default_factory=list)
    drift_events: int = 0
    alert: str | None = None
    checks: dict[str, list] = field(default_factory=dict)

    def stats_frame(self, spark: SparkSession) -> DataFrame:
        """One row per source."""
        rows = [(s.source, s.rows, s.skipped, s.error) for s in self.stats]
        return spark.createDataFrame(rows, STATS_COLUMNS)


def land(
    spark: SparkSession, cfg: RunConfig, source: Source, entity: str, path: str, batch_id: str
) -> tuple[DataFrame, dict]:
    """Read, map and validate a dump once and write it to shared storage.

    Everything later reads the landed columns: the pages are parsed once, record
    numbers stay fixed, and a lost executor does not send the job back to them. Counts
    and what drift needs to know of the fields are taken on the way. Where drift is
    looked for in the records as sent, they are landed as well.
    """
    fields = ENTITY_FIELDS[entity]
    kept = [*RECORD_ORDER, "record"] if cfg.drift_raw else list(RECORD_ORDER)
    mapped = source.mapping(entity)(source.read(spark, path), kept)
    checked = validate(mapped, fields, kept)
    watched_rows, state = checked, drift_ops.canonical_state(fields)
    if cfg.drift_raw:
        names = list(source.field_map(entity))
        watched_rows = drift_ops.with_kinds(checked, names, RECORD_ORDER)
        state = drift_ops.raw_state(names, RECORD_ORDER, unpacked=True)
    target = cfg.landing(entity, source.name, batch_id)
    # Folders of a batch belong to the batch, so a rerun after a crash replaces them.
    rows, seen = counted(watched_rows, state)
    landing = rows.select(*checked.columns).write.mode("overwrite")
    landing.option("compression", tables.COMPRESSION).parquet(target)
    return spark.read.schema(checked.schema).parquet(target), seen.get


def extract(
    spark: SparkSession, cfg: RunConfig, source: Source, batch_id: str
) -> tuple[SourceStats, list[DataFrame]]:
    """Land and upsert all entities of one source, and look for drift in them.

    A failure leaves none of the entities: their tables are written first and take
    effect together.
    """
    dumps = cfg.dumps.get(source.name, {})
    if not dumps:
        if source.optional:
            return SourceStats(source.name, 0, skipped=True), []
        raise ValueError(f"no dump configured for {source.name}")
    admitted, events, rows = {}, [], 0
    for entity, path in dumps.items():
        landed, figures = land(spark, cfg, source, entity, path, batch_id)
        rejected = cfg.rejected(entity, source.name, batch_id)
        valid, count = admit(landed, source.name, rejected, cfg.strict, figures)
        found = entity_drift(spark, cfg, source, entity, landed, figures)
        events.append(drift_ops.log_rows(found, source.name, entity, cfg.run_ts))
        rows += count
        if count:
            admitted[entity] = valid
    written = []
    try:
        for entity, valid in admitted.items():
            batch = to_envelope(
                valid, ENTITY_FIELDS[entity], source.name, batch_id, cfg.run_ts, RECORD_ORDER
            )
            with MERGING:
                written.append(write_upsert(spark, cfg.raw(entity), batch, source.name, RECORD_ORDER))
    except Exception:
        for version in written:
            version.discard()
        raise
    for version in written:
        version.commit()
    return SourceStats(source.name, rows), events


def extract_optional(
    spark: SparkSession, cfg: RunConfig, source: Source, batch_id: str
) -> tuple[SourceStats, list[DataFrame]]:
    """An optional source that fails is skipped and the run goes on."""
    try:
        return extract(spark, cfg, source, batch_id)
    except Exception as exc:  # noqa: BLE001 - whatever it is, the core sources go on
        log.warning("going on without source %s: %s", source.name, exc)
        return SourceStats(source.name, 0, skipped=True, error=str(exc)), []


def entity_drift(
    spark: SparkSession, cfg: RunConfig, source: Source, entity: str, landed: DataFrame, figures: dict
) -> DataFrame:
    """Drift events of one landed entity, of records as sent or canonical.

    Unless a sample is asked for, they follow from ``figures``, which were taken while the
    entity was landed.
    """
    fields, baseline, pii = ENTITY_FIELDS[entity], BASELINES[entity], PII_FIELDS
    rows = landed if cfg.drift_sample is None else first_records(landed, cfg.drift_sample)
    if not cfg.drift_raw:
        if cfg.drift_sample is None:
            observed = drift_ops.canonical_types(spark, figures, fields)
        else:
            observed = drift_ops.infer_schema(canonical_records(rows, fields=fields), RECORD_ORDER)
        return drift_ops.detect_drift(observed, baseline, pii)

    def look(names: list[str] | None) -> DataFrame:
        return drift_ops.infer_schema(rows.select(*RECORD_ORDER, "record"), RECORD_ORDER, names)

    names = source.field_map(entity)
    if cfg.drift_sample is None:
        observed = drift_ops.raw_types(spark, figures, list(names), look)
    else:
        observed = look(None)
    return drift_ops.detect_drift(
        observed, drift_ops.native_names(baseline, names), drift_ops.native_pii(pii, names)
    )


def canonical_records(validated: DataFrame, order=RECORD_ORDER, fields=EMPLOYEE_FIELDS) -> DataFrame:
    """Valid records as JSON objects, every field named."""
    body = F.to_variant_object(payload_struct(fields))
    return valid_records(validated).select(*order, body.alias("record"))


def build_models(spark: SparkSession, cfg: RunConfig) -> dict[str, list]:
    """Build and check the models; a failed check stops the models that read it.

    Employees and applications feed separate models and are built side by side. The
    checks of a staging view count while the model above it is written, so payloads are
    read once, and stop that model before it takes effect.
    """
    serve_raw(spark, cfg.raw("employees"), EMPLOYEE_SOURCES)
    serve_raw(spark, cfg.raw("job_applications"), APPLICATION_SOURCES)
    staging.create_views(
        spark,
        cfg.schema("staging"),
        cfg.raw("employees"),
        cfg.raw("job_applications"),
        cfg.as_of,
        cfg.retention,
    )

    def built(name: str, frame: DataFrame, before=None) -> tuple[DataFrame, list]:
        def check(written: DataFrame) -> list:
            if before is not None:
                before()
            return gate(written, CHECKS[name])

        # Checked before it becomes the table: a failed run leaves the last good version.
        passed = tables.replace(
            frame, cfg.model(name), check, SERVED_NUMERICS.get(name, ()), CLUSTERED.get(name, ())
        )
        return tables.read(spark, cfg.model(name)), passed

    def above(staged: str, columns: list[str], name: str, model) -> tuple[DataFrame, dict[str, list]]:
        """A model over a staging view, and what the checks of both say."""
        done = {}
        rows, seen = watched(spark.table(cfg.staged(staged)).select(*columns), CHECKS[staged])

        def before() -> None:
            done[staged] = verdict(spark.table(cfg.staged(staged)), CHECKS[staged], seen)

        frame, done[name] = built(name, model(rows), before)
        return frame, done

    def employee_models() -> dict[str, list]:
        run_ts = F.lit(cfg.run_ts).cast("timestamp")
        wanted = [c for c in spark.table(cfg.staged("stg_employees")).columns if c not in SENSITIVE_FIELDS]
        employees, done = above(
            "stg_employees", wanted, "dim_employees", lambda rows: marts.dim_employees(rows, run_ts)
        )
        daily = marts.fct_headcount_daily(employees, cfg.as_of)
        _, done["fct_headcount_daily"] = built("fct_headcount_daily", daily)
        attrition = marts.fct_attrition_monthly(employees, cfg.as_of, cfg.corrected)
        _, done["fct_attrition_monthly"] = built("fct_attrition_monthly", attrition)
        return done

    def application_models() -> dict[str, list]:
        wanted = ["application_id", *reports.FUNNEL_INPUTS]
        _, done = above(
            "stg_job_applications",
            wanted,
            "rpt_recruiting_funnel",
            lambda rows: reports.rpt_recruiting_funnel(rows, cfg.collation),
        )
        return done

    with ThreadPoolExecutor(2) as pool:
        branches = [pool.submit(employee_models), pool.submit(application_models)]
    return {name: passed for branch in branches for name, passed in branch.result().items()}


# Tables that are read by a range of these columns.
CLUSTERED = {"fct_headcount_daily": ("date", "department", "level")}


def check_config(cfg: RunConfig) -> None:
    """Refuse a run that cannot end well before anything is landed."""
    for name, dumps in cfg.dumps.items():
        if name not in SOURCES:
            raise ValueError(f"unknown source {name}")
        for entity in dumps:
            SOURCES[name].mapping(entity)
    for source in SOURCES.values():
        if not source.optional and not cfg.dumps.get(source.name):
            raise ValueError(f"no dump configured for {source.name}")


def run_daily(spark: SparkSession, cfg: RunConfig, batch_id: str | None = None) -> RunResult:
    """The whole run in its fixed order."""
    configure(spark)
    check_config(cfg)
    with passing_shuffles(spark):
        return _run(spark, cfg, batch_id or str(uuid.uuid4()))


def _run(spark: SparkSession, cfg: RunConfig, batch_id: str) -> RunResult:
    result = RunResult()

    for layer in LAYERS:
        tables.create_schema(spark, cfg.schema(layer), f"{cfg.root}/{layer}")

    def load(source: Source) -> tuple[SourceStats, list[DataFrame]]:
        step = extract_optional if source.optional else extract
        return step(spark, cfg, source, batch_id)

    try:
        # Sources do not depend on each other, so their jobs share the cluster.
        with ThreadPoolExecutor(len(SOURCES)) as pool:
            loaded = list(pool.map(load, SOURCES.values()))
        result.stats = [stats for stats, _ in loaded]
        found = {stats.source: reduce(DataFrame.unionByName, events) for stats, events in loaded if events}
        # At most a row per field name ever seen; kept so that drift is computed once.
        events = reduce(DataFrame.unionByName, found.values()).persist()
        try:
            result.drift_events = events.count()
            for source in found:
                own = events.where(F.col("source") == source)
                drift_ops.append_log(own, source, cfg.run_ts, cfg.drift_log)
            alert = drift_ops.pii_alert(events).first()
        finally:
            events.unpersist()
    finally:
        # The models read the raw tables.
        discard(spark, cfg.batch(batch_id))
    result.checks = build_models(spark, cfg)
    if alert is not None:
        result.alert = alert.message
        log.warning("%s", result.alert)
    return result


def discard(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
