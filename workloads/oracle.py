"""The same queries as DuckDB SQL, in the direct form: spine joins, JSON
extraction and literal definitions instead of the rewrites the jobs use."""

from __future__ import annotations

from workloads.recipes import AS_OF, BATCH_ID, ctes

# Spelled out here, so that a wrong value in the library shows.
WORKER_FIELD_MAP = {
    "Worker_ID": "source_id", "Legal_First_Name": "first_name", "Legal_Last_Name": "last_name",
    "Work_Email": "email", "Cost_Center": "department", "Job_Title": "job_title",
    "Hire_Date": "hire_date", "Termination_Date": "termination_date",
    "Worker_Type": "employment_type", "Management_Level": "level", "Location": "location",
    "Manager_ID": "manager_id", "Base_Pay": "salary", "Performance_Rating": "performance_rating",
}
APPLICATION_STATUS_STAGE = {
    "active": "applied", "submitted": "applied", "phone_screen": "phone_screen",
    "interviewing": "interview", "offer_extended": "offer", "hired": "hired", "rejected": "rejected",
}
EMPLOYEE_BASELINE = dict.fromkeys(
    ("source_id", "first_name", "last_name", "email", "department", "job_title", "hire_date",
     "employment_type", "level", "location"), "str",
)
APPLICATION_BASELINE = dict.fromkeys(
    ("source_id", "candidate_id", "job_id", "job_title", "department", "stage", "applied_at",
     "stage_changed_at"), "str",
)
# Names of the application source where they differ from the canonical ones.
NATIVE_APPLICATION = {"source_id": "id", "stage": "status", "stage_changed_at": "last_activity_at"}
LEVELS = ("IC1", "IC2", "IC3", "IC4", "IC5", "IC6", "M1", "M2", "M3", "M4", "M5")
PII_FIELDS = ("email", "first_name", "last_name", "salary", "performance_rating", "ssn")

DAY = f"date '{AS_OF}'"
START = f"cast({DAY} - interval '2 years' as date)"
RUN = "timestamp '2001-08-01 06:00:00'"
SPACE = r"[\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def listed(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def text(column: str, key: str) -> str:
    return f"json_extract_string({column}, '$.{key}')"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{SPACE}|{SPACE}$', '', 'g')"


def rounded(num: str, den: str) -> str:
    """num / den as the nearest integer, ties away from zero."""
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


STG_EMPLOYEES = f"""
flat_employees as (
  select {text('payload', 'source_id')} employee_id, source source_system,
    {', '.join(f"{text('payload', c)} {c}" for c in ('first_name', 'last_name', 'email', 'department', 'job_title', 'level', 'employment_type', 'location', 'manager_id'))},
    cast({text('payload', 'hire_date')} as date) hire_date,
    cast(nullif({text('payload', 'termination_date')}, '') as date) termination_date,
    cast(nullif({text('payload', 'salary')}, '') as decimal(38,6)) salary,
    nullif({text('payload', 'performance_rating')}, '') performance_rating,
    ingested_at
  from raw_employees),
staged_all as (
  select *, termination_date is null or termination_date > {DAY} is_active
  from flat_employees where source_system in ('workday', 'airtable')),
stg_employees as (
  select * from staged_all
  where termination_date is null or termination_date > {DAY} - interval '90 days')
"""


def dim(name: str, staged: str) -> str:
    return f"""
{name} as (
  select employee_id, first_name || ' ' || last_name full_name, email, department, job_title,
    level, hire_date, termination_date, is_active, employment_type, manager_id, location,
    ingested_at created_at, {RUN} updated_at
  from (select *, row_number() over (partition by employee_id
          order by ingested_at desc nulls first, source_system) rn from {staged})
  where rn = 1)"""


def headcount(name: str, employees: str) -> str:
    return f"""
{name} as (
  select s.date, department, level, employment_type, count(*) headcount
  from (select cast(unnest(generate_series({START}, {DAY}, interval '1 day')) as date) date) s
  join {employees} e on e.hire_date <= s.date
    and (e.termination_date is null or e.termination_date > s.date)
  group by all)"""


def terminations(employees: str) -> str:
    return f"""
terminations as (
  select cast(date_trunc('month', termination_date) as date) month_start, department,
    count(*) filter (where voluntary) voluntary_terminations,
    count(*) filter (where not voluntary) involuntary_terminations,
    count(*) total_terminations
  from (select *, cast('0x' || substr(md5(employee_id), 1, 8) as bigint) % 4 <> 0 voluntary
        from {employees})
  where termination_date is not null group by all)"""


MONTHS = f"""
months as (
  select cast(unnest(generate_series(date_trunc('month', {START}), date_trunc('month', {DAY}),
    interval '1 month')) as date) month_start)"""

MONTHLY = """
monthly as (
  select cast(date_trunc('month', date) as date) month_start, department,
    cast(sum(headcount) as bigint) headcount_sum, count(*) cells
  from fct_headcount_daily group by all)"""

ON_SPINE = "on_spine as (select m.* from months join monthly m using (month_start))"

COMBINED = """
combined as (
  select s.month_start, s.department, s.headcount_sum, s.cells,
    coalesce(t.voluntary_terminations, 0) voluntary_terminations,
    coalesce(t.involuntary_terminations, 0) involuntary_terminations,
    coalesce(t.total_terminations, 0) total_terminations
  from on_spine s left join terminations t
    on t.month_start = s.month_start and t.department = s.department)"""

ATTRITION = f"""
rates as (
  select *, {rounded('10000 * total_terminations * cells', 'headcount_sum')} rate from combined),
fct_attrition_monthly as (
  select strftime(month_start, '%Y-%m') year_month, department, voluntary_terminations,
    involuntary_terminations, total_terminations,
    {rounded('10 * headcount_sum', 'cells')} / 10 avg_headcount,
    rate / 100 attrition_rate_pct,
    (2 * sum(rate) over w + count(*) over w) // (2 * count(*) over w) / 100 rolling_12m_attrition_rate_pct
  from rates
  window w as (partition by department order by month_start rows between 11 preceding and current row))
"""

STG_APPLICATIONS = f"""
flat_applications as (
  select {text('payload', 'source_id')} application_id, source source_system,
    {', '.join(f"{text('payload', c)} {c}" for c in ('candidate_id', 'job_id', 'job_title', 'department', 'stage', 'recruiter_id'))},
    cast({text('payload', 'applied_at')} as timestamp) applied_at,
    cast({text('payload', 'stage_changed_at')} as timestamp) stage_changed_at,
    extract(day from cast({text('payload', 'stage_changed_at')} as timestamp)
                   - cast({text('payload', 'applied_at')} as timestamp)) time_in_stage_days
  from raw_applications),
stg_job_applications as (
  select * from flat_applications where source_system in ('greenhouse', 'airtable'))
"""

FUNNEL = f"""
funnel_counts as (
  select job_id, strftime(applied_at, '%Y-%m') year_month, max(job_title) job_title,
    max(department) department,
    {', '.join(f"count(*) filter (where stage = '{s}') {s}_count" for s in ('applied', 'phone_screen', 'interview', 'offer', 'hired'))},
    coalesce(sum(time_in_stage_days) filter (where stage = 'hired'), 0) days_sum,
    count(time_in_stage_days) filter (where stage = 'hired') days_n
  from stg_job_applications group by 1, 2),
rpt_recruiting_funnel as (
  select * exclude (days_sum, days_n),
    case when days_n > 0 then {rounded('10 * days_sum', 'days_n')} else 0 end / 10
      application_to_hire_days_avg,
    case when offer_count > 0 then {rounded('10000 * hired_count', 'offer_count')} else 0 end / 100
      offer_acceptance_rate_pct
  from funnel_counts)
"""

RAW_EMP = ctes("raw_employees", "duckdb")
RAW_APP = ctes("raw_applications", "duckdb")
WORKERS = ctes("native_workers", "duckdb")
EMP = ctes("emp", "duckdb")

EMPLOYEES = f"{RAW_EMP},\n{STG_EMPLOYEES},\n{dim('dim_employees', 'stg_employees')}"
DAILY = f"{EMPLOYEES},\n{headcount('fct_headcount_daily', 'dim_employees')}"
MONTHLY_TERMS = terminations("dim_employees")
ALL_ATTRITION = f"{DAILY},\n{MONTHS},\n{MONTHLY},\n{ON_SPINE},\n{MONTHLY_TERMS},\n{COMBINED},\n{ATTRITION}"
APPLICATIONS = f"{RAW_APP},\n{STG_APPLICATIONS}"
ALL_FUNNEL = f"{APPLICATIONS},\n{FUNNEL}"

WORKER_TEXT = {dst: src for src, dst in WORKER_FIELD_MAP.items()}
STRING_FIELDS = [
    d for d in WORKER_TEXT if d not in ("hire_date", "termination_date", "salary")
]


def canonical_worker(name: str) -> str:
    raw = text("payload", WORKER_TEXT[name])
    return strip(raw) if name in STRING_FIELDS else raw


def typed_worker(name: str) -> str:
    kind = {"hire_date": "date", "termination_date": "date", "salary": "decimal(38,6)"}.get(name)
    value = canonical_worker(name)
    return f"try_cast({value} as {kind})" if kind else value


ENVELOPE_ORDER = (
    "source_id", "first_name", "last_name", "email", "department", "job_title", "hire_date",
    "termination_date", "manager_id", "employment_type", "level", "location", "salary",
    "performance_rating",
)

OPTIONAL = {"termination_date", "manager_id", "salary", "performance_rating"}


def worker_rule(name: str) -> str:
    """Errors of one worker field as SQL."""
    path = f"json_type(payload, '$.{WORKER_TEXT[name]}')"
    raw = text("payload", WORKER_TEXT[name])
    cases = []
    if name not in OPTIONAL:
        cases.append(f"when {path} is null then '{name}:missing' when {path} = 'NULL' then '{name}:null'")
    if name != "salary":
        cases.append(f"when {path} not in ('VARCHAR', 'NULL') then '{name}:type'")
    if name in ("hire_date", "termination_date"):
        cases.append(f"when {raw} is not null and try_cast({raw} as date) is null then '{name}:value'")
    if name == "salary":
        cases.append(f"when {raw} is not null and try_cast({raw} as decimal(38,6)) is null then 'salary:value'")
    return f"case {' '.join(cases)} end"


WORKER_ERRORS = f"concat_ws(',', {', '.join(worker_rule(n) for n in ENVELOPE_ORDER)})"

APPLICATION_STAGE = (
    "case "
    + " ".join(f"when {text('payload', 'status')} = '{a}' then '{b}'" for a, b in APPLICATION_STATUS_STAGE.items())
    + " else 'applied' end"
)
CHANGED = (
    f"case when json_exists(payload, '$.last_activity_at') then {text('payload', 'last_activity_at')}"
    f" else {text('payload', 'applied_at')} end"
)

# First non-null type per member in record order.
TYPES = """
members as (select k, e.key field_name, e.type t from {records}, json_each({payload}) e),
typed as (
  select k, field_name, case t when 'VARCHAR' then 'str' when 'UBIGINT' then 'int'
    when 'BIGINT' then 'int' when 'DOUBLE' then 'float' when 'BOOLEAN' then 'bool'
    when 'OBJECT' then 'dict' when 'ARRAY' then 'list' else 'NoneType' end t from members),
observed as (
  select field_name, coalesce(arg_min(t, k) filter (where t <> 'NoneType'), 'NoneType') type_name
  from typed group by 1)"""


def baseline(fields: dict[str, str]) -> str:
    rows = ", ".join(f"('{n}', '{t}')" for n, t in fields.items())
    return f"baseline as (select * from (values {rows}) b(field_name, old_type))"


def events(pii) -> str:
    return f"""
events as (
  select * from (
    select coalesce(o.field_name, b.field_name) field_name,
      case when b.field_name is null then 'added' when o.field_name is null then 'removed'
           when type_name <> old_type and type_name <> 'NoneType' then 'type_changed' end change_type,
      old_type, type_name new_type, coalesce(o.field_name, b.field_name) in ({listed(pii)}) is_pii
    from observed o full join baseline b on o.field_name = b.field_name)
  where change_type is not null)"""


NATIVE_BASELINE = {s: EMPLOYEE_BASELINE[d] for s, d in WORKER_FIELD_MAP.items() if d in EMPLOYEE_BASELINE}
NATIVE_PII = [*PII_FIELDS, *[s for s, d in WORKER_FIELD_MAP.items() if d in PII_FIELDS]]

CANONICAL_JSON = "json_object({})".format(
    ", ".join(f"'{n}', {canonical_worker(n)}" for n in ENVELOPE_ORDER)
)

RAW_DRIFT = (
    f"{WORKERS},\n{TYPES.format(records='native_workers', payload='payload')},\n"
    f"{baseline(NATIVE_BASELINE)},\n{events(NATIVE_PII)}"
)
CANONICAL_DRIFT = (
    f"{WORKERS},\ncanonical as (select k, {CANONICAL_JSON} body from native_workers),\n"
    f"{TYPES.format(records='canonical', payload='body')},\n"
    f"{baseline(EMPLOYEE_BASELINE | {'salary': 'float', 'badge': 'str'})},\n{events(PII_FIELDS)}"
)


def summary(kind: str, table: str, column: str, failures: str) -> str:
    return (
        f"select '{kind}_{table}_{column}' check_name, '{table}' table_name,"
        f" '{column}' column_name, ({failures}) failures"
    )


def nulls(table: str, column: str) -> str:
    return summary("not_null", table, column, f"select count(*) from {table} where {column} is null")


def bad_values(table: str, column: str, values) -> str:
    return summary(
        "accepted_values", table, column,
        f"select count(distinct {column}) from {table} where {column} not in ({listed(values)})",
    )


DQ_SUMMARY = " union all ".join(
    [
        nulls("stg_employees", "employee_id"),
        nulls("stg_employees", "is_active"),
        bad_values("stg_employees", "employment_type", ("full_time", "part_time", "contractor")),
        nulls("stg_job_applications", "application_id"),
        bad_values(
            "stg_job_applications", "stage",
            ("applied", "phone_screen", "interview", "offer", "hired", "rejected"),
        ),
        nulls("dim_employees", "employee_id"),
        nulls("dim_employees", "full_name"),
        summary("expression", "dim_employees", "employee_id",
                "select count(*) from dim_employees where employee_id is null"),
        summary("unique", "dim_employees", "employee_id",
                "select count(*) from (select employee_id from dim_employees"
                " where employee_id is not null group by 1 having count(*) > 1)"),
        bad_values("dim_employees", "level", LEVELS),
        nulls("fct_headcount_daily", "date"),
        nulls("fct_headcount_daily", "headcount"),
        summary("expression", "fct_headcount_daily", "headcount",
                "select count(*) from fct_headcount_daily where headcount < 0"),
        nulls("fct_attrition_monthly", "year_month"),
        nulls("fct_attrition_monthly", "attrition_rate_pct"),
        nulls("rpt_recruiting_funnel", "job_id"),
        nulls("rpt_recruiting_funnel", "offer_acceptance_rate_pct"),
    ]
)

DIRTY = ctes("dirty_workers", "duckdb")
NATIVE_APPS = ctes("native_applications", "duckdb")
WRAPPED = ctes("wrapped_employees", "duckdb")
WITHOUT_IDS = "blank_ids as (select * replace (case when k % 1009 <> 0 then employee_id end as employee_id) from emp)"

# What a run lands: valid records of the dumps of all sources, loaded at the same time.
WRAPPED_FIELDS = ", ".join(
    f"'{n}', "
    + (
        f"coalesce(json_extract_string(page_row, '$.fields.{n}'), 'full_time')"
        if n == "employment_type"
        else f"json_extract_string(page_row, '$.fields.{n}')"
    )
    for n in ENVELOPE_ORDER
)
RUN_RAW = f"""{WORKERS},
{WRAPPED.removeprefix(EMP).lstrip(",").strip()},
raw_employees as (
  select 'workday' source, {CANONICAL_JSON} payload, {RUN} ingested_at from native_workers
  union all
  select 'airtable', json_object({WRAPPED_FIELDS}), {RUN} from wrapped_employees
  where json_exists(page_row, '$.fields')
    and coalesce(json_type(page_row, '$.fields.employment_type'), 'VARCHAR') <> 'NULL')"""
RUN_EMPLOYEES = f"{RUN_RAW},\n{STG_EMPLOYEES},\n{dim('dim_employees', 'stg_employees')}"
RUN_DAILY = f"{RUN_EMPLOYEES},\n{headcount('fct_headcount_daily', 'dim_employees')}"
RUN_ATTRITION = f"{RUN_DAILY},\n{MONTHS},\n{MONTHLY},\n{ON_SPINE},\n{MONTHLY_TERMS},\n{COMBINED},\n{ATTRITION}"
APPLICATION_JSON = "json_object({})".format(
    ", ".join(
        f"'{d}', {e}"
        for d, e in {
            "source_id": text("payload", "id"),
            **{c: strip(text("payload", c)) for c in ("candidate_id", "job_id", "job_title", "department", "recruiter_id")},
            "applied_at": text("payload", "applied_at"),
            "stage": APPLICATION_STAGE,
            "stage_changed_at": CHANGED,
        }.items()
    )
)
RUN_FUNNEL = f"""{NATIVE_APPS},
raw_applications as (
  select 'greenhouse' source, {APPLICATION_JSON} payload from native_applications
  where coalesce(json_type(payload, '$.last_activity_at'), 'VARCHAR') <> 'NULL'),
{STG_APPLICATIONS},
{FUNNEL}"""


def drift_of(bodies: str, baselines: dict[tuple[str, str], dict[str, str]], pii) -> str:
    """Events of several sources; ``bodies`` gives ``(source, entity, k, body)``."""
    known = ", ".join(
        f"('{source}', '{entity}', '{n}', '{t}')"
        for (source, entity), fields in baselines.items()
        for n, t in fields.items()
    )
    return f"""
bodies as ({bodies}),
members as (select source, entity, k, e.key field_name, e.type t from bodies, json_each(body) e),
typed as (
  select source, entity, k, field_name, case t when 'VARCHAR' then 'str' when 'UBIGINT' then 'int'
    when 'BIGINT' then 'int' when 'DOUBLE' then 'float' when 'BOOLEAN' then 'bool'
    when 'OBJECT' then 'dict' when 'ARRAY' then 'list' else 'NoneType' end t from members),
observed as (
  select source, entity, field_name, coalesce(arg_min(t, k) filter (where t <> 'NoneType'), 'NoneType') type_name
  from typed group by all),
baseline as (select * from (values {known}) b(source, entity, field_name, old_type)),
events as (
  select * from (
    select source, entity, field_name,
      case when old_type is null then 'added' when type_name is null then 'removed'
           when type_name <> old_type and type_name <> 'NoneType' then 'type_changed' end change_type,
      old_type, type_name new_type, field_name in ({listed(pii)}) is_pii
    from observed full join baseline using (source, entity, field_name))
  where change_type is not null)"""


RUN_DRIFT = f"{RUN_RAW},\n{NATIVE_APPS}," + drift_of(
    f"""select 'workday' source, 'employees' entity, k, {CANONICAL_JSON} body from native_workers
  union all
  select 'airtable', 'employees', k, json_object({WRAPPED_FIELDS}) from wrapped_employees
  where json_exists(page_row, '$.fields')
    and coalesce(json_type(page_row, '$.fields.employment_type'), 'VARCHAR') <> 'NULL'
  union all
  select 'greenhouse', 'job_applications', k, {APPLICATION_JSON} from native_applications
  where coalesce(json_type(payload, '$.last_activity_at'), 'VARCHAR') <> 'NULL'""",
    {
        ("workday", "employees"): EMPLOYEE_BASELINE,
        ("airtable", "employees"): EMPLOYEE_BASELINE,
        ("greenhouse", "job_applications"): APPLICATION_BASELINE,
    },
    PII_FIELDS,
)
LATE_DRIFT = (
    f"{ctes('late_workers', 'duckdb')},\n{WRAPPED.removeprefix(EMP).lstrip(',').strip()},\n{NATIVE_APPS},"
    + drift_of(
        """select 'workday' source, 'employees' entity, k, cast(payload as json) body from late_workers
  union all
  select 'airtable', 'employees', k, json_extract(page_row, '$.fields') from wrapped_employees
  where json_exists(page_row, '$.fields')
  union all
  select 'greenhouse', 'job_applications', k, cast(payload as json) from native_applications""",
        {
            ("workday", "employees"): NATIVE_BASELINE,
            ("airtable", "employees"): EMPLOYEE_BASELINE,
            ("greenhouse", "job_applications"): {
                NATIVE_APPLICATION.get(n, n): t for n, t in APPLICATION_BASELINE.items()
            },
        },
        NATIVE_PII,
    )
)

CRC = """xor(list_reduce(list_prepend(4294967295::bigint, [ord(c)::bigint for c in string_split(application_id, '')]),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
              lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295::bigint)"""

ORACLE: dict[str, str] = {
    "scan_pages": f"with {WORKERS} select row_number() over (order by k) place, "
    + ", ".join(f"{text('payload', n)} {n.lower()}" for n in (*WORKER_FIELD_MAP, "ssn"))
    + " from native_workers",
    "scan_wrapped": f"with {WRAPPED} select row_number() over (order by k) place, "
    + ", ".join(f"json_extract_string(page_row, '$.fields.{n}') {n}" for n in ENVELOPE_ORDER)
    + " from wrapped_employees",
    "scan_optional_missing": f"with {WORKERS} select 'workday' source, count(*) n_records from native_workers",
    "envelope": f"""with {WORKERS} select 'workday' source, {canonical_worker('source_id')} source_id,
        cast({CANONICAL_JSON} as varchar) payload, {RUN} ingested_at, '{BATCH_ID}' batch_id
        from native_workers""",
    "raw_scan": f"""with {RAW_EMP} select source, source_id, ingested_at from raw_employees
        where source in ('workday', 'airtable')""",
    "materialize_roundtrip": f"with {ALL_FUNNEL} select * from rpt_recruiting_funnel",
    "drift_log": f"""with {RAW_DRIFT} select 'workday' source, 'employees' entity, d detected_at, field_name, change_type,
        old_type, new_type, is_pii from events,
        (values ({RUN}), ({RUN} + interval '1 day')) x(d)""",
    "serve_decimals": f"""with {ALL_ATTRITION} select year_month, department,
        {', '.join(f'cast({c} as decimal(38,6)) {c}' for c in ('avg_headcount', 'attrition_rate_pct', 'rolling_12m_attrition_rate_pct'))}
        from fct_attrition_monthly""",
    "map_workers": f"""with {WORKERS} select k,
        {', '.join(f"{text('payload', WORKER_TEXT[n])} {n}" for n in ENVELOPE_ORDER)},
        case json_type(payload, '$.Termination_Date') when 'NULL' then 'null' when 'VARCHAR' then 'value'
             else 'missing' end termination_state from native_workers""",
    "map_status_stage": f"""with {NATIVE_APPS} select k, {text('payload', 'status')} status,
        {APPLICATION_STAGE} stage from native_applications""",
    "map_applications": f"""with {NATIVE_APPS} select k,
        {', '.join(f"{strip(text('payload', s))} {d}" for s, d in (('id', 'source_id'), ('candidate_id', 'candidate_id'), ('job_id', 'job_id'), ('job_title', 'job_title'), ('department', 'department')))},
        {APPLICATION_STAGE} stage, cast({text('payload', 'applied_at')} as timestamp) applied_at,
        cast({CHANGED} as timestamp) stage_changed_at, {text('payload', 'recruiter_id')} recruiter_id,
        case when json_type(payload, '$.last_activity_at') = 'NULL' then 'stage_changed_at:null'
             else '' end errors from native_applications""",
    "default_missing": f"""with {WRAPPED}, found as (
          select k, json_type(page_row, '$.fields.employment_type') t,
            json_extract_string(page_row, '$.fields.employment_type') v from wrapped_employees)
        select k, case when t is null then 'full_time' else v end employment_type,
          coalesce(t = 'NULL', false) explicit_null from found""",
    "strip_strings": f"select c_custkey, {strip('padded')} c_name from"
    " (select c_custkey, chr(9)||' '||c_name||' '||chr(160)||chr(10) padded from customer)",
    "validate_records": f"""with {DIRTY} select k,
        {', '.join(f"{typed_worker(n)} {n}" for n in ENVELOPE_ORDER)}, {WORKER_ERRORS} errors
        from dirty_workers""",
    "validate_epoch": f"""with {ctes('epoch_workers', 'duckdb')}, sent as (
          select e.k, n.hire_date, cast(e.k % 11 as int) kind from epoch_workers e join native_workers n using (k))
        select k, case when kind in (0, 1, 2, 3, 5, 10) then hire_date end hire_date,
          case kind when 4 then 'hire_date:value' when 6 then 'hire_date:type' when 7 then 'hire_date:value'
            when 8 then 'hire_date:value' when 9 then 'hire_date:value' else '' end errors from sent""",
    "envelope_epoch": """with sent as (
          select o_orderkey k, cast(o_orderkey % 6 as int) kind, o_orderdate + to_seconds(o_orderkey*977%86400) t from orders),
        timed as (
          select k, kind, case kind when 1 then t + interval '250 milliseconds' when 2 then t + interval '500 milliseconds'
            when 4 then t + interval '250 milliseconds' when 5 then null else t end t from sent)
        select k, t applied_at, case when kind in (1, 2, 4) then strftime(t, '%Y-%m-%dT%H:%M:%S.%fZ')
            else strftime(t, '%Y-%m-%dT%H:%M:%SZ') end payload_applied_at,
          case kind when 5 then 'applied_at:type' else '' end errors from timed""",
    "refused_rows": f"""with {RAW_EMP} select k, source, concat_ws(',',
          case when k % 97 = 0 then 'source_id' end, case when k % 89 = 0 then 'payload' end,
          case when k % 83 = 0 then 'batch_id' end) null_columns
        from raw_employees where k % 97 = 0 or k % 89 = 0 or k % 83 = 0""",
    "source_capabilities": """select source, entity, note, optional,
          case when note = 'owned' then n_records else 0 end n_records
        from (select count(*) n_records from orders), (values
          ('workday', 'employees', 'owned', false),
          ('workday', 'job_applications', 'no mapping of job_applications from workday', false),
          ('greenhouse', 'employees', 'no mapping of employees from greenhouse', false),
          ('greenhouse', 'job_applications', 'owned', false),
          ('airtable', 'employees', 'owned', true),
          ('airtable', 'job_applications', 'owned', true)) c(source, entity, note, optional)""",
    "validate_summary": f"""with {DIRTY} select count(*) records,
        count(*) filter (where {WORKER_ERRORS} <> '') invalid from dirty_workers""",
    "batch_stats": f"""with {WORKERS}, {NATIVE_APPS}
        select 'workday' source, count(*) records, 0 invalid from native_workers
        union all select 'greenhouse', count(*),
          count(*) filter (where json_type(payload, '$.last_activity_at') = 'NULL')
        from native_applications""",
    "flatten_employees": f"with {RAW_EMP}, {STG_EMPLOYEES} select * from flat_employees",
    "flatten_applications": f"with {APPLICATIONS} select * from flat_applications",
    "active_flag": f"""with {EMP} select employee_id,
        termination_date is null or termination_date > {DAY} is_active from emp""",
    "retention_filter": f"""with {EMP} select employee_id, termination_date from emp
        where termination_date is null or termination_date > {DAY} - interval '90 days'""",
    "interval_join_active": f"""with {EMP}
        select s.date, count(*) employees, cast(sum(k) as bigint) key_sum, min(hire_date) first_hire
        from (select cast(unnest(generate_series({START}, {DAY}, interval '1 day')) as date) date) s
        join emp e on e.hire_date <= s.date
          and (e.termination_date is null or e.termination_date > s.date)
        group by 1""",
    "headcount_changepoints": f"with {EMP}, {headcount('counted', 'emp')} select * from counted",
    "month_spine_join": f"with {DAILY}, {MONTHS}, {MONTHLY}, {ON_SPINE} select * from on_spine",
    "left_join_terminations": f"""with {DAILY}, {MONTHS}, {MONTHLY}, {ON_SPINE}, {MONTHLY_TERMS},
        {COMBINED} select * from combined""",
    "filtered_counts": f"with {EMP}, {WITHOUT_IDS}, {terminations('blank_ids')} select * from terminations",
    "avg_headcount_cells": f"""with {DAILY}, {MONTHLY} select *,
        {rounded('10 * headcount_sum', 'cells')} / 10 avg_headcount from monthly""",
    "global_count": f"with {EMPLOYEES} select count(*) n from dim_employees",
    "dedup_latest": f"""with {RAW_EMP}, {STG_EMPLOYEES}
        select employee_id, source_system, job_title, ingested_at from (
          select *, row_number() over (partition by employee_id
            order by ingested_at desc nulls first, source_system) rn from stg_employees)
        where rn = 1""",
    "rolling_12m": f"""with {ALL_ATTRITION} select year_month, department, attrition_rate_pct,
        rolling_12m_attrition_rate_pct from fct_attrition_monthly""",
    "sorted_report": f"""with {ALL_ATTRITION} select * from fct_attrition_monthly
        order by department nulls last, year_month nulls last""",
    "preview_limit": f"""with {ALL_FUNNEL} select * from rpt_recruiting_funnel
        order by year_month nulls last, job_id nulls last limit 10""",
    "drift_sample": f"""with {WORKERS} select {text('payload', 'Worker_ID')} worker_id
        from native_workers order by k limit 50""",
    "full_name": f"""with {RAW_EMP}, {STG_EMPLOYEES} select employee_id, source_system,
        first_name || ' ' || last_name full_name from flat_employees""",
    "month_bucket": """select o_orderkey, cast(date_trunc('month', o_orderdate) as date) month_start,
        strftime(o_orderdate, '%Y-%m') year_month from orders""",
    "date_spine": f"""with {EMP} select s.date, count(e.k) hires
        from (select cast(unnest(generate_series({START}, {DAY}, interval '1 day')) as date) date) s
        left join emp e on e.hire_date = s.date group by 1""",
    "month_spine": f"""with {EMP}, {MONTHS} select month_start, count(e.k) hires
        from months left join emp e on cast(date_trunc('month', e.hire_date) as date) = month_start
        group by 1""",
    "time_in_stage_days": f"""with {APPLICATIONS}
        select application_id, source_system, time_in_stage_days from stg_job_applications""",
    "voluntary_split": f"""with {EMP}, {WITHOUT_IDS} select k,
        cast('0x' || substr(md5(employee_id), 1, 8) as bigint) % 4 <> 0 is_voluntary from blank_ids""",
    "upsert_raw": f"""with {EMP},
        a as (select case when k%2=0 then 'workday' else 'airtable' end source, 'E'||k source_id,
                'id-'||k id, '{{"department":"'||department||'","level":"'||level||'"}}' payload,
                timestamp '2001-07-31 06:00:00' ingested_at, 'b1' batch_id from emp),
        b as (select 'workday' source, 'E'||(2*k) source_id,
                '{{"employment_type":"'||employment_type||'","level":"'||level||'"}}' payload,
                {RUN} ingested_at, 'b2' batch_id from emp)
        select coalesce(a.id, 'new') id, b.source, b.source_id, b.payload, b.ingested_at, b.batch_id
        from b left join a on a.source = b.source and a.source_id = b.source_id
        union all
        select id, source, source_id, payload, ingested_at, batch_id from a
        where not exists (select 1 from b where b.source = a.source and b.source_id = a.source_id)""",
    "upsert_idempotent": f"""with {WORKERS} select 'workday' source,
        {text('payload', 'Worker_ID')} source_id, true same_id, {text('payload', 'Work_Email')} email,
        '{BATCH_ID}' batch_id from native_workers""",
    "upsert_last_wins": """select user_id, arg_max(event_type, event_id) event_type,
        arg_max(props, event_id) props from events group by 1""",
    "infer_schema": f"with {WORKERS}, {TYPES.format(records='native_workers', payload='payload')} select * from observed",
    "drift_events": f"with {CANONICAL_DRIFT} select * from events",
    "drift_raw": f"with {RAW_DRIFT} select * from events",
    "pii_alert": f"""with {RAW_DRIFT} select count(*) events, 'PII schema drift detected in fields: '
        || string_agg(field_name, ', ' order by field_name) message from events
        where is_pii having count(*) > 0""",
    "dq_not_null": f"""with {EMPLOYEES} select employee_id, full_name, email from dim_employees
        where full_name is null""",
    "dq_unique": f"""with {RAW_EMP}, {STG_EMPLOYEES} select employee_id, count(*) n_records
        from stg_employees where employee_id is not null group by 1 having count(*) > 1""",
    "dq_accepted_values": f"""with {EMPLOYEES} select level, count(*) n_records from dim_employees
        where level not in ({listed(LEVELS)}) group by 1""",
    "dq_headcount_positive": f"""with {DAILY} select date, department, level, headcount
        from fct_headcount_daily where headcount < 0""",
    "dq_no_null_id": f"with {EMPLOYEES} select employee_id from dim_employees where employee_id is null",
    "dq_summary": f"with {ALL_ATTRITION}, {ALL_FUNNEL.replace(EMP + ',', '')} {DQ_SUMMARY}",
    "stg_employees": f"with {RAW_EMP}, {STG_EMPLOYEES} select * from stg_employees",
    "stg_job_applications": f"with {APPLICATIONS} select * from stg_job_applications",
    "dim_employees": f"with {EMPLOYEES} select * from dim_employees",
    "fct_headcount_daily": f"with {DAILY} select * from fct_headcount_daily",
    "fct_attrition_monthly": f"with {ALL_ATTRITION} select * from fct_attrition_monthly",
    "rpt_recruiting_funnel": f"with {ALL_FUNNEL} select * from rpt_recruiting_funnel",
    "funnel_collated": f"""with {APPLICATIONS}, titled as (
          select * replace (['zeta', 'Zeta', 'Élan', 'elan', 'Alpha', 'ångström', 'beta', 'Äpfel'][{CRC} % 8 + 1] as job_title)
          from stg_job_applications)
        select job_id, strftime(applied_at, '%Y-%m') year_month, arg_max(job_title, icu_sort_key(job_title, 'en')) job_title,
          arg_max(department, icu_sort_key(department, 'en')) department,
          count(*) filter (where stage = 'applied') applied_count
        from titled group by 1, 2""",
    "attrition_corrected": f"""with {RAW_EMP}, {STG_EMPLOYEES}, {dim('dim_employees', 'staged_all')},
        {headcount('fct_headcount_daily', 'dim_employees')}, {MONTHS},
        monthly as (
          select m.month_start, department, headcount_sum, n_days cells from (
            select cast(date_trunc('month', date) as date) month_start, department,
              cast(sum(headcount) as bigint) headcount_sum from fct_headcount_daily group by all) m
          join (select cast(date_trunc('month', d) as date) month_start, count(*) n_days
                from (select unnest(generate_series({START}, {DAY}, interval '1 day')) d) group by 1) n
            using (month_start)),
        {ON_SPINE}, {MONTHLY_TERMS}, {COMBINED}, {ATTRITION} select * from fct_attrition_monthly""",
    "run_stats": f"""with {RUN_RAW}, {NATIVE_APPS}
        select 'greenhouse' source, count(*) filter (where json_type(payload, '$.last_activity_at')
          is distinct from 'NULL') rows, false skipped, cast(null as varchar) error from native_applications
        union all select source, count(*), false, null from raw_employees group by source""",
    "envelope_offsets": f"""with {ctes('offset_applications', 'duckdb')} select k,
        {text('payload', 'applied_at')} applied_at, {APPLICATION_STAGE} stage from offset_applications""",
    "upsert_two_batches": f"""with {WORKERS} select 'workday' source, 'E'||k source_id,
        case when k % 2 = 0 then '{BATCH_ID[:-1]}2' else '{BATCH_ID}' end batch_id,
        case when k % 2 = 0 then 'Lead' else {canonical_worker('job_title')} end job_title, true id_kept
        from native_workers where k % 3 <> 0 or k % 2 = 0""",
    "run_dim_employees": f"with {RUN_EMPLOYEES} select * from dim_employees",
    "run_attrition": f"with {RUN_ATTRITION} select * from fct_attrition_monthly",
    "run_headcount": f"with {RUN_DAILY} select * from fct_headcount_daily",
    "run_funnel": f"with {RUN_FUNNEL} select * from rpt_recruiting_funnel",
    "run_drift_log": f"""with {RUN_DRIFT} select source, entity, {RUN} detected_at, field_name,
        change_type, old_type, new_type, is_pii from events""",
    "run_headcount_month": f"""with {RUN_DAILY} select * from fct_headcount_daily
        where date between date '2001-03-01' and date '2001-03-31'""",
    "run_alert": f"""with {RUN_DRIFT} select count(*) drift_events, 'PII schema drift detected in fields: '
        || string_agg(distinct field_name, ', ' order by field_name) filter (where is_pii) alert from events""",
    "run_staged_employees": f"with {RUN_RAW},\n{STG_EMPLOYEES} select * from stg_employees",
    "run_staged_applications": f"""with {RUN_FUNNEL} select * from stg_job_applications""",
    "run_checks": f"with {RUN_ATTRITION}, {RUN_FUNNEL} {DQ_SUMMARY}",
    "drift_late_field": f"""with {LATE_DRIFT} select source, entity, field_name, change_type,
        old_type, new_type, is_pii from events""",
}
