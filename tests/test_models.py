import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rosterlake.functions import dates, values
from rosterlake.functions.exact import rounded_quotient
from rosterlake.operators import quality
from rosterlake.operators.intervals import active_totals, headcount
from rosterlake.operators.lineage import made_from
from rosterlake.plans import marts, reports, staging
from rosterlake.plans.checks import CHECKS
from rosterlake.schemas import SENSITIVE_FIELDS
from tests.conftest import AS_OF
from tests.people import employee, raw_frame

DAY = dt.timedelta(days=1)


def staged(spark, *rows, **kwargs):
    """Employees staged from payloads, or from ``(source, payload, time)``."""
    full = [r if isinstance(r, tuple) else ("workday", r, "2024-03-01 06:00:00") for r in rows]
    return staging.stg_employees(raw_frame(spark, full), AS_OF, **kwargs)


def people(spark, rows):
    """Dimension-like rows ``(id, department, hire, termination)``."""
    schema = "employee_id string, department string, hire_date date, termination_date date"
    frame = spark.createDataFrame(rows, schema)
    return frame.withColumns({"level": F.lit("IC1"), "employment_type": F.lit("full_time")})


def test_blank_text_becomes_null(spark):
    row = staged(spark, employee(1, termination_date="", salary="", performance_rating="")).first()
    assert (row.termination_date, row.salary, row.performance_rating) == (None, None, None)
    assert row.is_active is True


def test_salary_is_exact(spark):
    assert staged(spark, employee(1, salary="80000.25")).first().salary == Decimal("80000.250000")


def test_blank_hire_date_is_an_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staged(spark, employee(1, hire_date="")).collect()


def test_other_sources_are_left_out(spark):
    rows = [(s, employee(i), "2024-03-01") for i, s in enumerate(("workday", "greenhouse", "airtable"))]
    assert {r.source_system for r in staged(spark, *rows).collect()} == {"workday", "airtable"}


@pytest.mark.parametrize("ago, kept, active", [(91, False, None), (90, False, None), (89, True, False), (0, True, False), (-1, True, True)])
def test_retention_boundary(spark, ago, kept, active):
    ended = (AS_OF - ago * DAY).isoformat()
    rows = staged(spark, employee(1, termination_date=ended)).collect()
    assert [r.is_active for r in rows] == ([active] if kept else [])
    assert staged(spark, employee(1, termination_date=ended), retention_days=None).count() == 1


def test_variant_payloads_give_the_same_rows(spark, tmp_path):
    raw = raw_frame(spark, [("workday", employee(i, salary=None), "2024-03-01") for i in range(5)])
    path = str(tmp_path / "raw")
    raw.withColumn("payload", F.parse_json("payload")).write.parquet(path)
    variant = spark.read.parquet(path)
    texts = staging.stg_employees(raw, AS_OF)
    assert sorted(staging.stg_employees(variant, AS_OF).collect()) == sorted(texts.collect())


def test_variant_scan_reads_only_the_members_in_use(spark, tmp_path):
    raw = raw_frame(spark, [("workday", employee(i), "2024-03-01") for i in range(5)])
    path = str(tmp_path / "raw")
    raw.withColumn("payload", F.parse_json("payload")).write.parquet(path)
    slim = staging.stg_employees(spark.read.parquet(path), AS_OF).select("department")
    plan = slim._jdf.queryExecution().executedPlan().toString()
    assert "payload:struct<0:string,1:string>" in plan


def test_dimension_takes_the_newest_record(spark):
    rows = [
        ("workday", employee(1, job_title="old"), "2024-01-01"),
        ("airtable", employee(1, job_title="new"), "2024-02-01"),
        ("airtable", employee(2, job_title="undated"), None),
        ("workday", employee(2, job_title="dated"), "2024-02-01"),
        ("workday", employee(3, job_title="w"), "2024-02-01"),
        ("airtable", employee(3, job_title="a"), "2024-02-01"),
    ]
    found = marts.dim_employees(staged(spark, *rows)).collect()
    assert {(r.employee_id, r.job_title) for r in found} == {("e-1", "new"), ("e-2", "undated"), ("e-3", "a")}


def test_dimension_columns_are_not_sensitive(spark):
    frame = marts.dim_employees(staged(spark, employee(1)))
    assert frame.columns == [
        "employee_id", "full_name", "email", "department", "job_title", "level", "hire_date",
        "termination_date", "is_active", "employment_type", "manager_id", "location", "created_at",
        "updated_at",
    ]
    with pytest.raises(ValueError, match="salary"):
        marts.without_sensitive(staged(spark, employee(1)))


def test_missing_name_part_gives_no_name(spark):
    row = marts.dim_employees(staged(spark, employee(1, first_name=None))).first()
    assert row.full_name is None


def test_spell_is_half_open(spark):
    hire, end = AS_OF - 10 * DAY, AS_OF - 7 * DAY
    rows = [("a", "D", hire, end), ("b", "D", hire + DAY, hire + 2 * DAY)]
    least = {"first": F.col("employee_id")}
    days = active_totals(people(spark, rows), {}, least, AS_OF).orderBy("date").collect()
    assert [(r.date, r.employees, r.first) for r in days] == [
        (hire, 1, "a"), (hire + DAY, 2, "a"), (hire + 2 * DAY, 1, "a"),
    ]


@pytest.mark.parametrize(
    "hire, end, expected",
    [
        (AS_OF, None, 1),
        (AS_OF, AS_OF, 0),  # ended on the day of hire
        (AS_OF, AS_OF - 5 * DAY, 0),  # ended before hire
        (AS_OF + DAY, None, 0),
        (AS_OF, AS_OF + 30 * DAY, 1),
        (dt.date(2001, 1, 1), dt.date(2022, 3, 15), 0),  # ended on the first day
        (dt.date(2001, 1, 1), dt.date(2022, 3, 16), 1),
        (dt.date(2001, 1, 1), None, 732),
        (None, None, 0),
        (None, AS_OF, 0),
    ],
)
def test_headcount_edges(spark, hire, end, expected):
    frame = people(spark, [("a", "D", hire, end)])
    counted = headcount(frame, marts.HEADCOUNT_KEYS, AS_OF)
    assert counted.agg(F.coalesce(F.sum("headcount"), F.lit(0)).alias("n")).first().n == expected
    assert active_totals(frame, {}, {}, AS_OF).count() == expected


def test_headcount_equals_the_join_on_random_spells(spark):
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("employee_id"),
        F.expr("if(id % 7 = 0, null, 'd' || id % 3)").alias("department"),
        F.expr("date'2021-06-01' + cast(pmod(xxhash64(id), 1200) as int)").alias("hire_date"),
        F.expr("if(id % 2 = 0, date'2021-06-01' + cast(pmod(xxhash64(id, 1), 1400) as int), null)").alias(
            "termination_date"
        ),
        F.expr("'L' || id % 2").alias("level"),
        F.lit("full_time").alias("employment_type"),
    )
    keys = list(marts.HEADCOUNT_KEYS)
    spine = dates.day_spine(spark, AS_OF)
    literal = (
        spine.join(rows, F.expr("hire_date <= date and (termination_date is null or termination_date > date)"))
        .groupBy("date", *keys)
        .agg(F.count("*").alias("headcount"))
    )
    counted = headcount(rows, keys, AS_OF).select("date", *keys, "headcount")
    assert counted.exceptAll(literal).isEmpty() and literal.exceptAll(counted).isEmpty()


def test_headcount_needs_no_join(spark):
    plan = headcount(people(spark, []), marts.HEADCOUNT_KEYS, AS_OF)._jdf.queryExecution().toString()
    assert "Join" not in plan and "partial_sum" in plan


def test_leap_day_history_starts_on_28_february(spark):
    leap = dt.date(2024, 2, 29)
    spine = dates.day_spine(spark, leap).agg(F.min("date"), F.max("date"), F.count("*")).first()
    assert tuple(spine) == (dt.date(2022, 2, 28), leap, 732)
    months = [r.month_start for r in dates.month_spine(spark, leap).orderBy("month_start").collect()]
    assert (len(months), months[0], months[-1]) == (25, dt.date(2022, 2, 1), dt.date(2024, 2, 1))


def attrition(spark, rows, **kwargs):
    frame = people(spark, rows)
    found = marts.fct_attrition_monthly(frame, AS_OF, **kwargs).collect()
    return {(r.year_month, r.department): r for r in found}


def test_attrition_of_one_month(spark):
    rows = [(f"p{i}", "D", dt.date(2020, 1, 1), None) for i in range(9)]
    rows.append(("p9", "D", dt.date(2020, 1, 1), dt.date(2024, 2, 1)))
    found = attrition(spark, rows)
    feb = found[("2024-02", "D")]
    assert (feb.total_terminations, feb.avg_headcount, feb.attrition_rate_pct) == (1, 9.0, 11.11)
    assert feb.rolling_12m_attrition_rate_pct == 0.93  # 11.11 / 12
    assert found[("2024-01", "D")].attrition_rate_pct == 0.0
    assert len(found) == 25


def test_average_is_over_cells_unless_corrected(spark):
    rows = [("a", "D", dt.date(2020, 1, 1), None), ("b", "D", dt.date(2020, 1, 1), None)]
    frame = people(spark, rows).withColumn("level", F.col("employee_id"))
    plain = marts.fct_attrition_monthly(frame, AS_OF).first()
    fixed = marts.fct_attrition_monthly(frame, AS_OF, corrected=True).first()
    assert (plain.avg_headcount, fixed.avg_headcount) == (1.0, 2.0)


def test_null_department_matches_no_termination(spark):
    rows = [("a", None, dt.date(2020, 1, 1), None), ("b", None, dt.date(2020, 1, 1), dt.date(2024, 2, 10))]
    assert attrition(spark, rows)[("2024-02", None)].total_terminations == 0


def test_employee_without_id_counts_in_the_total_only(spark):
    rows = [(None, "D", dt.date(2020, 1, 1), dt.date(2024, 2, 10))]
    row = marts.monthly_terminations(people(spark, rows)).first()
    assert (row.voluntary_terminations, row.involuntary_terminations, row.total_terminations) == (0, 0, 1)


def test_future_termination_of_this_month_counts(spark):
    rows = [("a", "D", dt.date(2020, 1, 1), AS_OF + 5 * DAY), ("b", "D", dt.date(2020, 1, 1), AS_OF + 60 * DAY)]
    found = attrition(spark, rows)
    assert found[("2024-03", "D")].total_terminations == 1
    assert sum(r.total_terminations for r in found.values()) == 1


def test_month_without_headcount_is_absent_and_rolling_counts_rows(spark):
    rows = [
        ("a", "D", dt.date(2023, 1, 1), dt.date(2023, 2, 1)),
        ("b", "D", dt.date(2023, 6, 1), dt.date(2023, 7, 15)),
    ]
    found = attrition(spark, rows)
    assert sorted(m for m, _ in found) == ["2023-01", "2023-06", "2023-07"]
    assert found[("2023-07", "D")].attrition_rate_pct == 100.0
    assert found[("2023-07", "D")].rolling_12m_attrition_rate_pct == 33.33


def test_rounding_is_half_away_from_zero(spark):
    pairs = [(1, 2, 1), (-1, 2, -1), (3, 2, 2), (-3, 2, -2), (1, 3, 0), (-1, 3, 0), (2, 3, 1), (5, 10, 1), (0, 7, 0)]
    frame = spark.createDataFrame(pairs, "n bigint, d bigint, want bigint")
    got = frame.select("want", rounded_quotient(F.col("n"), F.col("d")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_voluntary_split_is_the_md5_rule(spark):
    import hashlib

    names = [f"id-{i}" for i in range(500)]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.v for r in frame.select("n", values.is_voluntary(F.col("n")).alias("v")).collect()}
    assert got == {n: int(hashlib.md5(n.encode()).hexdigest()[:8], 16) % 4 != 0 for n in names}


def application_rows(spark, *rows):
    """Staged applications from ``(job, title, stage, applied, changed)``."""
    data = [
        (
            "greenhouse",
            {
                "source_id": f"a{i}", "candidate_id": "c", "job_id": job, "job_title": title,
                "department": "D", "stage": stage, "applied_at": applied, "stage_changed_at": changed,
                "recruiter_id": None,
            },
            None,
        )
        for i, (job, title, stage, applied, changed) in enumerate(rows)
    ]
    return staging.stg_job_applications(raw_frame(spark, data))


def test_days_are_whole_and_toward_zero(spark):
    rows = application_rows(
        spark,
        ("J", "T", "hired", "2024-01-01T12:00:00", "2024-01-31T11:00:00"),
        ("J", "T", "hired", "2024-01-31T11:00:00", "2024-01-01T12:00:00"),
        ("J", "T", "hired", "2024-01-31T11:00:00", None),
    )
    assert [r.time_in_stage_days for r in rows.orderBy("application_id").collect()] == [29, -29, None]


def test_funnel(spark):
    at = "2024-01-05T00:00:00"
    rows = application_rows(
        spark,
        ("J1", "A", "offer", at, at),
        ("J1", "B", "hired", at, "2024-01-06T00:00:00"),
        ("J1", "B", "hired", at, "2024-01-07T00:00:00"),
        ("J1", "A", "applied", at, at),
        ("J2", "A", "rejected", at, at),
        ("J3", "A", "hired", at, "2024-01-04T00:00:00"),
        ("J3", "A", "hired", at, "2024-01-05T00:00:00"),
    )
    found = {r.job_id: r for r in reports.rpt_recruiting_funnel(rows).collect()}
    one, two, three = found["J1"], found["J2"], found["J3"]
    assert (one.job_title, one.applied_count, one.offer_count, one.hired_count) == ("B", 1, 1, 2)
    assert (one.application_to_hire_days_avg, one.offer_acceptance_rate_pct) == (1.5, 200.0)
    assert (two.applied_count, two.hired_count, two.offer_acceptance_rate_pct) == (0, 0, 0.0)
    assert (three.application_to_hire_days_avg, three.offer_acceptance_rate_pct) == (-0.5, 0.0)


def test_funnel_heavy_step_aggregates_by_hash(spark):
    plan = reports.funnel_counts(application_rows(spark))._jdf.queryExecution().sparkPlan().toString()
    lowest = [line for line in plan.splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate" in lowest


def test_report_order_puts_nulls_last(spark):
    frame = spark.createDataFrame([(None, "a"), ("B", "b"), ("A", "a")], "department string, year_month string")
    found = [r.department for r in reports.ordered(frame, "fct_attrition_monthly").collect()]
    assert found == ["A", "B", None]
    assert reports.preview(frame, "fct_attrition_monthly", 2).count() == 2


def test_serving_decimals(spark):
    frame = spark.createDataFrame([(Decimal("1.0000005"), 2.5)], "a decimal(20,10), b double")
    row = marts.serve(frame, ["a", "b"]).first()
    assert (row.a, row.b) == (Decimal("1.000001"), Decimal("2.500000"))


# --- quality -----------------------------------------------------------------


def test_checks(spark):
    frame = spark.createDataFrame(
        [("a", "IC6", 1), ("a", "M5", -1), (None, "X1", 2), (None, None, 3)], "id string, level string, n int"
    )
    rules = [
        quality.not_null("t", "id"),
        quality.unique("t", "id"),
        quality.accepted_values("t", "level", ("IC6", "M5")),
        quality.expression("t", "n", "n < 0", ["id", "n"]),
    ]
    got = {r.check_name: r.failures for r in quality.summarize(frame, rules).collect()}
    assert got == {"not_null_t_id": 2, "unique_t_id": 1, "accepted_values_t_level": 1, "expression_t_n": 1}
    assert [tuple(r) for r in quality.failing_rows(frame, rules[1]).collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.failing_rows(frame, rules[2]).collect()] == [("X1", 1)]
    assert [tuple(r) for r in quality.failing_rows(frame, rules[3]).collect()] == [("a", -1)]
    with pytest.raises(quality.QualityError, match="not_null_t_id"):
        quality.gate(frame, rules)


def test_declared_checks():
    kinds = [c.kind for checks in CHECKS.values() for c in checks]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 11, "unique": 1, "accepted_values": 3, "expression": 2,
    }


def test_sensitive_columns_are_found_by_any_name(spark):
    rows = staged(spark, employee(1), employee(2))
    assert made_from(rows.select("employee_id", F.lower("department").alias("d")), SENSITIVE_FIELDS) == {}
    renamed = rows.withColumnRenamed("salary", "bracket")
    assert made_from(renamed, SENSITIVE_FIELDS) == {"bracket": ["salary"], "performance_rating": ["performance_rating"]}
    pay = F.col("salary")
    by_department = rows.groupBy("department").agg(F.avg(pay).alias("typical"), F.count("*").alias("n"))
    best = F.max("performance_rating").over(Window.partitionBy("level"))
    cases = {
        "expression": rows.select((pay > 100_000).alias("senior")),
        "struct": rows.select(F.struct("employee_id", "salary").alias("both")).select("both.employee_id", "both"),
        "aggregate": by_department,
        "window": rows.select(best.alias("best")),
        "join": rows.select("employee_id", "department").join(by_department, "department").select("typical"),
        "union": rows.select("location").union(rows.select("performance_rating")),
        "explode": rows.select(F.explode(F.array("location", "performance_rating")).alias("x")),
        "payload": spark.sql("SELECT variant_get(parse_json('{}'), '$.salary', 'string') AS x"),
        "subquery": rows.select(F.lit(1).alias("x"), rows.agg(F.max("salary")).scalar().alias("top")),
        "new name": rows.select(F.col("department").alias("salary")),
    }
    leaks = {name: sorted(made_from(df, SENSITIVE_FIELDS)) for name, df in cases.items()}
    assert leaks == {
        "expression": ["senior"], "struct": ["both", "employee_id"], "aggregate": ["typical"], "window": ["best"],
        "join": ["typical"], "union": ["location"], "explode": ["x"], "payload": ["x"], "subquery": ["top"],
        "new name": ["salary"],
    }
    with pytest.raises(ValueError, match=r"bracket \(from salary\)"):
        marts.without_sensitive(renamed.drop("performance_rating"))


def test_dimension_of_disguised_pay_is_refused(spark):
    disguised = staged(spark, employee(1)).withColumn("location", F.concat("location", F.col("salary").cast("string")))
    with pytest.raises(ValueError, match=r"location \(from salary\)"):
        marts.dim_employees(disguised)


@pytest.mark.parametrize(
    "titles, collation, want",
    [
        (["a", "B"], None, "a"), (["a", "B"], "UNICODE", "B"), (["z", "Ä"], None, "Ä"), (["z", "Ä"], "UNICODE", "z"),
        (["z", "Ä"], "sv", "Ä"), (["e", "É", "f"], "UNICODE", "f"),
    ],
)
def test_last_title_by_collation(spark, titles, collation, want):
    shape = "job_id string, job_title string, department string, stage string, applied_at timestamp_ntz, time_in_stage_days bigint"
    rows = [("j", t, "d", "applied", dt.datetime(2024, 1, 1), 1) for t in titles]
    frame = reports.rpt_recruiting_funnel(spark.createDataFrame(rows, shape), collation)
    row = frame.first()
    assert row.job_title == want and frame.schema["job_title"].dataType.simpleString() == "string"
