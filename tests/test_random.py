"""Random inputs against plain Python."""

import datetime as dt
import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rosterlake.functions.values import member_text
from rosterlake.operators.drift import detect_drift, infer_schema
from rosterlake.operators.envelope import to_envelope
from rosterlake.operators.upsert import read_raw, upsert
from rosterlake.operators.validate import validate
from rosterlake.plans import marts, reports, staging
from rosterlake.schemas import EMPLOYEE_FIELDS
from rosterlake.sources.mapping import map_workers
from tests.conftest import AS_OF, RUN_TS
from tests.people import raw_frame, record_frame, worker

DAY = dt.timedelta(days=1)


def half_up(value: Fraction, places: int) -> float:
    scaled = abs(value) * 10**places
    whole = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    return (-whole if value < 0 else whole) / 10**places


@pytest.mark.parametrize("seed", range(3))
def test_drift(spark, seed):
    rnd = random.Random(seed)
    samples = [None, 1, 2.5, True, "x", [1], {"z": 1}, 10**25]
    records = [
        {f: rnd.choice(samples) for f in "abcdefgh" if rnd.random() < 0.3} for _ in range(60)
    ]
    observed: dict[str, str] = {}
    for record in records:
        for name, value in record.items():
            if observed.get(name, "NoneType") == "NoneType":
                observed[name] = type(value).__name__
    baseline = {f: rnd.choice(["int", "str", "float"]) for f in "abcdxy"}
    want = set()
    for name in observed.keys() | baseline.keys():
        old, new = baseline.get(name), observed.get(name)
        if old is None:
            want.add((name, "added", None, new))
        elif new is None:
            want.add((name, "removed", old, None))
        elif new not in (old, "NoneType"):
            want.add((name, "type_changed", old, new))
    frame = record_frame(spark, records).repartition(7)
    found = detect_drift(infer_schema(frame, ["k"]), baseline, ["a"]).drop("is_pii")
    assert {tuple(r) for r in found.collect()} == want


@pytest.mark.parametrize("seed", range(3))
def test_attrition(spark, seed):
    rnd = random.Random(seed)
    people = []
    for i in range(80):
        hire = AS_OF - rnd.randrange(1200) * DAY
        end = hire + rnd.randrange(500) * DAY if rnd.random() < 0.6 else None
        people.append(
            (
                f"p{i}", rnd.choice(["A", "B", None]), rnd.choice(["IC1", "M1"]),
                rnd.choice(["full_time", "contractor"]), hire, end,
            )
        )
    start = dt.date(AS_OF.year - 2, AS_OF.month, AS_OF.day)
    cells = Counter()
    for _, dept, level, kind, hire, end in people:
        day = max(hire, start)
        while day <= AS_OF and (end is None or end > day):
            cells[day, dept, level, kind] += 1
            day += DAY
    months = defaultdict(list)
    for (day, dept, _, _), n in cells.items():
        months[dept, day.replace(day=1)].append(n)
    left = Counter()
    for name, dept, _, _, _, end in people:
        if end is not None:
            chosen = int(hashlib.md5(name.encode()).hexdigest()[:8], 16) % 4 != 0
            left[dept, end.replace(day=1), chosen] += 1
    want, history = set(), defaultdict(list)
    for (dept, month), counts in sorted(months.items(), key=lambda x: (str(x[0][0]), x[0][1])):
        voluntary, forced = (left[dept, month, c] if dept is not None else 0 for c in (True, False))
        mean = Fraction(sum(counts), len(counts))
        rate = half_up((voluntary + forced) / mean * 100, 2)
        history[dept].append(Fraction(round(rate * 100), 100))
        last = history[dept][-12:]
        want.add(
            (
                month.strftime("%Y-%m"), dept, voluntary, forced, voluntary + forced,
                half_up(mean, 1), rate, half_up(sum(last) / len(last), 2),
            )
        )
    frame = spark.createDataFrame(
        people,
        "employee_id string, department string, level string, employment_type string,"
        " hire_date date, termination_date date",
    )
    daily = marts.fct_headcount_daily(frame, AS_OF)
    counted = {(r.date, r.department, r.level, r.employment_type): r.headcount for r in daily.collect()}
    assert counted == dict(cells)
    found = marts.fct_attrition_monthly(frame, AS_OF).collect()
    assert {tuple(r) for r in found} == want


def test_funnel(spark):
    rnd = random.Random(5)
    stages = ["applied", "phone_screen", "interview", "offer", "hired", "rejected"]
    rows, groups = [], defaultdict(list)
    for i in range(400):
        applied = dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(2000))
        changed = applied + dt.timedelta(hours=rnd.randrange(-200, 900)) if rnd.random() < 0.9 else None
        job, title, dept, stage = f"J{rnd.randrange(5)}", rnd.choice("xyz"), rnd.choice(["D", None]), rnd.choice(stages)
        payload = {
            "source_id": f"a{i}", "candidate_id": "c", "job_id": job, "job_title": title, "department": dept,
            "stage": stage, "applied_at": applied.isoformat(),
            "stage_changed_at": changed and changed.isoformat(), "recruiter_id": None,
        }
        rows.append(("greenhouse", payload, None))
        span = None if changed is None else int((changed - applied) / DAY)
        groups[job, applied.strftime("%Y-%m")].append((title, dept, stage, span))
    want = set()
    for (job, month), members in groups.items():
        n = Counter(m[2] for m in members)
        spans = [m[3] for m in members if m[2] == "hired" and m[3] is not None]
        depts = [m[1] for m in members if m[1] is not None]
        want.add(
            (
                job, month, max(m[0] for m in members), max(depts, default=None),
                *[n[s] for s in stages[:5]],
                half_up(Fraction(sum(spans), len(spans)), 1) if spans else 0.0,
                half_up(Fraction(n["hired"], n["offer"]) * 100, 2) if n["offer"] else 0.0,
            )
        )
    frame = reports.rpt_recruiting_funnel(staging.stg_job_applications(raw_frame(spark, rows)))
    assert {tuple(r) for r in frame.collect()} == want


def test_upserts(spark, raw):
    rnd = random.Random(9)
    state, ids = {}, {}
    for n in range(4):
        batch = [worker(rnd.randrange(12), Job_Title=f"t{n}-{j}") for j in range(rnd.randrange(1, 15))]
        for record in batch:
            state[record["Worker_ID"]] = (record["Job_Title"], f"b{n}")
        checked = validate(map_workers(record_frame(spark, batch), ["k"]), EMPLOYEE_FIELDS, ["k"])
        rows = to_envelope(checked, EMPLOYEE_FIELDS, "workday", f"b{n}", RUN_TS, ["k"])
        upsert(spark, raw, rows, "workday", ["k"])
        title = member_text(F.col("payload"), "job_title").alias("title")
        found = read_raw(spark, raw, ["workday"]).select("id", "source_id", title, "batch_id").collect()
        assert {r.source_id: (r.title, r.batch_id) for r in found} == state
        assert all(ids.setdefault(r.source_id, r.id) == r.id for r in found)
    assert len(set(ids.values())) == len(ids)
