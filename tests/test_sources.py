import json

import pytest
from pyspark.sql import functions as F

from rosterlake.functions.values import member_text
from rosterlake.sources.mapping import map_applications, map_workers, map_wrapped_employees
from rosterlake.sources.pages import (
    RECORD_ORDER,
    first_records,
    no_records,
    read_pages,
    read_wrapped,
    with_file_order,
)
from rosterlake.sources.registry import AIRTABLE, GREENHOUSE, SOURCES, WORKDAY
from tests.people import application, record_frame, worker, write_pages


def ids(frame, key="Worker_ID"):
    rows = frame.orderBy(*RECORD_ORDER).select(member_text(F.col("record"), key).alias("id")).collect()
    return [r.id for r in rows]


def test_pages_keep_source_order(spark, folder):
    path = write_pages(folder, "w", [[worker(i) for i in range(p * 10, p * 10 + 10)] for p in range(3)])
    assert ids(read_pages(spark, path)) == [f"w-{i}" for i in range(30)]


def test_page_lines_in_one_file(spark, tmp_path):
    bodies = [{"data": [worker(2 * p), worker(2 * p + 1)]} for p in range(5)]
    file = tmp_path / "pages.json"
    file.write_text("\n".join(json.dumps(b) for b in bodies) + "\n\n")
    assert ids(read_pages(spark, str(file))) == [f"w-{i}" for i in range(10)]


def test_page_without_data_has_no_records(spark, folder):
    path = write_pages(folder, "w", [[worker(1)], None, [worker(2)], []])
    assert ids(read_pages(spark, path)) == ["w-1", "w-2"]


def test_a_body_is_parsed_once(spark, folder):
    path = write_pages(folder, "w", [[worker(1)], [worker(2)]])
    plan = read_pages(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_files_sort_by_the_last_number_of_their_names(spark):
    number = r"^(.*?)([0-9]+)([^0-9/]*)$"
    paths = ["file:/a1/b/page-10.json", "s3://x/9/p", "/p/2024-01/x007y", "page", "12", "/a/0", "/a/1.2.3", ""]
    paths += ["/a/%20b%C3%A9-5-c000.txt", "/d/" + "7" * 25 + ".txt", "/d5/", "/d/00012a/x-1-y", "part-00003-7f0a-c000.x"]
    frame = spark.createDataFrame([(p,) for p in paths], "p string")
    old = F.concat(
        F.regexp_extract("p", number, 1), F.lpad(F.regexp_extract("p", number, 2), 20, "0"), F.regexp_extract("p", number, 3)
    )
    old = F.when(F.col("p").rlike(number), old).otherwise(F.col("p"))
    found = with_file_order(frame.select("p", old.alias("old")), F.col("p"), "new")
    assert [r.new for r in found.collect()] == [r.old for r in found.collect()]


def test_a_line_is_placed_by_one_pattern(spark, folder):
    path = write_pages(folder, "w", [[worker(1)], [worker(2)]])
    plan = read_wrapped(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan and "(.*?)" not in plan


def test_pretty_printed_pages(spark, folder):
    path = write_pages(folder, "w", [[worker(1)], [worker(2)]], indent=2)
    assert ids(read_pages(spark, path, whole_files=True)) == ["w-1", "w-2"]


@pytest.mark.parametrize("whole_files", [True, False])
def test_body_larger_than_a_variant(spark, tmp_path, whole_files):
    filler = "x" * 100_000
    with open(tmp_path / "page.json", "w") as out:  # 130 MiB and more, in one line
        out.write('{"_links": {}, "data": [')
        out.writelines(f'{"," if i else ""}{{"Worker_ID": "w-{i}", "filler": "{filler}"}}' for i in range(1400))
        out.write("]}")
    found = read_pages(spark, str(tmp_path), whole_files=whole_files)
    assert ids(found) == [f"w-{i}" for i in range(1400)]
    with pytest.raises(Exception, match="VARIANT_SIZE_LIMIT"):
        spark.read.text(str(tmp_path)).select(F.is_variant_null(F.parse_json("value"))).collect()


@pytest.mark.parametrize("body", ["5", "[1]", '{"data": 5}', '{"data": {"a": 1}}', "nope"])
def test_body_of_another_shape_fails(spark, tmp_path, body):
    (tmp_path / "p.json").write_text(body)
    for whole_files in (True, False):
        with pytest.raises(Exception, match="MALFORMED|FAILED_READ|Malformed"):
            read_pages(spark, str(tmp_path), whole_files=whole_files).count()


def test_malformed_page_fails(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"data": [')
    with pytest.raises(Exception, match="MALFORMED"):
        read_pages(spark, str(tmp_path)).count()


def test_repeated_key_keeps_the_last_value(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"data": [{"Worker_ID": "a", "Worker_ID": "b"}]}')
    assert ids(read_pages(spark, str(tmp_path))) == ["b"]


def test_wrapped_rows(spark, tmp_path):
    rows = [{"id": "r1", "fields": {"source_id": "a"}}, {"id": "r2"}]
    (tmp_path / "rows.json").write_text("\n".join(map(json.dumps, rows)))
    bodies = read_wrapped(spark, str(tmp_path)).orderBy(*RECORD_ORDER).select(F.to_json("record").alias("j"))
    assert [r.j for r in bodies.collect()] == ['{"source_id":"a"}', "{}"]


def test_sample_takes_the_front(spark, folder):
    path = write_pages(folder, "w", [[worker(i) for i in range(p * 4, p * 4 + 4)] for p in range(8)])
    records = read_pages(spark, path)
    assert ids(first_records(records, 6)) == [f"w-{i}" for i in range(6)]
    assert first_records(records, 500).count() == 32


def test_page_numbers_sort_by_value_in_a_path_with_blanks(spark, tmp_path):
    folder = tmp_path / "a dump #1"
    folder.mkdir()
    for n in (1, 2, 10, 9):
        (folder / f"page-{n}.json").write_text(json.dumps({"data": [worker(n)]}))
    records = read_pages(spark, str(folder))
    assert ids(records) == ["w-1", "w-2", "w-9", "w-10"]
    assert ids(first_records(records, 2)) == ["w-1", "w-2"]


def test_unconfigured_source_is_empty(spark):
    frame = no_records(spark)
    assert frame.count() == 0 and "record" in frame.columns


def test_sources_refuse_entities_they_do_not_own():
    with pytest.raises(NotImplementedError):
        WORKDAY.mapping("job_applications")
    with pytest.raises(NotImplementedError):
        GREENHOUSE.mapping("employees")
    assert set(AIRTABLE.mappings) == {"employees", "job_applications"}
    assert list(SOURCES) == ["workday", "greenhouse", "airtable"]


def test_worker_fields_are_renamed_and_unknown_ones_dropped(spark):
    mapped = map_workers(record_frame(spark, [worker(1, ssn="1", Termination_Date=...)]), ["k"])
    assert "ssn" not in mapped.columns and "source_id" in mapped.columns
    row = mapped.select(
        F.variant_get("source_id", "$", "string").alias("id"),
        F.col("termination_date").isNull().alias("missing"),
        F.is_variant_null("performance_rating").alias("null"),
    ).first()
    assert (row.id, row.missing, row.null) == ("w-1", True, False)


@pytest.mark.parametrize(
    "status, stage",
    [
        ("active", "applied"), ("submitted", "applied"), ("phone_screen", "phone_screen"),
        ("interviewing", "interview"), ("offer_extended", "offer"), ("hired", "hired"),
        ("rejected", "rejected"), ("brand_new", "applied"), (None, "applied"), (..., "applied"),
        (5, "applied"),
    ],
)
def test_status_to_stage(spark, status, stage):
    mapped = map_applications(record_frame(spark, [application(1, status=status)]))
    assert mapped.first().stage == stage


def test_last_activity_falls_back_only_when_missing(spark):
    records = [application(1), application(2, last_activity_at=...), application(3, last_activity_at=None)]
    changed = F.col("stage_changed_at")
    rows = (
        map_applications(record_frame(spark, records), ["k"])
        .select("k", F.variant_get(changed, "$", "string").alias("at"), F.is_variant_null(changed).alias("n"))
        .orderBy("k")
        .collect()
    )
    assert [r.at for r in rows] == ["2024-02-01T12:00:00", "2024-01-01T12:00:00", None]
    assert [r.n for r in rows] == [False, False, True]


def test_employment_type_default_is_for_missing_keys(spark):
    records = [{"source_id": "a"}, {"employment_type": None}, {"employment_type": "contractor"}]
    kind = F.col("employment_type")
    rows = (
        map_wrapped_employees(record_frame(spark, records), ["k"])
        .select("k", F.variant_get(kind, "$", "string").alias("t"))
        .orderBy("k")
        .collect()
    )
    assert [r.t for r in rows] == ["full_time", None, "contractor"]
