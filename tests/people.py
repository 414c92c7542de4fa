"""Hand-made records for the tests."""

from __future__ import annotations

import json

from pyspark.sql import functions as F


def worker(i: int = 1, **changes) -> dict:
    """Source-native worker; a change to ``...`` removes the key."""
    record = {
        "Worker_ID": f"w-{i}",
        "Legal_First_Name": "Ada",
        "Legal_Last_Name": "Byron",
        "Work_Email": f"ada{i}@example.com",
        "Cost_Center": "Data",
        "Job_Title": "Engineer",
        "Hire_Date": "2023-01-10",
        "Termination_Date": None,
        "Worker_Type": "full_time",
        "Management_Level": "IC3",
        "Location": "Dublin, IE",
        "Manager_ID": "m-1",
        "Base_Pay": 120000.5,
        "Performance_Rating": "meets",
    }
    record.update(changes)
    return {k: v for k, v in record.items() if v is not ...}


def application(i: int = 1, **changes) -> dict:
    record = {
        "id": f"app-{i}",
        "candidate_id": f"cand-{i}",
        "job_id": "JOB-1001",
        "job_title": "Data Engineer",
        "department": "Data",
        "status": "interviewing",
        "applied_at": "2024-01-01T12:00:00",
        "last_activity_at": "2024-02-01T12:00:00",
        "recruiter_id": "rec-1",
    }
    record.update(changes)
    return {k: v for k, v in record.items() if v is not ...}


def employee(i: int = 1, **changes) -> dict:
    """Canonical employee as it stands in a raw payload."""
    record = {
        "source_id": f"e-{i}",
        "first_name": "Ada",
        "last_name": "Byron",
        "email": f"e{i}@example.com",
        "department": "Data",
        "job_title": "Engineer",
        "hire_date": "2023-01-10",
        "termination_date": None,
        "manager_id": None,
        "employment_type": "full_time",
        "level": "IC3",
        "location": "Dublin, IE",
        "salary": "100000.25",
        "performance_rating": None,
    }
    record.update(changes)
    return record


def record_frame(spark, records) -> object:
    """``(k, record)`` frame of JSON objects, or of JSON texts as they are."""
    rows = [(k, r if isinstance(r, str) else json.dumps(r)) for k, r in enumerate(records)]
    frame = spark.createDataFrame(rows, "k bigint, body string")
    return frame.select("k", F.parse_json("body").alias("record"))


def raw_frame(spark, rows) -> object:
    """Raw rows from ``(source, payload, ingested_at)``."""
    data = [(s, p["source_id"], json.dumps(p), t) for s, p, t in rows]
    frame = spark.createDataFrame(data, "source string, source_id string, payload string, t string")
    return frame.withColumn("ingested_at", F.col("t").cast("timestamp")).drop("t")


def write_pages(folder: str, name: str, pages: list[list[dict]], indent: int | None = None) -> str:
    """One file per page."""
    import os

    path = f"{folder}/{name}"
    os.makedirs(path)
    for n, page in enumerate(pages):
        body = {"data": page, "_links": {}} if page is not None else {"_links": {}}
        with open(f"{path}/page-{n:04d}.json", "w", encoding="utf-8") as out:
            json.dump(body, out, indent=indent)
    return path
