import pytest
from pyspark.sql import functions as F

from rosterlake.operators import tables
from workloads.queries import QUERIES


def numbers(spark, n):
    return spark.range(n).toDF("n")


def refuse(_):
    raise ValueError("no")


def test_failed_check_leaves_the_table(spark, schema):
    name = f"{schema}.numbers"
    tables.replace(numbers(spark, 3), name)
    for _ in range(3):
        with pytest.raises(ValueError):
            tables.replace(numbers(spark, 9), name, refuse)
    assert spark.table(name).count() == tables.read(spark, name).count() == 3
    assert len(tables.versions(spark, name)) == 1


def test_failed_job_leaves_the_table(spark, schema):
    name = f"{schema}.numbers"
    tables.replace(numbers(spark, 3), name)
    with pytest.raises(Exception, match="broken"):
        tables.replace(numbers(spark, 3).select(F.raise_error(F.lit("broken")).cast("long").alias("n")), name)
    assert tables.read(spark, name).count() == 3 and len(tables.versions(spark, name)) == 1


def test_the_later_of_two_writers_fails(spark, schema):
    name = f"{schema}.numbers"
    tables.replace(numbers(spark, 3), name)
    first, second = tables.write(numbers(spark, 4), name), tables.write(numbers(spark, 5), name)
    first.commit()
    with pytest.raises(tables.Conflict):
        second.commit()
    assert tables.read(spark, name).count() == 4
    tables.replace(numbers(spark, 6), name)
    assert tables.read(spark, name).count() == 6


def test_readers_of_the_version_before_go_on(spark, schema):
    name = f"{schema}.numbers"
    tables.replace(numbers(spark, 3), name)
    planned = spark.table(name).selectExpr("n + 1 AS n")
    tables.replace(numbers(spark, 4), name)
    assert planned.count() == 3


def test_tables_with_like_names_are_apart(spark, schema):
    tables.replace(numbers(spark, 3), f"{schema}.a")
    tables.replace(numbers(spark, 4), f"{schema}.a_b")
    tables.replace(numbers(spark, 5), f"{schema}.a__version")
    assert [len(tables.versions(spark, f"{schema}.{n}")) for n in ("a", "a_b", "a__version")] == [1, 1, 1]
    assert tables.read(spark, f"{schema}.a").count() == 3


def test_schemas_keep_their_place(spark, schema, tmp_path):
    tables.create_schema(spark, schema, str(tmp_path / schema))
    with pytest.raises(ValueError, match="lies in"):
        tables.create_schema(spark, schema, str(tmp_path / "elsewhere"))
    numbers(spark, 2).write.parquet(str(tmp_path / "left" / "numbers"))
    with pytest.raises(tables.UnknownData):
        tables.create_schema(spark, "t_lost", str(tmp_path / "left"))
    assert tables.read(spark, f"{schema}.none", numbers(spark, 0).schema).count() == 0
    with pytest.raises(FileNotFoundError):
        tables.read(spark, f"{schema}.none")


def rows_scanned(df):
    """Rows that the scan of a finished query handed on."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().length() or node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        node = node.executedPlan() if "Adaptive" in node.getClass().getSimpleName() else node.children().head()
    return node.metrics().apply("numOutputRows").value()


def test_clustered_table_skips_other_months(spark, schema):
    name = f"{schema}.daily"
    days = spark.range(120_000).selectExpr(
        "date_add(DATE'2023-01-01', cast(hash(id) % 360 as int)) AS date", "id % 7 AS level", "id AS headcount"
    )
    tables.replace(days, name, clustered=("date", "level"))
    month = tables.read(spark, name).where("date BETWEEN DATE'2023-03-01' AND DATE'2023-03-31'")
    wanted = month.count()
    month = tables.read(spark, name).where("date BETWEEN DATE'2023-03-01' AND DATE'2023-03-31'")
    assert 0 < wanted <= rows_scanned(month) < 60_000  # of 120,000
    tables.replace(days, f"{schema}.mixed")
    mixed = tables.read(spark, f"{schema}.mixed").where("date BETWEEN DATE'2023-03-01' AND DATE'2023-03-31'")
    assert rows_scanned(mixed) == 120_000


@pytest.mark.parametrize(
    "name",
    ["fct_attrition_monthly", "attrition_corrected", "left_join_terminations", "serve_decimals", "rolling_12m", "sorted_report"],
)
def test_attrition_stages_employees_once(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("json_tuple") == 1
    assert sum("row_number" in line and "Window [" in line for line in plan.splitlines()) == 1
