import datetime as dt
import uuid

import pytest

from rosterlake.operators.tables import create_schema
from rosterlake.session import local_session

AS_OF = dt.date(2024, 3, 15)
RUN_TS = dt.datetime(2024, 3, 15, 6, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="session")
def spark():
    return local_session(4, memory="4g", partitions=4)


@pytest.fixture()
def folder(spark, tmp_path):
    """Scratch folder for tables a test writes."""
    return str(tmp_path)


@pytest.fixture()
def schema(spark, tmp_path):
    """Catalog schema for tables a test writes."""
    name = f"t_{uuid.uuid4().hex}"
    create_schema(spark, name, str(tmp_path / name))
    yield name
    spark.sql(f"drop schema {name} cascade")


@pytest.fixture()
def raw(schema):
    """Name of a raw table."""
    return f"{schema}.employees"
